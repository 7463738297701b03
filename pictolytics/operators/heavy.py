"""The most frequent tokens out of an unbounded vocabulary, in memory that does not grow with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.session import stored

#: Tokens that a summary holds at first; its memory is in proportion.
TRACKED = 1 << 14
#: The most that Spark's function holds.
MOST_TRACKED = 1_000_000


def most_used_sketched(tokens: DataFrame, k: int, token: str = "word", name: str = "usage", tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent tokens with their exact counts, ties by token.

    Every task keeps a mergeable summary of ``tracked`` tokens, and these combine into one. A token that the summary
    leaves out occurs in 7 of ``tracked`` rows at most. What it puts forward is counted exactly in a second
    pass. If that leaves open whether the last of the ``k`` is more frequent than all that was left out, the summary is
    doubled and asked again, up to what Spark's function holds; beyond that all tokens are counted. So the result
    is always that of counting all. Null tokens are left out; with fewer than ``k`` tokens all are returned.
    """
    named = tokens.where(F.col(token).isNotNull()).select(F.col(token).alias("token"))
    ranking = [F.desc(name), F.asc("token")]
    asked = tracked
    while asked <= MOST_TRACKED:
        found = F.expr(f"approx_top_k(token, {asked // 2}, {asked})").alias("found")
        summary = stored(named.agg(found, F.count(F.lit(1)).alias("rows")), "summary")
        rows = summary.first()["rows"]
        candidates = summary.select(F.explode("found").alias("r")).select(F.col("r.item").alias("token"))  # half of ``asked``
        counted = named.join(F.broadcast(candidates), "token").groupBy("token").agg(F.count(F.lit(1)).alias(name))
        best = counted.orderBy(*ranking).limit(k)
        counts, covered = [r[name] for r in best.collect()], counted.agg(F.sum(name)).first()[0] or 0
        if covered == rows or (len(counts) == k and counts[-1] > 7 * rows / asked):
            return best.withColumnRenamed("token", token)
        asked *= 2
    counted = named.groupBy("token").agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(*ranking).limit(k).withColumnRenamed("token", token)
