"""How a ranking changes from date to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Pieces that the tokens of a date are ranked in first.
PIECES = 64


def top_per_date(counts: DataFrame, k: int, token: str = "emoji", name: str = "n") -> DataFrame:
    """``date``, ``rank`` (1 to ``k``), token and count; of equal counts the first token in order ranks higher.

    Each piece of a date's tokens keeps its best ``k``, so no task ranks all tokens of a date.
    """
    best = [F.desc(name), F.asc(token)]
    piece = F.pmod(F.xxhash64(token), F.lit(PIECES)).alias("piece")
    in_piece = F.row_number().over(W.partitionBy("date", "piece").orderBy(*best))
    few = counts.select("date", token, name, piece).withColumn("rank", in_piece).where(F.col("rank") <= k)
    rank = F.row_number().over(W.partitionBy("date").orderBy(*best))
    return few.withColumn("rank", rank).where(F.col("rank") <= k).select("date", "rank", token, name)


def rank_changes(counts: DataFrame, k: int = 10, token: str = "emoji", name: str = "n") -> DataFrame:
    """``date``, token, ``change`` (enters, leaves, up, down, same), ``rank``, ``before`` and count, from date to date.

    ``counts`` has one row per date and token. A date is compared with the last one before it that has any token,
    however long ago; on the first date every token enters. A token that leaves has no rank and no count. Histories are
    ordered per token over at most ``k`` rows per date, never over a whole date.
    """
    top = top_per_date(counts, k, token, name)
    # One row per date, which the calendar bounds.
    days = counts.select("date").where(F.col("date").isNotNull()).distinct()
    numbered = days.select("date", F.row_number().over(W.orderBy("date")).alias("day"))
    top = top.join(F.broadcast(numbered), "date")
    own = W.partitionBy(token).orderBy("day")
    told = top.withColumns({"last": F.lag("day").over(own), "last_rank": F.lag("rank").over(own), "next": F.lead("day").over(own)})
    before = F.when(F.col("last") == F.col("day") - 1, F.col("last_rank"))
    moved = F.when(before.isNull(), "enters").when(before > F.col("rank"), "up").when(before < F.col("rank"), "down").otherwise("same")
    stays = told.select("date", token, moved.alias("change"), "rank", before.alias("before"), name)
    gone = told.where(F.col("next").isNull() | (F.col("next") > F.col("day") + 1))
    gone = gone.select((F.col("day") + 1).alias("day"), token, F.col("rank").alias("before"))
    gone = gone.join(F.broadcast(numbered), "day")  # after the last date nobody can tell
    none = [F.lit("leaves").alias("change"), F.lit(None).cast("int").alias("rank")]
    left = gone.select("date", token, *none, "before", F.lit(None).cast("bigint").alias(name))
    return stays.unionByName(left)
