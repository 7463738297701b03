"""A stored table of partial aggregates, from which most questions are answered without any text.

One row per date, hour, language and token, with how often it occurs and the sums of likes and reposts. All of it
adds up, so a load writes its own part of the dates it touches and readers add the parts: two loads in turn are as
good as one. A load that is repeated replaces its part, and ``compact_cube`` makes one part of many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pictolytics.functions.time import bucket


def _schema(token: str) -> str:
    """Measures may be null in all posts of a row: ``n_likes`` and ``n_reposts`` count those that are not."""
    counts = ", ".join(f"{n} bigint" for n in ("n", "likes", "n_likes", "reposts", "n_reposts"))
    return f"hour int, lang string, `{token}` string, {counts}, token_date date, load string"


def add_to_cube(tokens: DataFrame, path: str, load: str, token: str = "emoji") -> str:
    """Count the tokens of one load into the cube under ``path``; tokens without a time have no date and are left out.

    ``load`` names the load: the same name again replaces what it wrote to the dates it touches now.
    """
    timed = tokens.where(F.col("time").isNotNull())
    keys = [F.to_date("time").alias("token_date"), bucket("hour", F.col("time")), F.col("lang"), F.col(token)]
    sums = [F.count(F.lit(1)).alias("n")]
    for name, measure in (("likes", "like_count"), ("reposts", "retweet_count")):
        sums += [F.sum(measure).alias(name), F.count(measure).alias(f"n_{name}")]
    counted = timed.groupBy(*keys).agg(*sums).withColumn("load", F.lit(load))
    _write(counted, path)
    return path


def read_cube(spark: SparkSession, path: str, token: str = "emoji") -> DataFrame:
    """The rows of all loads, which readers add up."""
    return spark.read.schema(_schema(token)).parquet(path)


def compact_cube(spark: SparkSession, path: str, into: str, token: str = "emoji", load: str = "compacted") -> str:
    """The cube under ``path`` with one part per date, written to a new folder; the old one stays as it is."""
    keys = ["token_date", "hour", "lang", token]
    sums = [F.sum(n).alias(n) for n in ("n", "likes", "n_likes", "reposts", "n_reposts")]
    _write(read_cube(spark, path, token).groupBy(*keys).agg(*sums).withColumn("load", F.lit(load)), into)
    return into


def _write(counted: DataFrame, path: str) -> None:
    writer = counted.hint("rebalance", "token_date").write.partitionBy("token_date", "load")
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def usage_from_cube(cube: DataFrame, token: str = "emoji") -> DataFrame:
    return cube.groupBy(token).agg(F.sum("n").alias("usage"))


def average_from_cube(cube: DataFrame, likes: bool = True, min_support: int = 10, token: str = "emoji") -> DataFrame:
    """Average likes or reposts of the tokens that occur more than ``min_support`` times."""
    measure, name = ("likes", "average_likes") if likes else ("reposts", "average_retweets")
    whole = cube.groupBy(token).agg(F.sum("n").alias("n"), F.sum(measure).alias("s"), F.sum(f"n_{measure}").alias("c"))
    return whole.where(F.col("n") > min_support).select(token, (F.col("s") / F.col("c")).alias(name))


def counts_from_cube(cube: DataFrame, buckets: list[str], token: str = "emoji", name: str = "n") -> DataFrame:
    """Counts by time buckets, of those that dates and hours make up."""
    by = {"hour": F.col("hour"), "date": F.col("token_date"), "day_of_week": F.dayofweek("token_date")}
    return cube.groupBy(*[by[b].alias(b) for b in buckets], token).agg(F.sum("n").alias(name))


def languages_from_cube(cube: DataFrame, first: str, second: str, token: str = "emoji") -> DataFrame:
    """Totals of two languages side by side, null where a token is missing in one of them."""
    totals = [F.nullif(F.sum(F.when(F.col("lang") == v, F.col("n")).otherwise(0)), F.lit(0)).alias(f"{v}_total") for v in (first, second)]
    return cube.where(F.col("lang").isin(first, second)).groupBy(token).agg(*totals)
