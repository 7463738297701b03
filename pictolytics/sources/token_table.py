"""A stored token table, so that many questions read narrow columns instead of cutting texts again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_token_table(tokens: DataFrame, path: str, time: str = "time", mode: str = "overwrite") -> str:
    """Write tokens to parquet by ``token_date``, without the text they came from.

    A rerun replaces the dates it writes and leaves the others; ``mode="append"`` adds to them.

    The rebalance hint makes files of even size: it splits a date that holds much of the data and
    gathers the small ones, which a plain repartition by date would not.
    """
    dated = tokens.drop("text").withColumn("token_date", F.to_date(time))
    dated.hint("rebalance", "token_date").write.partitionBy("token_date").option(
        "partitionOverwriteMode", "dynamic"
    ).mode(mode).parquet(path)
    return path


def read_token_table(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored tokens, of the dates from ``first`` to ``last`` only where these are given."""
    tokens = spark.read.parquet(path)
    if first is not None:
        tokens = tokens.where(F.col("token_date") >= F.lit(first).cast("date"))
    if last is not None:
        tokens = tokens.where(F.col("token_date") <= F.lit(last).cast("date"))
    return tokens
