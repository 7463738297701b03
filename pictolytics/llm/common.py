"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pictolytics.session import shared_dir

# The letters that contracts lower-case; all others stay as they are.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character untouched.

    A text with as many bytes as characters is pure ASCII, where ``lower`` does the same, faster.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """Write into the shared folder and read again: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_place(df: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """The columns named by their place, so that no name of a caller's clashes, and the new names of ``used``."""
    places = [f"_col{i}" for i in range(len(df.columns))]
    return df.toDF(*places), [places[df.columns.index(name)] for name in used]


def by_name(df: DataFrame, names: list[str], *new: str) -> DataFrame:
    """The columns of ``by_place`` under their names again, then ``new`` ones, which replace those of their name."""
    kept = [F.col(f"_col{i}").alias(name) for i, name in enumerate(names) if name not in new]
    return df.select(*kept, *new)
