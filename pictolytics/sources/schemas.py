"""Explicit schemas of the two JSON shapes; nothing is inferred by an extra pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The fields of the public JSON and the names of the flat columns.
_POST = """
    struct<author_id: string, created_at: string, id: string, lang: string, text: string, withheld: string,
           public_metrics: struct<like_count: bigint, quote_count: bigint, reply_count: bigint,
                                  retweet_count: bigint>>
"""
_USERS = """
    struct<users: array<struct<id: string, name: string, username: string,
                               public_metrics: struct<followers_count: bigint, following_count: bigint,
                                                      tweet_count: bigint, listed_count: bigint>>>>
"""

# A page holds an array of posts, a record a single one; both carry an array of authors.
PAGE = f"data array<{_POST}>, includes {_USERS}, meta struct<next_token: string, result_count: bigint>"
RECORD = f"data {_POST}, includes {_USERS}"

POST_COLUMNS = [
    "tweet_id",
    "author_id",
    "time",
    "lang",
    "like_count",
    "quote_count",
    "reply_count",
    "retweet_count",
    "text",
]
AUTHOR_COLUMNS = [
    "user_id",
    "name",
    "username",
    "followers_count",
    "following_count",
    "tweet_count",
    "listed_count",
]
POST_METRICS = ["like_count", "quote_count", "reply_count", "retweet_count"]
AUTHOR_METRICS = ["followers_count", "following_count", "tweet_count", "listed_count"]


def infer_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> str:
    """Development aid: the DDL that Spark would infer from the files under ``path``."""
    found = spark.read.option("samplingRatio", sampling_ratio).json(path)
    return schema_ddl(found)


def schema_ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
