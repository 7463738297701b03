"""Posts and authors derived from the given tables, which hold no emoji of their own.

Every event is a post: it takes the whole text of one document and gets emoji added by rule.
Every customer is an author. The column expressions are plain SQL, so that another engine can
evaluate the very same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pictolytics.sources.schemas import AUTHOR_COLUMNS, POST_COLUMNS

# The emoji that posts get; plain, with selector, toned, flag, joined, keycap, tagged flag.
PALETTE = "😂,❤️,👍,🙏,🙏🏻,🙏🏽,🙏🏿,🇪🇸,👩‍💻,1️⃣,☝🏽,🎉,😍,🤣,👍🏾,🏴󠁧󠁢󠁳󠁣󠁴󠁿"

_SECOND = f"split_part('{PALETTE}', ',', CAST((event_id + length(event_type)) % 5 + 1 AS INT))"

POST_EXPRESSIONS = {
    "tweet_id": "event_id",
    "author_id": "user_id",
    "time": "CAST(ts AS TIMESTAMP)",
    "lang": "lang",
    "like_count": "CAST(floor(value * 10) AS BIGINT)",
    "quote_count": "event_id % 13",
    "reply_count": "event_id % 29",
    "retweet_count": "(event_id * 7) % 97",
    "text": (
        "CASE WHEN event_id % 7 = 0 THEN 'RT @x: ' ELSE '' END || text || ' ' || "
        f"split_part('{PALETTE}', ',', CAST((event_id * 7 + user_id) % 16 + 1 AS INT)) || ' and ' || "
        f"{_SECOND} || CASE WHEN event_id % 3 = 0 THEN {_SECOND} ELSE '' END"
    ),
}

AUTHOR_EXPRESSIONS = {
    "user_id": "c_custkey",
    "name": "c_name",
    "username": "lower(c_name)",
    "followers_count": "CAST(floor(abs(c_acctbal) * 100) AS BIGINT)",
    "following_count": "c_custkey % 500",
    "tweet_count": "(c_custkey * 37) % 10000",
    "listed_count": "c_custkey % 11",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return _posts(table(spark, folder, "events"), table(spark, folder, "documents"))


def post_heads(spark: SparkSession, folder: str) -> DataFrame:
    """The posts before they get their text and language: what is joined or dealt by a narrow key moves no text.

    ``_event`` holds what ``with_texts`` needs to give them both.
    """
    names = [c for c in POST_COLUMNS if c not in ("lang", "text")]
    dealt = _dealt(table(spark, folder, "events"), table(spark, folder, "documents"))
    event = F.struct("doc_id", "event_id", "user_id", "event_type").alias("_event")
    return dealt.select(*[F.expr(POST_EXPRESSIONS[n]).alias(n) for n in names], event)


def with_texts(heads: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """``post_heads``, or rows that these were joined into, as whole posts; further columns follow those of the post.

    The rows come to the texts: a document is moved once, however many posts take it.
    """
    further = [c for c in heads.columns if c not in (*POST_COLUMNS, "_event")]
    kept = [c for c in POST_COLUMNS if c in heads.columns]
    # Under other names, so that those of the event and the document are free for the expressions.
    held = heads.select("_event", *[F.col(c).alias(f"_held_{c}") for c in (*kept, *further)])
    texts = table(spark, folder, "documents").select("doc_id", "text", "lang").hint("merge")
    found = held.join(texts, F.col("_event.doc_id") == texts["doc_id"])
    named = found.select("_event.*", "text", "lang", *[f"_held_{c}" for c in (*kept, *further)])
    whole = [(F.col(f"_held_{n}") if n in kept else F.expr(POST_EXPRESSIONS[n])).alias(n) for n in POST_COLUMNS]
    return named.select(*whole, *[F.col(f"_held_{n}").alias(n) for n in further])


def text_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all posts' texts, about: as if every document were taken equally often."""
    events, documents = table(spark, folder, "events"), table(spark, folder, "documents")
    return round(events.count() * (documents.agg(F.avg(F.octet_length("text"))).first()[0] or 0))


def post_times(spark: SparkSession, folder: str) -> DataFrame:
    """Ids, authors and times of the posts, which need no document: each post has one."""
    names = ["tweet_id", "author_id", "time"]
    return table(spark, folder, "events").selectExpr(*_aliased(POST_EXPRESSIONS, names))


def post_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same posts with the events read as a stream and the documents as a static side."""
    schema = table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return _posts(events, table(spark, folder, "documents"))


def authors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*_aliased(AUTHOR_EXPRESSIONS, AUTHOR_COLUMNS))


def _dealt(events: DataFrame, documents: DataFrame) -> DataFrame:
    # Documents are numbered from 0 without gaps, so the remainder deals the events evenly over all.
    n_documents = documents.agg(F.count(F.lit(1))).scalar()
    return events.withColumn("doc_id", F.col("event_id") % n_documents)


def _posts(events: DataFrame, documents: DataFrame) -> DataFrame:
    dealt = _dealt(events, documents)
    # Both sides grow with the data, so neither is broadcast: the join deals the texts over all tasks.
    texts = documents.select("doc_id", "text", "lang").hint("merge")
    return dealt.join(texts, "doc_id").selectExpr(*_aliased(POST_EXPRESSIONS, POST_COLUMNS))


def _aliased(expressions: dict[str, str], names: list[str]) -> list[str]:
    return [f"{expressions[name]} AS {name}" for name in names]
