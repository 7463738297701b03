"""Author snapshots and the join of posts with their authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.session import stored

# Ids of posts that have copies: up to so many go to where the posts are.
HELD_IDS = 1_000_000
# A join key with more than this share of all posts is split over several tasks. At most
# 1 / HOT_SHARE keys can qualify, which bounds what is broadcast.
HOT_SHARE = 0.001


def latest_authors(authors: DataFrame, stamp: str = "page_time") -> DataFrame:
    """The newest snapshot per author.

    Without it an author found on k pages would multiply each of their posts by k. Snapshots of
    one author are combined within each task before they are shuffled; equal stamps are told
    apart by the other columns, so a rerun gives the same row.
    """
    rest = [c for c in authors.columns if c not in ("user_id", stamp)]
    newest = F.max(F.struct(stamp, *rest)).alias("newest")
    return authors.groupBy("user_id").agg(newest).select("user_id", *[f"newest.{c}" for c in rest])


def unique_posts(posts: DataFrame, stamp: str = "time", held_ids: int = HELD_IDS) -> DataFrame:
    """One row per post id, the one with the newest stamp.

    Posts without an id are no copies of each other and all stay. The ids are counted first, by a pass over that column.
    Posts whose id occurs once stay where they are; only the copies are shuffled, collapsed before. With more than
    ``held_ids`` repeated ids all posts are.
    """
    rest = [c for c in posts.columns if c not in ("tweet_id", stamp)]

    def newest(rows: DataFrame) -> DataFrame:
        best = F.max(F.struct(stamp, *rest)).alias("newest")
        return rows.groupBy("tweet_id").agg(best).select("tweet_id", "newest.*").select(*posts.columns)

    named = posts.where(F.col("tweet_id").isNotNull())
    repeated = named.groupBy("tweet_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("tweet_id")
    repeated = stored(repeated, "repeated-ids")
    n = repeated.count()
    if n == 0:
        return posts
    if n > held_ids:
        return newest(named).unionByName(posts.where(F.col("tweet_id").isNull()))
    held = F.broadcast(repeated)
    # Rows without an id match nothing, so they stay with the single ones.
    single = posts.join(held, "tweet_id", "left_anti").select(*posts.columns)
    return single.unionByName(newest(named.join(held, "tweet_id", "left_semi")))


def with_authors(posts: DataFrame, authors: DataFrame, how: str = "inner") -> DataFrame:
    """Posts joined with their authors (``inner``, ``left``), or posts that have one (``left_semi``).

    ``authors`` has one row per ``user_id``. No job runs until the result is used: adaptive execution
    broadcasts the authors if their bytes allow it, and splits the partitions of busy authors otherwise.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join {how!r}")
    return posts.join(authors, posts["author_id"] == authors["user_id"], how)


def with_authors_dealt(
    posts: DataFrame, authors: DataFrame, how: str = "inner", hot_share: float = HOT_SHARE
) -> DataFrame:
    """The same join, both sides shuffled and busy authors dealt over pieces by hand.

    For sessions without adaptive execution, or where one author's posts outgrow what it splits. Authors
    with more than ``hot_share`` of all posts have their posts dealt by post id and their author row repeated
    once per piece, at the cost of one count over the ``author_id`` column. All others keep a single piece.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join {how!r}")
    hot = _hot_authors(posts, hot_share)
    # Posts without an author match nothing; a left join keeps them, dealt like those of a hot author.
    dealt_over = F.when(F.col("author_id").isNull(), F.lit(round(1 / hot_share))).otherwise(F.col("pieces"))
    piece = F.coalesce(F.pmod(F.xxhash64("tweet_id"), dealt_over), F.lit(0).cast("bigint"))
    pieces = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("pieces") - 1, F.lit(0).cast("bigint")))
    dealt = (
        posts.join(F.broadcast(hot), posts["author_id"] == hot["hot_id"], "left")
        .withColumn("post_piece", piece)
        .drop("hot_id", "pieces")
    )
    repeated = (
        authors.join(F.broadcast(hot), authors["user_id"] == hot["hot_id"], "left")
        .withColumn("author_piece", F.explode(pieces))
        .drop("hot_id", "pieces")
    )
    same = (F.col("author_id") == F.col("user_id")) & (F.col("post_piece") == F.col("author_piece"))
    return dealt.join(repeated.hint("merge"), same, how).drop("post_piece", "author_piece")


def _hot_authors(posts: DataFrame, hot_share: float) -> DataFrame:
    """``hot_id`` and the number of ``pieces`` for the authors above the share."""
    load = posts.where(F.col("author_id").isNotNull()).groupBy("author_id").agg(F.count(F.lit(1)).alias("n"))
    portion = load.agg(F.sum("n")).scalar() * F.lit(hot_share)
    return load.where(F.col("n") > portion).select(
        F.col("author_id").alias("hot_id"),
        F.ceil(F.col("n") / portion).cast("bigint").alias("pieces"),
    )


def usage_by_followed(tokens: DataFrame, authors: DataFrame, threshold: int, token: str, name: str) -> DataFrame:
    """Token counts over the posts of authors with more than ``threshold`` followers.

    Tokens are first counted per author, so the join moves one row per author and token instead
    of one per post, however active an author is. The threshold filters the author scan.
    """
    followed = authors.where(F.col("followers_count") > threshold).select("user_id")
    per_author = tokens.groupBy("author_id", token).agg(F.count(F.lit(1)).alias("n"))
    joined = per_author.join(followed, per_author["author_id"] == followed["user_id"], "left_semi")
    return joined.groupBy(token).agg(F.sum("n").alias(name))
