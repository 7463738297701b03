"""Running counts over a stream of posts. Columns are those of the batch twins.

No post is lost by default: copies are remembered for ever, as the plain definition of distinct asks, at
the cost of one key per post in the state. With a ``delay`` the state is bounded, and Spark drops the posts
that come later than that after newer ones; ``run.totals_so_far`` tells how many those were. Posts without
an id are no copies of each other and all count.

Reposts and languages are chosen beforehand with ``operators.tokens.select_posts``, as in batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.functions.patterns import PRESENTATION_SELECTOR
from pictolytics.functions.text import emoji_tokens, strip_presentation
from pictolytics.operators.tokens import distinct_emoji, explode_emoji, select_posts


def live_famous(posts: DataFrame, threshold: int, delay: str | None = None) -> DataFrame:
    """Totals per emoji over the posts of authors with more than ``threshold`` followers.

    ``posts`` carries ``followers_count`` of its author, as a flattened record does.
    """
    followed = posts.where(F.col("followers_count") > threshold)
    return _totals(_emoji_once_per_post(followed, delay))


def live_variants(posts: DataFrame, base: str, delay: str | None = None, regex: bool = False) -> DataFrame:
    """Totals per variant of a base emoji, or per emoji that a regular expression finds (``regex``)."""
    if regex:
        return _totals(_emoji_once_per_post(posts, delay, lambda e: e.rlike(base)))
    possible = posts.where(F.contains(F.col("text"), F.lit(base[0])))
    plain = base.replace(PRESENTATION_SELECTOR, "")
    tokens = _emoji_once_per_post(possible, delay, lambda e: F.contains(e, F.lit(plain)))
    return _totals(tokens)


def live_windows(posts: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Occurrences per emoji and time window of original posts; late posts count up to ``delay``.

    In append mode a window appears once it is closed, that is when the newest post is more
    than ``delay`` past its end.
    """
    originals = select_posts(posts).withWatermark("time", delay)
    counted = (
        explode_emoji(originals).groupBy(F.window("time", width), "emoji").agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select("window.start", "window.end", "emoji", "n").withColumnsRenamed(
        {"start": "window_start", "end": "window_end"}
    )


def live_windows_open(posts: DataFrame, seconds: int = 3600, once: bool = False) -> DataFrame:
    """Occurrences per emoji and window of a fixed length, open windows too, however late a post is.

    Totals for ``run.totals_so_far``. ``once`` removes copies of a post id first; the text is cut before that.
    """
    originals = select_posts(posts).where(F.col("time").isNotNull())
    micros = seconds * 1_000_000
    start = F.timestamp_micros(F.unix_micros("time") - F.pmod(F.unix_micros("time"), F.lit(micros))).alias("window_start")
    if once:
        found = F.transform(emoji_tokens(F.col("text")), strip_presentation).alias("found")
        narrow = _one_per_id(originals.select("tweet_id", "time", found), None)
        tokens = narrow.select("time", F.explode_outer("found").alias("emoji")).where(F.col("emoji").isNotNull())
    else:
        tokens = explode_emoji(originals)
    return tokens.groupBy(start, "emoji").agg(F.count(F.lit(1)).alias("n"))


def live_winners(posts: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """The most used emoji of every closed time window: ``window_start``, ``window_end``, ``emoji``, ``n``.

    Two aggregations in a row under one watermark, in append mode: occurrences per emoji and window, then the best of
    each window. Of equally frequent emoji the first in order wins. State is a row per open window and emoji.
    """
    originals = select_posts(posts).withWatermark("time", delay)
    counted = explode_emoji(originals).groupBy(F.window("time", width), "emoji").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct((-F.col("n")).alias("less"), F.col("emoji"))).alias("best")
    best = counted.groupBy("window").agg(least)
    return best.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "best.emoji", (-F.col("best.less")).alias("n")
    )


def cut_once(posts: DataFrame, keep=None) -> DataFrame:
    """``tweet_id``, ``time`` and the different emoji of each post, for ``run.totals_into``."""
    found: Column = distinct_emoji(F.col("text"))
    return posts.select("tweet_id", "time", (found if keep is None else F.filter(found, keep)).alias("found"))


def _emoji_once_per_post(posts: DataFrame, delay: str | None, keep=None) -> DataFrame:
    """One row per post and emoji.

    The text is cut before copies are removed: what is shuffled by post id is the id, the time
    and the few different emoji of the post.
    """
    # No filter on the found emoji, nor an explode that implies one: it would be pushed below and cut every
    # text twice.
    once = _one_per_id(cut_once(posts, keep), delay)
    tokens = once.select("tweet_id", F.explode_outer("found").alias("emoji"))
    return tokens.where(F.col("emoji").isNotNull())


def _one_per_id(rows: DataFrame, delay: str | None) -> DataFrame:
    """One row per ``tweet_id``; rows without one all stay.

    In one branch, so that the source is read once: a row without an id gets a key of its own.
    """
    own = F.when(F.col("tweet_id").isNull(), F.uuid()).alias("_own")
    keyed = rows.select("*", own)
    key = ["tweet_id", "_own"]
    if delay is None:
        return keyed.dropDuplicates(key).drop("_own")
    return keyed.withWatermark("time", delay).dropDuplicatesWithinWatermark(key).drop("_own")


def _totals(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("emoji").agg(F.count(F.lit(1)).alias("total"))
