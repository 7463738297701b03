"""Who uses which emoji, when, and with what effect. Every function returns a lazy DataFrame."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.functions.patterns import TONE_PATTERN
from pictolytics.functions.time import weekday_name
from pictolytics.operators import authors as A
from pictolytics.operators import counts as C
from pictolytics.operators import sampling as S
from pictolytics.operators import tokens as T

# What the three time profiles call their columns.
TIME_PROFILES = {
    "daily": ("day", "popularity"),
    "hourly": ("hour", "occurrence"),
    "dailyAndHourly": ("day_hour", "n"),
    "date": ("date", "n"),
}


def emoji_of(
    posts: DataFrame,
    lang: str | None = None,
    keep_reposts: bool = False,
    known_authors: DataFrame | None = None,
    per_post: bool = False,
    normalize: str = "strip_vs",
    repost_prefix: str = "RT",
) -> DataFrame:
    """The emoji table: one row per emoji of the chosen posts, with all columns of its post.

    ``known_authors`` keeps only posts of these authors. Author columns are not added, so no
    author can multiply a post.
    """
    chosen = T.select_posts(posts, lang, keep_reposts, repost_prefix)
    if known_authors is not None:
        chosen = A.with_authors(chosen, known_authors.select("user_id").distinct(), "left_semi")
    return T.explode_emoji(chosen, normalize, per_post)


def most_used(tokens: DataFrame, token: str = "emoji", limit: int | None = None) -> DataFrame:
    """Most used tokens, ties in token order. ``limit`` makes it a top-k report."""
    ranked = C.count_by(tokens, [token], "usage").orderBy(F.desc("usage"), token)
    return ranked.limit(limit) if limit else ranked


def most_used_by_time(tokens: DataFrame, profile: str = "dailyAndHourly", token: str = "emoji") -> DataFrame:
    """The most used token of every weekday, hour, both, or calendar date; ties are kept."""
    if profile not in TIME_PROFILES:
        raise ValueError(f"profile must be one of {list(TIME_PROFILES)}, not {profile!r}")
    grain, name = TIME_PROFILES[profile]
    best = C.winners_by_time(tokens, grain, token, name)
    return named_days(best.orderBy(*C.GRAINS[grain], token))


def most_used_by_every_grain(tokens: DataFrame, token: str = "emoji") -> DataFrame:
    """The first three time profiles in one result and one pass."""
    best = C.winners_of_all_grains(tokens, token)
    return named_days(best.orderBy("grain", "day_of_week", "hour", token)).select(
        "grain", "day_of_week", "hour", token, "n"
    )


def compare_languages(tokens: DataFrame, first: str, second: str, token: str = "emoji") -> DataFrame:
    """Totals of two languages side by side, by the first language's use."""
    compared = C.two_groups(tokens, "lang", first, second, token)
    return compared.orderBy(F.desc_nulls_last(f"{first}_total"), F.desc_nulls_last(f"{second}_total"), token)


def compare_language_shares(tokens: DataFrame, first: str, second: str, token: str = "emoji") -> DataFrame:
    """Shares within each language and their ratio: what is typical of the first one."""
    shares = C.with_shares(C.two_groups(tokens, "lang", first, second, token), first, second)
    return shares.orderBy(F.desc_nulls_first("share_ratio"), token)


def average_engagement(
    tokens: DataFrame, likes: bool = True, min_support: int = 10, token: str = "emoji"
) -> DataFrame:
    """Average likes, or reposts, of the posts a token occurs in."""
    measure, name = ("like_count", "average_likes") if likes else ("retweet_count", "average_retweets")
    return C.average_by(tokens, token, measure, name, min_support).orderBy(F.desc(name), token)


def used_by_followed_authors(posts: DataFrame, authors: DataFrame, threshold: int) -> DataFrame:
    """Emoji used by authors above a follower threshold, each counted once per post.

    ``posts`` has one row per post, see ``operators.authors.unique_posts``.
    """
    tokens = T.explode_emoji(posts, per_post=True)
    return A.usage_by_followed(tokens, authors, threshold, "emoji", "total").orderBy(F.desc("total"), "emoji")


def variants_of(posts: DataFrame, base: str, regex: bool = False) -> DataFrame:
    """Variants of a base emoji, each counted once per post, with base and tone told apart.

    With ``regex``, ``base`` is a regular expression, and every emoji it is found in counts.
    """
    if regex:
        found = T.any_variant(T.explode_emoji(posts, per_post=True), base)
    else:
        found = T.explode_variants(posts, base)
    totals = T.split_tone(C.count_by(found, ["emoji"], "total"))
    return totals.orderBy(F.desc("total"), "emoji")


def tone_breakdown(tokens: DataFrame) -> DataFrame:
    """How often each base emoji that takes a skin tone is used with which one."""
    totals = C.count_by(tokens, ["emoji"], "total")
    toned = totals.where(F.col("emoji").rlike(TONE_PATTERN))
    split = T.split_tone(toned)
    return split.groupBy("base_emoji", "tone").agg(F.sum("total").alias("total"))


def historical_sample(
    posts: DataFrame,
    now: datetime | Column,
    step_minutes: int = 30,
    span_days: int = 7,
    per_slot: int = 100,
    bounded: bool = True,
) -> DataFrame:
    """The newest posts of each slot (``bounded``), or before each slot end however old they are.

    Only ids and times are ranked. Join the result with the posts on ``tweet_id`` for the rest.
    """
    narrow = posts.select("tweet_id", "time")
    kept = S.newest_per_slot(S.assign_slots(narrow, now, step_minutes, span_days), per_slot)
    grid = S.slot_grid(posts.sparkSession, now, step_minutes, span_days)
    if not bounded:
        kept = S.newest_before_end(kept, grid, per_slot)
    ends = grid.select("slot", "slot_end")
    return kept.join(ends, "slot").select("slot", "slot_end", "position", "tweet_id", "time")


def named_days(df: DataFrame) -> DataFrame:
    if "day_of_week" not in df.columns:
        return df
    return df.withColumn("day_of_week", weekday_name(F.col("day_of_week")))
