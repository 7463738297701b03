"""From posts to one row per token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.functions.patterns import PRESENTATION_SELECTOR
from pictolytics.functions.text import (
    base_emoji,
    emoji_tokens,
    is_repost,
    strip_presentation,
    tone_of,
    word_tokens,
)


def select_posts(
    posts: DataFrame,
    lang: str | None = None,
    keep_reposts: bool = False,
    repost_prefix: str = "RT",
) -> DataFrame:
    """Original posts, optionally of one language. Both filters reach the scan."""
    if not keep_reposts:
        posts = posts.where(~is_repost(F.col("text"), repost_prefix))
    if lang is not None:
        posts = posts.where(F.col("lang") == lang)
    return posts


def explode_emoji(
    posts: DataFrame,
    normalize: str = "strip_vs",
    per_post: bool = False,
    text: str = "text",
) -> DataFrame:
    """Add an ``emoji`` column, one row per occurrence, or per post and emoji with ``per_post``.

    ``normalize`` is ``"strip_vs"`` (count both spellings as one) or ``"none"``. Posts without
    emoji give no row. The step is narrow: the text is read, cut and dropped in one stage.
    """
    if normalize not in ("strip_vs", "none"):
        raise ValueError(f"unknown normalization {normalize!r}")
    strip = normalize == "strip_vs"
    if per_post:
        return posts.select("*", F.explode(distinct_emoji(F.col(text), strip)).alias("emoji"))
    rows = posts.select("*", F.explode(emoji_tokens(F.col(text))).alias("emoji"))
    return rows.withColumn("emoji", strip_presentation(F.col("emoji"))) if strip else rows


def distinct_emoji(text: Column, strip: bool = True) -> Column:
    """The different emoji of one text."""
    found = emoji_tokens(text)
    return F.array_distinct(F.transform(found, strip_presentation) if strip else found)


def explode_words(posts: DataFrame, per_post: bool = False, text: str = "text") -> DataFrame:
    """Add a ``word`` column, one row per whitespace-separated word, or per post and word.

    Outer, so that no filter on the words is made up and pushed below, which would cut every text twice.
    """
    words = word_tokens(F.col(text))
    rows = posts.select("*", F.explode_outer(F.array_distinct(words) if per_post else words).alias("word"))
    return rows.where(F.col("word").isNotNull())


def split_tone(tokens: DataFrame, token: str = "emoji") -> DataFrame:
    """Add ``base_emoji`` and ``tone`` (empty where the emoji has no skin tone)."""
    return tokens.withColumns({"base_emoji": base_emoji(F.col(token)), "tone": tone_of(F.col(token))})


def any_variant(tokens: DataFrame, pattern: str, token: str = "emoji") -> DataFrame:
    """Tokens that match a regular expression, such as a base emoji or several of them."""
    return tokens.where(F.col(token).rlike(pattern))


def explode_variants(posts: DataFrame, base: str, per_post: bool = True, text: str = "text") -> DataFrame:
    """The emoji that contain a base emoji, such as all tones of one gesture; see ``any_variant`` for a pattern.

    Only texts with the base's first character are cut, a plain substring test for all others.
    """
    possible = posts.where(F.contains(F.col(text), F.lit(base[0])))
    tokens = explode_emoji(possible, per_post=per_post, text=text)
    return tokens.where(F.contains(F.col("emoji"), F.lit(base.replace(PRESENTATION_SELECTOR, ""))))
