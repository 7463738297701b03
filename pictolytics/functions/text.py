"""Tokens, tones and text predicates as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pictolytics.functions.patterns import (
    EMOJI_PATTERN,
    JVM_EMOJI_PATTERN,
    PRESENTATION_SELECTOR,
    TONE_PATTERN,
)


def emoji_tokens(text: Column) -> Column:
    """All emoji of a text in reading order, as written; null for a null text.

    Every emoji has a character outside ASCII, so a text with as many bytes as characters has
    none. That test reads bytes only; such texts are neither decoded nor searched.
    """
    found = F.regexp_extract_all(text, F.lit(JVM_EMOJI_PATTERN), F.lit(0))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.array().cast("array<string>")).otherwise(found)


def strip_presentation(token: Column) -> Column:
    """Drop U+FE0F, so that both spellings of a symbol count as one."""
    return F.replace(token, F.lit(PRESENTATION_SELECTOR), F.lit(""))


def word_tokens(text: Column) -> Column:
    """Whitespace-separated words; leading and doubled whitespace gives no empty word."""
    return F.array_remove(F.split(text, r"\s+"), "")


def base_emoji(token: Column) -> Column:
    """The emoji without its skin tones."""
    return F.regexp_replace(token, TONE_PATTERN, "")


def tone_of(token: Column) -> Column:
    """First skin-tone character of the emoji, or the empty string."""
    return F.regexp_extract(token, f"({TONE_PATTERN})", 1)


def is_repost(text: Column, prefix: str = "RT") -> Column:
    return text.startswith(prefix)


def has_any(tokens: Column, wanted: Iterable[str]) -> Column:
    """True where the token array holds one of the wanted emoji, in either spelling."""
    plain = [w.replace(PRESENTATION_SELECTOR, "") for w in wanted]
    found = F.transform(tokens, strip_presentation)
    return F.arrays_overlap(found, F.array(*[F.lit(w) for w in plain]))


def rule_tags(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Sorted distinct tags of the ``(value, tag)`` rules whose value occurs in the text.

    The rules are arguments of the program, so they are part of the expression: every post is
    labelled where it is read, without a join. Rule *tables* go through
    ``operators.tagging.tag_by_token_rules``.
    """
    hits = [F.when(F.contains(text, F.lit(value)), F.lit(tag)) for value, tag in rules]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))


def register_sql_functions(spark: SparkSession) -> None:
    """Offer the expressions to ``spark.sql`` as SQL functions, which Catalyst inlines.

    Explode the tokens with ``explode_outer`` and leave out the null ones: a plain explode makes Spark ask for texts
    with tokens first, and so cut every text again for that.
    """
    found = f"regexp_extract_all(t, r'{JVM_EMOJI_PATTERN}', 0)"
    definitions = {
        "emoji_tokens(t STRING) RETURNS ARRAY<STRING>": (
            f"CASE WHEN octet_length(t) = char_length(t) THEN CAST(array() AS ARRAY<STRING>) ELSE {found} END"
        ),
        "base_emoji(t STRING) RETURNS STRING": f"regexp_replace(t, r'{TONE_PATTERN}', '')",
        "emoji_tone(t STRING) RETURNS STRING": f"regexp_extract(t, r'({TONE_PATTERN})', 1)",
    }
    for signature, body in definitions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


__all__ = [
    "EMOJI_PATTERN",
    "base_emoji",
    "emoji_tokens",
    "has_any",
    "is_repost",
    "register_sql_functions",
    "rule_tags",
    "strip_presentation",
    "tone_of",
    "word_tokens",
]
