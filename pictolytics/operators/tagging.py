"""Labelling posts by rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.functions.text import emoji_tokens, has_any, rule_tags


def tag_by_rules(posts: DataFrame, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Add ``tags`` from ``(value, tag)`` rules and keep the posts that match at least one."""
    # Exploding a list of one or no array keeps the tagged posts; a filter on the column would be pushed
    # below it and evaluate every rule a second time.
    some = F.filter(F.array(rule_tags(F.col("text"), list(rules))), lambda tags: F.size(tags) > 0)
    return posts.select("*", F.explode(some).alias("tags"))


def tag_by_token_rules(tokens: DataFrame, rules: DataFrame, token: str, key: str = "tweet_id") -> DataFrame:
    """Post key and ``tag`` by a rule table ``(value, tag)`` whose values are whole tokens.

    The table may have any size: an equi-join on the token does the work. Where it is too large to
    broadcast, both sides of the join come straight from a shuffle, which lets adaptive execution
    split the partition of a token that a third of all posts contain. Give tokens that are distinct
    per post; copies cost time but do not change the result.

    Copies of rules, and tags that a post meets again, are told apart by hash before any are collected: ``collect_set``
    sorts all rows once a task has more than a few groups.
    """
    pairs = rules.select("value", "tag").distinct()
    values = pairs.groupBy("value").agg(F.sort_array(F.collect_list("tag")).alias("tags"))
    hits = tokens.select(key, token).join(values, tokens[token] == values["value"])
    # Tags of a value come as one array, so a token with many tags does not multiply its posts.
    return hits.select(key, "tags").distinct().select(key, F.explode("tags").alias("tag")).distinct()


def containing_any(posts: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Posts with at least one of the wanted emoji."""
    return posts.where(has_any(emoji_tokens(F.col("text")), wanted))
