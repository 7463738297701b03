"""Counts, roll-ups and winners.

Every aggregate below combines partially before it shuffles, so a token that makes up a third
of all rows arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.functions.time import GRAINS, bucket


def count_by(tokens: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return tokens.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_buckets(tokens: DataFrame, names: Sequence[str], time: str = "time") -> DataFrame:
    """Add time buckets; rows without a time belong to none and are left out."""
    timed = tokens.where(F.col(time).isNotNull())
    return timed.withColumns({n: bucket(n, F.col(time)) for n in names})


def roll_up(counts: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Coarser counts from finer ones."""
    return counts.groupBy(*keys).agg(F.sum(name).alias(name))


def winners(counts: DataFrame, buckets: Sequence[str], name: str = "n", few_buckets: bool = False) -> DataFrame:
    """The rows with the greatest count of their bucket; ties are all kept.

    A window would bring a whole bucket, such as all words of one weekday, into one task. Here the
    maxima are a small partial aggregate that joins back on bucket and count, and both readers
    of ``counts`` share one shuffle. ``few_buckets`` states that the calendar bounds the number of
    buckets (168 weekday hours, one date per day), so the maxima are broadcast and the counts
    stay where they are; other buckets are joined as their size demands.
    """
    best = counts.groupBy(*buckets).agg(F.max(name).alias(name))
    best = best.toDF(*[f"best_{c}" for c in best.columns])
    if few_buckets:
        best = F.broadcast(best)
    matches = [F.col(c).eqNullSafe(F.col(f"best_{c}")) for c in [*buckets, name]]
    return counts.join(best, matches, "left_semi")


def winners_by_time(tokens: DataFrame, grain: str, token: str, name: str = "n") -> DataFrame:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}, not {grain!r}")
    buckets = GRAINS[grain]
    counts = count_by(with_buckets(tokens, buckets), [*buckets, token], name)
    return winners(counts, buckets, name, few_buckets=True)


def winners_of_all_grains(tokens: DataFrame, token: str, name: str = "n") -> DataFrame:
    """Winners per weekday, per hour and per both, from one pass over the tokens.

    The fine counts are rolled up with grouping sets; ``grain`` tells the three levels apart.
    """
    fine = count_by(with_buckets(tokens, GRAINS["day_hour"]), ["day_of_week", "hour", token], name)
    day, hour, key = F.col("day_of_week"), F.col("hour"), F.col(token)
    grain = F.when(F.grouping(hour) == 1, "day").when(F.grouping(day) == 1, "hour").otherwise("day_hour")
    levels = fine.groupingSets([[day, key], [hour, key], [day, hour, key]], day, hour, key).agg(
        grain.alias("grain"), F.sum(name).alias(name)
    )
    return winners(levels, ["grain", "day_of_week", "hour"], name, few_buckets=True)


def two_groups(tokens: DataFrame, group: str, first: str, second: str, token: str) -> DataFrame:
    """Counts of two groups side by side, null where a token is missing in one of them.

    One aggregation takes the place of two counts and a full outer join.
    """
    if first == second:
        raise ValueError("compare two different groups")
    chosen = tokens.where(F.col(group).isin(first, second))

    def total(value: str) -> Column:
        return F.nullif(F.count_if(F.col(group) == value), F.lit(0)).alias(f"{value}_total")

    return chosen.groupBy(token).agg(total(first), total(second))


def with_shares(compared: DataFrame, first: str, second: str) -> DataFrame:
    """Add each group's share of its own total, and the ratio of the two shares.

    The two totals are scalar subqueries over the same shuffle, not a window over all rows.
    """

    def share(value: str) -> Column:
        whole = compared.agg(F.sum(f"{value}_total")).scalar()
        return F.coalesce(F.col(f"{value}_total"), F.lit(0)) / whole

    shares = compared.withColumns({f"{v}_share": share(v) for v in (first, second)})
    ratio = F.col(f"{first}_share") / F.nullif(F.col(f"{second}_share"), F.lit(0.0))
    return shares.withColumn("share_ratio", ratio)


def average_by(tokens: DataFrame, token: str, measure: str, name: str, min_support: int = 10) -> DataFrame:
    """Average of a measure per token, weighted by occurrence, for tokens seen more than
    ``min_support`` times."""
    grouped = tokens.groupBy(token).agg(F.avg(measure).alias(name), F.count(F.lit(1)).alias("n"))
    return grouped.where(F.col("n") > min_support).drop("n")
