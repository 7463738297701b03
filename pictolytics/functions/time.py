"""Time buckets. Hours and days are those of the session time zone, see ``session.configure``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket columns per grain. The calendar bounds the number of buckets: 7, 24, 168, one per day.
GRAINS = {
    "day": ["day_of_week"],
    "hour": ["hour"],
    "day_hour": ["day_of_week", "hour"],
    "date": ["date"],
}


def bucket(name: str, time: Column) -> Column:
    """``day_of_week`` as 1 (Sunday) to 7, ``hour`` as 0 to 23, or the calendar ``date``."""
    return {"day_of_week": F.dayofweek, "hour": F.hour, "date": F.to_date}[name](time).alias(name)


def weekday_name(day_of_week: Column) -> Column:
    """Name of a Spark weekday number, where 1 is Sunday (1970-01-04 was one)."""
    return F.date_format(F.date_add(F.lit("1970-01-03").cast("date"), day_of_week), "EEEE")
