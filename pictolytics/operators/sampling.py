"""The newest posts before each of a series of points in time.

Going back from ``now``, slot 0 ends ``lag_seconds`` before it and slot i ends i + 1 steps before
it; the end one step back is passed over, as the historical search does. A slot reaches back
to the end of the next older one, so the slots tile the whole span and no post falls between.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MICROS = 1_000_000
BLOCK = 1024


def slot_count(step_minutes: int, span_days: int) -> int:
    steps = -(-span_days * 24 * 60 // step_minutes)
    return steps - 1


def slot_grid(
    spark: SparkSession, now: datetime | Column, step_minutes: int = 30, span_days: int = 7, lag_seconds: int = 10
) -> DataFrame:
    """``slot``, ``slot_start`` (included) and ``slot_end`` (not included), newest slot first."""
    step, now_micros = step_minutes * 60 * MICROS, _micros(now)
    back = F.when(F.col("slot") == 0, F.lit(lag_seconds * MICROS)).otherwise((F.col("slot") + 1) * step)
    grid = spark.range(slot_count(step_minutes, span_days)).select(F.col("id").alias("slot"))
    return grid.select(
        "slot",
        F.timestamp_micros(now_micros - (F.col("slot") + 2) * step).alias("slot_start"),
        F.timestamp_micros(now_micros - back).alias("slot_end"),
    )


def assign_slots(
    posts: DataFrame, now: datetime | Column, step_minutes: int = 30, span_days: int = 7, lag_seconds: int = 10
) -> DataFrame:
    """Add the ``slot`` of each post by arithmetic on its age; no join with the grid is needed."""
    step = step_minutes * 60 * MICROS
    age = _micros(now) - F.unix_micros("time")
    last = slot_count(step_minutes, span_days) + 1
    inside = posts.withColumn("age", age).where((F.col("age") > lag_seconds * MICROS) & (F.col("age") <= last * step))
    slot = F.expr(f"greatest((age + {step - 1}) div {step} - 2, 0L)")
    return inside.withColumn("slot", slot).drop("age")


def newest_per_slot(slotted: DataFrame, per_slot: int = 100) -> DataFrame:
    """Up to ``per_slot`` newest posts of every slot, with their ``position`` from 1.

    Spark prunes each task to its own ``per_slot`` best rows of a slot before the shuffle, up to a
    limit it sets for such pruning. Beyond that limit the posts of a slot are ranked in pieces
    first, so that a slot with a third of all posts still spreads over many tasks.
    """
    spark = slotted.sparkSession
    newest_first = [F.desc("time"), F.desc("tweet_id")]
    if per_slot >= int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        piece = F.pmod(F.xxhash64("tweet_id"), F.lit(1024))
        in_piece = F.row_number().over(W.partitionBy("slot", "piece").orderBy(*newest_first))
        slotted = (
            slotted.withColumn("piece", piece)
            .withColumn("piece_position", in_piece)
            .where(F.col("piece_position") <= per_slot)
            .drop("piece", "piece_position")
        )
    position = F.row_number().over(W.partitionBy("slot").orderBy(*newest_first))
    return slotted.withColumn("position", position).where(F.col("position") <= per_slot)


def newest_before_end(kept: DataFrame, grid: DataFrame, per_slot: int = 100) -> DataFrame:
    """Up to ``per_slot`` newest posts before each slot end, however far back they are.

    ``kept`` is the result of ``newest_per_slot`` for the same number. A post beyond that number
    within its own slot cannot be among the newest of any later end either, so ``kept`` has all
    that is needed: a slot takes the slots behind it until their sizes add up. Sizes and running
    sums have one row per slot of the grid, a number that the arguments fix.
    """
    sizes = kept.groupBy("slot").agg(F.count(F.lit(1)).alias("size"))
    block = F.floor(F.col("slot") / BLOCK)
    every = grid.join(sizes, "slot", "left").select("slot", F.coalesce("size", F.lit(0)).alias("size"), block.alias("block"))
    # Running sums in two levels: over the blocks, of which there are few, and within each block.
    before = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = every.groupBy("block").agg(F.sum("size").alias("size"))
    blocks = blocks.select("block", before(W.orderBy("block")).alias("newer_blocks"))
    inside = every.withColumn("newer_inside", before(W.partitionBy("block").orderBy("slot")))
    running = inside.join(blocks, "block").select("slot", "size", (F.col("newer_blocks") + F.col("newer_inside")).alias("newer"))
    # A slot in reach has fewer than per_slot newer posts between, so it lies in the same bucket or the next.
    bucket = F.floor(F.col("newer") / per_slot)
    filled = running.where(F.col("size") > 0).select(
        F.col("slot").alias("source"), F.col("newer").alias("source_newer"), bucket.alias("bucket")
    )
    targets = running.select(F.col("slot").alias("target"), "newer", F.explode(F.array(bucket, bucket + 1)).alias("bucket"))
    reached = (
        targets.join(filled, "bucket")
        .where((F.col("source") >= F.col("target")) & (F.col("source_newer") - F.col("newer") < per_slot))
        .select("target", "source", (F.col("source_newer") - F.col("newer")).alias("skipped"))
    )
    posts = kept.join(reached, kept["slot"] == reached["source"])
    place = (F.col("position") + F.col("skipped")).cast("int")
    found = posts.withColumn("position", place).where(F.col("position") <= per_slot)
    return found.drop("slot", "source", "skipped").withColumnRenamed("target", "slot")


def _micros(now: datetime | Column) -> Column:
    """Microseconds since the epoch; a naive ``now`` is UTC, whatever zone the driver machine is in."""
    if isinstance(now, Column):
        return F.unix_micros(now)
    aware = now if now.tzinfo else now.replace(tzinfo=UTC)
    return F.lit((aware - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1))
