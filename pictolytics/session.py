"""Session settings and the shared folder of the cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin what the results depend on: hours and weekdays are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder that the session names.

    Where no folder is named and Spark itself is local, as in tests, a temporary folder takes its place
    until the program ends; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """A write in here removes its shuffle files as it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write into the shared folder and read again: what follows does not work it out anew."""
    path = shared_dir(df.sparkSession, purpose)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _local_root(made: list[str] = []) -> str:
    """One temporary folder per program, removed at its end."""
    if not made:
        made.append(tempfile.mkdtemp(prefix="pictolytics-"))
        atexit.register(shutil.rmtree, made[0], ignore_errors=True)
    return made[0]
