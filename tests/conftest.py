import contextlib
import io
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from pictolytics.session import configure

    return configure(session)


@pytest.fixture
def with_conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def make_posts(spark):
    """Posts from ``(tweet_id, text)`` or dictionaries; what is not given gets a default."""
    from pyspark.sql import functions as F

    schema = (
        "tweet_id bigint, author_id bigint, time string, lang string, like_count bigint, quote_count bigint, "
        "reply_count bigint, retweet_count bigint, text string"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    defaults = dict(author_id=1, time="2024-01-01T00:00:00Z", lang="en", text="😀") | dict.fromkeys(
        ["like_count", "quote_count", "reply_count", "retweet_count"], 0
    )

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            if isinstance(row, tuple):
                row = {"tweet_id": row[0], "text": row[1]}
            full.append(defaults | {"tweet_id": i} | row)
        df = spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema)
        return df.withColumn("time", F.try_to_timestamp("time"))

    return make


@pytest.fixture
def make_authors(spark):
    """Authors from ``{user_id: followers_count}``."""

    def make(followers):
        return spark.createDataFrame(
            [(u, f"Name {u}", f"name{u}", f, 1, 2, 3) for u, f in followers.items()],
            "user_id bigint, name string, username string, followers_count bigint, following_count bigint, "
            "tweet_count bigint, listed_count bigint",
        )

    return make


def plan_of(df, run: bool = True) -> str:
    """The formatted plan; after a run it is the final one, with exchanges as they were reused."""
    if run:
        df.collect()
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain("formatted")
    return printed.getvalue()
