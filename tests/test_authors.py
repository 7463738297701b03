import uuid

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from pictolytics.operators import authors as A
from pictolytics.plans import questions as Q


@pytest.fixture
def skewed(make_posts):
    """One author with half of all posts, one unknown, and posts without author."""
    owners = [1] * 60 + [2, 3, 4] * 10 + [99] * 10 + [None] * 20
    return make_posts([{"author_id": a, "text": f"{i} 😀"} for i, a in enumerate(owners)])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_dealt_join_equals_the_plain_one(skewed, make_authors, how):
    authors = make_authors({1: 10, 2: 20, 3: 30, 4: 40, 5: 50})
    plain = skewed.join(authors, skewed["author_id"] == authors["user_id"], how)
    for joined in (A.with_authors(skewed, authors, how), A.with_authors_dealt(skewed, authors, how, hot_share=0.05)):
        assert joined.columns == plain.columns
        assert sorted(joined.collect(), key=str) == sorted(plain.collect(), key=str)


def test_hot_authors_are_found_and_bounded(skewed):
    hot = {r.hot_id: r.pieces for r in A._hot_authors(skewed, 0.05).collect()}
    assert hot == {1: 12, 2: 2, 3: 2, 4: 2, 99: 2}


def test_dealt_join_spreads_a_hot_author(skewed, make_authors, with_conf):
    with_conf(
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="64",
    )
    joined = A.with_authors_dealt(skewed, make_authors({1: 10, 2: 20}), hot_share=0.05)
    sizes = joined.where("author_id = 1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 60
    assert max(r["count"] for r in sizes) < 30


def test_building_the_join_runs_no_job(spark, skewed, make_authors):
    group = f"lazy-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "lazy")
    A.with_authors(skewed, make_authors({1: 10}))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    spark.sparkContext.setJobGroup("", "")


def test_posts_without_an_id_stay_apart(make_posts):
    posts = make_posts([{"tweet_id": None}, {"tweet_id": None}, {"tweet_id": 1}, {"tweet_id": 1}])
    assert A.unique_posts(posts).count() == 3


def test_join_type_is_checked(skewed, make_authors):
    with pytest.raises(ValueError):
        A.with_authors(skewed, make_authors({1: 1}), "full")


def test_latest_snapshot_per_author(make_authors):
    first = make_authors({1: 10, 2: 5}).withColumn("page_time", F.lit("2024-01-01").cast("timestamp"))
    later = make_authors({1: 12}).withColumn("page_time", F.lit("2024-01-02").cast("timestamp"))
    latest = A.latest_authors(first.union(later).union(first))
    assert {(r.user_id, r.followers_count) for r in latest.collect()} == {(1, 12), (2, 5)}
    assert latest.columns == make_authors({1: 1}).columns


def test_author_on_several_pages_does_not_multiply_posts(make_posts, make_authors):
    posts = make_posts([{"author_id": 1}] * 6)
    pages = [make_authors({1: 10}).withColumn("page_time", F.lit(d).cast("timestamp")) for d in ("2024-01-01", "2024-01-02")]
    authors = A.latest_authors(pages[0].union(pages[1]))
    assert A.with_authors(posts, authors).count() == 6


def test_unique_posts_keep_the_newest_copy(make_posts):
    posts = make_posts(
        [
            {"tweet_id": 1, "time": "2024-01-01T00:00:00Z", "like_count": 1},
            {"tweet_id": 1, "time": "2024-01-02T00:00:00Z", "like_count": 5},
            {"tweet_id": 2},
            {"tweet_id": 2},
        ]
    )
    unique = A.unique_posts(posts)
    assert unique.columns == posts.columns
    assert {(r.tweet_id, r.like_count) for r in unique.collect()} == {(1, 5), (2, 0)}


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_followed_authors(make_posts, make_authors, with_conf, broadcast):
    with_conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    posts = make_posts(
        [
            {"author_id": 1, "text": "😀😀🎉"},
            {"author_id": 1, "text": "RT 😀"},
            {"author_id": 2, "text": "🎉"},
            {"author_id": 3, "text": "👍"},
            {"author_id": None, "text": "👍"},
        ]
    )
    authors = make_authors({1: 101, 2: 100, 4: 900})
    assert [tuple(r) for r in Q.used_by_followed_authors(posts, authors, 100).collect()] == [("😀", 2), ("🎉", 1)]


@pytest.mark.parametrize("held", [0, 10])
def test_only_copies_of_posts_are_shuffled(make_posts, with_conf, held):
    with_conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [{"tweet_id": i % 40, "like_count": i} for i in range(45)] + [{"tweet_id": None, "like_count": i} for i in (1, 1, 2)]
    posts = make_posts(rows)
    unique = A.unique_posts(posts, held_ids=held)
    assert unique.columns == posts.columns
    found = [(r.tweet_id, r.like_count) for r in unique.collect()]
    want = [(i, i + 40 if i < 5 else i) for i in range(40)] + [(None, i) for i in (1, 1, 2)]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    lone = A.unique_posts(posts.where("tweet_id > 4 or tweet_id is null"), held_ids=held)
    assert "Exchange" not in plan_of(lone) and lone.count() == 38
    if held:
        assert "LeftAnti" in plan_of(unique) and "Exchange hashpartitioning(tweet_id" in str(unique._jdf.queryExecution().executedPlan())
