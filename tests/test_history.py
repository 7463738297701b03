"""Stored partial aggregates, changes of a ranking, and the most frequent tokens by a summary."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pictolytics.operators import heavy
from pictolytics.operators import history as H
from pictolytics.operators.tokens import explode_emoji
from pictolytics.plans import questions as Q
from pictolytics.sources import cube as B
from conftest import plan_of


@pytest.fixture
def tokens(make_posts):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(["😀", "🎉", "🙏", "❤️"], [5, 3, 2, 1], k=rng.randint(0, 5)))
        rows.append({"tweet_id": i, "text": text, "time": f"2024-01-{1 + i % 9:02d}T{i % 24:02d}:00:00Z", "lang": rng.choice(["en", "es", None]), "like_count": rng.choice([None, 1, 5])})
    rows.append({"tweet_id": 999, "text": "😀", "time": None})
    return explode_emoji(make_posts(rows))


def rows_of(df):
    return sorted((tuple(r.asDict()[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_two_loads_are_as_good_as_one(spark, tokens, tmp_path):
    timed = tokens.where("time is not null")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    B.add_to_cube(tokens, one, "all")
    B.add_to_cube(tokens.where("tweet_id % 3 = 0"), two, "a")
    B.add_to_cube(tokens.where("tweet_id % 3 > 0"), two, "b")
    B.add_to_cube(tokens.where("tweet_id % 3 > 0"), two, "b")  # repeated
    packed = B.compact_cube(spark, two, str(tmp_path / "packed"))
    for path in (one, two, packed):
        cube = B.read_cube(spark, path)
        assert rows_of(B.usage_from_cube(cube)) == rows_of(Q.most_used(timed))
        for likes in (True, False):
            assert rows_of(B.average_from_cube(cube, likes)) == rows_of(Q.average_engagement(timed, likes))
        assert rows_of(B.languages_from_cube(cube, "es", "en")) == rows_of(Q.compare_languages(timed, "es", "en"))
        by_date = timed.groupBy(F.to_date("time").alias("date"), "emoji").agg(F.count("*").alias("n"))
        assert rows_of(B.counts_from_cube(cube, ["date"])) == rows_of(by_date)
    assert B.read_cube(spark, packed).count() == B.read_cube(spark, one).count()


def test_a_date_is_read_alone(spark, tokens, tmp_path):
    path = B.add_to_cube(tokens, str(tmp_path / "cube"), "all")
    plan = plan_of(B.usage_from_cube(B.read_cube(spark, path).where("token_date = '2024-01-03'")))
    assert "PartitionFilters: [isnotnull(token_date" in plan and "text" not in plan


def brute_changes(counts, k):
    days = sorted({d for d, _ in counts})
    top = {d: {t: r for r, (t, _) in enumerate(sorted(((t, n) for (x, t), n in counts.items() if x == d), key=lambda p: (-p[1], p[0]))[:k], 1)} for d in days}
    out = []
    for before, d in zip([None, *days], days):
        old = top.get(before, {})
        for t, r in top[d].items():
            b = old.get(t)
            change = "enters" if b is None else "up" if r < b else "down" if r > b else "same"
            out.append((d, t, change, r, b, counts[d, t]))
        out += [(d, t, "leaves", None, b, None) for t, b in old.items() if t not in top[d]]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [1, 3, 100])
def test_rank_changes_equal_brute_force(spark, k):
    rng = random.Random(k)
    counts = {}
    for day in (1, 2, 3, 7, 8, 20):  # dates without any token lie between
        for t in rng.sample("abcdefghij", rng.randint(1, 8)):
            counts[f"2024-01-{day:02d}", t] = rng.randint(1, 4)
    df = spark.createDataFrame([(d, t, n) for (d, t), n in counts.items()], "date string, emoji string, n bigint")
    changes = H.rank_changes(df.withColumn("date", F.to_date("date")), k)
    found = sorted(((str(r.date), r.emoji, r.change, r["rank"], r.before, r.n) for r in changes.collect()), key=repr)
    assert found == brute_changes(counts, k)
    assert H.rank_changes(df.limit(0).withColumn("date", F.to_date("date")), k).collect() == []


@pytest.mark.parametrize("tracked", [8, 64, 1 << 14])
def test_sketched_equals_counting_all(spark, tracked):
    rng = random.Random(tracked)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(20_000)]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)] * 5, "word string").repartition(6)
    expected = sorted(Counter(words).items(), key=lambda p: (-p[1], p[0]))
    assert [tuple(r) for r in heavy.most_used_sketched(df, 10, tracked=tracked).collect()] == expected[:10]
    few = df.where("word in ('w1', 'w2')")
    assert len(heavy.most_used_sketched(few, 10, tracked=tracked).collect()) == 2
    assert heavy.most_used_sketched(df.limit(0), 10, tracked=tracked).collect() == []


def test_even_counts_are_counted_in_full(spark, monkeypatch):
    monkeypatch.setattr(heavy, "MOST_TRACKED", 64)
    df = spark.range(3000).selectExpr("concat('w', id % 1000) AS word")
    assert [r.word for r in heavy.most_used_sketched(df, 3, tracked=16).collect()] == ["w0", "w1", "w10"]
