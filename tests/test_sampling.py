import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pictolytics.operators import sampling as S
from pictolytics.plans import questions as Q

NOW = datetime(2024, 1, 8, 12, 0, 0)
STEP = timedelta(minutes=30)


@pytest.fixture(scope="module")
def times():
    """Bursts and gaps over eight days, with exact slot borders and a third of all in one slot."""
    rng = random.Random(7)
    found = [NOW - timedelta(seconds=rng.uniform(0, 8 * 86400)) for _ in range(150)]
    found += [NOW - timedelta(hours=30) + timedelta(seconds=rng.uniform(0, 900)) for _ in range(80)]
    found += [NOW - k * STEP for k in (0, 1, 2, 3, 4, 335, 336, 337)] + [NOW - timedelta(seconds=s) for s in (9, 10, 11)]
    return [t.replace(microsecond=0) for t in found]


@pytest.fixture
def posts(make_posts, times):
    return make_posts([{"time": t.isoformat() + "Z"} for t in times])


def ends():
    return [NOW - timedelta(seconds=10)] + [NOW - k * STEP for k in range(2, 336)]


def newest(times, start, end, n):
    inside = [(t, i) for i, t in enumerate(times) if start <= t < end]
    return [i for _, i in sorted(inside, reverse=True)[:n]]


def by_slot(df):
    slots = {}
    for r in df.orderBy("slot", "position").collect():
        slots.setdefault(r.slot, []).append(r.tweet_id)
        assert r.position == len(slots[r.slot])
    return slots


def test_grid(spark):
    rows = S.slot_grid(spark, NOW).orderBy("slot").collect()
    assert len(rows) == 335
    assert [r.slot_end for r in rows] == ends()
    assert [r.slot_start for r in rows] == ends()[1:] + [NOW - timedelta(days=7)]


@pytest.mark.parametrize("n", [1, 3, 100])
def test_newest_of_each_slot(posts, times, n):
    borders = ends() + [NOW - timedelta(days=7)]
    expected = {s: newest(times, borders[s + 1], borders[s], n) for s in range(335)}
    assert by_slot(Q.historical_sample(posts, NOW, per_slot=n)) == {s: v for s, v in expected.items() if v}


@pytest.mark.parametrize("n", [1, 3, 100])
def test_newest_before_each_end(posts, times, n):
    expected = {s: newest(times, NOW - timedelta(days=7), end, n) for s, end in enumerate(ends())}
    sample = Q.historical_sample(posts, NOW, per_slot=n, bounded=False)
    assert by_slot(sample) == {s: v for s, v in expected.items() if v}


def test_large_samples_rank_in_pieces_first(posts, with_conf):
    plain = by_slot(Q.historical_sample(posts, NOW, per_slot=5))
    with_conf(spark__sql__optimizer__windowGroupLimitThreshold="3")
    assert by_slot(Q.historical_sample(posts, NOW, per_slot=5)) == plain


def test_now_may_be_a_column(posts):
    latest = posts.agg(F.max("time")).scalar()
    assert Q.historical_sample(posts, latest, per_slot=1).count() > 0


def test_a_naive_now_is_utc_wherever_the_driver_is(spark, make_posts, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        ends = S.slot_grid(spark, datetime(2024, 1, 1, 12), 30, 1).where("slot = 0").select(F.unix_micros("slot_end")).first()[0]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert ends == (1704110400 - 10) * 1_000_000


def test_minute_grid_over_a_year(spark, make_posts):
    posts = make_posts([{"tweet_id": i, "time": f"2024-{1 + i % 12:02d}-01T00:00:00Z"} for i in range(240)])
    found = Q.historical_sample(posts, datetime(2024, 12, 31), 1, 365, 3, bounded=False)
    assert found.count() == found.select("slot", "position").distinct().count() > 1_000_000
