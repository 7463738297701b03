from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pictolytics.functions.time import weekday_name
from pictolytics.operators import counts as C
from pictolytics.plans import questions as Q

HOURS = [
    ("2024-01-01T05:10:00Z", "😀 🎉"),  # a Monday
    ("2024-01-01T05:59:59Z", "😀 🎉"),
    ("2024-01-01T06:00:00Z", "🎉"),
    ("2024-01-07T05:00:00Z", "👍 👍 😀"),  # a Sunday
    ("2024-01-08T05:00:00Z", "👍"),
    (None, "👍 👍 👍 👍 👍"),
]
DAYS = {"01": "Monday", "07": "Sunday", "08": "Monday"}


@pytest.fixture
def tokens(make_posts):
    return Q.emoji_of(make_posts([{"time": t, "text": x} for t, x in HOURS]))


def expected_winners(key):
    counts = defaultdict(Counter)
    for time, text in HOURS:
        if time:
            counts[key(time)].update(text.split())
    return {(k, e, n) for k, c in counts.items() for e, n in c.items() if n == max(c.values())}


def test_weekday_names(spark):
    named = spark.range(1, 8).select(weekday_name(F.col("id").cast("int")).alias("d"))
    assert [r.d for r in named.collect()] == "Sunday Monday Tuesday Wednesday Thursday Friday Saturday".split()
    monday = spark.sql("SELECT dayofweek(DATE'2020-11-09') d").select(weekday_name(F.col("d"))).first()[0]
    assert monday == "Monday"


def test_winners_by_time_keep_ties(tokens):
    daily = Q.most_used_by_time(tokens, "daily").collect()
    assert {(r.day_of_week, r.emoji, r.popularity) for r in daily} == expected_winners(lambda t: DAYS[t[8:10]])
    assert [r.day_of_week for r in daily] == ["Sunday", "Monday"]
    hourly = Q.most_used_by_time(tokens, "hourly").collect()
    assert {(r.hour, r.emoji, r.occurrence) for r in hourly} == expected_winners(lambda t: int(t[11:13]))
    both = Q.most_used_by_time(tokens).collect()
    assert {((r.day_of_week, r.hour), r.emoji, r.n) for r in both} == expected_winners(
        lambda t: (DAYS[t[8:10]], int(t[11:13]))
    )
    dates = Q.most_used_by_time(tokens, "date").collect()
    assert {(str(r.date), r.emoji, r.n) for r in dates} == expected_winners(lambda t: t[:10])
    with pytest.raises(ValueError):
        Q.most_used_by_time(tokens, "yearly")


def test_all_grains_equal_the_single_ones(tokens):
    rows = Q.most_used_by_every_grain(tokens).collect()
    single = {
        "day": ("daily", "popularity"),
        "hour": ("hourly", "occurrence"),
        "day_hour": ("dailyAndHourly", "n"),
    }
    for grain, (profile, name) in single.items():
        ours = {(r.day_of_week, r.hour, r.emoji, r.n) for r in rows if r.grain == grain}
        alone = {
            (r.asDict().get("day_of_week"), r.asDict().get("hour"), r.emoji, r[name])
            for r in Q.most_used_by_time(tokens, profile).collect()
        }
        assert ours == alone


def test_roll_up(tokens):
    fine = C.count_by(C.with_buckets(tokens, ["day_of_week", "hour"]), ["day_of_week", "hour", "emoji"])
    coarse = C.count_by(C.with_buckets(tokens, ["hour"]), ["hour", "emoji"])
    assert sorted(map(tuple, C.roll_up(fine, ["hour", "emoji"]).collect())) == sorted(map(tuple, coarse.collect()))


def test_most_used_is_ordered_with_ties_by_token(tokens):
    rows = [(r.emoji, r.usage) for r in Q.most_used(tokens).collect()]
    assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
    assert Counter(dict(rows)) == Counter(e for _, x in HOURS for e in x.split())
    assert [tuple(r) for r in Q.most_used(tokens, limit=2).collect()] == rows[:2]


def test_every_occurrence_counts_in_batch(make_posts):
    assert Q.most_used(Q.emoji_of(make_posts([(1, "😀😀")]))).first().usage == 2


@pytest.fixture
def two_languages(make_posts):
    texts = [("es", "😀 😀 🎉"), ("en", "😀 👍 👍 👍"), ("fr", "😀 😀 😀 🇫🇷"), (None, "😀")]
    return Q.emoji_of(make_posts([{"lang": lang, "text": text} for lang, text in texts]))


def test_languages_side_by_side(two_languages):
    rows = [tuple(r) for r in Q.compare_languages(two_languages, "es", "en").collect()]
    assert rows == [("😀", 2, 1), ("🎉", 1, None), ("👍", None, 3)]
    assert Q.compare_languages(two_languages, "es", "en").columns == ["emoji", "es_total", "en_total"]
    with pytest.raises(ValueError):
        Q.compare_languages(two_languages, "es", "es")


def test_language_shares(two_languages):
    rows = {r.emoji: r for r in Q.compare_language_shares(two_languages, "es", "en").collect()}
    assert (rows["😀"].es_share, rows["😀"].en_share) == (2 / 3, 1 / 4)
    assert rows["😀"].share_ratio == (2 / 3) / (1 / 4)
    assert (rows["👍"].es_share, rows["👍"].share_ratio) == (0.0, 0.0)
    assert rows["🎉"].share_ratio is None


def test_language_argument_filters(two_languages, make_posts):
    posts = make_posts([{"lang": "en", "text": "😀"}, {"lang": "fr", "text": "🎉"}])
    assert [r.emoji for r in Q.emoji_of(posts, lang="en").collect()] == ["😀"]


def test_average_needs_more_than_the_support(make_posts):
    rows = [{"text": "😀", "like_count": n, "retweet_count": 2 * n} for n in range(11)]
    rows += [{"text": "🎉", "like_count": 9} for _ in range(10)]
    rows += [{"text": "👍" * 6, "like_count": 1}, {"text": "👍" * 6, "like_count": 2}]
    tokens = Q.emoji_of(make_posts(rows))
    assert [tuple(r) for r in Q.average_engagement(tokens).collect()] == [("😀", 5.0), ("👍", 1.5)]
    assert [tuple(r) for r in Q.average_engagement(tokens, likes=False).collect()] == [("😀", 10.0), ("👍", 0.0)]
    assert Q.average_engagement(tokens, min_support=9).count() == 3


def test_tone_breakdown(make_posts):
    tokens = Q.emoji_of(make_posts([(1, "🙏 🙏🏽 🙏🏽 ☝🏿")]))
    assert {tuple(r) for r in Q.tone_breakdown(tokens).collect()} == {("🙏", "🏽", 2), ("☝", "🏿", 1)}


def test_variants_count_once_per_post(make_posts):
    posts = make_posts([(1, "🙏🏽 🙏🏽 🙏"), (2, "🙏🏽"), (3, "😀")])
    assert [tuple(r) for r in Q.variants_of(posts, "🙏").collect()] == [("🙏🏽", 2, "🙏", "🏽"), ("🙏", 1, "🙏", "")]


def test_other_tokens_than_emoji(spark):
    rows = [("2024-01-01 00:00:00", "view"), ("2024-01-01 00:30:00", "view"), ("2024-01-01 01:00:00", "click")]
    events = spark.createDataFrame(rows, "time string, kind string").withColumn("time", F.to_timestamp("time"))
    best = Q.most_used_by_time(events, "hourly", "kind")
    assert [tuple(r) for r in best.collect()] == [(0, "view", 2), (1, "click", 1)]
