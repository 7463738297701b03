"""Rules from a table against one ``contains`` per rule and text."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from pictolytics.operators import rule_index as R


def brute(posts, rules):
    out = []
    for key, text in dict.fromkeys(posts):
        tags = {t for v, t in rules if v is not None and t is not None and text is not None and v in text}
        if tags:
            out.append((key, tuple(sorted(tags))))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.tweet_id, tuple(r.tags)) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def posts():
    rng = random.Random(6)
    letters = "abcde é👍🙏🏽\n"
    rows = [(i, "".join(rng.choices(letters, k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(200, "aaaaaaaaaaaaaaaaaaaaaaaa"), (201, None), (202, ""), (203, "x" * 50_000 + "needle in it" + "y" * 50_000)]
    return [*rows, rows[3], (None, "abc needle"), (None, "abc needle"), (None, "nothing"), (5, "another text of 5 👍👍👍")]


@pytest.fixture(scope="module")
def rules():
    rng = random.Random(7)
    letters = "abcde é👍🙏🏽\n"
    rows = [("".join(rng.choices(letters, k=rng.randint(1, 9))), f"t{i % 23}") for i in range(1500)]
    rows += [("aaaaa", "run"), ("aaaaaaaaaaaaaaaaaaaaaaaaa", "too long"), ("needle in it", "long"), ("needle", None), (None, "x")]
    return [*rows, ("👍", "one"), ("👍", "two"), ("🏽", "half of an emoji"), ("nothing", "t1"), ("nothing", "t1")]


@pytest.mark.parametrize("held", [0, R.HELD_BYTES])
@pytest.mark.parametrize("size", [2, 5])
def test_rule_table_equals_one_test_per_rule(spark, posts, rules, held, size):
    p = spark.createDataFrame(posts, "tweet_id long, text string").repartition(4)
    r = spark.createDataFrame(rules, "value string, tag string")
    assert found(R.tag_by_rule_table(p, r, size=size, held_bytes=held)) == brute(posts, rules)


def test_empty_values_and_tables(spark, posts):
    p = spark.createDataFrame(posts, "tweet_id long, text string")
    everywhere = [("", "all"), ("needle", "some")]
    r = spark.createDataFrame(everywhere, "value string, tag string")
    assert found(R.tag_by_rule_table(p, r)) == brute(posts, everywhere)
    assert R.tag_by_rule_table(p, r.limit(0)).collect() == []
    assert R.tag_by_rule_table(p.limit(0), r).collect() == []
    assert R.tag_by_rule_table(p, spark.createDataFrame([("not there at all", "x")], "value string, tag string")).collect() == []


def test_bitmap_is_bounded_and_drops_most(spark, posts, rules, monkeypatch):
    p = spark.createDataFrame(posts, "tweet_id long, text string")
    r = spark.createDataFrame(rules, "value string, tag string")
    monkeypatch.setattr(R, "MOST_WORDS", 1)  # all bits set: the join alone drops what is no anchor
    assert found(R.tag_by_rule_table(p, r)) == brute(posts, rules)


def test_anchor_is_the_rarest_pair(spark):
    texts = [f"common words{i % 3} in it" + (" rarely seen" if i == 7 else "") for i in range(20)]
    p = spark.createDataFrame(enumerate(texts), "tweet_id long, text string")
    values = ["ds1 in it", "n it rarely s", "common never", "are", "e", " in ", " ", "ds2 i"]
    r = spark.createDataFrame([(v, "x") for v in values], "value string, tag string")
    index = {}
    for row in R.rule_index(p, r, size=3).collect():
        index.setdefault(row.value, set()).add(row.h)

    def h(*words):
        return spark.range(1).select(F.xxhash64(*map(F.lit, words))).first()[0]

    assert index == {
        "ds1 in it": {h("words1", "in")},
        "n it rarely s": {h("rarely", "seen")},
        "are": {h("rarely")},
        "e": {h("rarely"), h("seen")},
        " in ": {h("in")},
        " ": {h(R.EVERYWHERE)},
        "ds2 i": {h("words2", "in")},
    }  # one value has a pair that no text has


def test_texts_stay_where_they_are(spark, posts, rules):
    p = spark.createDataFrame(posts, "tweet_id long, text string")
    r = spark.createDataFrame(rules, "value string, tag string")
    plan = plan_of(R.tag_by_rule_table(p, r))
    shuffled = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert shuffled and not any("_text" in line for line in shuffled) and "SortMergeJoin" not in plan


def test_words_are_hashed_by_compiled_code(spark, posts, rules):
    p = spark.createDataFrame(posts, "tweet_id long, text string")
    r = spark.createDataFrame(rules, "value string, tag string")
    for held in (R.HELD_BYTES, 0):
        lines = plan_of(R.tag_by_rule_table(p, r, held_bytes=held), run=False).splitlines()
        hashed = [line for line in lines if "xxhash64" in line]
        assert hashed and not any("lambda" in line for line in hashed)


def test_a_rule_with_many_words_is_held_once(spark):
    posts = [(i, f"needle{i} in stack{i % 3}") for i in range(300)]
    rules = [("eedle", "long " * 400), ("in st", "pair"), ("stack2", "last")]
    p, r = spark.createDataFrame(posts, "tweet_id long, text string"), spark.createDataFrame(rules, "value string, tag string")
    tagged = R.tag_by_rule_table(p, r, held_bytes=40_000)  # 300 hashes of the first rule, its text once
    assert found(tagged) == brute(posts, rules)
    assert "_maybe" not in plan_of(tagged, run=False)


def test_corpus_is_never_broadcast(spark, with_conf, tmp_path):
    """A vocabulary that is small on disk makes many more q-grams than its files tell."""
    rows = spark.range(3000).select(F.col("id").alias("tweet_id"), F.concat(F.lit("w"), F.md5(F.col("id").cast("string"))).alias("text"))
    rules = spark.createDataFrame([("abc", "within"), ("w1 ", "end"), (" w12", "begin"), ("zz w1", "pair")], "value string, tag string")
    values = rules.select("value")
    with_conf(spark__sql__autoBroadcastJoinThreshold="10m")
    for matches in (R._word_matches(R._parts(values), rows, "text", 4), R._pair_matches(R._parts(values), rows, "text", 4)):
        plan = plan_of(matches, run=False)
        sides = [line for line in plan.splitlines() if "BuildRight" in line or "BuildLeft" in line]
        assert not sides and "SortMergeJoin" in plan
    made = R._wanted_only(rows.select("text", F.explode(R._grams(F.col("text"), 4)).alias("g")).select("text", F.xxhash64("g").alias("key")), rows.limit(2).select(F.xxhash64(F.left("text", F.lit(4))).alias("key")))
    assert made.count() < 3000  # of 90,000


@pytest.mark.parametrize("held", [0, R.HELD_BYTES])
def test_index_of_pairs_is_as_large_as_the_rules(spark, monkeypatch, held):
    """However many word pairs of the texts a value can stand for; no pairs of the corpus are counted."""
    posts = [(i, f"x{i}of the{i} long{i}er\tpart{i % 7} of 1") for i in range(200)]
    rules = [("of the", "all"), ("f the1", "some"), ("er\tpart3 of", "tab"), ("er part3 of", "no"), ("5of the5 ", "one"), ("part1 of 1", "last")]
    p, r = spark.createDataFrame(posts, "tweet_id long, text string"), spark.createDataFrame(rules, "value string, tag string")
    values = r.select("value", F.monotonically_increasing_id().alias("rule"))
    assert R._by_ends(values, R._parts(values), 4).count() == len(rules)
    monkeypatch.setattr(R, "_pair_matches", None)
    assert found(R.tag_by_rule_table(p, r, held_bytes=held)) == brute(posts, rules)
