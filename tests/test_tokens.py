import duckdb
import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pictolytics.functions import text as X
from pictolytics.functions.patterns import EMOJI_PATTERN, FACE_EMOJI, JVM_EMOJI_PATTERN, PRESENTATION_SELECTOR, TONES
from pictolytics.operators import tokens as T

SCOTLAND = "\U0001F3F4\U000E0067\U000E0062\U000E0073\U000E0063\U000E0074\U000E007F"

GOLDEN = [
    ("hi 👍", ["👍"]),
    ("👍 ok 👍", ["👍", "👍"]),
    ("⬇️⬇️⬇️ x", ["⬇️", "⬇️", "⬇️"]),
    ("🙌🏿🙌🏾🙌 🙏🏾", ["🙌🏿", "🙌🏾", "🙌", "🙏🏾"]),
    ("🇺🇸🇫🇷", ["🇺🇸", "🇫🇷"]),
    ("👩‍💻 1️⃣ ☝🏽", ["👩‍💻", "1️⃣", "☝🏽"]),
    ("👨‍👩‍👧x😀😀", ["👨‍👩‍👧", "😀", "😀"]),
    ("©2020 — “q” … plain", ["©"]),
    ("10€ — ok 😀", ["😀"]),
    ("plain → • text", []),
    ("𝐀bc", []),
    (f"a {SCOTLAND}{SCOTLAND} b", [SCOTLAND, SCOTLAND]),
    ("12 #3 *4 only ascii", []),
    ("日本語のテキスト 🎌 です", ["🎌"]),
    ("❤️‍🔥", ["❤️‍🔥"]),
    ("", []),
    (None, None),
]

PIECES = st.sampled_from(
    ["a", " ", "é", "7", "#", "*", "—", "語", "‍", "️", "⃣", "☝", "🏽", "🏿", "🙏", "👩", "💻", "🇺", "🇸", "❤", "©"]
    + [SCOTLAND, "\U0001F1E6", "\U0001F3F4", "\U000E0067", "\U000E007F", "𝐀", "㊗", "€"]
)
TEXTS = st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=60, max_size=60)
PROPERTY = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def cut(spark, texts, column=X.emoji_tokens):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("t"))).collect()]


def test_golden_texts(spark):
    assert cut(spark, [t for t, _ in GOLDEN]) == [found for _, found in GOLDEN]


def test_golden_texts_in_the_other_engine():
    for text, found in GOLDEN:
        assert duckdb.execute(f"SELECT regexp_extract_all(?, '{EMOJI_PATTERN}')", [text]).fetchone()[0] == found


@PROPERTY
@given(TEXTS)
def test_fast_pattern_and_ascii_test_change_nothing(spark, texts):
    plain = cut(spark, texts, lambda c: F.regexp_extract_all(c, F.lit(EMOJI_PATTERN), F.lit(0)))
    fast = cut(spark, texts, lambda c: F.regexp_extract_all(c, F.lit(JVM_EMOJI_PATTERN), F.lit(0)))
    other = [duckdb.execute(f"SELECT regexp_extract_all(?, '{EMOJI_PATTERN}')", [t]).fetchone()[0] for t in texts]
    assert cut(spark, texts) == fast == plain == other


@PROPERTY
@given(TEXTS)
def test_space_separates_and_nothing_is_empty(spark, texts):
    left, right = texts[:30], texts[30:]
    joined = cut(spark, [a + " " + b for a, b in zip(left, right)])
    assert joined == [a + b for a, b in zip(cut(spark, left), cut(spark, right))]
    assert all(token for tokens in joined for token in tokens)


def test_every_face_is_one_token(spark):
    assert cut(spark, ["x".join(FACE_EMOJI)]) == [FACE_EMOJI]


def test_posts_without_emoji_or_text_give_no_row(make_posts):
    posts = make_posts([(1, "none"), (2, None), (3, ""), (4, "a 😀 b 🙏🏽😀")])
    assert [(r.tweet_id, r.emoji) for r in T.explode_emoji(posts).collect()] == [(4, "😀"), (4, "🙏🏽"), (4, "😀")]


def test_both_spellings_count_as_one_unless_asked(make_posts):
    posts = make_posts([(1, "❤️ ❤ ❤️")])
    assert [r.emoji for r in T.explode_emoji(posts).collect()] == ["❤"] * 3
    assert [r.emoji for r in T.explode_emoji(posts, normalize="none").collect()] == ["❤️", "❤", "❤️"]
    assert [r.emoji for r in T.explode_emoji(posts, per_post=True).collect()] == ["❤"]
    with pytest.raises(ValueError):
        T.explode_emoji(posts, normalize="nfc")


def test_text_is_kept_next_to_the_token(make_posts):
    row = T.explode_emoji(make_posts([(1, "a 😀")])).first()
    assert (row.text, row.emoji) == ("a 😀", "😀")


def test_tones(spark):
    tokens = ["🙏", "🙏🏽", "👩🏿‍💻", "☝🏻"]
    assert cut(spark, tokens, X.base_emoji) == ["🙏", "🙏", "👩‍💻", "☝"]
    assert cut(spark, tokens, lambda c: X.base_emoji(X.base_emoji(c))) == cut(spark, tokens, X.base_emoji)
    assert [TONES.get(t) for t in cut(spark, tokens, X.tone_of)] == [None, "medium", "dark", "light"]


def test_variants_skip_other_texts_but_find_both_spellings(make_posts):
    posts = make_posts([(1, "🙏 🙏 🙏🏽"), (2, "😀"), (3, "❤️ and ❤"), (4, "🙏🏿x")])
    assert [(r.tweet_id, r.emoji) for r in T.explode_variants(posts, "🙏").collect()] == [
        (1, "🙏"),
        (1, "🙏🏽"),
        (4, "🙏🏿"),
    ]
    assert [r.emoji for r in T.explode_variants(posts, "❤️", per_post=False).collect()] == ["❤", "❤"]
    assert T.any_variant(T.explode_emoji(posts), "🙏|😀").count() == 5


def test_repost_prefix(make_posts):
    posts = make_posts([(1, "RT @a: 😀"), (2, "RTX 😀"), (3, "so RT 😀"), (4, None)])
    assert [r.tweet_id for r in T.select_posts(posts).collect()] == [3]
    assert [r.tweet_id for r in T.select_posts(posts, repost_prefix="RT @").collect()] == [2, 3]
    assert T.select_posts(posts, keep_reposts=True).count() == 4


def test_words(make_posts):
    rows = T.explode_words(make_posts([(1, " a  b\n a\t"), (2, ""), (3, None)])).collect()
    assert [r.word for r in rows] == ["a", "b", "a"]
    assert [r.word for r in T.explode_words(make_posts([(1, "a b a")]), per_post=True).collect()] == ["a", "b"]


def test_sql_functions(spark):
    X.register_sql_functions(spark)
    row = spark.sql("SELECT emoji_tokens('a 🙏🏽 1️⃣') t, emoji_tokens('a') e, base_emoji('🙏🏽') b, emoji_tone('🙏🏽') o").first()
    assert (row.t, row.e, row.b, row.o) == (["🙏🏽", "1️⃣"], [], "🙏", "🏽")


def test_rules_and_search(spark, make_posts):
    from pictolytics.operators import tagging as G

    posts = make_posts([(1, "cats 😀"), (2, "dogs and cats"), (3, "birds ☺"), (4, None)])
    tagged = G.tag_by_rules(posts, [("cats", "pet"), ("dogs", "pet"), ("dogs", "loud")])
    assert [(r.tweet_id, r.tags) for r in tagged.collect()] == [(1, ["pet"]), (2, ["loud", "pet"])]
    assert [r.tweet_id for r in G.containing_any(posts, FACE_EMOJI).collect()] == [1, 3]
    assert PRESENTATION_SELECTOR in FACE_EMOJI[8]

    rules = spark.createDataFrame([("cats", "pet"), ("cats", "soft"), ("birds", "pet"), ("fish", "wet")], "value string, tag string")
    found = G.tag_by_token_rules(T.explode_words(posts), rules, "word").collect()
    assert sorted(map(tuple, found)) == [(1, "pet"), (1, "soft"), (2, "pet"), (2, "soft"), (3, "pet")]


def test_token_rules_collect_no_token_and_cut_once(spark, make_posts):
    from pictolytics.operators import tagging as G

    posts = make_posts([(i, f"w{i % 300} w{i % 7} w{i % 300}") for i in range(600)] + [(600, None), (601, " ")])
    said = [(f"w{i % 400}", f"t{i % 3}") for i in range(2400)]  # copies of rules
    rules = spark.createDataFrame([*said, ("w1", None), (None, "t9")], "value string, tag string")
    tagged = G.tag_by_token_rules(T.explode_words(posts, per_post=True).repartition(4), rules, "word")
    expected = {(i, t) for i in range(600) for v, t in said if v in (f"w{i % 300}", f"w{i % 7}")}
    plan = plan_of(tagged)
    assert sorted(map(tuple, tagged.collect())) == sorted(expected)
    assert "collect_set" not in plan  # it sorts all rows once a task has many groups
    cut = T.explode_words(posts)
    assert plan_of(cut, run=False).count("split(") == 1


def test_texts_of_any_length_return(spark):
    unit = "\U0001F469\u200D"
    texts = {
        1: unit * 50_000 + "\U0001F469",
        2: "\U0001F3F4" + "\U000E0067" * 50_000 + "\U000E007F",
        3: "\U0001F1EA\U0001F1F8" * 50_000,
        4: (unit + "x1\uFE0F\u20E3\U0001F3FD ") * 500_000,
    }
    df = spark.createDataFrame(list(texts.items()), "id int, text string")
    sizes = {r.id: r.n for r in df.select("id", F.size(X.emoji_tokens(F.col("text"))).alias("n")).collect()}
    assert sizes == {1: 1, 2: 1, 3: 50_000, 4: 1_000_000}


def test_links_of_a_chain_are_not_compared_with_every_range():
    from pictolytics.functions.patterns import EMOJI_BASE

    spans, whole = JVM_EMOJI_PATTERN.split("|")[-2:]  # of the links
    assert spans.endswith("]") and whole.startswith(f"[{EMOJI_BASE}]")


def test_long_chains_mixed_of_all_spans(spark):
    units = ["👩", "❤️", "☝🏽", "🤣", "🥰", "🟠", "🪐", "©", "🏴\U000E0067\U000E0062\U000E007F", "👍🏿"]
    chains = ["‍".join(units[(i * k) % 10] for i in range(3000)) for k in (1, 3, 7)]
    rows = cut(spark, [f"a {c} b{c}‍" for c in chains], lambda c: F.regexp_extract_all(c, F.lit(JVM_EMOJI_PATTERN), F.lit(0)))
    assert rows == [[c, c] for c in chains]
