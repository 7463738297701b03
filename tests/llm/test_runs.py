"""Periodic runs against brute force, and on nulls, long texts, repeats, empty tables and odd columns."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pictolytics.llm import runs


def brute(x, exponent, least):
    out = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, l, q) for (s, l), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([(2, 2), (3, 4), (4, 6)]))
@settings(max_examples=400, deadline=None)
def test_runs_of_small_alphabets(x, bounds):
    assert list(zip(*(a.tolist() for a in runs.runs_of(np.array(x, np.int64), *bounds)), strict=True)) == brute(x, *bounds)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12), st.lists(st.integers(0, 3), max_size=9))
@settings(max_examples=300, deadline=None)
def test_runs_of_repeated_parts(part, times, rest):
    x = rest + part * times + rest[::-1] + part
    assert list(zip(*(a.tolist() for a in runs.runs_of(np.array(x, np.int64), 2, 2)), strict=True)) == brute(x, 2, 2)


def test_suffix_array_and_common_words():
    rng = np.random.default_rng(2)
    x = np.tile(rng.integers(0, 3, 23), 9)
    s = runs.SuffixArray(x)
    assert s.sa.tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist()) and s.isa[s.sa].tolist() == list(range(len(x)))
    for a, b in ((0, 23), (5, 51), (1, 2)):
        ahead = next((k for k in range(len(x)) if b + k == len(x) or x[a + k] != x[b + k]))
        behind = next((k for k in range(len(x)) if a - k == 0 or x[a - k - 1] != x[b - k - 1]))
        assert s.common(np.array([a]), np.array([b]))[0] == ahead and s.common_before(np.array([a]), np.array([b]))[0] == behind


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = []
    for _ in range(150):
        words = rng.choices(["a", "b", "c", "Ä", "a,"], k=rng.randint(0, 30))
        part = rng.choices("xyz", k=rng.randint(1, 5))
        texts.append("\t".join(words) + " " + "  ".join(part * rng.randint(1, 9)) + "\n" + " ".join(words))
    texts += ["", None, " \n ", "one", "w " * 50_000, "a b c " * 20_000 + "end", "a a a a a a a a a a a a"]
    return [*enumerate(texts), (3, texts[3]), (None, texts[4])]


@pytest.mark.parametrize("portion", [10, 200_000])
def test_find_runs_equals_brute_force(spark, rows, portion, monkeypatch):
    monkeypatch.setattr(runs, "PORTION", portion)
    clash = {c: F.lit(1) for c in ("runs", "collapsed", "n_words", "start", "_text")}
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash).repartition(3)
    found = runs.find_runs(df)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    expected = []
    for d, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        if len(words) < 1000:
            own = brute(words, 4, 6)
        else:
            own = [(0, 50_000, 1)] if words[1] == "w" else [(0, 60_000, 3)]
        expected.append((d, len(words), own, collapsed(words, own)))
    assert got == sorted(expected, key=repr)


def test_words_may_be_replaced_and_nothing_gives_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id long, text string")
    found = runs.find_runs(df, prepare=lambda k, words: words * 5 if k == 1 else words)
    assert {r.doc_id: (r.n_words, r.collapsed) for r in found.collect()} == {1: (10, "a b"), 2: (2, "a b")}
    assert runs.find_runs(df.limit(0)).collect() == []
