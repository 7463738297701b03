"""Ranked search against brute force, and on nulls, ties, repeats, empty tables and odd columns."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pictolytics.llm import search

WORDS = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "un", "or")]
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items, limit):
    counts = [(d, Counter(TERM.findall((t or "").translate(UPPER)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            score = 0
            for t in set(TERM.findall((text or "").translate(UPPER))) & c.keys():
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:limit], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(4)
    zipf = [1 / (i + 1) for i in range(len(WORDS))]
    texts = [" ".join(rng.choices(WORDS, zipf, k=rng.randint(1, 90))) for _ in range(300)]
    texts += [texts[3]] * 5 + ["", None, "  .,; ", "Ünï Ünï ünï", "BA_be!bi", "ba " * 40_000]
    rows = list(enumerate(texts))
    return [*rows, (3, texts[3]), (None, texts[5]), (None, texts[5]), (-7, texts[5])]


@pytest.fixture(scope="module")
def items():
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 25)))) for i in range(20)]
    return [*rows, (20, None), (21, ""), (22, "ba"), (23, "unknown words"), (24, "ÜNÏ ünï. BA"), (None, "be bi"), (22, "bo bo bo")]


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_search_equals_brute_force(spark, docs, items, limit):
    clash = {c: F.lit("x") for c in ("_key", "_n", "_terms", "_item", "score", "rank", "_part", "_id", "_text")}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash).repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string").withColumns(clash)
    ranked = search.rank_documents(d, i, limit)
    assert ranked.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert found(ranked) == brute(docs, items, limit)


def test_search_in_blocks_of_items_and_many_indexes(spark, docs, items, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BYTES", 300)
    monkeypatch.setattr(search, "POSTINGS", 500)
    monkeypatch.setattr(search, "STEP", 16)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        ranked = found(search.rank_documents(d, spark.createDataFrame(items, "item_id long, text string"), 5))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert ranked == brute(docs, items, 5)


def test_lists_below_the_bar_propose_nothing():
    # Term 0 is in all documents with a low contribution, term 1 in a few with a high one.
    docs = np.r_[np.arange(10_000), np.arange(0, 10_000, 100)]
    terms = np.r_[np.zeros(10_000, int), np.ones(100, int)]
    index = search.Index(docs, terms, np.r_[np.full(10_000, 3), np.arange(100, 200)], 10_000, 2)
    best = search.Best(5)
    asked = []
    real = np.searchsorted

    def counting(a, v, *rest, **more):
        if isinstance(v, np.ndarray):
            asked.append(len(v))
        return real(a, v, *rest, **more)

    search.np.searchsorted, keep = counting, real
    try:
        index.search(np.array([0, 1]), best, np.arange(10_000), np.ones(10_000, bool))
    finally:
        search.np.searchsorted = keep
    assert best.scores.tolist() == [202, 201, 200, 199, 198] and best.keys.tolist() == [9900, 9800, 9700, 9600, 9500]
    assert sum(asked) <= 100  # after the first window only what term 1 proposes is looked up in term 0


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.rank_documents(none, items).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id long, text string")
    assert search.rank_documents(some, items.limit(0)).collect() == []
    assert search.rank_documents(some.select("doc_id", F.lit(None).cast("string").alias("text")), items).collect() == []
