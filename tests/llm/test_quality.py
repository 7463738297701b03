"""The quality classifier on held-out labels, its parts against plain forms, and on odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pictolytics.llm import quality
from pictolytics.llm.queries import REGISTRY

TABLES = "/root/testdata/sf0.01"


def test_grams_are_distinct_and_of_the_whole_text():
    grams = quality.Grams()
    raw = ("ab " * 30 + "äé z").encode()
    plain = {raw[i : i + n] for n in quality.BYTES for i in range(len(raw) - n + 1)}
    words = raw.split()
    shapes = {tuple(a == b for j, a in enumerate(w) for b in w[j + 1 :]) for w in (words[i : i + 4] for i in range(len(words) - 3))}
    found = grams(raw)
    assert len(np.unique(found)) == len(found) == len(plain) + len(shapes)
    assert set(grams(raw + b"#")) > set(found)  # the end of the text counts
    for short in (None, b"", b"a", b"ab", b"a b c"):
        assert len(grams(short)) <= 15
    assert sorted(grams(raw)) == sorted(found)  # the table that tells repeats needs no clearing


def test_support_vectors_reach_the_dual_optimum():
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(60, rng.integers(3, 20), replace=False)) for _ in range(80)]
    y = np.array([int(5 in r or 7 in r) for r in rows])
    ratio = quality._log_ratios(rows, y, 1.0)
    counts = [1 + np.bincount(np.concatenate([r for r, l in zip(rows, y) if l == c]), minlength=1 << quality.SPACE_BITS) for c in (1, 0)]
    assert np.allclose(ratio, np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum()))
    w = quality._support_vectors(rows, y, 0.1, 500, 1.0)
    full = np.zeros((80, 61))
    for i, r in enumerate(rows):
        full[i, r] = ratio[r]
    full[:, 60] = 1
    sign, cost = np.where(y, 1.0, -1.0), 0.1 * 80 / 2 / np.where(y, y.sum(), 80 - y.sum())

    def primal(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - sign * (full @ v))).sum()

    scaled = np.r_[w[:60] / ratio[:60], w[-1]]
    best = min(primal(scaled + e) for e in rng.normal(0, 0.01, (2000, 61)))
    assert primal(scaled) <= best + 1e-6


def test_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    rows = [r for r in REGISTRY["op12_quality"](spark, TABLES).collect()]
    assert len(rows) == spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in held if y == c] for c in (1, 0))
    ranked = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert ranked > 0.97 and np.mean([s >= 0.3 for s in good]) > 0.97


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    return [(i, " ".join(rng.choices(["tic", "tac", "toe"] if i % 2 else ["vim", "von", "vex"], k=rng.randint(1, 40)))) for i in range(200)]


def test_learns_scores_and_bounds_its_sample(spark, texts):
    odd = [(None, "tic"), (3, texts[3][1]), (900, None), (901, ""), (902, "vim " * 60_000)]
    clash = {c: F.lit(0) for c in ("_key", "_y", "_slot", "_grams", "_text", "score", "quality")}
    docs = spark.createDataFrame(texts + odd, "doc_id long, text string").withColumns(clash)
    marks = [(i, i % 2) for i, _ in texts] + [(3, 0), (None, 1), (5, None), (7000, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int").withColumns({"text": F.lit("x"), "_key": F.lit(1)})
    for bounds in ({}, {"sample_rows": 60}, {"sample_grams": 2_000}):
        model = quality.fit_quality(docs, labels, **bounds)
        rows = quality.score_quality(docs, model).collect()
        scores = dict((r.doc_id, r.score) for r in rows)
        assert len(rows) == 205 and all((scores[i] > 0.5) == bool(i % 2) for i, _ in texts)
        assert scores[None] > 0.5 > scores[902] and scores[900] == scores[901]
    assert np.allclose([r.score for r in rows if r.doc_id == 3], scores[3])


def test_one_class_no_labels_and_empty_tables(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for marks, expected in (([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.5)):
        model = quality.fit_quality(docs, spark.createDataFrame(marks, "doc_id long, quality int"))
        assert {round(r.score, 6) for r in quality.score_quality(docs, model).collect()} == {expected}
    model = quality.fit_quality(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert quality.score_quality(docs.limit(0), model).collect() == []
