"""The pipeline's stages on planted cases, each held against what its operator says."""

import re

import pytest

import corpus_pipeline as P
from pictolytics.llm.common import landed
from pictolytics.llm.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


def test_all_operators_have_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY) == list(range(1, 14))


def test_stages_take_effect(spark):
    pytest.importorskip("public_tokenizers")
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "near copies", "decontamination", "secrets", "packing"]
    steps = {"raw": raw}
    docs = raw
    for name, stage in P.STAGES[:-1]:
        docs = steps[name] = landed(stage(spark, docs, SMALL), "test")
        assert docs.columns == raw.columns
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in steps.items()}
    assert ids["toxicity"] < ids["raw"]

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert all(d in ids["toxicity"] for d, t in labels.items() if not t and d in ids["raw"])

    benchmark = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in steps["near copies"].collect()}
    leaking = {d for d, t in before.items() if any(b in t for b in benchmark)}
    assert ids["decontamination"] == ids["near copies"] - leaking

    assert ids["secrets"] == ids["decontamination"]
    for r in steps["secrets"].collect():
        assert not re.search(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", r.text) and (r.n_chars == len(r.text) or r.text == before[r.doc_id])

    packed = P.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids["secrets"]
