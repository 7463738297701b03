"""Column names of callers that clash with inner or returned ones, stages on odd tables, and two operators by brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from pictolytics.llm import decontamination, jaccard, licenses, repeats, secrets, toxicity, urls
from pictolytics.llm.queries import URL_RULES

SOURCES = [decontamination, licenses, repeats, secrets, toxicity, urls]
NAMES = sorted({n for m in SOURCES for n in re.findall(r'"(_\w+)"', open(m.__file__).read())} | {"spans", "host", "rule", "labels", "score", "p_toxic", "x", "n"})
TEXT = "user=bob1 pwd: abcd1 at https://db.host.io/x mit license and more words of one line that is long enough to be a unit"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(1, TEXT), (2, TEXT), (None, TEXT), (3, None), (4, "")], "doc_id long, text string")
    return df.withColumns({n: F.lit(n) for n in NAMES})


@pytest.fixture(scope="module")
def plain(docs):
    return docs.select("doc_id", "text")


def same_but(found, expected, docs, *new):
    kept = [c for c in docs.columns if c not in new]
    assert found.columns == [*kept, *new]
    own = [n for n in NAMES if n not in new]
    assert all(all(r[n] == n for n in own) for r in found.select(*own).collect())
    as_text = lambda df: sorted(map(str, df.select("doc_id", *new).collect()))
    assert as_text(found) == as_text(expected)


def test_secrets_with_any_names(docs, plain):
    same_but(secrets.find_secrets(docs), secrets.find_secrets(plain), docs, "spans")


def test_licenses_with_any_names(docs, plain):
    new = ("n_words", "starts", "base_labels", "labels", "score")
    same_but(licenses.scan_licenses(docs), licenses.scan_licenses(plain), docs, *new)


def test_urls_with_any_names(spark, docs):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(F.col("page_id").alias("doc_id"), "url").limit(60)
    named = pages.withColumns({n: F.lit(n) for n in NAMES})
    model = urls.fit_urls(pages, "url", urls.label_by_rules(URL_RULES))
    found, expected = (urls.judge_urls(p, "url", URL_RULES, model) for p in (named, pages))
    same_but(found, expected, named, "host", "path", "rule", "verdict", "p_block")


def test_leaks_and_repeats_with_any_names(spark, docs, plain):
    benchmark = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    kept = decontamination.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4]
    found = repeats.find_repeats(docs)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, repeats.find_repeats(plain).collect()))
    cut = repeats.without_repeats(docs, found)
    assert cut.columns == docs.columns and {r.doc_id: r.text for r in cut.collect() if r.doc_id} == {1: TEXT, 2: "", 3: None, 4: ""}


# The pipeline's stages


def stage(name):
    return dict(P.STAGES)[name]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choices(words, k=60))
    near = long + " end"
    rows = [(5, long), (9, near), (None, long), (None, near), (7, "short text"), (7, "short text"), (7, "another one"), (8, None), (10, ""), (11, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1).cast("long")})
    return df.withColumns({n: F.lit(n) for n in NAMES})


def test_one_row_of_each_group_stays(spark, odd):
    kept = stage("near copies")(spark, odd, "/root/testdata/sf0.001")
    assert kept.columns == odd.columns
    found = sorted(((r.doc_id, (r.text or "")[:5]) for r in kept.collect()), key=repr)
    assert found == sorted([(5, "w" + odd.first().text[1:5]), (7, "short"), (7, "anoth"), (8, ""), (10, ""), (11, "")], key=repr)


def test_ids_without_repeats_are_decided_alike(spark, odd):
    plain = odd.where("doc_id in (5, 9, 8, 10, 11)")
    kept = stage("near copies")(spark, plain, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in kept.collect()) == [5, 8, 10, 11]


def test_secrets_are_struck_out_whatever_the_columns(spark, odd):
    changed = odd.withColumn("text", F.when(F.col("doc_id") == 5, "a password=hunter22 b").otherwise(F.col("text")))
    found = stage("secrets")(spark, changed, "")
    assert found.columns == odd.columns and {r.spans for r in found.select("spans").collect()} == {"spans"}
    rows = {(r.doc_id, r.text, r.n_chars) for r in found.collect()}
    assert (5, "a <SECRET> b", 12) in rows and (8, None, 1) in rows and len(found.collect()) == 10


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_of_nothing(spark, odd, name):
    if name == "packing":
        pytest.importorskip("public_tokenizers")
    found = stage(name)(spark, odd.limit(0), "/root/testdata/sf0.001")
    assert found.collect() == [] and (name == "packing" or found.columns == odd.columns)


# Repeats by brute force


def test_repeats_equal_brute_force(spark):
    rng = random.Random(12)
    words = ["alpha", "Beta", "gamma", "delta", "eps"]
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 14))) + rng.choice(["", ".", " Xi. more of it is here now ok?"]) for _ in range(25)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(60)]
    rows += [(60, rows[7][1]), (61, None), (62, ""), (63, "z " * 20_000)]
    df = spark.createDataFrame([*rows, rows[3], (None, rows[5][1])], "doc_id long, text string").repartition(5)
    places = defaultdict(set)
    for d, t in rows:
        for cut in (repeats.units(t or "", 6, 8), repeats.chunks(t or "")):
            for start, end, line, digest in cut:
                places[digest[:12]].add((d, start, end, line))
    copies = Counter()
    for d, t in [*rows, rows[3]]:  # repeated rows count as occurrences
        for cut in (repeats.units(t or "", 6, 8), repeats.chunks(t or "")):
            copies.update(digest[:12] for *_, digest in cut)
    repeated = set()
    for digest, found in places.items():
        kept = min(found)
        repeated |= {(*p, kept[:2], copies[digest]) for p in found if p[0] != kept[0] or p[1] >= kept[2]}
    whole = defaultdict(int)
    for d, start, end, line, *_ in repeated:
        if start == line:
            whole[d, line] = max(whole[d, line], end)
    best = {}
    for d, start, end, line, kept, n in repeated:
        until = whole.get((d, line))
        if until is None or start >= until or (start == line and end == until):
            best[d, start, end] = min(best.get((d, start, end), (*kept, n)), (*kept, n))
    expected = sorted((*k, *v) for k, v in best.items())
    assert sorted(map(tuple, repeats.find_repeats(df).collect())) == expected and len(expected) > 100


# The chain by plain sums


def test_chain_equals_plain_sums(spark):
    rng = np.random.default_rng(5)
    known = np.unique(rng.integers(0, 2**32, 500, dtype=np.uint32))
    texts = ["alpha beta Beta", "", None, "gamma, alphabet!"]
    known = np.unique(np.r_[known, toxicity.features("alpha gamma alphabet")])
    chain = toxicity.Chain(("a", "b"), np.array([0.3, -0.2]), np.array([[0, 0], [1.5, 0]]), known, rng.normal(size=(len(known), 2)), {})
    found = chain.probabilities(texts)
    for text, p in zip(texts, found, strict=True):
        before = []
        for i in range(2):
            z = chain.bias[i] + sum(chain.given[i, j] * (before[j] - 0.5) for j in range(i))
            z += sum(chain.weights[k, i] for k, h in enumerate(known) if h in toxicity.features(text))
            before.append(1 / (1 + np.exp(-z)))
        assert np.allclose(p, before)
