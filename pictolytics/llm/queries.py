"""The operators bound to the given tables: name -> (session, folder) -> DataFrame."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pictolytics.llm import (
    decontamination,
    embeddings,
    jaccard,
    licenses,
    packing,
    quality,
    repeats,
    runs,
    search,
    secrets,
    toxicity,
    urls,
    warc,
)
from pictolytics.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CATEGORIES = ("quality", "toxic")


def query(f: Query) -> Query:
    @wraps(f)
    def bound(spark: SparkSession, folder: str) -> DataFrame:
        return f(spark, folder)

    REGISTRY[f.__name__] = bound
    return bound


@query
def op9_packing(spark, folder):
    import public_tokenizers

    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    chain = toxicity.fit_chain(docs, table(spark, folder, "labels"), CATEGORIES)
    scored = toxicity.score_chain(docs, chain)
    return scored.select("doc_id", "p_quality", "p_toxic", (F.col("p_toxic") >= chain.thresholds["toxic"]).alias("toxic"))


@query
def op2_secret_scans(spark, folder):
    found = secrets.find_secrets(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    base = secrets.base_only(F.col("spans"))
    counts = {f"n_{k}": F.size(secrets.base_only(F.col("spans"), k)).cast("long") for k in secrets.BASE}
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in counts.items()],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


@query
def op6_benchmark_decontamination(spark, folder):
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op5_ngram_jaccard_join(spark, folder):
    return jaccard.similar_components(table(spark, folder, "documents"))


@query
def op8_substring_dedup(spark, folder):
    return repeats.find_repeats(table(spark, folder, "documents"))


@query
def op4_warc(spark, folder):
    store = warc.archive_folder(spark)
    archives = warc.write_archives(table(spark, folder, "pages"), store)
    return warc.read_archives(archives, store).drop("url", "html")


@query
def op7_embedding_near_dedup(spark, folder):
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


ORACLES["op7_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(e, lambda x: abs(x))) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS n, vec_id AS r FROM v UNION SELECT reach.n, link.b FROM reach JOIN link ON link.a = reach.r
), comp AS (SELECT n, min(r) AS component_id FROM reach GROUP BY n)
SELECT n AS vec_id, (SELECT count(*) FROM link WHERE link.a = n) AS n_links, component_id, component_id = n AS kept FROM comp
"""


@query
def op3_license_scans(spark, folder):
    found = licenses.scan_licenses(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


_TEMPLATES = ", ".join(f"('{n}', '{t}')" for n, t in licenses.TEMPLATES.items())
_STEP = max(len(t.split()) for t in licenses.TEMPLATES.values())

# Every block against every template, by counting common words.
ORACLES["op3_license_scans"] = rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), t AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(len(w))) AS i FROM d),
p AS (
  SELECT doc_id, i, CASE WHEN x = 'mit' AND x1 = 'license' THEN 'mit' WHEN x = 'apache' AND x1 = 'license' THEN 'apache'
    WHEN x = 'general' AND x1 = 'public' AND x2 = 'license' THEN 'gpl' END AS label
  FROM (SELECT doc_id, i, x, lead(x) OVER o AS x1, lead(x, 2) OVER o AS x2 FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i))
), b AS (SELECT doc_id, count(*) AS n_base, min(i) AS lo, max(i) AS hi FROM p WHERE label IS NOT NULL GROUP BY doc_id),
v AS (SELECT label, unnest(s) AS x, len(s) AS size, ceil(len(s) * {licenses.CONTAINMENT}) AS need
  FROM (SELECT label, list_distinct(string_split(words, ' ')) AS s FROM (VALUES {_TEMPLATES}) AS y(label, words))),
k AS (SELECT doc_id, x, unnest([i // {_STEP}, i // {_STEP} - 1]) AS block, greatest(n - {_STEP} - 1, 0) // {_STEP} AS last FROM t),
m AS (SELECT doc_id, label, count(DISTINCT x) / size AS share FROM k JOIN v USING (x) WHERE block BETWEEN 0 AND last
  GROUP BY doc_id, block, label, size, need HAVING count(DISTINCT x) >= need),
s AS (SELECT doc_id, max(share) AS share FROM m GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels
  FROM (SELECT doc_id, label, true AS base FROM p WHERE label IS NOT NULL UNION ALL SELECT doc_id, label, false FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0) END AS score
FROM d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN l ON l.doc_id = d.doc_id
"""


URL_RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


@query
def op1_url_filters(spark, folder):
    """Trees are trained on the URLs that the rules label and judge the others."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = urls.fit_urls(pages, "url", urls.label_by_rules(URL_RULES))
    return urls.judge_urls(pages, "url", URL_RULES, model).drop("url")


@query
def op11_ranked_search(spark, folder):
    return search.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


KEEP_FROM = 0.3


@query
def op12_quality(spark, folder):
    """Labels of a fifth of the documents, by a hash of the id, are never learnt from."""
    docs = table(spark, folder, "documents")

    def apart(labelled: DataFrame):
        return F.crc32(labelled["doc_id"].cast("string")) % 5 == 0

    labels = table(spark, folder, "labels")
    model = quality.fit_quality(docs, labels.where(~apart(labels)).select("doc_id", "quality"))
    scored = quality.score_quality(docs, model)
    return scored.select(
        "doc_id", apart(scored).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted")
    )


def repeating(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by a hash of the id, repeat a part of theirs up to the end."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query
def op13_periodic_runs(spark, folder):
    found = runs.find_runs(table(spark, folder, "documents"), prepare=repeating)
    longest = F.element_at(F.array_sort("runs", lambda x, y: F.when(
        F.struct(-x["length"], x["start"], x["period"]) < F.struct(-y["length"], y["start"], y["period"]), -1).otherwise(1)), 1)
    listed = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    found = found.withColumn("longest", F.when(F.size("runs") > 0, longest))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.*",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# SHA-1 in base 32: five bits at a time, out of two hexadecimal digits.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
  (CAST('0x' || substr(s || '0', 1 + (5 * i) // 4, 2) AS INTEGER) >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31 AS BIGINT), 1)), '')"""

ORACLES["op4_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
FROM d
"""

ORACLES["op5_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(len(ws) - 4), lambda i: array_to_string(ws[i + 1:i + 5], ' ')) END)) AS sh FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, e.b FROM reach JOIN e ON e.a = reach.r)
SELECT d AS doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.d GROUP BY d
"""


# CRC-32 of the decimal id, bit by bit. Runs are islands of places i whose word comes again q words later; only
# equal words are joined, and every stretch keeps its smallest period.
ORACLES["op13_periodic_runs"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(length(CAST(doc_id AS VARCHAR))),
      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS BIGINT), 1)) AS BIGINT))),
      lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)),
        lambda b, k: xor(b >> 1, CASE WHEN b & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS h
  FROM documents
), e AS (SELECT doc_id, ws, len(ws) AS n, h, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN n > 0 AND h % 10 = 0 THEN g % n ELSE n END AS a FROM e),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM f),
t AS (SELECT doc_id, i, ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS w, n
  FROM (SELECT doc_id, ws, n, a, p, unnest(range(n)) AS i FROM p)),
s AS (SELECT x.doc_id, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
  FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
m AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM m GROUP BY doc_id, start, length),
b AS (SELECT doc_id, count(*) AS n_runs, arg_min([start, length, period], [-length, start, period]) AS best,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS rest FROM t WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.doc_id = t.doc_id AND t.i >= r.start + r.period AND t.i < r.start + r.length) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period,
  1000 * best[2] // best[3] AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""

ORACLES["op11_ranked_search"] = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
m AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // words AS m FROM n, a),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), df AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, a GROUP BY term, docs),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN df USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
