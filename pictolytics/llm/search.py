"""Ranked lexical search: short lists term at a time, long ones document at a time.

Every task holds an inverted index of some documents at a time. For an item, the shortest of its lists are
summed term at a time into accumulators. These then count as one list whose bound is their largest sum,
next to the long lists, each bounded by its largest contribution. Document at a time, by windows of
documents, only lists whose bounds together can still lift a document into the best ones propose candidates
(the essential ones); the others are not read but asked for the candidates, largest bound first, and
candidates that their remaining bounds cannot save are dropped on the way. The bar rises with every document found
and stays from one index to the next.

Documents are cut once: a first job writes, for each document, its length and its counts of the items' terms.
Counts over all documents come from that table, and so do the indexes, so nothing is shuffled but the
best of each task. All scores are whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pictolytics.llm.common import landed

#: Bytes of item texts that one pass over the documents answers; more items take more passes.
BLOCK_BYTES = 4 << 20
#: Postings of one index.
POSTINGS = 2_000_000
#: Short lists together have as many postings as one document in so many.
SHORT = 8
#: Documents of a window.
STEP = 4096
#: Parts that the best of all tasks are merged in first.
PARTS = 64

# ASCII letters in lower case and digits are kept, as is everything beyond ASCII; the rest parts terms.
_TO_TERMS = bytes(c if c >= 128 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_TERMS).split()


class Best:
    """The ``limit`` best of what was added, equal scores by ascending key, those without a key last."""

    def __init__(self, limit: int):
        self.limit, self.bar = limit, 1  # a score of 0 is none
        self.scores, self.keys, self.known = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, keys: np.ndarray, known: np.ndarray) -> None:
        scores, keys, known = np.r_[self.scores, scores], np.r_[self.keys, keys], np.r_[self.known, known]
        order = np.lexsort((keys, ~known, -scores))[: self.limit]
        self.scores, self.keys, self.known = scores[order], keys[order], known[order]
        if len(order) == self.limit:
            self.bar = max(1, int(self.scores[-1]))


class Index:
    """Lists of (document, contribution) by term, over documents numbered from 0."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, values: np.ndarray, n_docs: int, n_terms: int):
        order = np.argsort(terms, kind="stable")  # documents stay in order within a term
        self.docs, self.values = docs[order], values[order]
        self.at = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.n_docs = n_docs
        self.most = np.zeros(n_terms, np.int64)
        some = np.flatnonzero(np.diff(self.at))
        if len(some):
            self.most[some] = np.maximum.reduceat(self.values, self.at[some])

    def lists(self, item: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Bound, documents and contributions of the accumulators and the long lists, by rising bound."""
        item = item[self.most[item] > 0]
        size = self.at[item + 1] - self.at[item]
        item = item[np.argsort(size, kind="stable")]
        short = int(np.searchsorted(np.cumsum(np.sort(size)), self.n_docs // SHORT, side="right"))
        out = [(int(self.most[t]), self.docs[self.at[t] : self.at[t + 1]], self.values[self.at[t] : self.at[t + 1]]) for t in item[short:]]
        if short:
            places = np.concatenate([np.arange(self.at[t], self.at[t + 1]) for t in item[:short]])
            order = places[np.argsort(self.docs[places], kind="stable")]
            docs = self.docs[order]
            first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
            sums = np.add.reduceat(self.values[order], first)
            out.append((int(sums.max()), docs[first], sums))
        return sorted(out, key=lambda x: x[0])

    def search(self, item: np.ndarray, best: Best, keys: np.ndarray, known: np.ndarray) -> None:
        """Add to ``best`` what is among the best of these documents for the terms of ``item``."""
        lists = self.lists(item)
        if not lists:
            return
        upto = np.cumsum([bound for bound, _, _ in lists])  # of all lists up to each
        sums = np.zeros(min(STEP, self.n_docs), np.int64)
        for lo in range(0, self.n_docs, STEP):
            essential = int(np.searchsorted(upto, best.bar))  # lists before it cannot reach the bar, not even together
            if essential == len(lists):
                return
            sums[:] = 0
            for _, docs, values in lists[essential:]:
                a, b = np.searchsorted(docs, (lo, lo + STEP))
                sums[docs[a:b] - lo] += values[a:b]
            found = np.flatnonzero(sums)
            scores = sums[found]
            found += lo
            for k in range(essential - 1, -1, -1):
                able = scores + upto[k] >= best.bar
                found, scores = found[able], scores[able]
                _, docs, values = lists[k]
                place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                scores = scores + np.where(docs[place] == found, values[place], 0)
            good = scores >= best.bar
            if good.any():
                best.add(scores[good], keys[found[good]], known[found[good]])


def _counted(docs: DataFrame, key: str, text: str, number: dict[bytes, int]) -> DataFrame:
    """``_key``, ``_n`` (terms of the document), and its counts of the terms that have a number."""
    kind = pa.list_(pa.int32())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, ends, found, times = [], [0], [], []
            for t in b.column(1):
                words = terms(t.as_py())
                counts = Counter(map(number.get, words))
                counts.pop(None, None)
                size.append(len(words))
                found.extend(counts.keys())
                times.extend(counts.values())
                ends.append(len(found))
            at = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())).cast(kind) for x in (found, times)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), *lists], ["_key", "_n", "_terms", "_times"])

    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("binary").alias("_text"))
    return rows.mapInArrow(count, "_key long, _n long, _terms array<int>, _times array<int>")


def _ranked(docs: DataFrame, ids: pa.Array, texts: list[bytes], item_kind: str, item_key: str, key: str, text: str, limit: int) -> DataFrame:
    """``rank_documents`` for some items, whose terms are held by every task."""
    number: dict[bytes, int] = {}
    items = [np.array(sorted({number.setdefault(w, len(number)) for w in terms(t)}), np.int64) for t in texts]
    counted = landed(_counted(docs, key, text, number), "search-counts")
    n_docs, total = counted.agg(F.count_if(F.col("_n") > 0), F.coalesce(F.sum("_n"), F.lit(0))).first()
    # One row per term of the items at most, as is what follows from it.
    held = counted.select(F.explode("_terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow()
    weight = np.zeros(len(number), np.int64)
    for t, df in zip(held["t"].to_pylist(), held["df"].to_pylist(), strict=True):
        weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(limit) for _ in items]

        def all_items(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            n = rows["_n"].to_numpy()
            lists = [rows[c].combine_chunks() for c in ("_terms", "_times")]
            t, times = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            doc = np.repeat(np.arange(len(n)), lists[0].value_lengths().to_numpy())
            long = 100 - 50 + (50 * n * n_docs) // total
            index = Index(doc, t, weight[t] * ((1_000_000_000 * times) // (1000 * times + 20 * long[doc])), len(n), len(weight))
            keys, known = rows["_key"].combine_chunks().fill_null(0).to_numpy(), rows["_key"].is_valid().to_numpy()
            for item, b in zip(items, best, strict=True):
                index.search(item, b, keys, known)

        held, size = [], 0
        for b in batches:
            b = b.filter(pa.compute.greater(b.column(1), 0))
            held.append(b)
            size += len(b.column(2).flatten())
            if size >= POSTINGS:
                all_items(held)
                held, size = [], 0
        if size:
            all_items(held)
        at = np.repeat(np.arange(len(items)), [len(b.scores) for b in best])
        keys = pa.array(np.concatenate([b.keys for b in best]), mask=~np.concatenate([b.known for b in best]))
        scores = pa.array(np.concatenate([b.scores for b in best]))
        yield pa.RecordBatch.from_arrays([pa.array(at), ids.take(pa.array(at)), keys, scores], ["_item", "_id", "_key", "score"])

    found = counted.mapInArrow(search, f"_item long, _id {item_kind}, _key long, score long")
    found = found.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    order = [F.desc("score"), F.asc_nulls_last("_key")]
    for by in (["_part", "_item"], ["_item"]):  # however many tasks there are, none gets the best of them all
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= limit)
    return found.select(F.col("_id").alias(item_key), "rank", F.col("_key").alias(key), "score")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    limit: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_key``, ``rank`` (from 1), ``key`` and ``score`` of the ``limit`` best documents of every item.

    Terms are runs of ASCII letters and digits and of everything beyond ASCII; only A-Z are lower-cased. With N
    documents that have terms, L terms in all, n in a document and df documents that hold a term, a term weighs
    floor(1000 ln((2N + 2) / (2df + 1))); a document scores weight * (10^9 tf div (1000 tf + 20 m)) with
    m = 50 + 50nN div L for every different term of the item. Only scores above 0 are listed, equal ones by
    ascending key, rows without a key last.

    ``key`` is an integer. Every row of ``docs`` is a document of its own, repeated rows too, and every row of
    ``items`` an item of its own. Null or empty texts have no terms and are found nowhere or find nothing; an empty
    table on either side gives no rows. Other columns are left aside. Items are answered in blocks of about
    ``BLOCK_BYTES`` of text, whatever their number.
    """
    asked = items.where(F.col(item_text).isNotNull()).select(F.col(item_key).alias("_id"), F.col(item_text).cast("binary").alias("_text"))
    kind = asked.schema["_id"].dataType.simpleString()
    total = asked.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    out = []
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)) == block).toArrow()
        if not some.num_rows:
            continue
        ids = pa.concat_arrays(some["_id"].chunks)
        out.append(_ranked(docs, ids, some["_text"].to_pylist(), kind, item_key, key, text, limit))
    if not out:
        return docs.sparkSession.createDataFrame([], f"`{item_key}` {kind}, rank int, `{key}` long, score long")
    return reduce(DataFrame.unionByName, out)
