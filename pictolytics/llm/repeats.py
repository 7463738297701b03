"""Substring dedup by units: lines, the sentences of lines that hold several, and chunks of words.

Units are normalised and hashed where the text is read; digests are counted globally, the occurrence
with the lowest rank stays, and every other one is reported with its original offsets. A passage that
was set in the middle of a line is found by its sentences. Chunks end where the words say so, whatever
lines and sentences do: they find passages in short lines, short sentences or inside a long one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import by_name, by_place, landed

LINE_WORDS = 6
SENTENCE_WORDS = 8
_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?!\s)[^.!?\n]*)*[.!?]*")
#: A part ends at a word with the least hash among so many on either side, or after so many words.
PART_NEAR, PART_MOST = 4, 30
#: Chunks with fewer words are no units.
CHUNK_WORDS = 10
_WORD = re.compile(r"\S+")
_BATCH = 50_000


def _normal(unit: str) -> list[str]:
    return unit.lower().split()


def units(text: str, line_words: int, sentence_words: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, end, start of the line, digest) of all units with enough words; offsets in code points."""
    from xxhash import xxh3_128_digest

    at = 0
    for line in text.split("\n"):
        words = _normal(line)
        if len(words) >= line_words:
            yield at, at + len(line), at, xxh3_128_digest(" ".join(words).encode("utf-8", "replace"))
        if len(words) >= sentence_words:
            for m in _SENTENCE.finditer(line):
                own = _normal(m[0])
                if sentence_words <= len(own) < len(words):
                    start = at + m.start() + len(m[0]) - len(m[0].lstrip())
                    yield start, at + m.start() + len(m[0].rstrip()), at, xxh3_128_digest(" ".join(own).encode("utf-8", "replace"))
        at += len(line) + 1


def chunks(text: str) -> Iterator[tuple[int, int, int, bytes]]:
    """Like ``units``, for runs of words over lines; their line is a number below 0, each its own.

    A chunk is two neighbouring parts. Where a part ends depends on the words around only, so two copies of a
    passage are cut alike, but for some words at its ends.
    """
    from xxhash import xxh3_128_digest

    places = [m.span() for m in _WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in places]
    raw = [w.encode("utf-8", "replace") for w in words]
    h = np.array([zlib.crc32(w, zlib.crc32(v)) for v, w in zip([b"", *raw], raw)], np.int64)
    least = np.ones(len(h), bool)
    for d in range(1, PART_NEAR + 1):
        least[d:] &= h[d:] < h[:-d]
        least[:-d] &= h[:-d] <= h[d:]
    ends = [0]
    for e in [*(np.flatnonzero(least) + 1).tolist(), len(words)]:
        ends.extend(range(ends[-1] + PART_MOST, e, PART_MOST))
        if e > ends[-1]:
            ends.append(e)
    for lo, hi in zip(ends, ends[2:] or ends[1:]):
        if hi - lo >= CHUNK_WORDS:
            start = places[lo][0]
            yield start, places[hi - 1][1], -1 - start, xxh3_128_digest(b"\0" + b" ".join(raw[lo:hi]))


def find_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    line_words: int = LINE_WORDS,
    sentence_words: int = SENTENCE_WORDS,
) -> DataFrame:
    """Every occurrence to remove: key, ``start``, ``end`` (exclusive), ``kept_<key>``, ``kept_start``, ``copies``.

    Occurrences are ranked by key, then offset; the first stays. Units are equal if their words, lower-cased
    and parted by single spaces, are. Lines of fewer than ``line_words`` and sentences of fewer than
    ``sentence_words`` words are no units; sentences of a removed line are not reported again. Chunks of words
    go across both and may overlap them, so cut the union of the spans. ``key``
    is an integer; rows with a null key or text have no units. Repeated rows are one document and do not
    remove each other; other columns are left aside; an empty table gives no rows.
    """
    kinds = {"_id": pa.int64(), "start": pa.int32(), "end": pa.int32(), "line": pa.int32(), "d1": pa.int64(), "d2": pa.int32()}
    schema = pa.schema(list(kinds.items()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            head = np.array([r[:4] for r in rows], np.int64)
            digests = np.frombuffer(b"".join(r[4] for r in rows), [("d1", np.int64), ("d2", np.int32), ("rest", np.int32)])
            columns = (*head.T, digests["d1"], digests["d2"])  # 96 bits tell units apart
            return pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(columns, schema.types)], schema=schema)

        for b in batches:
            for doc, words in zip(b.column(0), b.column(1), strict=True):
                doc = doc.as_py()
                words = words.as_py() or ""
                rows.extend((doc, *u) for u in units(words, line_words, sentence_words))
                rows.extend((doc, *u) for u in chunks(words))
                if len(rows) >= _BATCH:
                    yield batch()
                    rows = []
        if rows:
            yield batch()

    texts = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text")).where("_id is not null and _text is not null")
    cuts = landed(texts.mapInArrow(cut, "_id long, start int, end int, line int, d1 long, d2 int"), "units")
    # Most units occur once. Of these only half of the digest is counted; whole rows are sorted for the others alone.
    # Partial counts leave one row per task and digest before the shuffle, however common a unit is.
    often = cuts.groupBy("d1").agg(F.count("*").alias("n")).where("n > 1").select("d1")
    cuts = landed(cuts.join(often.hint("shuffle_hash"), "d1"), "repeated-units")
    first = F.min(F.struct(F.col("_id").alias("kept"), F.col("start").alias("kept_start"), F.col("end").alias("kept_end")))
    # What overlaps the occurrence that stays, in a text that repeats itself, is left alone.
    groups = cuts.groupBy("d1", "d2").agg(first.alias("f"), F.count("*").alias("copies")).where("copies > 1")
    found = cuts.join(groups.select("d1", "d2", "f.*", "copies"), ["d1", "d2"]).where("_id <> kept or start >= kept_end")
    found = landed(found.distinct(), "repeats")
    # The unit of a line starts where the line does; shorter units with that start are its first sentence.
    whole = found.groupBy("_id", "line").agg(F.max(F.when(F.col("start") == F.col("line"), F.col("end"))).alias("until"))
    out = found.join(whole, ["_id", "line"]).where(F.col("until").isNull() | (F.col("start") >= F.col("until")) | ((F.col("start") == F.col("line")) & (F.col("end") == F.col("until"))))
    # A chunk with the span of a line or sentence is the same occurrence.
    out = out.groupBy("_id", "start", "end").agg(F.min(F.struct("kept", "kept_start", "copies")).alias("x"))
    place = {n: F.col(c).cast("long").alias(n) for n, c in (("start", "start"), ("end", "end"), ("kept_start", "x.kept_start"))}
    return out.select(F.col("_id").alias(key), place["start"], place["end"], F.col("x.kept").alias(f"kept_{key}"), place["kept_start"], "x.copies")


def without_repeats(docs: DataFrame, repeats: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the reported spans cut out of the texts.

    Rows without a span, a null key or a null text stay as they are; rows repeated under one key are cut alike. Columns
    keep their names, whatever these are. An empty table on either side changes nothing.
    """
    spans = F.sort_array(F.collect_set(F.struct("start", "end")))
    cuts = repeats.groupBy(F.col(key).alias("_key")).agg(spans.alias("_cuts"))
    placed, (own_key, own_text) = by_place(docs, key, text)
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state, x):
        piece = F.substring(F.col(own_text), (state["at"] + 1).cast("int"), F.greatest(x["start"] - state["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.concat(state["out"], piece).alias("out"))

    rest = F.aggregate("_cuts", begin, step, lambda s: F.concat(s["out"], F.substring(F.col(own_text), (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    joined = placed.join(cuts, placed[own_key] == cuts["_key"], "left")
    changed = joined.withColumn(own_text, F.when(F.col("_cuts").isNull(), F.col(own_text)).otherwise(rest))
    return by_name(changed, docs.columns)
