"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles. Shingles are dealt over the parts of a sketch and
XOR-hashed there, so a shingle that only one of two documents has spoils one part at most: the number
of differing parts is a lower bound of the symmetric difference. Two sets with a Jaccard similarity of
75 % or more differ in a seventh of their joint sizes at most, so of more parts than that some agree
(pigeonhole), and documents are joined on equal parts within a band of sizes.

* Parts are ordered by how many documents share them, rare ones first. A document with at most d
  spoilt parts needs its first d + 1 only; parts that it has alone count among these. What common
  passages fill falls out that way.
* A second sketch of ``BITS`` parities per document is compared in the join condition: its Hamming
  distance too is a lower bound of the symmetric difference.
* What is left is verified on the shingle sets.

Documents with equal sets are folded first. Groups of near copies are first joined to a few of their
own (``LEADERS``); afterwards only pairs of different groups are looked for. All links that connect
groups are found: pairs within a group that is connected already need no look.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pictolytics.llm.common import landed
from pictolytics.llm.components import components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
BITS = 1024
WORDS = BITS // 64
LEADERS = 4
SEEN = 500_000
SATURATED = 4096
PORTION = 500_000
BROADCAST_IDS = 1_000_000

_M = (1 << 64) - 1


def _salt(salt: int) -> np.uint64:
    return np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _M)


_SALTS = np.array([_salt(101 + level) for level in range(64)], np.uint64)


def _mix(x: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift until every bit depends on every bit."""
    x = x + (salt if isinstance(salt, np.ndarray) else _salt(salt))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, and how many words each text has.

    A word's hash is the sum of hashes of its bytes at their places; all texts are hashed at once.
    """
    parts = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    space = _SPACE[raw]
    at = np.flatnonzero(~space)
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    begins = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    size = np.diff(np.r_[begins, len(at)])
    place = np.arange(len(at), dtype=np.uint64) - np.repeat(begins, size).astype(np.uint64)
    x = raw[at].astype(np.uint64) + (place << np.uint64(8))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    h = _mix(np.add.reduceat(x, begins), 11)
    ends = np.cumsum([len(p) + 1 for p in parts])  # of the texts, in bytes
    upto = np.searchsorted(at[begins], ends)
    return h, np.diff(np.r_[0, upto])


class Sets:
    """Shingle sets of several texts, one after the other: ``h`` sorted and distinct within each, ``n`` their sizes."""

    def __init__(self, h: np.ndarray, n: np.ndarray):
        self.h, self.n = h, n
        self.at = np.r_[0, np.cumsum(n)]
        self.of = np.repeat(np.arange(len(n)), n)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.h[self.at[i] : self.at[i + 1]]

    def take(self, rows: np.ndarray) -> Sets:
        keep = np.zeros(len(self.n), bool)
        keep[rows] = True
        return Sets(self.h[keep[self.of]], self.n[rows])

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of every set, 0 for an empty one."""
        out = np.zeros((2, len(self.n)), np.int64)
        some = np.flatnonzero(self.n)
        if len(some):
            out[0, some] = np.add.reduceat(_mix(self.h, 606), self.at[some]).view(np.int64)
            out[1, some] = np.bitwise_xor.reduceat(_mix(self.h, 707), self.at[some]).view(np.int64)
        return out[0], out[1]

    def sketches(self) -> np.ndarray:
        """Parities of the shingles that fall on each of ``BITS`` bits, as rows of signed 64-bit words."""
        at = (_mix(self.h, 505) & np.uint64(BITS - 1)).astype(np.int64) + self.of * BITS
        bits = (np.bincount(at, minlength=BITS * len(self.n)) & 1).astype(np.uint8)
        return np.packbits(bits).view(np.int64).reshape(-1, WORDS)

    def parts(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Set, number and XOR-hash of every part that holds shingles; a set of level -1 has none.

        The number of parts depends on the level only.
        """
        count = np.where(level < 0, 0, np.maximum(1, (0.72 * 2.0 ** np.maximum(level, 0)).astype(np.int64)))
        first = np.r_[0, np.cumsum(count)]
        use = level[self.of] >= 0
        h, of = self.h[use], self.of[use]
        slot = first[of] + (_mix(h, _SALTS[level[of]]) % count[of].astype(np.uint64)).astype(np.int64)
        value = np.zeros(first[-1], np.uint64)
        np.bitwise_xor.at(value, slot, _mix(h, 202))
        filled = np.flatnonzero(np.bincount(slot, minlength=first[-1]))
        owner = np.searchsorted(first, filled, side="right") - 1
        return owner, filled - first[owner], value[filled]


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> Sets:
    """Distinct 64-bit hashes of the word shingles; a shorter text is one shingle, an empty one none."""
    h, n = _word_hashes(texts)
    at = np.r_[0, np.cumsum(n)]

    def hashed(h: np.ndarray, span: int) -> np.ndarray:
        if len(h) < span:
            return h[:0]
        total = np.full(len(h) - span + 1, span, np.uint64)
        for i in range(span):
            total = _mix(total ^ h[i : len(h) - span + 1 + i], i + 1)
        return total

    whole = hashed(h, size)  # those that reach over the end of a text are not taken
    sets = []
    for i in range(len(n)):
        if n[i] >= size:
            sets.append(np.unique(whole[at[i] : at[i + 1] - size + 1]))
        else:
            sets.append(hashed(h[at[i] : at[i + 1]], int(n[i])) if n[i] else h[:0])
    return Sets(np.concatenate(sets) if sets else np.empty(0, np.uint64), np.array([len(x) for x in sets], np.int64))


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Keys and texts of a batch, in portions of about ``PORTION`` characters."""
    low, size, texts = 0, 0, []
    for i, t in enumerate(batch.column(1)):
        texts.append(t.as_py())
        size += len(texts[-1] or "")
        if size >= PORTION or i + 1 == batch.num_rows:
            yield batch.column(0).slice(low, len(texts)), texts
            low, size, texts = i + 1, 0, []


def _limit(n: int, other: int) -> int:
    """Largest symmetric difference of linked sets of these sizes."""
    return (DENOMINATOR - NUMERATOR) * (n + other) // (DENOMINATOR + NUMERATOR)


def _levels(n: int) -> list[tuple[int, int]]:
    """(level, largest symmetric difference there): the band of the size, and the next one if partners lie there."""
    level, largest = n.bit_length() - 1, DENOMINATOR * n // NUMERATOR
    top = (2 << level) - 1
    out = [(level, _limit(n, min(largest, top)))]
    if largest > top:
        out.append((level + 1, _limit(n, largest)))
    return out


def _key(value: np.ndarray, tag: np.ndarray) -> np.ndarray:
    return ((_mix(value, 303) & np.uint64(_M - 127)) | tag.astype(np.uint64)).view(np.int64)


def _keys(sets: Sets) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(tag, prefix length) of every set, -1 where it has none, and (set, key) of all keys: filled parts, level by level.

    Where a set fills no more parts than may be spoilt, two such sets could agree in empty parts only.
    They get their single shingles as keys too, of which linked sets always share some.
    """
    levels = [_levels(int(n)) if n else [] for n in sets.n]
    for turn in range(2):
        level = np.array([x[turn][0] if len(x) > turn else -1 for x in levels], np.int64)
        apart = np.array([x[turn][1] if len(x) > turn else 0 for x in levels], np.int64)
        owner, number, value = sets.parts(level)
        tag = np.where(level < 0, -1, 2 * level)
        yield tag, apart + 1, owner, _key(value ^ _mix(number.astype(np.uint64), 404), tag[owner])
        weak = (level >= 0) & (np.bincount(owner, minlength=len(level)) <= apart)
        tag = np.where(weak, 2 * level + 1, -1)
        own = weak[sets.of]
        yield tag, apart + 1, sets.of[own], _key(sets.h[own], tag[sets.of[own]])


_SKETCH = [f"s{i}" for i in range(WORDS)]
_LEVELS = [("t0", "f0"), ("t1", "f1"), ("t2", "f2"), ("t3", "f3")]


def _described(docs: DataFrame, size: int) -> DataFrame:
    """id, set size, digest of the set, sketch, and for each tag how many keys are in the prefix beyond the filled ones."""
    names = ["_id", "n", "d1", "d2", *[x for p in _LEVELS for x in p], *_SKETCH]
    schema = pa.schema([(x, pa.int64()) for x in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in _portions(b):
                sets = shingle_sets(texts, size)
                columns = [ids, pa.array(sets.n), *map(pa.array, sets.digests())]
                for tag, prefix, owner, _ in _keys(sets):
                    free = prefix - np.bincount(owner, minlength=len(tag))
                    columns += [pa.array(tag), pa.array(np.where(tag < 0, -1, free))]
                columns += [pa.array(c) for c in sets.sketches().T]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _emitted(docs: DataFrame, size: int) -> DataFrame:
    """(key, id) of every document; a task leaves out sets that it has emitted lately."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for b in batches:
            for ids, texts in _portions(b):
                sets, new = shingle_sets(texts, size), []
                for i, same in enumerate(zip(sets.n.tolist(), *(d.tolist() for d in sets.digests()), strict=True)):
                    if same[0] and same not in seen:
                        seen.add(same)
                        new.append(i)
                if len(seen) > SEEN:
                    seen.clear()
                rows = np.array(new, np.int64)
                doc = ids.to_numpy(zero_copy_only=False)[rows]
                for _, _, owner, key in _keys(sets.take(rows)):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc[owner])], ["key", "_id"])

    return docs.mapInArrow(run, "key long, _id long")


def _shared(emitted: DataFrame) -> DataFrame:
    """Rows of keys that several documents have, with their number, saturated at ``SATURATED``.

    Sorted partitions are streamed; of one key no more than ``SATURATED`` rows are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, full = np.empty((0, 2), np.int64), None  # the last key's rows; the key known to be saturated

        def counted(rows: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
            nonlocal full
            first = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
            size = np.diff(np.r_[first, len(rows)])
            if not last:
                if size[-1] < SATURATED and rows[-1, 0] != full:
                    held, rows, size = rows[first[-1] :], rows[: first[-1]], size[:-1]
                else:
                    held = rows[:0]
            else:
                held = rows[:0]
            if len(rows) == 0:
                return np.empty((0, 3), np.int64), held
            n = np.minimum(np.repeat(size, size), SATURATED)
            if full is not None:
                n[rows[:, 0] == full] = SATURATED
            if len(size) and n[-1] == SATURATED:
                full = rows[-1, 0]
            keep = n > 1
            return np.column_stack([rows[keep], n[keep]]), held

        def batch(out: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(out[:, i]) for i in range(3)], ["key", "_id", "n_key"])

        for b in batches:
            rows = np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy()])
            if not len(rows):
                continue
            out, tail = counted(np.concatenate([tail, rows]), False)
            if len(out):
                yield batch(out)
        if len(tail):
            out, _ = counted(tail, True)
            if len(out):
                yield batch(out)

    return emitted.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, _id long, n_key long")


def _prefixes(shared: DataFrame, described: DataFrame) -> DataFrame:
    """Rows of a document's prefix: its rarest keys, as many as the pigeonhole needs.

    ``free`` is the prefix length less all keys of the tag; keys of the document alone are not in
    ``shared``, so the prefix takes ``free`` + its rows there, rarest first.
    """
    tags = described.select("_id", F.explode(F.array(*[F.struct(F.col(t).alias("tag"), F.col(f).alias("free")) for t, f in _LEVELS])).alias("x"))
    tags = tags.select("_id", "x.*").where("tag >= 0")
    own = shared.select("*", F.col("key").bitwiseAND(F.lit(127)).alias("tag"))
    rank = Window.partitionBy("_id", "tag").orderBy("n_key", "key")
    counted = own.select("*", F.row_number().over(rank).alias("rank"), F.count("*").over(Window.partitionBy("_id", "tag")).alias("rows"))
    return counted.join(tags, ["_id", "tag"]).where(F.col("rank") <= F.col("free") + F.col("rows")).select("key", "_id", "n_key")


def _may_link(a: str, b: str) -> Column:
    """Sizes and sketches allow a link: both are lower bounds of the symmetric difference."""
    apart = F.lit(0)
    for s in _SKETCH:
        apart = apart + F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}")))
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    fits = (F.least(x, y) * DENOMINATOR >= F.greatest(x, y) * NUMERATOR)
    return fits & (apart * (DENOMINATOR + NUMERATOR) <= (x + y) * (DENOMINATOR - NUMERATOR))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in _portions(b):
                sets = shingle_sets(texts, size)
                found = [sets[i].tobytes() for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], ["_id", "h"])

    return docs.join(wanted, "_id", "left_semi").select("_id", "_text").mapInArrow(run, "_id long, h binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sets fulfil the threshold, counted exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(DENOMINATOR * both >= NUMERATOR * (len(p) + len(q) - both))
            kept = b.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    left = sets.select(F.col("_id").alias("a"), F.col("h").alias("ha"))
    right = sets.select(F.col("_id").alias("b"), F.col("h").alias("hb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "hb")
    return landed(joined.mapInArrow(run, "a long, b long"), "links")


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """key, ``n_shingles``, ``component_id``: the smallest key reachable by links, one row per document.

    Two documents link if 100 x shared >= 75 x joint shingles. A null or empty text has no shingles and is
    a component of its own. ``key`` is an integer; rows with a null key are left out; repeated rows give
    one row, and of different texts under one key the longest (then the largest) counts. Other columns are
    left aside. An empty table gives an empty result.
    """
    texts = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text")).where("_id is not null")
    described = landed(_described(texts, size), "sets")
    # One row per key; several texts under one key are an error of the table, and decided alike everywhere.
    best = F.max_by(F.struct(*[c for c in described.columns if c != "_id"]), F.struct("n", "d1", "d2"))
    described = described.groupBy("_id").agg(best.alias("x")).select("_id", "x.*")
    filled = described.where("n > 0")
    folded = filled.groupBy("n", "d1", "d2").agg(F.min("_id").alias("first"), F.count("*").alias("copies"))
    same = filled.join(folded.where("copies > 1"), ["n", "d1", "d2"]).select(F.col("_id").alias("a"), F.col("first").alias("b"))
    same = landed(same.where("a <> b"), "equal-sets")

    shared = landed(_shared(_emitted(texts, size)), "shared-parts")
    rows = landed(_prefixes(shared, described), "prefixes")
    about = landed(described.join(rows.select("_id").distinct(), "_id", "left_semi").select("_id", "n", *_SKETCH), "sketches")
    # Few ids go to where the texts are (16 MB at most); with more of them the texts are shuffled, once.
    wanted = about.select("_id")
    wanted = F.broadcast(wanted) if about.count() <= BROADCAST_IDS else wanted
    sets = landed(_sets(texts, wanted, size), "shingles")

    # Equal sets are stars already: every copy beside the first of its set.
    groups = same.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for last in (False, True):
        owned = rows.join(groups, rows["_id"] == groups["node"], "left")
        owned = owned.select("key", "_id", F.coalesce("component", "_id").alias("group"))
        mixed = owned.groupBy("key").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x <> y").select("key")
        owned = landed(owned.join(mixed, "key").distinct(), "open-keys")
        if not last:  # every document with those that most of its keys name as the first
            leaders = owned.groupBy("key").agg(F.min(F.struct("group", "_id")).alias("l")).select("key", F.col("l._id").alias("lead"), F.col("l.group").alias("lead_group"))
            named = owned.join(leaders, "key").where("group <> lead_group").groupBy("_id", "lead").agg(F.count("*").alias("c"))
            rank = F.row_number().over(Window.partitionBy("_id").orderBy(F.desc("c"), "lead"))
            named = named.withColumn("rank", rank).where(F.col("rank") <= LEADERS)
            pairs = named.select(F.least("_id", "lead").alias("a"), F.greatest("_id", "lead").alias("b")).distinct()
            x, y = about.alias("x"), about.alias("y")
            pairs = pairs.join(x, F.col("a") == F.col("x._id")).join(y, (F.col("b") == F.col("y._id")) & _may_link("x", "y"))
        else:
            full = owned.join(about, "_id")
            x, y = full.alias("x"), full.alias("y")
            apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.group") < F.col("y.group"))
            pairs = x.join(y, apart & _may_link("x", "y")).select(F.least("x._id", "y._id").alias("a"), F.greatest("x._id", "y._id").alias("b"))
        found = _verified(pairs.select("a", "b").distinct(), sets)
        if not last or not found.isEmpty():
            stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
            groups = components(stars.unionByName(found))
    return described.join(groups, described["_id"] == groups["node"], "left").select(
        F.col("_id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "_id").alias("component_id")
    )
