"""Periodic runs of words, by the branching tandem repeats of an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word extends. Its last square
(two equal halves of q words) cannot be rotated to the right, so the suffixes of its two halves part
after exactly q words: both lie in the LCP interval of depth q, in different children of it. For every
LCP interval the suffixes of all children but the largest are taken, and for a suffix i the inverse
suffix array says whether i + q or i - q lies in the interval too, in another child. That takes
n log n steps in all. Squares are then rotated to the left as far as the words agree, which gives the
run, and equal stretches keep their smallest period. No tree nodes are built.

Many texts are worked on at once, as arrays: each text has word numbers of its own, so that no interval
reaches from one text into another. Ranks by the first 1, 2, 4, ... words, which sort the suffixes, are
kept; two places agree in 2^k words if their ranks there are equal, which gives the LCP values and
rotates a square by many words in a step. Memory is about 400 bytes per word of a portion; a portion has
``PORTION`` words or, where a text is longer, that one text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words, of several texts together, that are worked on at once.
PORTION = 200_000

Prepare = Callable[[int | None, list[bytes]], list[bytes]]


class SuffixArray:
    """Suffixes of a sequence of numbers in order (``sa``), their ranks (``isa``), and ranks by 2^k words."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.n = n
        self.sa = np.argsort(x, kind="stable").astype(np.int32)
        ordered = x[self.sa]
        head = np.r_[True, ordered[1:] != ordered[:-1]]
        self.levels: list[np.ndarray] = []  # each with one place more, which equals no other
        rank = np.full(n + 1, -1, np.int32)
        rank[self.sa] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), 0))
        size = 1
        # Slots whose suffix shares its rank with another one are sorted by what follows, the others are done.
        slots = np.flatnonzero(~(head & np.r_[head[1:], True]))
        while len(slots):
            self.levels.append(rank)
            at = self.sa[slots]
            key = rank[at].astype(np.int64) * (n + 1) + rank[np.minimum(at + size, n)] + 1
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            self.sa[slots] = at
            head = np.r_[True, key[1:] != key[:-1]]
            rank = rank.copy()
            rank[at] = np.maximum.accumulate(np.where(head, slots, 0))
            slots = slots[~(head & np.r_[head[1:], True])]
            size *= 2
        self.isa = rank[:n]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and b on are equal; a and b differ everywhere."""
        out = np.zeros(len(a), np.int64)
        if not self.levels:
            return out
        some = np.flatnonzero(self.levels[0][a] == self.levels[0][b])
        a, b, size = a[some].astype(np.int64), b[some].astype(np.int64), np.zeros(len(some), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank = self.levels[k]
            size += (rank[np.minimum(a + size, self.n)] == rank[np.minimum(b + size, self.n)]).astype(np.int64) << k
        out[some] = size
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and b, which differ everywhere, are equal."""
        size = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank, lo, hi = self.levels[k], a - size - (1 << k), b - size - (1 << k)
            inside = (lo >= 0) & (hi >= 0)
            size += (inside & (rank[np.maximum(lo, 0)] == rank[np.maximum(hi, 0)])).astype(np.int64) << k
        return size


def _intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Borders (places t with lcp[t] > 0) and the first and last suffix of their LCP interval.

    Intervals of fewer than ``least`` suffixes are left out. Reach by halving steps over minima of 2^k places.
    """
    n = len(lcp)
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return at, at, at
    zeros = np.flatnonzero(np.r_[True, lcp[1:] == 0, True])
    widest = int(np.diff(zeros).max())
    minima = [lcp]
    while (2 << len(minima)) <= 2 * widest:
        m, half = minima[-1], 1 << (len(minima) - 1)
        minima.append(np.minimum(m, np.r_[m[half:], np.full(min(half, n), -1, lcp.dtype)][:n]))
    depth, lo, hi = lcp[at], at.copy(), at + 1
    for k in range(len(minima) - 1, -1, -1):
        m, step = minima[k], 1 << k
        lo -= np.where((lo >= step) & (m[np.maximum(lo - step, 0)] >= depth), step, 0)
        hi += np.where((hi + step <= n) & (m[np.minimum(hi, n - 1)] >= depth), step, 0)
    first, last = lo - 1, hi - 1
    wide = last - first + 1 >= least
    return at[wide], first[wide], last[wide]


def _squares(s: SuffixArray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and half of all branching squares whose half occurs ``least`` times or more."""
    none = np.empty(0, np.int64)
    lcp = np.r_[0, s.common(s.sa[:-1], s.sa[1:])]
    at, first, last = _intervals(lcp, least)
    if not len(at):
        return none, none
    # Children lie between the borders of an interval; sorted by interval, each border ends one and begins one.
    order = np.argsort(first * (s.n + 1) + last, kind="stable")
    at, first, last = at[order], first[order], last[order]
    new = np.r_[True, (first[1:] != first[:-1]) | (last[1:] != last[:-1])]
    group = np.cumsum(new) - 1
    begin_of, end_of, depth_of = first[new], last[new] + 1, lcp[at[new]]
    owner = np.r_[np.arange(len(begin_of)), group]
    begins = np.r_[begin_of, at]
    order = np.lexsort((begins, owner))
    owner, begins = owner[order], begins[order]
    ends = np.r_[begins[1:], 0]
    closing = np.r_[owner[1:] != owner[:-1], True]
    ends[closing] = end_of
    # All children but the largest of each interval.
    size = ends - begins
    biggest = np.lexsort((-size, owner))
    small = np.ones(len(owner), bool)
    small[biggest[np.r_[True, owner[biggest][1:] != owner[biggest][:-1]]]] = False
    owner, begins, size = owner[small], begins[small], size[small]
    child = np.repeat(np.arange(len(owner)), size)
    rank = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + begins[child]
    i, depth = s.sa[rank].astype(np.int64), depth_of[owner[child]]
    lo, hi = begin_of[owner[child]], end_of[owner[child]]
    own_lo, own_hi = begins[child], (begins + size)[child]
    starts, halves = [], []
    for step in (depth, -depth):
        other = i + step
        inside = np.flatnonzero((other >= 0) & (other < s.n))
        place = s.isa[other[inside]]
        met = (place >= lo[inside]) & (place < hi[inside]) & ((place < own_lo[inside]) | (place >= own_hi[inside]))
        met = inside[met]
        starts.append(np.minimum(i[met], other[met]))
        halves.append(depth[met])
    return np.concatenate(starts), np.concatenate(halves)


def runs_of(x: np.ndarray, least_exponent: int = 2, least_length: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs, by start, then period.

    A run has at least ``least_exponent`` (2 or more) periods and ``least_length`` numbers.
    """
    none = np.empty(0, np.int64)
    if len(x) < 2:
        return none, none, none
    s = SuffixArray(x)
    # The last square's half occurs once per whole period of the run, and so often in the interval.
    start, half = _squares(s, least_exponent)
    begin = start - s.common_before(start, start + half)
    length = start + 2 * half - begin
    keep = (length >= least_exponent * half) & (length >= least_length)
    begin, length, half = begin[keep], length[keep], half[keep]
    order = np.lexsort((half, length, begin))
    begin, length, half = begin[order], length[order], half[order]
    new = np.r_[True, (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])][: len(begin)]  # smallest period of a stretch
    begin, length, half = begin[new], length[new], half[new]
    order = np.lexsort((half, begin))
    return begin[order], length[order], half[order]


def _found(texts: list[list[bytes]], least_exponent: int, least_length: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """For every text its runs as rows (start, length, period), and the words that stay."""
    numbers: list[int] = []
    for words in texts:
        at, known = len(numbers), {}
        numbers.extend([known.setdefault(w, at + len(known)) for w in words])
    start, length, period = runs_of(np.array(numbers, np.int64), least_exponent, least_length)
    ends = list(accumulate(map(len, texts)))
    upto = np.searchsorted(start, ends)
    rows = np.column_stack([start, length, period])
    lo, before = 0, 0
    for words, hi, end in zip(texts, upto, ends, strict=True):
        own = rows[lo:hi] - [before, 0, 0]
        if len(own):
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, own[:, 0] + own[:, 2], 1)
            np.add.at(cover, own[:, 0] + own[:, 1], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
        yield own, b" ".join(words)
        lo, before = hi, end


def find_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_exponent: int = 4,
    least_length: int = 6,
    prepare: Prepare | None = None,
) -> DataFrame:
    """``key``, ``n_words``, ``runs`` (array of start, length, period, by start, then period) and ``collapsed``.

    Words are what ASCII white space separates, numbered from 0 and compared as they are. Runs have at least
    ``least_exponent`` periods and ``least_length`` words. ``collapsed`` is the text with one space between
    words and without every word that some run holds after its first period. ``prepare`` may replace the words
    of a row, given its key.

    Every row has a result of its own: rows repeated or without a key too. A null or empty text has no words, no
    runs and an empty ``collapsed``. Texts are read whole, however long. No shuffle; other columns are left
    aside, so their names cannot clash; an empty table gives an empty one.
    """
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    names = [key, "n_words", "runs", "collapsed"]

    def result(keys: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found, rest = zip(*_found(texts, least_exponent, least_length), strict=True)
        rows = np.concatenate(found)
        spans = pa.StructArray.from_arrays([pa.array(c) for c in rows.T.astype(np.int64)], fields=list(run))
        ends = pa.array(np.r_[0, np.cumsum([len(f) for f in found])], pa.int32())
        sizes = pa.array([len(t) for t in texts], pa.int64())
        collapsed = pa.array(rest, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([keys, sizes, pa.ListArray.from_arrays(ends, spans), collapsed], names)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size, first = [], 0, 0
            for i in range(b.num_rows):
                words = (b.column(1)[i].as_py() or b"").split()
                if prepare is not None:
                    words = prepare(b.column(0)[i].as_py(), words)
                if held and size + len(words) > PORTION:
                    yield result(b.column(0).slice(first, len(held)), held)
                    held, size, first = [], 0, i
                held.append(words)
                size += len(words)
            if held:
                yield result(b.column(0).slice(first, len(held)), held)

    return docs.select(F.col(key), F.col(text).cast("binary")).mapInArrow(find, schema)
