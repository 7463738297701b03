"""Quality by naive Bayes support vectors over n-gram indicators.

An indicator counts whether an n-gram occurs in a text, not how often. Each is scaled by the log ratio
of its share in the two classes (naive Bayes), and a linear hinge-loss model is fitted over the scaled
indicators by dual coordinate descent. The n-grams are those of one to three bytes of the whole text, and the
patterns of four words in a row: which of them are equal, whatever the words are. N-grams are hashed into a
fixed space, so nothing is cut by frequency.

The model is fitted with numpy on a bounded sample of labelled texts, whose n-grams are hashed by Spark where
the texts are read; all documents are scored there too. Margins become probabilities by a logistic curve
fitted on out-of-fold margins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import landed

#: The space that n-grams are hashed into.
SPACE_BITS = 18
BYTES = (1, 2, 3)
WORDS = 4


def _places(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - SPACE_BITS)).astype(np.int64)


def _patterns(words: list[bytes]) -> np.ndarray:
    """For each window of words, for every two of its places one bit: are the words there equal?"""
    h = np.array([zlib.crc32(w) for w in words], np.int64)
    out = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    bit = 0
    for a in range(WORDS):
        for b in range(a + 1, WORDS):
            same = h[a : a + len(out)] == h[b : b + len(out)]
            out |= same.astype(np.uint64) << np.uint64(bit)
            bit += 1
    return out


class Grams:
    """Distinct hashed n-grams of texts; holds a table of the space's size for telling repeats."""

    def __init__(self) -> None:
        self.last = np.zeros(1 << SPACE_BITS, np.int32)

    def __call__(self, text: bytes | None) -> np.ndarray:
        raw = np.frombuffer(text or b"", np.uint8).astype(np.uint64)
        parts = [(np.uint64(9) << np.uint64(40)) | _patterns((text or b"").split())]
        gram = np.zeros(len(raw), np.uint64)
        for n in BYTES:
            gram = (gram[: len(raw) - n + 1] << np.uint64(8)) | raw[n - 1 :]
            parts.append((np.uint64(n) << np.uint64(40)) | gram)
        at = _places(np.concatenate(parts))
        number = np.arange(len(at), dtype=np.int32)
        self.last[at] = number
        return at[self.last[at] == number]


@dataclass
class Model:
    """``weights`` of the hashed n-grams and the bias after them; a margin m has probability 1 / (1 + exp(-(a * m + b)))."""

    weights: np.ndarray
    a: float
    b: float

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * margins + self.b, -35, 35)))


def _log_ratios(rows: list[np.ndarray], y: np.ndarray, smoothing: float) -> np.ndarray:
    """Log ratio of an n-gram's share among all indicators of the two classes."""
    share = []
    for label in (1, 0):
        own = [r for r, l in zip(rows, y, strict=True) if l == label]
        counts = smoothing + np.bincount(np.concatenate(own), minlength=1 << SPACE_BITS)
        share.append(np.log(counts / counts.sum()))
    return share[0] - share[1]


def _support_vectors(rows: list[np.ndarray], y: np.ndarray, cost: float, epochs: int, smoothing: float) -> np.ndarray:
    """Weights of the unscaled indicators and, last, the bias: the dual problem, one row's multiplier at a time.

    A multiplier moves to the least of the dual objective along its axis, kept between 0 and the row's cost. Both
    classes have the same cost in sum.
    """
    ratio = np.r_[_log_ratios(rows, y, smoothing), 1.0]  # the bias is an indicator that every text has
    rows = [np.r_[r, 1 << SPACE_BITS] for r in rows]
    square = np.array([ratio[r] @ ratio[r] for r in rows])
    sign = np.where(y > 0, 1.0, -1.0)
    most = cost * len(y) / 2 / np.where(y > 0, (y > 0).sum(), (y == 0).sum())
    scaled = np.zeros(len(ratio))
    multiplier = np.zeros(len(y))
    draw = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in draw.permutation(len(y)):
            x = ratio[rows[i]]
            slope = sign[i] * (scaled[rows[i]] @ x) - 1
            to = min(max(multiplier[i] - slope / square[i], 0.0), most[i])
            if to != multiplier[i]:
                scaled[rows[i]] += (to - multiplier[i]) * sign[i] * x
                moved = max(moved, abs(to - multiplier[i]) * square[i])
                multiplier[i] = to
        if moved < 1e-3:  # no slope beyond this is left
            break
    return scaled * ratio


def _margins(rows: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    return np.array([weights[r].sum() + weights[-1] for r in rows])


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve, by Newton steps; targets are drawn in from 0 and 1."""
    ones = y.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    x, at = np.column_stack([margins, np.ones(len(y))]), np.zeros(2)

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -35, 35)))
        slope = x.T @ (p - target)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return max(float(at[0]), 0.0), float(at[1])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = 10_000,
    sample_grams: int = 12_000_000,
    folds: int = 3,
    cost: float = 0.1,
    epochs: int = 20,
    smoothing: float = 1.0,
) -> Model:
    """Fit on about ``sample_rows`` labelled documents with ``sample_grams`` n-grams in all, whichever is less.

    Both bounds hold in expectation: rows are taken by a hash of the key, and fewer of them where texts are long.
    Labels are 0 or 1; several of one document count as their maximum, null ones and those without a key are left
    out. Where the sample has one class only, that class has probability 1; where it is empty, both are as likely.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg((F.max(label) > 0).cast("int").alias("_y"))
    slots = 1 << 20
    slot = F.pmod(F.xxhash64("_key"), F.lit(slots))
    share = min(1.0, sample_rows / max(1, known.count()))
    sample = known.where(slot < F.lit(int(share * slots)))  # sample_rows rows in expectation: the broadcast's bound

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in batches:
            for i in range(b.num_rows):
                found = np.sort(grams(b.column(2)[i].as_py())).astype(np.int32)
                one = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(1).slice(i, 1), one], ["_slot", "_y", "_grams"])

    read = docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text")).join(F.broadcast(sample), "_key")
    read = read.select(slot.alias("_slot"), "_y", "_text")
    rows = landed(read.mapInArrow(hashed, "_slot long, _y int, _grams array<int>"), "quality")
    total = rows.agg(F.sum(F.size("_grams"))).first()[0] or 0
    share *= min(1.0, sample_grams / max(1, total))
    found = rows.where(F.col("_slot") < F.lit(int(share * slots))).toArrow()
    found = found.append_column("_n", pa.array([len(g) for g in found["_grams"]], pa.int64()))
    found = found.sort_by([("_slot", "ascending"), ("_y", "ascending"), ("_n", "ascending")]).combine_chunks()
    y = found["_y"].to_numpy()
    grams = [g.values.to_numpy() for g in found["_grams"]]
    fold = found["_slot"].to_numpy() % folds
    nothing = np.zeros((1 << SPACE_BITS) + 1)
    if len(np.unique(y)) < 2:
        return Model(nothing, 0.0, 0.0 if not len(y) else 35.0 if y[0] else -35.0)

    def fit(some: np.ndarray) -> np.ndarray:
        return _support_vectors([grams[i] for i in some], y[some], cost, epochs, smoothing)

    held = np.full(len(y), np.nan)
    for f in range(folds):
        rest, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        if len(own) and len(np.unique(y[rest])) == 2:
            held[own] = _margins([grams[i] for i in own], fit(rest))
    weights = fit(np.arange(len(y)))
    if np.isnan(held).all() or len(np.unique(y[~np.isnan(held)])) < 2:  # too few rows for folds
        held = _margins(grams, weights)
    told = ~np.isnan(held)
    return Model(weights.astype(np.float32), *_logistic(held[told], y[told]))


def score_quality(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", score: str = "score") -> DataFrame:
    """``key`` and the probability of label 1 as ``score`` for every row; whole texts, no shuffle.

    A null or empty text has no n-grams and gets the probability of the bias. Repeated rows and rows without a key
    are scored one by one. Other columns are left aside, so their names cannot clash; an empty table gives an
    empty one.
    """
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()

    def probabilities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in batches:
            rows = (grams(t.as_py()) for t in b.column(1))
            p = model.probability(np.array([model.weights[r].sum(dtype=np.float64) + model.weights[-1] for r in rows]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], [key, score])

    return docs.select(F.col(key), F.col(text).cast("binary")).mapInArrow(probabilities, f"`{key}` {kind}, `{score}` double")
