"""Toxicity by a classifier chain: each category's model reads the words and all earlier probabilities.

The later models are trained with out-of-fold probabilities of the earlier ones, so that they see
at training time what they will see at scoring time: predictions for texts the model was not fitted on.
The models are sparse linear ones over the distinct words of a text and their beginnings, hashed to 32 bits where the
text is read. They are fitted with numpy on a bounded sample of labelled texts, in a task, so that the driver holds no
more than the model; all documents are scored by Spark.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import landed

# Everything in ASCII that is neither letter nor digit separates words.
_TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


#: Toxic words are rare in a text, so the classes part below one half.
CUTS = (0.2, 0.6)
#: Words also count by their first bytes, which inflected forms share.
STEMS = (4, 5)


#: Texts that are scored at once.
PORTION = 500


def features(text: str | None) -> np.ndarray:
    """Hashes, in order, of a text's distinct lower-cased words and, marked by ``*``, of the beginnings of the longer ones."""
    words = set((text or "").lower().encode("utf-8", "replace").translate(_TO_SPACE).split())
    words = words.union(*({w[:n] + b"*" for w in words if len(w) > n} for n in STEMS))
    return np.unique(np.fromiter(map(zlib.crc32, words), np.uint32, len(words)))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the rows, one after the other, and the row of each."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return (np.concatenate(rows) if rows else np.empty(0, np.int64)), at


@dataclass
class Chain:
    """``weights`` of the sorted hashes ``known``: a column per category; ``given[i]`` weighs the earlier probabilities.

    ``thresholds``: from which probability on a category is said to hold, chosen on out-of-fold probabilities.
    """

    categories: tuple[str, ...]
    bias: np.ndarray
    given: np.ndarray
    known: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint32))
    weights: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    thresholds: dict[str, float] = field(default_factory=dict)

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        """One row per text, one column per category."""
        found, at = _flat([features(t) for t in texts])
        place = np.searchsorted(self.known, found)
        hit = np.flatnonzero(place < len(self.known))
        hit = hit[self.known[place[hit]] == found[hit]]
        place, at = place[hit], at[hit]
        p = np.zeros((len(texts), len(self.categories)))
        for i in range(len(self.categories)):
            z = self.bias[i] + (p[:, :i] - 0.5) @ self.given[i, :i]
            if len(place):
                z = z + np.bincount(at, self.weights[place, i], minlength=len(texts))
            p[:, i] = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        return p


def _sparse_linear(x: list[np.ndarray], dense: np.ndarray, y: np.ndarray, rows: np.ndarray, size: int, epochs: int, l1: float):
    """Logistic regression by follow-the-regularised-leader: L1, a step of its own for each word."""
    alpha, beta, l2, step = 0.5, 1.0, 0.1, 64
    total = size + dense.shape[1]
    z, n, w = np.zeros(total), np.zeros(total), np.zeros(total)
    strength = np.full(total, l1)
    strength[size:] = 0  # bias and earlier probabilities are not thinned out
    order = np.random.default_rng(7).permutation(rows)
    for _ in range(epochs):
        for lo in range(0, len(order), step):
            some = order[lo : lo + step]
            words, at = _flat([x[r] for r in some])
            score = np.bincount(at, w[words], minlength=len(some)) + dense[some] @ w[size:]
            error = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - y[some]
            g = np.zeros(total)
            g[:size] = np.bincount(words, error[at], minlength=size)
            g[size:] = dense[some].T @ error
            sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / alpha
            z += g - sigma * w
            n += g * g
            w = np.where(np.abs(z) <= strength, 0, -(z - np.sign(z) * strength) / ((beta + np.sqrt(n)) / alpha + l2))
    return w


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F-score on held-out probabilities, in the middle of its gap.

    Precision counts twice as much as recall, and the cut stays within CUTS, which few labels could leave.
    """
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    hits = np.cumsum(y)
    f = 1.25 * hits / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    ends = np.r_[p[:-1] > p[1:], True]  # a cut between equal probabilities is none
    best = int(np.argmax(np.where(ends, f, -1)))
    return float(np.clip((p[best] + (p[best + 1] if best + 1 < len(p) else 0.0)) / 2, *CUTS))


def _fitted(found: pa.Table, categories: Sequence[str], names: Sequence[str], folds: int, least_docs: int, epochs: int, l1: float) -> Chain:
    """The chain of a sample: ``_h``, a hash of the key, ``_words``, the features, and the labels ``names``."""
    found = found.append_column("_n", pc.list_value_length(found["_words"]))
    found = found.sort_by([("_h", "ascending"), ("_n", "ascending")])

    split = [w.values.to_numpy().view(np.uint32) for w in found["_words"]]
    known, counts = np.unique(np.concatenate(split) if split else np.empty(0, np.uint32), return_counts=True)
    known = known[counts >= least_docs]
    x = []
    for words in split:
        place = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
        x.append(place[known[place] == words].astype(np.int32) if len(known) else np.empty(0, np.int32))
    fold = found["_h"].to_numpy() % folds
    dense = np.ones((len(split), 1))
    chain = Chain(tuple(categories), np.zeros(len(categories)), np.zeros((len(categories),) * 2))
    weights = np.zeros((len(known), len(categories)))
    for i, name in enumerate(names):
        y = found[name].to_numpy(zero_copy_only=False).astype(float)
        rows = np.flatnonzero(~np.isnan(y))
        classes = np.unique(y[rows])
        if len(classes) < 2:
            chain.bias[i] = 35.0 if len(classes) and classes[0] > 0.5 else -35.0
            held = np.full(len(split), float(chain.bias[i] > 0))
            chain.thresholds[categories[i]] = 0.5
        else:
            w = _sparse_linear(x, dense, y, rows, len(known), epochs, l1)
            weights[:, i], chain.bias[i], chain.given[i, :i] = w[: len(known)], w[len(known)], w[len(known) + 1 :]
            held = np.zeros(len(split))
            for f in range(folds):
                w = _sparse_linear(x, dense, y, rows[fold[rows] != f], len(known), epochs, l1)
                out = np.flatnonzero(fold == f)
                if len(out):
                    ids, at = _flat([x[r] for r in out])
                    score = np.bincount(at, w[ids], minlength=len(out)) + dense[out] @ w[len(known) :]
                    held[out] = 1 / (1 + np.exp(-np.clip(score, -35, 35)))
            chain.thresholds[categories[i]] = _threshold(held[rows], y[rows])
        dense = np.column_stack([dense, held - 0.5])
    used = weights.any(axis=1)
    chain.known, chain.weights = known[used], weights[used]
    return chain


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = 10_000,
    sample_features: int = 12_000_000,
    folds: int = 3,
    least_docs: int = 3,
    epochs: int = 6,
    l1: float = 2.0,
) -> Chain:
    """Fit on about ``sample_rows`` labelled documents with ``sample_features`` features in all, whichever is less.

    Both bounds hold in expectation: rows are taken by a hash of the key, and fewer of them where texts are long. All
    features that ``least_docs`` of these have may get a weight; none is cut for being rare among them.
    ``categories`` are 0/1 columns of ``labels``, in the order of the chain. Several labels of one document count as
    their maximum; a null label leaves the document out of that category's fit; rows with a null key are not labelled. A category with one class in the sample gets that class as its
    probability, one without any label gets 0.
    """
    names = [f"_y{i}" for i in range(len(categories))]
    counted = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    counted = counted.agg(*[F.max(F.col(c).cast("double")).alias(n) for c, n in zip(categories, names, strict=True)])
    share = min(1.0, sample_rows / max(1, counted.count()))
    slots = 1 << 20
    slot = F.pmod(F.xxhash64("_key"), F.lit(slots))
    sample = counted.where(slot < F.lit(int(share * slots)))  # sample_rows rows in expectation: the broadcast's bound

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                own = features(b.column(1)[i].as_py()).view(np.int32)
                one = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(own))
                parts = [b.column(0).slice(i, 1), one, *(c.slice(i, 1) for c in b.columns[2:])]
                yield pa.RecordBatch.from_arrays(parts, ["_h", "_words", *names])

    read = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(sample), "_key")
    read = read.select(F.xxhash64("_key").alias("_h"), "_text", *names)
    kinds = ", ".join(f"{n} double" for n in names)
    found = landed(read.mapInArrow(hashed, f"_h long, _words array<int>, {kinds}"), "toxicity")
    total = found.agg(F.sum(F.size("_words"))).first()[0] or 0
    share *= min(1.0, sample_features / max(1, total))
    found = found.where(F.pmod("_h", F.lit(slots)) < F.lit(int(share * slots)))
    schema = pa.schema([("_h", pa.int64()), ("_words", pa.list_(pa.int32())), *((n, pa.float64()) for n in names)])
    settings = (tuple(categories), names, folds, least_docs, epochs, l1)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b.cast(schema) for b in batches], schema)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(_fitted(table, *settings)))], pa.binary())], ["chain"])

    # One task reads the sample, which is bounded. Without any partition there is no task.
    model = found.coalesce(1).mapInArrow(fit, "chain binary").first()
    return Chain(**pickle.loads(model[0])) if model else _fitted(schema.empty_table(), *settings)


def score_chain(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with one column ``p_<category>`` for each link of the chain; whole texts, no shuffle.

    A null or empty text has no words and gets the probabilities of the biases. Rows, repeated ones too,
    are scored one by one; other columns pass through, unless they are named ``p_<category>``: those
    are replaced. An empty table gives an empty one.
    """
    new = [f"p_{c}" for c in chain.categories]
    model = chain  # travels with the function; bounded by the sample

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text))
            parts = [model.probabilities(texts.slice(lo, PORTION).to_pylist()) for lo in range(0, b.num_rows, PORTION)]
            p = np.concatenate([np.empty((0, len(new))), *parts])
            keep = [i for i, n in enumerate(b.schema.names) if n not in new]
            arrays = [b.column(i) for i in keep] + [pa.array(p[:, i]) for i in range(len(new))]
            yield pa.RecordBatch.from_arrays(arrays, [b.schema.names[i] for i in keep] + new)

    schema = docs.drop(*new).schema
    for n in new:
        schema = schema.add(n, "double")
    return docs.mapInArrow(score, schema)
