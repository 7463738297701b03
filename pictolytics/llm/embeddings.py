"""Near-duplicate vectors by spherical k-means cells.

All vectors of a label start as one cell; cells with too many rows are divided by k-means, again and again, so the
number of cells grows with the table. The centroids of a cell are fitted on a bounded sample of it, in a task
of its own. A vector goes to the part with the most similar centroid. It also visits the parts in which a
partner could lie: two unit vectors with a cosine of t or more are at most sqrt(2 - 2t) apart, so a partner on the far
side of the border between two centroids can only be met by a vector that is that near to the border. Every
link is found by that, whatever the centroids are. A cell whose division would copy more than it saves (most of its
vectors lie near all borders) stays whole. Cells are compared in blocks of a bounded size, guests only with those at home.

A vector is copied once for each block that it is compared with, so blocks are large and a task compares two of them
tile by tile, in memory that does not grow with them. Vectors are moved and kept as they were given, in single precision
where that is what they have, and scaled to unit length, in double precision, where they are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.llm import common
from pictolytics.llm.components import components
from pictolytics.session import shuffles_freed

COSINE = 0.98
#: Rows of a block; two blocks are compared in a task, as many rows of both at a time as a tile has.
BLOCK = 16384
TILE = 1024
#: Vectors that the centroids of a cell are fitted on, about, and the most parts of one division.
SAMPLE = 8192
PARTS = 256
#: Rows that a part of a divided cell should have, and rows above which a cell is divided.
CELL_ROWS = 16384
DIVIDED_ABOVE = 65536
#: A copy of a vector for a visit costs as much as so many comparisons.
COPY_COST = 500
#: A division must leave at most this share of a cell's cost.
GAIN = 0.7
#: Rows of a cell that find their parts in one task.
PIECE = 8192
#: Divisions in a row; a bit of ``_guest`` each.
LEVELS = 32


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """Written and read again; its shuffle files go at once."""
    with shuffles_freed(df.sparkSession):
        return common.landed(df, purpose)


def spherical_kmeans(x: np.ndarray, k: int, steps: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids of unit length; empty cells keep their last centroid."""
    pick = np.random.default_rng(seed).choice(len(x), size=min(k, len(x)), replace=False)
    centroids = x[np.sort(pick)]
    for _ in range(steps):
        cell = np.argmax(x @ centroids.T, axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, cell, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centroids = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), centroids)
    return centroids


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column without nulls, taken over as they lie in memory."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps the squares within range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _parts(x: np.ndarray, centroids: np.ndarray, chord: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of every row, and a matrix of the parts that a row visits.

    Visits go to parts with a smaller number only, so that a pair meets once.
    """
    dots = x @ centroids.T
    own = np.argmax(dots, axis=1)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * centroids @ centroids.T)) + 1e-7
    gap = dots[np.arange(len(x)), own][:, None] - dots
    return own, (gap <= chord * apart[own]) & (np.arange(len(centroids))[None, :] < own[:, None])


_CELL = ["_label", "_size", "_cell"]


def _divided(placed: DataFrame, level: int, chord: float, sample: int, cell_rows: int, above: int, copy_cost: float) -> DataFrame | None:
    """``placed`` with its large cells divided once more, None if none is to be divided."""
    large = placed.where("not _whole").groupBy(*_CELL).agg(F.count("*").alias("_n")).where(F.col("_n") > above)
    large = landed(large, "large-cells")
    if large.isEmpty():
        return None
    types = dict(placed.dtypes)
    cell = ", ".join(f"{c} {types[c]}" for c in _CELL)
    slots = 1 << 20
    rows = placed.join(large, _CELL)
    drawn = rows.where(F.pmod(F.xxhash64("_first", F.lit(level)), F.lit(slots)) < F.ceil(F.lit(sample * slots) / F.col("_n")))

    def fit(t: pa.Table) -> pa.Table:
        x = _unit(_matrix(t["_v"].combine_chunks(), t["_size"][0].as_py()))
        k = max(2, min(PARTS, -(-t["_n"][0].as_py() // cell_rows), len(x) // 4))
        centroids = spherical_kmeans(x, k) if len(x) > 1 else x
        own, visits = _parts(x, centroids, chord)
        lives = t["_guest"].to_numpy() == 0  # guests of an earlier division are compared with these only
        home = np.bincount(own[lives], minlength=len(centroids))
        guests = visits.sum(axis=0)
        scale = t["_n"][0].as_py() / len(x)  # of the cell to its sample
        cost = (home * (np.bincount(own, minlength=len(centroids)) + guests)).sum() * scale**2 + copy_cost * guests.sum() * scale
        gains = cost <= GAIN * lives.sum() * len(x) * scale**2
        found = centroids.ravel() if gains else np.empty(0)
        return t.select(_CELL).slice(0, 1).append_column("_c", pa.array([found], pa.list_(pa.float64())))

    fitted = landed(drawn.select(*_CELL, "_n", "_guest", "_v").groupBy(*_CELL).applyInArrow(fit, f"{cell}, _c array<double>"), "centroids")
    pieces = F.ceil(F.col("_n") / PIECE)
    dealt = rows.withColumn("_piece", F.pmod(F.xxhash64(F.lit("piece"), "_first"), pieces)).drop("_n")
    copied = fitted.join(large, _CELL).select(*_CELL, "_c", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("_piece"))
    names = placed.columns
    schema = placed.schema

    def place(t: pa.Table, c: pa.Table) -> pa.Table:
        t = t.select(names).combine_chunks()
        flat = c["_c"].combine_chunks().flatten().to_numpy() if c.num_rows else np.empty(0)
        if not len(t) or not len(flat):  # stays as it is from now on
            return t.set_column(names.index("_whole"), "_whole", pa.array(np.ones(len(t), bool)))
        size = t["_size"][0].as_py()
        own, visits = _parts(_unit(_matrix(t["_v"].combine_chunks(), size)), flat.reshape(-1, size), chord)
        row, part = np.nonzero(visits)
        row, part = np.r_[np.arange(len(own)), row], np.r_[own, part]
        guest = t["_guest"].to_numpy()[row] | np.where(np.arange(len(row)) < len(own), 0, 1 << level)
        out = t.take(pa.array(row))
        paths = pc.binary_join_element_wise(out["_cell"], pa.array(part).cast(pa.string()), ".")
        return out.set_column(names.index("_cell"), "_cell", paths).set_column(names.index("_guest"), "_guest", pa.array(guest))

    by = [*_CELL, "_piece"]
    moved = dealt.groupBy(*by).cogroup(copied.groupBy(*by)).applyInArrow(place, schema)
    return landed(placed.join(large, _CELL, "left_anti").select(*names).unionByName(moved), "cells")


def _tiles(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[i : i + TILE] for i in range(0, len(rows), TILE)]


def _compared(placed: DataFrame, cosine: float) -> DataFrame:
    """Vectors with links in some pair of blocks: how many there, and the smallest vector reachable there."""
    classes = placed.groupBy(*_CELL, "_guest").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    # At most a row per set of visits: as many as the divisions of a cell allow.
    classes = classes.groupBy(*_CELL).agg(F.collect_list(F.struct("_guest", "_blocks")).alias("_classes"))
    dealt = placed.join(classes, _CELL)
    own = F.filter("_classes", lambda c: c["_guest"] == F.col("_guest"))[0]["_blocks"]
    dealt = dealt.withColumn("_b", F.struct("_guest", F.pmod(F.xxhash64("_first"), own).cast("int").alias("at")))
    # Two that were guests of one division have met elsewhere, if at all.
    others = F.filter("_classes", lambda c: c["_guest"].bitwiseAND(F.col("_guest")) == 0)
    each = F.transform(others, lambda c: F.transform(F.sequence(F.lit(0), c["_blocks"] - 1), lambda i: F.struct(c["_guest"], i.alias("at"))))
    dealt = dealt.withColumn("_o", F.explode(F.flatten(each)))
    dealt = dealt.select(
        *_CELL, F.least("_b", "_o").alias("_x"), F.greatest("_b", "_o").alias("_y"), (F.col("_b") <= F.col("_o")).alias("_left"), "_first", "_copies", "_v"
    )

    def tile(x: np.ndarray, ids: np.ndarray, copies: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows ``a`` against rows ``b``, or a tile with itself where these are the same."""
        near = x[a] @ x[b].T >= cosine
        if a is b:
            np.fill_diagonal(near, False)
            some = near.any(axis=1)
            at, near = a[some], near[np.ix_(some, some)]
        else:
            rows, columns = near.any(axis=1), near.any(axis=0)
            across = near[np.ix_(rows, columns)]
            at = np.r_[a[rows], b[columns]]
            near = np.zeros((len(at), len(at)), bool)
            near[: len(across), len(across) :] = across
            near[len(across) :, : len(across)] = across.T
        ids, copies = ids[at], copies[at]
        links = near @ copies if len(at) else np.empty(0, np.int64)
        low = ids.copy()
        while len(at):  # smallest id reachable inside the tile
            new = np.minimum(low, np.where(near, low[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (new == low).all():
                break
            low = new
        return ids, links.astype(np.int64), low

    def compare(t: pa.Table) -> pa.Table:
        ids, copies = t["_first"].to_numpy(), t["_copies"].to_numpy()
        x = _unit(_matrix(t["_v"].combine_chunks(), t["_size"][0].as_py()))
        left = t["_left"].to_numpy()
        if t["_x"][0] == t["_y"][0]:
            tiles = _tiles(np.arange(len(x)))
            pairs = [(a, b) for i, a in enumerate(tiles) for b in tiles[i:]]
        else:
            pairs = [(a, b) for a in _tiles(np.flatnonzero(left)) for b in _tiles(np.flatnonzero(~left))]
        found = [tile(x, ids, copies, a, b) for a, b in pairs]
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in zip(*found, strict=True)] or [np.empty(0, np.int64)] * 3
        return pa.table({n: pa.array(c) for n, c in zip(("_first", "_links", "_low"), columns, strict=True)})

    found = dealt.groupBy(*_CELL, "_x", "_y").applyInArrow(compare, "_first long, _links long, _low long")
    return landed(found, "vector-links")


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    sample: int = SAMPLE,
    cell_rows: int = CELL_ROWS,
    divided_above: int = DIVIDED_ABOVE,
    copy_cost: float = COPY_COST,
) -> DataFrame:
    """key, ``n_links``, ``component_id`` (smallest key reachable by links), ``kept``, one row per vector.

    Two vectors link if their labels are equal and not null, their lengths are equal and their cosine in double
    precision is at least ``cosine``. Null, empty and zero vectors and those with null or non-finite components
    link with nothing. Cells with more than ``divided_above`` rows are divided into parts of about ``cell_rows``
    where that saves comparisons, a visit counted as ``copy_cost`` of them; the centroids are fitted on about ``sample``
    vectors of the cell, all vectors are indexed. Rows with a null key are left out; repeated keys count once, with
    the largest vector. Other columns are left aside; an empty table gives an empty result.
    """
    # Single precision is exact for itself; all else is taken in double precision.
    kind = "float" if dict(vectors.dtypes)[vector] == "array<float>" else "double"
    read = vectors.select(F.col(key).cast("long").alias("_id"), F.col(label).alias("_label"), F.col(vector).cast(f"array<{kind}>").alias("_v")).where("_id is not null")
    read = read.groupBy("_id").agg(F.max_by(F.struct("_label", "_v"), F.struct("_label", "_v")).alias("x")).select("_id", "x.*")
    odd = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("_label").isNotNull() & (F.size("_v") > 0) & ~odd & F.exists("_v", lambda x: x != 0)
    read = landed(read.withColumn("_sound", F.coalesce(sound, F.lit(False))), "vectors")
    # Equal vectors are folded: they link by themselves and are compared once.
    plain = F.transform("_v", lambda x: x + F.lit(0.0).cast(kind))
    good = read.where("_sound").select("_id", "_label", plain.alias("_v"))
    folded = landed(good.groupBy("_label", "_v").agg(F.min("_id").alias("_first"), F.count("*").alias("_copies")), "distinct-vectors")
    chord = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9

    placed = folded.select("_first", "_label", "_v", "_copies", F.size("_v").alias("_size"))
    placed = placed.withColumns({"_cell": F.lit(""), "_guest": F.lit(0).cast("long"), "_whole": F.lit(False)})
    for level in range(LEVELS):
        more = _divided(placed, level, chord, sample, cell_rows, divided_above, copy_cost)
        if more is None:
            break
        placed = more
    found = _compared(placed, cosine)
    links = found.groupBy("_first").agg(F.sum("_links").alias("_links"))
    member = good.join(folded, ["_label", "_v"]).select("_id", "_first", "_copies")
    member = landed(member.join(links, "_first", "left"), "members")
    edges = member.where("_id <> _first").select(F.col("_id").alias("a"), F.col("_first").alias("b"))
    edges = edges.unionByName(found.where("_first <> _low").select(F.col("_first").alias("a"), F.col("_low").alias("b")))
    with shuffles_freed(vectors.sparkSession):
        groups = components(edges)
    out = read.select("_id").join(member.select("_id", "_copies", "_links"), "_id", "left").join(groups, F.col("_id") == F.col("node"), "left")
    component = F.coalesce("component", "_id")
    n_links = F.coalesce(F.col("_copies") - 1, F.lit(0)) + F.coalesce("_links", F.lit(0))
    return out.select(F.col("_id").alias(key), n_links.cast("long").alias("n_links"), component.alias("component_id"), (F.col("_id") == component).alias("kept"))
