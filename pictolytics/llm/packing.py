"""Packing by a bounded number of open windows per partition, best fit first.

Every task keeps ``windows`` open sequences. The rest of a document that does not fill a sequence of
its own goes into the open one that it fits best; if it fits none, the fullest is topped up with its
head and emitted, or emitted as it is when only a few places are free. What stays open at the end of a
partition is merged in groups of a few partitions. Documents are never shuffled.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import landed

LENGTH = 1024
WINDOWS = 64
TOP_UP = 24
MERGED = 4
ROWS = 4096

SCHEMA = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "_group long, _window long, _ids binary"
)


# Fixed value: how byte-level vocabularies of this family cut a text into words.
_WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """Letter -> byte in the written form of byte-level tokens: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Encoder:
    """Ids of texts by a byte-level tokenizer file, as ``encode(text, add_special_tokens=False)`` gives them.

    Where the file's merges are in the order of their ids, its vocabulary is handed to the faster ``tiktoken``,
    which then merges alike. Texts with the string of an added token are left to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in told["added_tokens"]]
        vocabulary, merges = told["model"]["vocab"], told["model"]["merges"]
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
        simple = told["pre_tokenizer"]["type"] == "ByteLevel" and not told["pre_tokenizer"]["add_prefix_space"] and not told["normalizer"]
        self.fast = None
        if simple and merged == sorted(merged):
            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in self.added}
            self.fast = tiktoken.Encoding("bytes", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(t in text for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


@dataclass
class Window:
    number: int
    filled: int = 0
    pieces: list = field(default_factory=list)


class Packer:
    """Open windows of one task; a piece is (document, start, ids, tokens of the document)."""

    def __init__(self, length: int, windows: int, top_up: int, first: int):
        self.length, self.most, self.top_up, self.next = length, windows, top_up, first
        self.open: list[Window] = []

    def _new(self) -> Window:
        self.next += 1
        return Window(self.next - 1)

    def _put(self, window: Window, piece: tuple) -> None:
        window.pieces.append((piece, window.filled))
        window.filled += len(piece[2])

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> Iterator[Window]:
        """Place one piece; yields the windows that this closes."""
        while len(ids) >= self.length:
            full = self._new()
            self._put(full, (doc, start, ids[: self.length], total))
            yield full
            ids, start = ids[self.length :], start + self.length
        while len(ids):
            need = len(ids)
            best = max((w for w in self.open if w.filled + need <= self.length), key=lambda w: w.filled, default=None)
            if best is None and len(self.open) < self.most:
                best = self._new()
                self.open.append(best)
            if best is not None:
                self._put(best, (doc, start, ids, total))
                if best.filled == self.length:
                    self.open.remove(best)
                    yield best
                return
            fullest = max(self.open, key=lambda w: w.filled)
            self.open.remove(fullest)
            free = self.length - fullest.filled
            if free >= self.top_up:
                self._put(fullest, (doc, start, ids[:free], total))
                ids, start = ids[free:], start + free
            yield fullest


class Rows:
    """Rows gathered into Arrow batches of a bounded size."""

    def __init__(self, schema: pa.Schema, key: str):
        self.schema, self.key, self.columns = schema, key, {n: [] for n in schema.names}

    def add(self, window: Window, group: int | None) -> None:
        for (doc, start, ids, total), offset in window.pieces:
            raw = ids.tobytes()
            row = (start, len(ids), zlib.crc32(raw), total, window.number, offset, group, window.number, None if group is None else raw)
            self.columns[self.key].append(doc)
            for n, v in zip(self.schema.names[1:], row, strict=True):
                self.columns[n].append(v)

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.columns[self.key]) >= least:
            yield pa.RecordBatch.from_pydict(self.columns, schema=self.schema)
            self.columns = {n: [] for n in self.schema.names}


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    windows: int = WINDOWS,
    top_up: int = TOP_UP,
    end_id: int = 0,
) -> DataFrame:
    """Pieces of all documents: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its text's, then ``end_id``; a null or empty text is that one id. Every id
    lies in exactly one piece; ids of a sequence lie from offset 0 without a gap; a sequence holds at
    most ``length`` ids. Repeated rows and rows with a null key are packed like any other; other columns
    are left aside. An empty table gives no pieces. Memory of a task: ``windows`` sequences and
    one document.
    """
    key_type = docs.schema[key].dataType.simpleString()
    arrow_key = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[key_type]
    kinds = [pa.int64()] * 8 + [pa.binary()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    schema = pa.schema([(key, arrow_key), *zip(names, kinds, strict=True)])

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        encoder, packer, rows = Encoder(tokenizer), Packer(length, windows, top_up, at << 32), Rows(schema, key)
        for batch in batches:
            for doc, words in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encoder.ids(words.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for closed in packer.add(doc.as_py(), 0, ids, len(ids)):
                    rows.add(closed, None)
                yield from rows.batches(ROWS)
        for window in packer.open:
            rows.add(window, at // MERGED)
        yield from rows.batches(1)

    def merge(groups: tuple, pieces: pa.Table) -> pa.Table:
        """Windows left open by a few partitions, poured into full ones; at most MERGED x windows of them."""
        group = groups[0].as_py()
        packer, rows = Packer(length, 1, 1, (1 << 62) + (group << 24)), Rows(schema, key)
        for r in pieces.sort_by([("_window", "ascending"), ("offset", "ascending")]).to_pylist():
            for closed in packer.add(r[key], r["start"], np.frombuffer(r["_ids"], dtype="<u4"), r["doc_tokens"]):
                rows.add(closed, None)
        for window in packer.open:
            rows.add(window, None)
        found = list(rows.batches(0))
        return pa.Table.from_batches(found, schema=schema)

    packed = docs.select(key, F.col(text)).mapInArrow(partition, f"`{key}` {key_type}, {SCHEMA}")
    packed = landed(packed, "packed")  # texts are encoded once, both readers below read rows
    merged = packed.where("_group is not null").groupBy("_group").applyInArrow(merge, packed.schema)
    return packed.where("_group is null").unionByName(merged).drop("_group", "_window", "_ids")
