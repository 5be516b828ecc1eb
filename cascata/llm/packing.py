"""Bounded-space online packing of tokenised documents into windows of a fixed capacity.

Each partition keeps a fixed number of open windows. A document gives full windows while it
is longer than one, and its rest goes to the open window that it fits best. When it fits none
and no more may be opened, the fullest window is filled up with a cut of it and emitted. What
is still open at the end of a partition is merged into one window, and these leftovers are
merged in a tree of bounded groups, so that no task ever sees more than ``fan_in`` of them.

Cases: null and empty texts are documents of the end id alone; repeated rows are packed once
each; a very long text is cut at window boundaries; an empty table gives no rows; of the other
columns only the id is carried, so clashing names do no harm; a null id is kept.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from cascata.llm.arrays import give_back
from cascata.llm.bpe import Vocabulary, encode_blocks, encoder_of
from cascata.session import materialize, ship_package


#: Distinct pieces that go to the tokenizers library in one call.
PIECES_AT_ONCE = 4096


@dataclass
class Piece:
    owner: Any
    start: int
    ids: np.ndarray
    doc_tokens: int


@dataclass
class Window:
    number: int
    filled: int = 0
    pieces: list[Piece] = field(default_factory=list)

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.filled += len(piece.ids)


class Packer:
    """Places pieces into at most ``most_open`` windows; ``emit`` takes those that are done."""

    def __init__(self, capacity: int, most_open: int, first_number: int, emit: Callable[[Window], None]) -> None:
        self.capacity, self.most_open, self.emit = capacity, most_open, emit
        self.next_number = first_number
        self.open: list[Window] = []

    def _new(self) -> Window:
        self.next_number += 1
        return Window(self.next_number - 1)

    def add(self, owner: Any, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            window = self._new()
            window.add(Piece(owner, start, ids[start : start + self.capacity], total))
            self.emit(window)
            start += self.capacity
        while start < total:
            rest = total - start
            fitting = [w for w in self.open if self.capacity - w.filled >= rest]
            if fitting:
                window = max(fitting, key=lambda w: w.filled)
            elif len(self.open) < self.most_open:
                window = self._new()
                self.open.append(window)
            else:
                window = max(self.open, key=lambda w: w.filled)
                rest = self.capacity - window.filled
            window.add(Piece(owner, start, ids[start : start + rest], total))
            start += rest
            if window.filled == self.capacity:
                self.open.remove(window)
                self.emit(window)


def merge_windows(windows: list[Window], capacity: int) -> list[Window]:
    """Fill the fullest windows from the emptier ones, cutting pieces; all but the last are full then."""
    order = sorted(windows, key=lambda w: (-w.filled, w.number))
    numbers = iter([w.number for w in order])
    merged: list[Window] = []
    for piece in (p for w in order for p in w.pieces):
        start = 0
        while start < len(piece.ids):
            if not merged or merged[-1].filled == capacity:
                merged.append(Window(next(numbers)))
            taken = min(capacity - merged[-1].filled, len(piece.ids) - start)
            merged[-1].add(Piece(piece.owner, piece.start + start, piece.ids[start : start + taken], piece.doc_tokens))
            start += taken
    return merged


@dataclass(frozen=True)
class Digest:
    """A column made of a piece's ids, returned instead of the ids themselves."""

    name: str
    kind: T.DataType
    arrow: pa.DataType
    make: Callable[[np.ndarray], Any]


class _Rows:
    """Collects piece rows and hands them out as Arrow blocks."""

    def __init__(self, owner_type: pa.DataType, digest: Digest | None) -> None:
        self.owner_type, self.digest = owner_type, digest
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.ids: list[np.ndarray | None] = []
        self.size = 0

    def add(self, window: Window, still_open: bool = False) -> None:
        offset = 0
        for p in window.pieces:
            made = self.digest.make(p.ids) if self.digest and not still_open else None
            self.rows.append((p.owner, p.start, len(p.ids), p.doc_tokens, window.number, offset, still_open, made))
            keep = still_open or not self.digest
            self.ids.append(p.ids if keep else None)
            self.size += len(p.ids) if keep else 8
            offset += len(p.ids)

    def block(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * 8
        longs = [pa.array(c, pa.int64()) for c in columns[1:6]]
        made = [pa.array(columns[7], self.digest.arrow)] if self.digest else []
        lists = pa.array(self.ids, pa.list_(pa.int32()))
        names = ["_owner", "start", "length", "doc_tokens", "sequence_id", "offset", "_open", "token_ids", *([self.digest.name] if made else [])]
        block = pa.RecordBatch.from_arrays([pa.array(columns[0], self.owner_type), *longs, pa.array(columns[6], pa.bool_()), lists, *made], names=names)
        self.clear()
        return block


def library_merge(library):
    """Ids of distinct pieces by the tokenizers library, each piece as a text of its own."""

    def merge(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for a in range(0, len(pieces), PIECES_AT_ONCE):  # what the library returns takes about a KB a piece
            found = [e.ids for e in library.encode_batch_fast([p.decode() for p in pieces[a : a + PIECES_AT_ONCE]], add_special_tokens=False)]
            flat.append(np.array([i for ids in found for i in ids], np.int32))
            counts.append(np.array([len(ids) for ids in found], np.int64))
        return np.concatenate(flat), np.concatenate(counts)

    return merge


def pack(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 2048,
    open_windows: int = 16,
    end_id: int = 1,
    fan_in: int = 64,
    digest: Digest | None = None,
) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset and token_ids (or the digest).

    ``path`` names the vocabulary file, read on the driver; its size bounds what is broadcast.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(path, encoding="utf-8") as file:
        text = file.read()
    shared = spark.sparkContext.broadcast((Vocabulary(path), text))
    owner = docs.schema[id_column].dataType
    extra = [T.StructField(digest.name, digest.kind)] if digest else []
    longs = [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")]
    schema = T.StructType([T.StructField("_owner", owner), *longs, T.StructField("_open", T.BooleanType()),
                           T.StructField("token_ids", T.ArrayType(T.IntegerType())), *extra])

    def merge():
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # there is a task for each core already
        from tokenizers import Tokenizer

        return library_merge(Tokenizer.from_str(shared.value[1]))

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what earlier tasks left in this worker, before the vocabulary takes its place
        rows, packer = None, None
        encoder = encoder_of(shared.value[0], f"library:{path}", merge)
        for block in encode_blocks(blocks, encoder, "text", "ids"):
            if packer is None:
                rows = _Rows(block.column(0).type, digest)
                packer = Packer(capacity, open_windows, TaskContext.get().partitionId() << 32, rows.add)
            flat, ends = np.asarray(block.column(2).flatten()), np.asarray(block.column(2).offsets)
            ends = (ends - ends[0]).tolist()
            for key, a, b in zip(block.column(0).to_pylist(), ends, ends[1:]):
                packer.add(key, np.append(flat[a:b], np.int32(end_id)))
                if rows.size > 1 << 20:
                    yield rows.block()
        if packer is not None:
            for window in merge_windows(packer.open, capacity):
                rows.add(window, window.filled < capacity)
            yield rows.block()
        give_back()

    given = docs.select(F.col(id_column).alias("_owner"), F.col(text_column).alias("text"))
    placed = materialize(given.mapInArrow(run, schema), "pacotes")
    done, left = placed.where(~F.col("_open")), placed.where("_open")
    parts = (left.agg(F.max(F.shiftright("sequence_id", 32))).first()[0] or 0) + 1
    level = fan_in
    while True:
        merged = _merge_level(left, level, capacity, digest, schema, parts <= level)
        if parts <= level:
            break
        merged = materialize(merged, "restos")
        done, left = done.unionByName(merged.where(~F.col("_open"))), merged.where("_open")
        level *= fan_in
    names = [digest.name] if digest else ["token_ids"]
    return done.unionByName(merged).select(F.col("_owner").alias(id_column), "start", "length", "doc_tokens", "sequence_id", "offset", *names)


def _merge_level(left: DataFrame, level: int, capacity: int, digest: Digest | None, schema: T.StructType, last: bool) -> DataFrame:
    """Merge the leftovers of ``level`` neighbouring partitions; at the last level nothing stays open."""

    def run(table: pa.Table) -> pa.Table:
        windows: dict[int, Window] = {}
        for row in table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            window = windows.setdefault(row["sequence_id"], Window(row["sequence_id"]))
            window.add(Piece(row["_owner"], row["start"], np.array(row["token_ids"], np.int32), row["doc_tokens"]))
        rows = _Rows(table.schema.field("_owner").type, digest)
        for window in merge_windows(list(windows.values()), capacity):
            rows.add(window, not last and window.filled < capacity)
        return pa.Table.from_batches([rows.block()])

    group = F.floor(F.shiftright("sequence_id", 32) / F.lit(level))
    return left.groupBy(group.alias("_grupo")).applyInArrow(run, schema)
