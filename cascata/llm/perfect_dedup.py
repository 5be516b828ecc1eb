"""Exact duplicates through a minimal perfect hash over the distinct digests of earlier loads.

A text's digest is the SHA-256 of its characters without white space. The distinct digests of what
was loaded before are dealt by their first bytes into shards of bounded size, and each shard becomes
one row of an index: layered bit arrays that give every known digest a slot of its own, and, slot by
slot, the full digest, the row that stays and how many rows the group has. An arriving digest is
looked up in its shard; a slot counts only if all 32 bytes agree. Members are merged with
their slot, so repeats of known texts never meet each other in a shuffle; the others are grouped
on their own.

Of equal texts the row with the most code points in its original text stays, then the one with the
smallest id. Equal digests of one Arrow batch are combined before the first shuffle, so a text on a
third of all rows reaches its shard as one row a batch; the join that tells each row its group is a
plain one, which Spark's skew join splits.

Cases: null counts as empty; texts of white space only equal the empty text; a null id comes after
all others and its row is kept only if the group has no other; of rows that agree in id and length one
is kept, though all carry its id as ``keep_id``; extra columns are ignored; an empty table, and an
empty history, give what the other side gives; texts are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cascata.llm.arrays import byte_texts
from cascata.session import materialize, ship_package

#: Distinct digests that a shard of the index holds on average.
SHARD_DIGESTS = 1 << 14
WIDTH = 32
_WHITE = b" \t\n\r\x0b\x0c"
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
_LAYER = 0x9E3779B97F4A7C15
_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]

GROUP = "digest binary, doc_id long, chars long, row long, size long"
INDEX = "shard long, sizes array<int>, bits binary, digests binary, doc_ids array<long>, chars binary, rows binary, counts binary"


# ------------------------------------------------------------ the hash itself


@dataclass(frozen=True)
class PerfectHash:
    """Slots 0..n-1 for n distinct pairs of 64-bit words, from bit arrays in layers.

    A pair has its bit in the first layer in which no other pair left over falls on the same
    position; its slot is the number of set bits before it. Others may find a slot too, or none.
    """

    sizes: np.ndarray
    bits: np.ndarray  # 0 or 1, one layer after another

    @staticmethod
    def positions(words: np.ndarray, layer: int, size: int) -> np.ndarray:
        x = (words[:, 0] ^ np.uint64(_LAYER * (layer + 1) % (1 << 64))) * _MIX[0]
        x = ((x ^ (x >> np.uint64(29))) + words[:, 1]) * _MIX[1]
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def over(cls, words: np.ndarray) -> PerfectHash:
        layers, left = [], words
        while len(left):
            size = 2 * len(left) + 8
            at = cls.positions(left, len(layers), size)
            met = np.bincount(at, minlength=size)
            layers.append(met == 1)
            left = left[met[at] > 1]
        sizes = np.array([len(x) for x in layers], np.int32)
        return cls(sizes, np.concatenate(layers) if layers else np.zeros(0, bool))

    def slots(self, words: np.ndarray) -> np.ndarray:
        """Slot of each pair; -1 where no layer has a bit for it."""
        before = np.cumsum(self.bits) - self.bits
        found, left, begin = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
        for layer, size in enumerate(self.sizes.tolist()):
            at = begin + self.positions(words[left], layer, size)
            hit = self.bits[at]
            found[left[hit]] = before[at[hit]]
            left, begin = left[~hit], begin + size
        return found


def _words(digests: np.ndarray) -> np.ndarray:
    """The second and third of the four words of each digest; shards are dealt by the first."""
    return digests.view("<u8").reshape(-1, 4)[:, 1:3]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(whole.to_pylist()), np.uint8).reshape(-1, WIDTH)


# ----------------------------------------------------------- rows and groups


def digest_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", first_row: int = 0) -> DataFrame:
    """One narrow row per document, stored: a group of one, whose ``row`` locates the document among all loads."""

    def hashed(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            texts = byte_texts(block.column(1))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array([hashlib.sha256(t.translate(None, _WHITE)).digest() for t in texts], pa.binary()),
                 pa.array([len(t.translate(None, _FOLLOWING)) for t in texts], pa.int64())], names=["doc_id", "digest", "chars"])

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        hashed, "doc_id long, digest binary, chars long")
    numbered = rows.withColumns({"row": F.monotonically_increasing_id() + first_row, "size": F.lit(1).cast("long")})
    return materialize(numbered.select("digest", "doc_id", "chars", "row", "size"), "resumos")


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays, and the number of rows."""
    first = F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("n"), "doc_id", "row"))
    merged = rows.groupBy("digest").agg(first.alias("_first"), F.sum("size").alias("size"))
    return merged.select("digest", F.col("_first.doc_id").alias("doc_id"), (-F.col("_first.c")).alias("chars"), F.col("_first.row").alias("row"), "size")


def _merged(digests: np.ndarray, ids: pa.Array, chars: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For equal digests: the position of the row that stays, the number of rows, and each row's group."""
    _, group = np.unique(digests.view(f"V{WIDTH}").ravel(), return_inverse=True)
    order = np.lexsort((rows, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), -chars, group))
    begins = np.flatnonzero(np.r_[True, np.diff(group[order]) > 0]) if len(order) else order
    return order[begins], np.bincount(group, weights=sizes).astype(np.int64), group


def _table(digests: np.ndarray, ids: pa.Array, chars: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    return [pa.array([d.tobytes() for d in digests], pa.binary()), ids, *(pa.array(x, pa.int64()) for x in (chars, rows, sizes))]


def _columns(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    ids = table.column("doc_id")
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    return _matrix(table.column("digest")), ids, *(table.column(c).to_numpy() for c in ("chars", "row", "size"))


def _combined(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal digests of a batch become one row."""
    for block in blocks:
        digests, ids, chars, rows, sizes = _columns(block)
        first, counts, _ = _merged(digests, ids, chars, rows, sizes)
        yield pa.RecordBatch.from_arrays(_table(digests[first], ids.take(pa.array(first)), chars[first], rows[first], counts),
                                         names=["digest", "doc_id", "chars", "row", "size"])


def in_shards(rows: DataFrame, shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(shards)))


# ------------------------------------------------------------ index, look-up


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """The index of distinct digests, stored; one row per shard that has any."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        digests, ids, chars, rows, sizes = _columns(table)
        known = PerfectHash.over(_words(digests))
        by_slot = np.argsort(known.slots(_words(digests)))
        ints = [pa.array([x[by_slot].astype("<i8").tobytes()], pa.binary()) for x in (chars, rows, sizes)]
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([known.sizes.tolist()], pa.list_(pa.int32())),
             pa.array([np.packbits(known.bits).tobytes()], pa.binary()), pa.array([digests[by_slot].tobytes()], pa.binary()),
             pa.array([ids.take(pa.array(by_slot)).to_pylist()], pa.list_(pa.int64())), *ints],
            names=["shard", "sizes", "bits", "digests", "doc_ids", "chars", "rows", "counts"])

    return materialize(in_shards(groups, shards).groupBy("shard").applyInArrow(build, INDEX), "indice")


def look_up(index: DataFrame, arrivals: DataFrame, shards: int) -> DataFrame:
    """What is known about arriving rows: merged groups of every slot, and rows of digests that no slot holds (``known`` false)."""

    def check(index_rows: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["digest", "doc_id", "chars", "row", "size", "known"]
        made: list[pa.Table] = []
        digests, ids, chars, row, sizes = _columns(rows)
        new = np.ones(len(digests), bool)
        if index_rows.num_rows:
            slot = {c: index_rows.column(c)[0] for c in index_rows.column_names}
            level_sizes = np.array(slot["sizes"].as_py(), np.int32)
            bits = np.unpackbits(np.frombuffer(slot["bits"].as_py(), np.uint8))[: level_sizes.sum()].astype(bool)
            held = np.frombuffer(slot["digests"].as_py(), np.uint8).reshape(-1, WIDTH)
            held_ids = pa.array(slot["doc_ids"].as_py(), pa.int64())
            held_chars, held_rows, held_sizes = (np.frombuffer(slot[c].as_py(), "<i8") for c in ("chars", "rows", "counts"))
            at = PerfectHash(level_sizes, bits).slots(_words(digests))
            new = at < 0
            new[~new] = (held[at[~new]] != digests[~new]).any(axis=1)
            member = np.flatnonzero(~new)
            all_digests = np.concatenate([held, digests[member]])
            all_ids = pa.concat_arrays([held_ids, ids.take(pa.array(member))])
            all_chars, all_rows, all_sizes = (np.concatenate([a, b[member]]) for a, b in ((held_chars, chars), (held_rows, row), (held_sizes, sizes)))
            first, counts, _ = _merged(all_digests, all_ids, all_chars, all_rows, all_sizes)
            parts = _table(all_digests[first], all_ids.take(pa.array(first)), all_chars[first], all_rows[first], counts)
            made.append(pa.Table.from_arrays([*parts, pa.array(np.ones(len(first), bool))], names=names))
        left = np.flatnonzero(new)
        parts = _table(digests[left], ids.take(pa.array(left)), chars[left], row[left], sizes[left])
        made.append(pa.Table.from_arrays([*parts, pa.array(np.zeros(len(left), bool))], names=names))
        return pa.concat_tables(made)

    few = in_shards(arrivals.mapInArrow(_combined, GROUP), shards)
    return index.groupBy("shard").cogroup(few.groupBy("shard")).applyInArrow(check, GROUP + ", known boolean")


def shards_for(rows: int) -> int:
    return max(1, -(-rows // SHARD_DIGESTS))


def merge(history: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Groups of earlier loads (``grouped`` rows, or those of an earlier merge) brought up to date with arriving rows; stored."""
    ship_package(history.sparkSession)
    shards = shards_for(history.count() + arrivals.count())
    found = materialize(look_up(build_index(history, shards), arrivals, shards), "consultados")
    names = ["digest", "doc_id", "chars", "row", "size"]
    return materialize(found.where("known").select(names).unionByName(grouped(found.where("not known").select(names))), "grupos")


def assign(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """What became of each row: the id that stays for it, its group's size, and whether it is the row that stays."""
    winners = groups.select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("_stays"), F.col("size").alias("group_size"))
    return rows.drop("size").join(winners, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("_stays")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, loaded_before: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Exact duplicates of a table part of which was loaded before; the result does not depend on which part."""
    marked = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(loaded_before, F.lit(False)).alias("_old"))
    old = digest_rows(marked.where("_old").drop("_old"))
    last = old.agg(F.max("row")).first()[0]
    new = digest_rows(marked.where("not _old").drop("_old"), first_row=0 if last is None else last + 1)
    return assign(old.unionByName(new), merge(grouped(old), new))
