"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint is the bitwise majority of the XXH64 values of a text's word shingles. Distinct
fingerprints meet in groups: if two differ in at most ``radius`` of 64 bits, then of
``blocks`` equal blocks at least ``blocks - radius`` agree, so grouping by every choice of that
many blocks loses no pair. Within a group the bit planes lie vertically, 64 fingerprints to a
machine word; carry-save counters add up the differing planes of all of them at once, and words
in which every count has passed the radius are abandoned.

``keep_first`` looks for a similarity rather than a few bits: its fingerprints have 256 bits, and as
no choice of blocks is sure to agree at the larger radius, fingerprints meet in groups whose sets share
``BAND_ROWS`` least hashes, of which each set has ``BANDS`` at any size of the table. What is
near by fingerprint is only a candidate: the candidates' shingle sets are compared, and a link needs
the wanted Jaccard similarity.

Cases: null text counts as empty; a text without words has the fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; equal texts have equal fingerprints
and one comparison; a null id has a fingerprint but links nothing; extra columns are ignored; an
empty table gives an empty result; very long texts are hashed whole, a slice at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cascata.llm.arrays import byte_lengths, byte_texts, give_back, ragged, slices
from cascata.llm.components import Forest, connected
from cascata.llm.hot_groups import in_tiles
from cascata.session import materialize, ship_package

SEED = 42
SLICE_BYTES = 1 << 19
#: Hashes of the shingle sets that one side of a tile holds, and what each set counts for besides them.
TILE_HASHES, SET_WEIGHT = 1 << 19, 256
QUERIES_AT_ONCE = 256
#: From this many values on wide fingerprints are compared over bit planes; a plane of fewer is mostly the cost of its calls.
PLANE_VALUES = 512
#: Groups that each set takes part in, and least hashes that its members share: of pairs at 0.8 one in 1,600 shares no group.
BANDS, BAND_ROWS = 40, 8
_BIT_LANES = np.array([sum(((byte >> k) & 1) << (8 * k) for k in range(8)) for byte in range(256)], np.uint64)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_WHITE = b" \t\n\r\x0b\x0c"


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of lower-cased words, in slices of bounded size."""
    begin, carried, met = 0, [], False
    while begin < len(text):
        end = begin + SLICE_BYTES
        while end < len(text) and text[end] not in _WHITE:
            end += 1
        found = carried + text[begin:end].lower().split()
        begin = end
        if len(found) >= words:
            met = True
            shingles = map(b" ".join, zip(*(found[k:] for k in range(words))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(found) - words + 1)
            carried = found[len(found) - words + 1 :]
        else:
            carried = found
    if carried and not met:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)], np.uint64)


def widened(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """The hashes, and further words of bits mixed from them, one column each."""
    columns = [hashes]
    for lane in range(1, lanes):
        x = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        columns.append(x ^ (x >> np.uint64(31)))
    return np.stack(columns, axis=1)


def majority_bits(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per text and lane, the bits that are set in more than half of its hashes (one column a lane).

    Eight counters share a machine word, so a run of at most 255 hashes is summed at once.
    """
    lanes = hashes.shape[1]
    texts = np.zeros((len(lengths), lanes), np.uint64)
    full = lengths > 0
    starts = (np.cumsum(lengths) - lengths)[full]
    if not starts.size:
        return texts
    runs = -(-lengths[full] // 255)
    first = np.cumsum(runs) - runs
    run_starts = np.repeat(starts, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first, runs))
    for lane in range(lanes):
        spread = _BIT_LANES[np.ascontiguousarray(hashes[:, lane]).view(np.uint8).reshape(-1, 8)]
        counts = np.add.reduceat(spread, run_starts, axis=0).view(np.uint8).astype(np.int64)
        counts = np.add.reduceat(counts, first, axis=0)
        set_ = 2 * counts > lengths[full][:, None]
        texts[full, lane] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64).ravel()
    return texts


def long_majority(parts: Iterable[np.ndarray], lanes: int) -> np.ndarray:
    """``majority_bits`` of one text whose hashes come in parts, in bounded memory."""
    total, counts = 0, np.zeros((lanes, 64), np.int64)
    for part in parts:
        total += len(part)
        for c in range(0, len(part), 1 << 16):
            wide = np.ascontiguousarray(widened(part[c : c + (1 << 16)], lanes).T)
            counts += np.unpackbits(wide.view(np.uint8).reshape(lanes, -1, 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int64)
    return np.packbits(2 * counts > total, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint(texts: list[bytes], words: int = 3, lanes: int = 1) -> np.ndarray:
    """Fingerprints of 64 bits a lane, one row a text."""
    made = np.zeros((len(texts), lanes), np.uint64)
    for a, b in slices([len(t) for t in texts], SLICE_BYTES):
        if b - a == 1 and len(texts[a]) > SLICE_BYTES:
            made[a] = long_majority(shingle_hashes(texts[a], words), lanes)
            continue
        each = [list(shingle_hashes(t, words)) for t in texts[a:b]]
        lengths = np.array([sum(map(len, parts)) for parts in each], np.int64)
        hashes = np.concatenate([np.empty(0, np.uint64), *chain.from_iterable(each)])
        made[a:b] = majority_bits(widened(hashes, lanes), lengths)
    return made


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text in ascending order."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(text, words)]))


def set_digest(hashes: np.ndarray) -> bytes:
    """By which equal shingle sets meet."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=20).digest()


def band_keys(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per set (its hashes one set after another) and band, a key of its least hashes under the band's functions."""
    keys = np.zeros((len(lengths), BANDS), np.uint64)
    full = np.flatnonzero(lengths > 0)
    if not full.size:
        return keys
    starts = (np.cumsum(lengths) - lengths)[full]
    factors = np.random.default_rng(29).integers(0, 1 << 63, (BANDS, BAND_ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
    for band in range(BANDS):
        key = np.zeros(len(full), np.uint64)
        for factor in factors[band]:
            key = (key ^ np.minimum.reduceat(hashes * factor, starts)) * np.uint64(0x94D049BB133111EB)
            key ^= key >> np.uint64(31)
        keys[full, band] = key
    return keys


def lane_names(lanes: int) -> list[str]:
    return [f"bits{k}" if k else "bits" for k in range(lanes)]


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, lanes: int = 1) -> DataFrame:
    """(id, ``bits``, ``bits1``, ...): the fingerprint of every row as signed longs."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), *(T.StructField(n, T.LongType()) for n in lane_names(lanes))])

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            bits = fingerprint(byte_texts(block.column(1)), words, lanes).view(np.int64)
            yield pa.RecordBatch.from_arrays([block.column(0), *(pa.array(b) for b in bits.T)], names=[id_column, *lane_names(lanes)])

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def set_fingerprints(docs: DataFrame, id_column: str, text_column: str, words: int, lanes: int) -> DataFrame:
    """(id, ``digest``, ``shingles``, ``bits``, ..., ``bands``): the shingle set's digest, size, fingerprint and band keys; a repeated shingle counts once."""
    ship_package(docs.sparkSession)
    fields = [T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("digest", T.BinaryType()), T.StructField("shingles", T.LongType())]
    schema = T.StructType([*fields, *(T.StructField(n, T.LongType()) for n in lane_names(lanes)), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            texts = block.column(1)
            lengths = byte_lengths(texts)
            bits, digests, sizes = np.zeros((len(texts), lanes), np.uint64), [], np.zeros(len(texts), np.int64)
            bands = np.zeros((len(texts), BANDS), np.uint64)
            for a, b in slices(lengths, SLICE_BYTES):
                sets = [shingle_set(t, words) for t in byte_texts(texts.slice(a, b - a))]
                digests += map(set_digest, sets)
                sizes[a:b] = [len(x) for x in sets]
                bands[a:b] = band_keys(np.concatenate(sets), sizes[a:b])
                if b - a == 1 and lengths[a] > SLICE_BYTES:
                    bits[a] = long_majority(sets, lanes)
                else:
                    bits[a:b] = majority_bits(widened(np.concatenate(sets), lanes), sizes[a:b])
            lists = pa.ListArray.from_arrays(pa.array(BANDS * np.arange(len(texts) + 1, dtype=np.int32)), pa.array(bands.view(np.int64).ravel()))
            columns = [block.column(0), pa.array(digests, pa.binary()), pa.array(sizes), *(pa.array(x) for x in bits.view(np.int64).T), lists]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            del texts, bits, digests, bands, lists, columns
        give_back()

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """One row per bit of the values; 64 values to a word. Unused places hold zeros."""
    width = -(-len(values) // 64)
    padded = np.zeros((64 * width, values.shape[1]), np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near(queries: np.ndarray, planes: np.ndarray, n: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, value) that differ in at most ``radius`` bits, by carry-save counting over the planes.

    The counters of all lanes start at what makes them overflow just beyond the radius.
    """
    width = planes.shape[1]
    rows, words = np.divmod(np.arange(len(queries) * width), width)
    wanted = [np.where((queries[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1), _FULL, np.uint64(0)) for k in range(len(planes))]
    size = max(1, radius.bit_length())
    offset = (1 << size) - 1 - radius
    counters = [np.full(len(rows), _FULL if offset >> b & 1 else 0, np.uint64) for b in range(size)]
    passed = np.zeros(len(rows), np.uint64)
    passed[words == width - 1] = _FULL << np.uint64(n - 64 * (width - 1)) if n % 64 else np.uint64(0)
    for k in range(len(planes)):
        carry = planes[k][words] ^ wanted[k][rows] if len(rows) < len(queries) * width else (planes[k][None, :] ^ wanted[k][:, None]).ravel()
        for b in range(size):
            over = counters[b] & carry
            counters[b] ^= carry
            carry = over
        passed |= carry
        if k >= max(11, 2 * radius) and k % 4 == 3:
            alive = np.flatnonzero(passed != _FULL)
            if 4 * len(alive) < 3 * len(rows):
                rows, words, passed = rows[alive], words[alive], passed[alive]
                counters = [c[alive] for c in counters]
                if not len(rows):
                    break
    hits = np.flatnonzero(passed != _FULL)
    lanes = np.unpackbits((~passed[hits]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    where, lane = np.nonzero(lanes)
    return rows[hits][where], 64 * words[hits][where] + lane


def near_wide(queries: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """``near`` for several lanes: at a large radius counting whole words is faster than counting planes. The last lane is counted for what is left."""
    last = values.shape[1] - 1
    counts = np.zeros((len(queries), len(values)), np.uint16)
    for lane in range(last):
        counts += np.bitwise_count(queries[:, lane, None] ^ values[None, :, lane])
    i, j = np.nonzero(counts <= radius)
    within = counts[i, j] + np.bitwise_count(queries[i, last] ^ values[j, last]) <= radius
    return i[within], j[within]


def comparer(values: np.ndarray, radius: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Finds the pairs (query, value) within the radius, bit-sliced but for a few wide values."""
    if values.shape[1] > 1 and len(values) < PLANE_VALUES:
        return lambda queries: near_wide(queries, values, radius)
    planes = bit_planes(values)
    return lambda queries: near(queries, planes, len(values), radius)


def link_tile(values: np.ndarray, first: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is near within a tile: each member with the root of its tree.

    ``first`` marks one side of a tile; only pairs across the sides are compared then.
    """
    forest = Forest(len(values))
    left = np.arange(len(values)) if first is None else np.flatnonzero(first)
    right = left if first is None else np.flatnonzero(~first)
    if len(left) and len(right):
        compare = comparer(values[right], radius)
        for a in range(0, len(left), QUERIES_AT_ONCE):
            i, j = compare(values[left[a : a + QUERIES_AT_ONCE]])
            forest.link(left[a + i], right[j])
    return forest.edges()


def _group_keys(count: int, radius: int, group_rows: int) -> Column:
    """For each choice of agreeing blocks, the number of the group a fingerprint belongs to."""
    blocks = radius + 1
    while blocks < radius + 4 and count >> (64 * (blocks - radius) // blocks) > 2 * group_rows:
        blocks += 1
    groups = max(1, count // group_rows)
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        agreed = F.col("bits").bitwiseAND(F.lit(signed))
        keys.append(F.struct(F.lit(number).alias("choice"), F.pmod(F.xxhash64(agreed), F.lit(groups)).alias("bucket")))
    return F.array(*keys)


def _linked(spread: DataFrame, radius: int, lanes: int, tile_rows: int) -> DataFrame:
    """Links ``a``, ``b`` that connect what is near within each (choice, bucket) of (node, bits...)."""
    names = lane_names(lanes)

    def run(tile: pa.Table) -> pa.Table:
        values = np.stack([tile.column(n).to_numpy() for n in names], axis=1).view(np.uint64)
        nodes = tile.column("node").to_numpy()
        across = tile.column("_lo")[0].as_py() != tile.column("_hi")[0].as_py()
        a, b = link_tile(values, tile.column("_first").to_numpy() if across else None, radius)
        return pa.table({"a": nodes[a], "b": nodes[b]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    tiles = in_tiles(spread, ["choice", "bucket"], "node", tile_rows)
    return tiles.groupBy("choice", "bucket", "_lo", "_hi").applyInArrow(run, "a long, b long")


def _spread(distinct: DataFrame, keys: Column, lanes: int) -> DataFrame:
    names = lane_names(lanes)
    spread = distinct.withColumn("_key", F.explode(keys))
    return spread.select("node", *names, F.col("_key.choice").alias("choice"), F.col("_key.bucket").alias("bucket"))


def links(distinct: DataFrame, radius: int = 3, group_rows: int = 2048, tile_rows: int = 4096) -> DataFrame:
    """Links that connect the nodes of (``node``, ``bits``) whose 64 bits are near, over distinct bits; none is missed."""
    keys = _group_keys(distinct.count(), radius, group_rows)
    return _linked(_spread(distinct, keys, 1), radius, 1, tile_rows)


def banded_links(distinct: DataFrame, radius: int, lanes: int, tile_rows: int = 4096) -> DataFrame:
    """The same for wide fingerprints, among those that share a band; each takes part in ``BANDS`` groups whatever the size of the table."""
    keys = F.transform("bands", lambda key, number: F.struct(number.alias("choice"), key.alias("bucket")))
    return _linked(_spread(distinct, keys, lanes), radius, lanes, tile_rows)


def link_sets(sets: list[np.ndarray], values: np.ndarray, first: np.ndarray | None, radius: int, jaccard: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between sets of distinct hashes whose Jaccard similarity is ``jaccard`` at least: each member with the root of its tree.

    Pairs within the radius are candidates. Each set is compared with those candidates that no link has joined it
    to yet, so that a group of near copies takes about one comparison a member.
    """
    forest = Forest(len(sets))
    left = np.arange(len(sets)) if first is None else np.flatnonzero(first)
    right = left if first is None else np.flatnonzero(~first)
    if not (len(left) and len(right)):
        return forest.edges()
    lengths = np.array([len(x) for x in sets], np.int64)
    starts = np.cumsum(lengths) - lengths
    known, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(known), bool)
    compare = comparer(values[right], radius)
    for a in range(0, len(left), QUERIES_AT_ONCE):
        i, j = compare(values[left[a : a + QUERIES_AT_ONCE]])
        i, j = left[a + i], right[j]
        low, high = np.minimum(lengths[i], lengths[j]), np.maximum(lengths[i], lengths[j])
        likely = (low >= jaccard * high - 1e-9) & ((i < j) if first is None else True)
        order = np.argsort(i[likely], kind="stable")
        i, j = i[likely][order], j[likely][order]
        begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, int)
        for begin, end in zip(begins, np.r_[begins[1:], len(i)]):
            one, others = i[begin], j[begin:end]
            others = others[forest.roots[others] != forest.roots[one]]
            if not len(others):
                continue
            own = numbers[starts[one] : starts[one] + lengths[one]]
            marked[own] = True
            ends = np.cumsum(lengths[others])
            common = np.add.reduceat(marked[numbers[ragged(starts[others], lengths[others])]], ends - lengths[others], dtype=np.int64)
            marked[own] = False
            similar_ = others[common >= jaccard * (lengths[one] + lengths[others] - common) - 1e-9]
            if len(similar_):
                forest.link(np.full(len(similar_), one), similar_)
    return forest.edges()


def verified_links(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str, words: int, lanes: int, radius: int, jaccard: float) -> DataFrame:
    """Links ``a``, ``b`` that connect what is similar among the classes ``wanted`` (``component``, ``node``, ``digest``, bits).

    Only members of the same component of candidates are compared. The texts are read once more for that; large
    components are compared in tiles.
    """
    names = lane_names(lanes)
    given = docs.select(F.col(id_column).cast("long").alias("node"), F.col(text_column).alias("text")).join(
        wanted.select("node", "component", F.col("digest").alias("_digest"), *names), "node")
    fields = [T.StructField("component", T.LongType()), T.StructField("node", T.LongType()), T.StructField("digest", T.BinaryType()),
              *(T.StructField(n, T.LongType()) for n in names), T.StructField("n", T.LongType()), T.StructField("hashes", T.BinaryType())]
    schema = T.StructType(fields)

    def read(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            texts = block.column("text")
            for a, b in slices(byte_lengths(texts), SLICE_BYTES):
                sets = [shingle_set(t, words) for t in byte_texts(texts.slice(a, b - a))]
                part = block.slice(a, b - a)
                # an id may have rows of other texts
                mine = [k for k, (x, digest) in enumerate(zip(sets, part.column("_digest").to_pylist())) if set_digest(x) == digest]
                part = part.take(pa.array(mine, pa.int64()))
                lists = [pa.array([len(sets[k]) for k in mine], pa.int64()), pa.array([sets[k].tobytes() for k in mine], pa.binary())]
                columns = [part.column(c) for c in ("component", "node", "_digest", *names)]
                yield pa.RecordBatch.from_arrays([*columns, *lists], names=schema.names)
        give_back()

    order = ["component", "node", *names, "n", "hashes"]
    sets = given.select("node", "text", "component", "_digest", *names).mapInArrow(read, schema)
    sets = materialize(sets.groupBy("digest").agg(*(F.first(c).alias(c) for c in order)), "conjuntos")

    def run(tile: pa.Table) -> pa.Table:
        values = np.stack([tile.column(n).to_numpy() for n in names], axis=1).view(np.uint64)
        nodes = tile.column("node").to_numpy()
        held = [np.frombuffer(x, np.uint64) for x in tile.column("hashes").to_pylist()]
        across = tile.column("_lo")[0].as_py() != tile.column("_hi")[0].as_py()
        a, b = link_sets(held, values, tile.column("_first").to_numpy() if across else None, radius, jaccard)
        if sum(map(len, held)) > TILE_HASHES // 4:
            del held
            give_back()
        return pa.table({"a": nodes[a], "b": nodes[b]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    tiles = in_tiles(sets, ["component"], "digest", TILE_HASHES, weight=f"n + {SET_WEIGHT}")
    return tiles.groupBy("component", "_lo", "_hi").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """(id, ``fingerprint`` in hex, ``component_id``): the least id that links of near fingerprints reach.

    The id is a long. Fingerprints are compared once however many rows share them.
    """
    made = materialize(fingerprints(docs, id_column, text_column, words), "impressoes")
    distinct = materialize(made.groupBy("bits").agg(F.min(id_column).cast("long").alias("node")), "distintas")
    found = connected(links(distinct.where("node is not null"), radius))
    named = distinct.join(found, "node", "left").select("bits", F.coalesce("component", "node").alias("component_id"))
    hexed = F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint")
    return made.join(named, "bits").select(id_column, hexed, "component_id")


def similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, jaccard: float = 0.8, lanes: int = 4) -> DataFrame:
    """(id, ``component_id``) of rows whose shingle sets are similar; how often a text repeats a shingle does not matter.

    Sets of Jaccard similarity j have the cosine 2j / (1 + j), and their fingerprints differ in the
    share acos(cosine) / pi of the bits. Candidates lie within a radius of four and a half standard deviations beyond
    that, which leaves room for sets of few shingles (four of five: 3 / 16 of the bits); links are verified. A row without words is similar to nothing but other such rows.
    """
    share = math.acos(2 * jaccard / (1 + jaccard)) / math.pi
    bits = 64 * lanes
    radius = round(bits * share + 4.5 * math.sqrt(bits * share * (1 - share)))
    names = lane_names(lanes)
    made = materialize(set_fingerprints(docs, id_column, text_column, words, lanes), "impressoes")
    classes = materialize(
        made.groupBy("digest").agg(F.min(id_column).cast("long").alias("node"), F.any_value("shingles").alias("shingles"), F.any_value("bands").alias("bands"), *(F.any_value(n).alias(n) for n in names)), "distintas")
    worded = classes.where("node is not null and shingles > 0")
    candidates = connected(banded_links(worded, radius, lanes))
    wanted = worded.drop("bands").join(candidates, "node")
    found = connected(verified_links(docs, wanted, id_column, text_column, words, lanes, radius, jaccard))
    named = classes.select("digest", "node").join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    return made.select(id_column, "digest").join(named, "digest").select(id_column, "component_id")


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, jaccard: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group of similar ones: the one whose id is least.

    Rows of a null id stay, since nothing can be said of their group; repeated rows of one id stay together.
    """
    found = similar(docs, id_column, text_column, words, jaccard)
    lost = found.where(F.col(id_column) != F.col("component_id")).select(id_column).distinct()
    return docs.join(lost, id_column, "left_anti").select(*docs.columns)
