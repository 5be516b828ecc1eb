"""Near-duplicate vectors by spherical-cap filters.

The filter directions form product codes: after a random rotation a vector is cut in two halves,
each half has its own code of random directions, and a filter is a pair of them. There are several
such codes, each with a rotation of its own, and their size follows the number of vectors, so that a filter
holds a bounded number of vectors that are spread. A vector is list
decoded to all filters whose direction it exceeds the cap's height with, vectors meet in the
filters they share, and what meets is verified in double precision, after a look at signs of random
projections or at products in single precision has put the pairs aside that are far from near. The height is found by
simulation: it is the largest at which pairs just at the threshold share a filter of any code with the wanted
probability, which for random rotations does not depend on the data.

Vectors are sent to the filters in rounds, each of which ships about as many rows as there are vectors, and
frees its shuffle before the next; so the disk it takes is a few times the vectors, however many filters they pass.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing
and form components of their own; equal vectors are compared once and count as links of one
another; vectors of different lengths are never compared; a filter that holds much of the vectors
is compared in tiles of bounded size; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from cascata.llm.arrays import ragged, slices, usable, vectors_of, whole_groups
from cascata.llm.components import Forest, connected
from cascata.session import discard, materialize, ship_package, shuffles_freed

SMALL_GROUP = 48
PAIRS_AT_ONCE = 1 << 17
FILTERS_AT_ONCE = 1 << 22
ROWS_AT_ONCE = 1024
#: Rows of a side of a product of a filter's vectors.
SIDE = 512
#: Signs by which pairs are put aside, and how many standard deviations beyond the mean at the threshold (one near pair in a billion).
SCREEN_BITS, SCREEN_DEVIATIONS = 256, 6
#: Product codes, the rows that a filter of them is meant to hold, and how many filters of a code a vector exceeds, about.
CODES, FILTER_ROWS, PASSED = 24, 256, 1.5
LEAST_DIRECTIONS = 16
#: First filters of two rows that are looked at before all of them are.
HEADS = 8
#: Bytes of a digest.
DIGEST = 20
NO_FILTER = np.int32(-(1 << 31))
#: What a round ships: so many rows at least, or as many as there are vectors.
ROUND_ROWS = 1 << 20
#: Into how many parts vectors are cut, one after the other, for equal ones to meet, if there are over ROUND_ROWS.
MEETINGS = 4
#: Bytes of vectors that are stored in one row, that are dealt to a round's units at once, that are sent in one block, and that a partition of a round is meant to hold.
STORED_AT_ONCE, DEALT_AT_ONCE, SENT_AT_ONCE, PARTITION_BYTES = 1 << 18, 16 << 20, 8 << 20, 16 << 20
#: Filters whose counts lie in one row.
COUNTED_AT_ONCE = 1 << 16


class CapFilters:
    """Product codes for vectors of one length."""

    def __init__(self, dimension: int, directions: int, height: float = 0.0, seed: int = 7, codes: int = 1) -> None:
        """``directions`` is for long vectors: there are no more than two for each sign pattern of half a vector."""
        rng = np.random.default_rng([seed, dimension, directions])
        self.dimension, self.height = dimension, height
        self.half = -(-dimension // 2)
        self.directions = directions = min(directions, 2 ** min(self.half, 30))
        width = 2 * self.half
        self.rotations, self.codes = [], []
        for _ in range(codes):
            self.rotations.append(np.linalg.qr(rng.normal(size=(width, width)))[0][:dimension].astype(np.float32))
            halves = rng.normal(size=(2, directions, self.half))
            self.codes.append((halves / np.linalg.norm(halves, axis=2, keepdims=True)).astype(np.float32))
        self.count = codes * directions**2

    def scores(self, units: np.ndarray, code: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Products of each vector's halves with the directions of either half of a code."""
        turned = units.astype(np.float32, copy=False) @ self.rotations[code]
        return turned[:, : self.half] @ self.codes[code][0].T, turned[:, self.half :] @ self.codes[code][1].T

    def height_for(self, cosine: float, recall: float, trials: int = 400) -> float:
        """The height at which a share ``recall`` of random pairs at ``cosine`` exceed a common filter.

        There are at least ``trials`` pairs, and enough for eight of them to lie beyond it.
        """
        trials = max(trials, min(round(8 / max(1 - recall, 1e-9)), 10_000))
        rng, best = np.random.default_rng(self.dimension), []
        for begin in range(0, trials, ROWS_AT_ONCE):
            one, other = self._pairs(rng, min(ROWS_AT_ONCE, trials - begin), cosine)
            best.append(np.max([self._best_common(one, other, code) for code in range(len(self.codes))], axis=0))
        return float(np.sort(np.concatenate(best))[int((1 - recall) * trials)]) - 1e-6

    def _pairs(self, rng: np.random.Generator, count: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        one, other = rng.normal(size=(2, count, self.dimension))
        one /= np.linalg.norm(one, axis=1, keepdims=True)
        if self.dimension == 1:
            return one, one
        other -= (other * one).sum(axis=1, keepdims=True) * one
        other /= np.linalg.norm(other, axis=1, keepdims=True)
        return one, cosine * one + np.sqrt(1 - cosine**2) * other

    def _best_common(self, one: np.ndarray, other: np.ndarray, code: int) -> np.ndarray:
        """The greatest height at which each pair still shares a filter of a code."""
        (a, b), (c, d) = self.scores(one, code), self.scores(other, code)
        # The directions that are best for both together hold the best common filter nearly always; missing it only lowers the height.
        few = min(16, self.directions)
        top = [np.argpartition(-(x + y), few - 1, axis=1)[:, :few] for x, y in ((a, c), (b, d))]
        (a, c), (b, d) = ([np.take_along_axis(x, t, axis=1) for x in pair] for pair, t in zip(((a, c), (b, d)), top))
        return np.minimum(a[:, :, None] + b[:, None], c[:, :, None] + d[:, None]).max(axis=(1, 2))

    def decode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that a vector exceeds; looks only at directions that can still reach the height."""
        rows, found = [], []
        units = units.astype(np.float32, copy=False)
        for begin in range(0, len(units), ROWS_AT_ONCE):
            for code in range(len(self.codes)):
                a, b = self.scores(units[begin : begin + ROWS_AT_ONCE], code)
                ra, ia = _reaching(a, self.height - b.max(axis=1))
                rb, ib = _reaching(b, self.height - a.max(axis=1))
                many = np.bincount(rb, minlength=len(a))
                first = np.cumsum(many) - many
                pick = ragged(first[ra], many[ra])
                row, i = np.repeat(ra, many[ra]), np.repeat(ia, many[ra])
                j = ib[pick]
                high = a[row, i] + b[row, j] >= self.height
                rows.append(begin + row[high])
                found.append((code * self.directions + i[high]) * self.directions + j[high])
        return np.concatenate([*rows, np.empty(0, int)]).astype(int), np.concatenate([*found, np.empty(0, int)]).astype(int)


def _reaching(scores: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.flatnonzero(scores >= least[:, None]), scores.shape[1])


def directions_for(vectors: int, most: int) -> int:
    """Directions of a code at which a filter holds about FILTER_ROWS of the vectors, if they are spread."""
    return min(most, max(LEAST_DIRECTIONS, int(np.ceil(np.sqrt(vectors * PASSED / FILTER_ROWS)))))


_made: dict[tuple, CapFilters] = {}


def _filters(*key) -> CapFilters:
    if key not in _made:
        _made[key] = CapFilters(*key, codes=CODES)
    return _made[key]


def _values(column: pa.Array | pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in the rows of a binary column, one row after another, and how many each row has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    width = np.dtype(kind).itemsize
    if data is None or ends[-1] == ends[0]:
        return np.empty(0, kind), np.diff(ends) // width
    return np.frombuffer(data, kind, count=(ends[-1] - ends[0]) // width, offset=ends[0]), np.diff(ends) // width


def _binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose rows hold so many of the numbers each."""
    ends = np.r_[0, np.cumsum(lengths)] * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _checked(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Id, vector (the bytes of its components) and a digest by which equal vectors meet; the digest is null where a vector takes no part."""
    single = vectors.schema[vector_column].dataType.elementType == T.FloatType()
    fields = [T.StructField("id", vectors.schema[id_column].dataType), T.StructField("digest", T.BinaryType()),
              T.StructField("vector", T.BinaryType())]

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            values, starts, lengths = vectors_of(block.column(1))
            good = usable(values, starts, lengths)
            values = values + 0.0  # minus zero becomes zero
            digests, kept = [], np.where(good, lengths, 0)
            for start, length, fine in zip(starts.tolist(), lengths.tolist(), good.tolist()):
                digests.append(hashlib.blake2b(values[start : start + length].tobytes(), digest_size=DIGEST).digest() if fine else None)
            held = _binary(values[ragged(starts[good], lengths[good])].astype(np.float32 if single else np.float64), kept)
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(digests, pa.binary()), held], names=["id", "digest", "vector"])

    given = F.col(vector_column) if single else F.col(vector_column).cast("array<double>")
    return vectors.select(F.col(id_column).alias("id"), given.alias("vector")).mapInArrow(run, T.StructType(fields))


def _first_common(pairs: tuple[np.ndarray, np.ndarray], filters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The least filter that both rows of each pair exceed."""
    left, right = pairs
    found = [_first_of_some(left[a:b], right[a:b], filters, starts, lengths) for a, b in slices((lengths[left] + lengths[right]).tolist(), FILTERS_AT_ONCE)]
    return np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int64)


def _first_of_some(left: np.ndarray, right: np.ndarray, filters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    number = np.arange(len(left))
    pair = np.concatenate([np.repeat(number, lengths[left]), np.repeat(number, lengths[right])])
    held = np.concatenate([filters[ragged(starts[left], lengths[left])], filters[ragged(starts[right], lengths[right])]])
    keys = np.sort((pair.astype(np.int64) << 32) | held)
    keys = keys[1:][keys[1:] == keys[:-1]]
    _, first = np.unique(keys >> 32, return_index=True)
    return keys[first] & 0xFFFFFFFF


def screen_limit(cosine: float) -> int:
    """In how many signs a pair at the threshold may differ."""
    share = np.arccos(np.clip(cosine, -1.0, 1.0)) / np.pi
    return int(SCREEN_BITS * share + SCREEN_DEVIATIONS * np.sqrt(SCREEN_BITS * share * (1 - share))) + 1


def sign_codes(units: np.ndarray) -> np.ndarray:
    """Signs of fixed random projections, packed into words."""
    directions = np.random.default_rng([19, units.shape[1]]).normal(size=(units.shape[1], SCREEN_BITS)).astype(np.float32)
    return np.packbits(units.astype(np.float32) @ directions > 0, axis=1).view(np.uint64)


class _Group:
    """Verifies the pairs of sorted groups of rows; links and counts a pair in the first filter that its rows share."""

    def __init__(self, units: np.ndarray, copies: np.ndarray, filters: np.ndarray, starts: np.ndarray, lengths: np.ndarray, cosine: float) -> None:
        self.units, self.copies, self.cosine = units, copies, cosine
        self.filters, self.starts, self.lengths = filters, starts, lengths
        self.links = np.zeros(len(units), np.int64)
        self.forest = Forest(len(units))
        self.limit = screen_limit(cosine)
        self.single = units.astype(np.float32)
        #: Below this no product in single precision comes out for a pair at the threshold.
        self.least = np.float32(cosine - 1.2e-7 * (units.shape[1] + 8))
        self._codes = self._heads = None

    @property
    def codes(self) -> np.ndarray:
        if self._codes is None:
            self._codes = sign_codes(self.units)
        return self._codes

    @property
    def heads(self) -> np.ndarray:
        """The first filters of each row; where there are fewer, numbers that are no filter's."""
        if self._heads is None:
            self._heads = np.repeat(np.arange(-1, -1 - len(self.units), -1, dtype=np.int32)[:, None], HEADS, axis=1)
            few = np.minimum(self.lengths, HEADS)
            row = np.repeat(np.arange(len(few)), few)
            self._heads[row, ragged(np.zeros(len(few), np.int64), few)] = self.filters[ragged(self.starts, few)]
        return self._heads

    def _count(self, left: np.ndarray, right: np.ndarray) -> None:
        self.forest.link(left, right)
        np.add.at(self.links, left, self.copies[right])
        np.add.at(self.links, right, self.copies[left])

    def _first_here(self, left: np.ndarray, right: np.ndarray, filter_of: np.ndarray | int) -> np.ndarray:
        """Which pairs share no filter less than this one."""
        first = np.ones(len(left), bool)
        its = np.broadcast_to(filter_of, left.shape)
        for a in range(0, len(left), PAIRS_AT_ONCE // 8):
            here = slice(a, a + PAIRS_AT_ONCE // 8)
            one, two = self.heads[left[here]], self.heads[right[here]]
            two = np.where(two < its[here, None], two, NO_FILTER)
            for k in range(HEADS):
                first[here] &= (one[:, k, None] != two).all(axis=1)
        open_ = np.flatnonzero(first)
        first[open_] = _first_common((left[open_], right[open_]), self.filters, self.starts, self.lengths) == its[open_]
        return first

    def verify(self, left: np.ndarray, right: np.ndarray, filter_of: np.ndarray) -> None:
        for a in range(0, len(left), PAIRS_AT_ONCE):
            i, j, its = left[a : a + PAIRS_AT_ONCE], right[a : a + PAIRS_AT_ONCE], filter_of[a : a + PAIRS_AT_ONCE]
            alike = np.bitwise_count(self.codes[i] ^ self.codes[j]).sum(axis=1, dtype=np.int32) <= self.limit
            i, j, its = i[alike], j[alike], its[alike]
            near = self._near(i, j)
            i, j, its = i[near], j[near], its[near]
            if i.size:
                first = self._first_here(i, j, its)
                self._count(i[first], j[first])

    def _near(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.units[left], self.units[right]) >= self.cosine

    def _verify_some(self, left: np.ndarray, right: np.ndarray, filter_: int) -> None:
        if left.size:
            near = self._near(left, right)
            left, right = left[near], right[near]
            first = self._first_here(left, right, filter_)
            self._count(left[first], right[first])

    def verify_blocks(self, left: np.ndarray, right: np.ndarray, filter_: int) -> None:
        """All pairs of two sides of a tile, or within one side if they are the same rows."""
        within = left is right
        for a in range(0, len(left), SIDE):
            for b in range(a if within else 0, len(right), SIDE):
                one, two = left[a : a + SIDE], right[b : b + SIDE]
                near = self.single[one] @ self.single[two].T >= self.least
                x, y = np.divmod(np.flatnonzero(near), len(two))
                if x.size <= near.size // 16:
                    if within and a == b:
                        x, y = x[x < y], y[x < y]
                    self._verify_some(one[x], two[y], filter_)
                    continue
                near &= self.units[one] @ self.units[two].T >= self.cosine
                if within and a == b:
                    near = np.triu(near, 1)
                for known in (self.heads, None):  # most pairs that met before did so in one of the first filters
                    near &= ~self._meet_before(one, two, filter_, known)
                    x, y = np.nonzero(near)
                    if x.size <= near.size // 16:
                        break
                if known is not None:
                    first = self._first_here(one[x], two[y], filter_)
                    near[x[~first], y[~first]] = False
                    x, y = x[first], y[first]
                self.forest.link(one[x], two[y])
                self.links[one] += near @ self.copies[two]
                self.links[two] += self.copies[one] @ near

    def _meet_before(self, one: np.ndarray, two: np.ndarray, filter_: int, heads: np.ndarray | None = None) -> np.ndarray:
        """Which pairs share a filter less than this one: a product of the two sides' incidence. ``heads``: it looks at these filters only."""
        sides = []
        for rows in (one, two):
            if heads is None:
                held = self.filters[ragged(self.starts[rows], self.lengths[rows])]
                row = np.repeat(np.arange(len(rows)), self.lengths[rows])
            else:
                held, row = heads[rows].reshape(-1), np.repeat(np.arange(len(rows)), HEADS)
            its = (held >= 0) & (held < filter_)
            sides.append((row[its], held[its]))
        shared = np.intersect1d(sides[0][1], sides[1][1])
        tables = []
        for (row, held), rows in zip(sides, (one, two)):
            known = np.isin(held, shared)
            incidence = np.zeros((len(rows), len(shared)), np.float32)
            incidence[row[known], np.searchsorted(shared, held[known])] = 1
            tables.append(incidence)
        return tables[0] @ tables[1].T > 0


@dataclass
class Round:
    """What one round compares: ranges of filters, and those of their tiles that have the numbers ``first`` to ``last - 1``.

    A range of more than one part is one filter whose rows are dealt into parts by their id; each pair of parts is a tile.
    """

    starts: np.ndarray
    stops: np.ndarray
    parts: np.ndarray
    units: np.ndarray  # number of the first tile of each range
    first: int
    last: int
    rows: int

    def tile(self, range_: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Number of the tile of two parts of a range."""
        return self.units[range_] + low * self.parts[range_] - low * (low - 1) // 2 + high - low


def rounds_of(counts: np.ndarray, bases: list[int], tile_rows: int, vectors: int, share: int) -> list[Round]:
    """Cut the filters, whose numbers of rows are given, into units of work and these into rounds.

    Vectors of one length have the filters from one of ``bases`` to the next. A unit holds filters of about equal work,
    or a tile of one filter with over ``tile_rows`` rows; ``share`` is the number of units a round is meant to have at least.
    """
    counts = counts.astype(np.int64)
    heavy = counts > tile_rows
    weight = np.where(heavy | (counts < 2), 0, counts + counts * counts // (2 * FILTER_ROWS))
    most = 2 * max(ROUND_ROWS, vectors)
    unit = min(max(int(weight.sum() / share / max(1, counts.sum() / most)), 1 << 12), 1 << 16)
    border = np.zeros(len(counts), np.int64)
    border[bases] = 1
    after = np.cumsum(heavy)
    group = (np.cumsum(weight) - weight) // unit + np.cumsum(border) + 2 * after - heavy
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(counts) else np.zeros(0, int)
    stops = np.r_[starts[1:], len(counts)].astype(np.int64)
    worth = np.add.reduceat(np.where(counts > 1, counts, 0), starts) > 0 if len(starts) else np.zeros(0, bool)
    rows = np.add.reduceat(counts, starts)[worth] if len(starts) else np.zeros(0, np.int64)
    starts, stops = starts[worth], stops[worth]
    parts = np.where(heavy[starts], -(-rows // tile_rows), 1)
    tiles = parts * (parts + 1) // 2
    units = np.cumsum(tiles) - tiles
    shipped = np.repeat(-(-rows * parts // np.maximum(tiles, 1)), tiles)  # each row goes to as many tiles as there are parts
    at = (np.cumsum(shipped) - shipped) // max(ROUND_ROWS, vectors)
    cuts = np.r_[np.flatnonzero(np.r_[True, at[1:] != at[:-1]]), len(at)] if len(at) else np.zeros(0, int)
    out = []
    for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        a, b = int(np.searchsorted(units, first, "right")) - 1, int(np.searchsorted(units, last, "left"))
        out.append(Round(starts[a:b], stops[a:b], parts[a:b], units[a:b], first, last, int(shipped[first:last].sum())))
    return out


def part_of(nodes: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The part that a row lies in, by a hash of its id."""
    mixed = nodes.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int64)


STORED = "size int, digests binary, nodes binary, copies binary, vectors binary, lengths binary, filters binary"
SENT = "unit int, nodes binary, copies binary, firsts binary, lengths binary, filters binary, vectors binary"


def _send(blocks: Iterator[pa.RecordBatch], round_: Round, kind) -> Iterator[pa.RecordBatch]:
    """The vectors that each unit of a round compares, those of a block in one row: ids, copies, whether on a tile's first side, filters, components."""
    for block in blocks:
        sizes = block.column("size").to_numpy()
        for size in np.unique(sizes).tolist():
            its = block.filter(pa.array(sizes == size))
            for a, b in slices(pc.binary_length(its.column("vectors")).to_pylist(), DEALT_AT_ONCE):
                yield from _send_some(its.slice(a, b - a), size, round_, kind)


def _send_some(block: pa.RecordBatch, size: int, round_: Round, kind) -> Iterator[pa.RecordBatch]:
    nodes, copies, lengths, filters, vectors = (
        _values(block.column(name), its)[0] for name, its in (("nodes", np.int64), ("copies", np.int64), ("lengths", np.int32), ("filters", np.int32), ("vectors", kind)))
    vectors, lengths = vectors.reshape(-1, size), lengths.astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    at = np.flatnonzero((filters >= round_.starts[0]) & (filters < round_.stops[-1]))
    range_ = np.searchsorted(round_.starts, filters[at], "right") - 1
    held = filters[at] < round_.stops[range_]
    at, range_ = at[held], range_[held]
    row = np.repeat(np.arange(len(lengths)), lengths)[at]
    if not len(at):
        return
    last = np.r_[(row[1:] != row[:-1]) | (range_[1:] != range_[:-1]), True]  # a row goes to a range once, with its filters up to there
    at, range_, row = at[last], range_[last], row[last]
    parts = round_.parts[range_]
    own = part_of(nodes[row], parts)
    if (parts > 1).any():
        other = ragged(np.zeros(len(parts), np.int64), parts)
        at, range_, row, own = (np.repeat(x, parts) for x in (at, range_, row, own))
        unit, first = round_.tile(range_, np.minimum(own, other), np.maximum(own, other)), own <= other
        meant = (unit >= round_.first) & (unit < round_.last)
        at, row, unit, first = at[meant], row[meant], unit[meant], first[meant]
    else:
        unit, first = round_.units[range_], np.ones(len(at), bool)
    order = np.argsort(unit, kind="stable")
    at, row, unit, first = at[order], row[order], unit[order], first[order]
    known = at - begins[row] + 1
    step = max(1, SENT_AT_ONCE // (size * np.dtype(kind).itemsize + 4 * max(1, int(known.mean())) + 24 if len(known) else 1))
    for a in range(0, len(unit), step):
        here, its = row[a : a + step], known[a : a + step]
        start = np.flatnonzero(np.r_[True, unit[a + 1 : a + step] != unit[a : a + step][:-1]])
        many = np.diff(np.r_[start, len(here)])
        yield pa.RecordBatch.from_arrays([
            pa.array(unit[a : a + step][start].astype(np.int32)), _binary(nodes[here], many), _binary(copies[here], many),
            _binary(first[a : a + step].astype(np.uint8), many), _binary(its.astype(np.int32), many),
            _binary(filters[ragged(begins[here], its)], np.add.reduceat(its, start)), _binary(vectors[here].reshape(-1), many * size),
        ], names=["unit", "nodes", "copies", "firsts", "lengths", "filters", "vectors"])


def _compare(blocks: Iterator[pa.RecordBatch], round_: Round, cosine: float, kind) -> Iterator[pa.RecordBatch]:
    for table, begins in whole_groups(blocks, ["unit"], 1):
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), table.num_rows]):
            unit = table.slice(a, b - a)
            range_ = int(np.searchsorted(round_.units, unit.column("unit")[0].as_py(), "right")) - 1
            yield _compare_one(unit, int(round_.starts[range_]), int(round_.stops[range_]), cosine, kind)


def _compare_one(unit: pa.Table, start_filter: int, stop_filter: int, cosine: float, kind) -> pa.RecordBatch:
    """Compare the rows of a unit in each filter of a range; those of a tile of two parts across these only."""
    nodes, copies, firsts, lengths, filters, vectors = (
        _values(unit.column(name), its)[0]
        for name, its in (("nodes", np.int64), ("copies", np.int64), ("firsts", np.uint8), ("lengths", np.int32), ("filters", np.int32), ("vectors", kind)))
    units = vectors.reshape(len(nodes), -1).astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    lengths, filters, first = lengths.astype(np.int64), filters.astype(np.int64), firsts.astype(bool)
    across = not first.all()
    group = _Group(units, copies, filters, np.cumsum(lengths) - lengths, lengths, cosine)
    here = np.flatnonzero((filters >= start_filter) & (filters < stop_filter))
    row, filter_of = np.repeat(np.arange(len(nodes)), lengths)[here], filters[here]
    order = np.argsort(filter_of, kind="stable")
    row, filter_of = row[order], filter_of[order]
    start = np.flatnonzero(np.r_[True, filter_of[1:] != filter_of[:-1]]) if len(row) else np.zeros(0, int)
    count = np.diff(np.r_[start, len(row)])
    small = count <= SMALL_GROUP
    few_start, few = start[small], count[small]
    for a, b in slices((few * few).tolist(), 4 * PAIRS_AT_ONCE):
        left = ragged(few_start[a:b], few[a:b])
        after = np.repeat(few_start[a:b] + few[a:b], few[a:b]) - left - 1
        left, right = np.repeat(left, after), ragged(left + 1, after)
        if across:
            meant = first[row[left]] != first[row[right]]
            left, right = left[meant], right[meant]
        group.verify(row[left], row[right], filter_of[left])
    for begin, n in zip(start[~small].tolist(), count[~small].tolist()):
        rows = row[begin : begin + n]
        if across:
            group.verify_blocks(rows[first[rows]], rows[~first[rows]], int(filter_of[begin]))
        else:
            group.verify_blocks(rows, rows, int(filter_of[begin]))
    item, root = group.forest.edges()
    some = np.flatnonzero(group.links)
    a = np.concatenate([nodes[item], nodes[some]])
    b = pa.array(np.concatenate([nodes[root], np.zeros(len(some), np.int64)]), mask=np.r_[np.zeros(len(item), bool), np.ones(len(some), bool)])
    return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.concatenate([np.zeros(len(item), np.int64), group.links[some]]))], names=["a", "b", "links"])


def _counts(decoded: DataFrame, total: int) -> np.ndarray:
    """How many rows each filter has."""

    def count(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, waiting = np.zeros(total, np.int64), [], 0
        for block in blocks:
            held.append(_values(block.column(0), np.int32)[0])
            waiting += len(held[-1])
            if waiting >= total:
                counts += np.bincount(np.concatenate(held), minlength=total)
                held, waiting = [], 0
        counts += np.bincount(np.concatenate([*held, np.empty(0, np.int32)]), minlength=total)
        for begin in range(0, total, COUNTED_AT_ONCE):
            its = counts[begin : begin + COUNTED_AT_ONCE]
            if its.any():
                its = its.astype(np.min_scalar_type(its.max()))
                yield pa.RecordBatch.from_arrays([pa.array([begin], pa.int32()), pa.array([its.itemsize], pa.int32()), pa.array([its.tobytes()], pa.binary())], names=["begin", "width", "counts"])

    def add(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for block in blocks:
            for begin, width, its in zip(*(block.column(k).to_pylist() for k in range(3))):
                its = np.frombuffer(its, f"u{width}").astype(np.int64)
                sums[begin] = sums[begin] + its if begin in sums else its
        for begin, its in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([begin], pa.int32()), pa.array([its.tobytes()], pa.binary())], names=["begin", "counts"])

    counted = decoded.select("filters").mapInArrow(count, "begin int, width int, counts binary")
    counts = np.zeros(total, np.int64)
    for begin, its in counted.repartition("begin").mapInArrow(add, "begin int, counts binary").collect():
        its = np.frombuffer(its, np.int64)
        counts[begin : begin + len(its)] = its
    return counts


def _classes(rows: DataFrame, width: int, cosine: float, recall: float, directions: int) -> tuple[list[DataFrame], list[int], int]:
    """Distinct vectors with the filters they exceed, stored many to a row in parts; where the filters of each length begin, and how many there are in all."""
    taking = rows.where("digest is not null and id is not null")
    size = F.floor(F.length("vector") / width).cast("int")
    about = sorted(tuple(r) for r in taking.groupBy(size).agg(F.approx_count_distinct("digest"), F.count("*")).collect())  # the lengths of vectors, most often one
    keys, base, total = {}, {}, 0
    for length, count, _ in about:
        its = directions_for(count, directions)
        filters = CapFilters(length, its, codes=CODES)
        keys[length], base[length] = (length, its, filters.height_for(cosine, recall)), total
        total += filters.count
    kind = np.dtype(f"f{width}")
    names = ["size", "digests", "nodes", "copies", "vectors", "lengths", "filters"]

    def decode(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            sizes = block.column("size").to_numpy()
            for length in np.unique(sizes).tolist():
                chosen = block.filter(pa.array(sizes == length))
                vectors = _values(chosen.column("vector"), kind)[0].reshape(-1, length)
                units = vectors.astype(np.float64)
                row, found = _filters(*keys[length]).decode(units / np.linalg.norm(units, axis=1, keepdims=True))
                both = np.sort((row.astype(np.int64) << 32) | (found + base[length]))
                lengths = np.bincount(row, minlength=len(units))
                digests = _values(chosen.column("digest"), np.uint8)[0]
                begins = np.arange(0, len(units), max(1, STORED_AT_ONCE // (length * width)))
                many = np.diff(np.r_[begins, len(units)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(many), length, np.int32)), _binary(digests, many * DIGEST), _binary(chosen.column("node").to_numpy(), many),
                    _binary(chosen.column("copies").to_numpy(), many), _binary(vectors.reshape(-1), many * length), _binary(lengths.astype(np.int32), many),
                    _binary((both & 0xFFFFFFFF).astype(np.int32), np.add.reduceat(lengths, begins)),
                ], names=names)

    meetings = MEETINGS if sum(x[2] for x in about) > ROUND_ROWS else 1
    stored = []
    for k in range(meetings):
        some = taking.where(F.pmod(F.xxhash64("digest"), F.lit(meetings)) == k)
        grouped = some.groupBy("digest").agg(F.min("id").cast("long").alias("node"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"))
        stored.append(materialize(grouped.withColumn("size", size).mapInArrow(decode, STORED), "filtros"))
    return stored, list(base.values()), total


def _named(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, id and number of copies of the vectors in stored rows."""
    for block in blocks:
        digests, nodes, copies = (_values(block.column(k), kind)[0] for k, kind in enumerate((np.uint8, np.int64, np.int64)))
        yield pa.RecordBatch.from_arrays([_binary(digests, np.full(len(nodes), DIGEST)), pa.array(nodes), pa.array(copies)], names=["digest", "node", "copies"])


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = 0.9,
    recall: float = 0.999,
    directions: int = 512,
    tile_rows: int = 4096,
) -> DataFrame:
    """(id, ``n_links``, ``component_id``, ``kept``) of every row; ids are longs.

    ``directions`` is the greatest size of either half of a code: there are its square many filters to a code. More of them
    make each filter more selective, at the price of a longer list decoding; few vectors take fewer.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    with shuffles_freed(spark):
        width = 4 if vectors.schema[vector_column].dataType.elementType == T.FloatType() else 8
        checked = materialize(_checked(vectors, id_column, vector_column), "vetores")
        stored, bases, total = _classes(checked, width, cosine, recall, directions)
        decoded = spark.read.schema(STORED).parquet(*(x._folder for x in stored))
        rows = materialize(checked.select("id", "digest"), "digests")
        discard(checked)
        links, parts = _linked(decoded, bases, total, cosine, tile_rows, np.dtype(f"f{width}"))
        classes = materialize(decoded.select("digests", "nodes", "copies").mapInArrow(_named, "digest binary, node long, copies long"), "classes")
        for part in stored:
            discard(part)
        parts = connected(parts)
    named = (
        classes.join(links, F.col("node") == F.col("a"), "left").drop("a").join(parts, "node", "left")
        .select("digest", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    linked = rows.where("digest is not null and id is not null").join(named, "digest").select("id", "n_links", "component_id")
    alone = rows.where("digest is null or id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    every = linked.unionByName(alone)
    return every.select(F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _linked(decoded: DataFrame, bases: list[int], total: int, cosine: float, tile_rows: int, kind) -> tuple[DataFrame, DataFrame]:
    """Links of each vector, and edges that join those linked; the filters are compared in rounds that ship about as much each."""
    spark = decoded.sparkSession
    vectors, row_bytes = decoded.agg(F.sum(F.floor(F.length("nodes") / 8)), F.sum(F.length("vectors") + F.length("filters") / 2 + F.length("nodes") * 3)).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = []
    for round_ in rounds_of(_counts(decoded, total), bases, tile_rows, vectors, 8 * least) if total else []:
        partitions = max(least, int(round_.rows * row_bytes / vectors) // PARTITION_BYTES)
        sent = decoded.drop("digests").mapInArrow(lambda blocks, r=round_: _send(blocks, r, kind), SENT)
        met = sent.repartition(partitions, "unit").sortWithinPartitions("unit")
        stored.append(materialize(met.mapInArrow(lambda blocks, r=round_: _compare(blocks, r, cosine, kind), FOUND), "achados")._folder)
    found = spark.read.schema(FOUND).parquet(*stored) if stored else spark.createDataFrame([], FOUND)
    return found.where("b is null").groupBy("a").agg(F.sum("links").alias("_links")), found.where("b is not null").select("a", "b")


FOUND = "a long, b long, links long"
