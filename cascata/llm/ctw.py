"""Language-model scores by context-tree weighting over bytes, beside a unigram base score.

A byte is coded as eight binary decisions, each with a tree of the preceding ``DEPTH`` bytes of its
own. A node's Krichevsky-Trofimov estimate is mixed with what its children say, all depths down;
the weights follow from the training counts, after which the model stays as it is and gives every
text a probability (and so a code length). An end mark closes each text and stands before it.

Documents lie in blocks of bounded size by their place in the files. Each block asks for the byte
strings of ``DEPTH + 1`` that occur in it: a row for each pair of latest context bytes, with the strings'
gaps and training counts squeezed into bytes. What ends in one pair is a unit; a pair that is asked for
often is split by its third byte into units of their own. Per unit the counts of all blocks are
merged one after another, and its trees weighted up to the level of the pair (or third byte); sums over the
levels above meet on the driver (at most 65,536 nodes, and 255 more for each split pair). Then the
same rows pass by the weighted unit again, and each goes back to its block with the answers in
the order asked. Words go the same way, in shards by their checksum.

Cases: a null text counts as empty and is scored as such (the end mark alone); a row with a null
id is scored and never learnt from; repeated rows count and are scored each; with nothing to learn
from all estimates are even and the base score is that of unknown tokens; an empty table gives no
rows; of the other columns only the id is carried.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cascata.llm.arrays import byte_texts, slices, whole_groups
from cascata.session import materialize, ship_package

DEPTH = 5
MARK = 0xFF  # no byte of UTF-8
PART_BYTES = 1 << 20
END_TOKEN = " "  # no word holds a blank
_HALF = np.log(0.5)
#: Bits of a key below its pair of latest context bytes, and below the third.
PAIR_SHIFT, THIRD_SHIFT = 8 * (DEPTH - 1), 8 * (DEPTH - 2)
WHOLE_PAIR = -1
#: Strings asked for that a task takes on about, blocks that share one copy of a unit, and strings that are held unmerged.
TASK_GRAMS, LOT_BLOCKS, PENDING_GRAMS = 2_000_000, 4096, 1 << 21
#: Text for which there is a shard of words, and the fewest and most shards.
SHARD_BYTES, WORD_SHARDS = 32 << 20, (16, 4096)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers, by Stirling's series at x + 8."""
    y = x + 8
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Key and text of every position, its end mark included; the latest context byte is a key's highest."""
    raw = np.frombuffer(b"".join(bytes([MARK]) * DEPTH + t + bytes([MARK]) for t in texts), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    keys = np.zeros(max(0, len(raw) - DEPTH), np.uint64)
    for back in range(1, DEPTH + 1):
        keys |= raw[DEPTH - back : len(raw) - back].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - back))
    keys |= raw[DEPTH:]
    owner = np.repeat(np.arange(len(texts)), lengths)
    ends = np.cumsum(lengths + DEPTH)
    at = np.arange(len(owner)) + np.repeat(ends - lengths - DEPTH - (np.cumsum(lengths) - lengths), lengths)
    return keys[at], owner


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def sorted_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[first], np.diff(np.r_[first, len(keys)])


class Level:
    """The binary nodes of all contexts of one depth: counts of zeros and ones, and their estimates."""

    def __init__(self, contexts: np.ndarray, bytes_: np.ndarray, counts: np.ndarray) -> None:
        steps = np.arange(8, dtype=np.uint64)
        symbol = bytes_[:, None].astype(np.uint64)
        self.bits = ((symbol >> (np.uint64(7) - steps)) & np.uint64(1)).astype(bool)
        nodes = (contexts[:, None] << np.uint64(8)) | (np.uint64(1) << steps) | (symbol >> (np.uint64(8) - steps))
        self.nodes, at = np.unique(nodes, return_inverse=True)
        self.at = at.reshape(nodes.shape)
        weights = np.broadcast_to(counts[:, None], nodes.shape).astype(float)
        self.ones = np.bincount(self.at.ravel(), weights=(weights * self.bits).ravel(), minlength=len(self.nodes))
        self.zeros = np.bincount(self.at.ravel(), weights=(weights * ~self.bits).ravel(), minlength=len(self.nodes))
        self.alone = log_kt(self.zeros, self.ones)
        self.weighted = self.alone

    def mix(self, below: Level) -> None:
        """Weight the own estimate against that of the contexts that are one byte longer."""
        parents = (below.nodes >> np.uint64(16) << np.uint64(8)) | (below.nodes & np.uint64(0xFF))
        children = np.bincount(np.searchsorted(self.nodes, parents), weights=below.weighted, minlength=len(self.nodes))
        self.weighted = np.logaddexp(_HALF + self.alone, _HALF + children)

    def chance(self) -> np.ndarray:
        """Estimated probability of the bit that each row has at each step."""
        one = ((self.ones + 0.5) / (self.ones + self.zeros + 1))[self.at]
        return np.where(self.bits, one, 1 - one)

    def share(self) -> np.ndarray:
        """Weight of the own estimate at each row's nodes."""
        return np.exp(_HALF + self.alone - self.weighted)[self.at]


def shard_levels(keys: np.ndarray, counts: np.ndarray, top: int) -> list[Level]:
    """Levels ``top`` to DEPTH of the contexts in a shard, weighted from the deepest up."""
    bytes_ = keys & np.uint64(0xFF)
    levels = [Level(keys >> np.uint64(8 * (DEPTH + 1 - d)), bytes_, counts) for d in range(top, DEPTH + 1)]
    for upper, lower in zip(levels[-2::-1], levels[:0:-1]):
        upper.mix(lower)
    return levels


def chances_below(levels: list[Level]) -> np.ndarray:
    """Mixed probability of each row's bits, from the deepest level up to the first given."""
    chance = levels[-1].chance()
    for level in levels[-2::-1]:
        share = level.share()
        chance = share * level.chance() + (1 - share) * chance
    return chance


class Roots:
    """Estimates of the levels that units share: the two top ones, and that of the pair where a pair was split."""

    def __init__(self, node: np.ndarray, split: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> None:
        """Sums by node: ``node`` is a context byte times 256 plus a decision, or a pair so if ``split``; ``below`` are
        the summed weighted logs of its children."""
        table = [np.zeros(1 << 16) for _ in range(3)]
        for values, given in zip(table, (zeros, ones, below)):
            np.add.at(values, node[~split], given[~split])
        self.pairs = np.unique(node[split] >> 8)
        parts = [np.zeros((len(self.pairs), 256)) for _ in range(3)]
        row, decision = np.searchsorted(self.pairs, node[split] >> 8), node[split] & 0xFF
        for values, given in zip(parts, (zeros, ones, below)):
            values[row, decision] = given[split]
        self.pair_one, self.pair_own, weighted = self._level(*parts)
        upper = (self.pairs[:, None] >> 8 << 8) + np.arange(256)[None, :]  # the latest context byte of each pair
        for values, given in zip(table, (parts[0], parts[1], weighted)):
            np.add.at(values, upper, given)
        zeros, ones, below = (t.reshape(256, 256) for t in table)
        self.one, self.own, weighted = self._level(zeros, ones, below)
        self.root_one, self.root_own, _ = self._level(zeros.sum(axis=0), ones.sum(axis=0), weighted.sum(axis=0))

    @staticmethod
    def _level(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        alone = log_kt(zeros, ones)
        weighted = np.logaddexp(_HALF + alone, _HALF + below)
        return (ones + 0.5) / (zeros + ones + 1), np.exp(_HALF + alone - weighted), weighted

    def log10(self, keys: np.ndarray, below: np.ndarray, split: bool) -> np.ndarray:
        """Log probability of each key's byte, given that of its bits below these levels."""
        steps = np.arange(8, dtype=np.uint64)
        symbol = (keys & np.uint64(0xFF))[:, None]
        bits = ((symbol >> (np.uint64(7) - steps)) & np.uint64(1)).astype(bool)
        decision = ((np.uint64(1) << steps) | (symbol >> (np.uint64(8) - steps))).astype(np.int64)
        last = (keys >> np.uint64(8 * DEPTH)).astype(np.int64)[:, None]
        levels = [(self.one[last, decision], self.own[last, decision]), (self.root_one[decision], self.root_own[decision])]
        if split:
            pair = np.searchsorted(self.pairs, (keys >> np.uint64(PAIR_SHIFT)).astype(np.int64))[:, None]
            levels.insert(0, (self.pair_one[pair, decision], self.pair_own[pair, decision]))
        chance = below
        for one, own in levels:
            chance = own * np.where(bits, one, 1 - one) + (1 - own) * chance
        return np.log10(chance).sum(axis=1)


# ------------------------------------------------- rows between blocks and units


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as bytes: all first bytes, then all second ones, and so on, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1) if len(values) else b""


def opened(stored: bytes, kind: str) -> np.ndarray:
    if not stored:
        return np.zeros(0, kind)
    planes = np.frombuffer(zstandard.decompress(stored), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys of one pair: the gaps between what they hold below it."""
    low = (keys & np.uint64((1 << PAIR_SHIFT) - 1)).astype(np.uint32)
    return squeezed(np.diff(low, prepend=np.uint32(0)))


def unpacked_keys(pair: int, stored: bytes) -> np.ndarray:
    return (np.uint64(pair) << np.uint64(PAIR_SHIFT)) | np.cumsum(opened(stored, "<u4").astype(np.uint64))


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal neighbours."""
    begins = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, int)
    return zip(begins.tolist(), [*begins[1:].tolist(), len(values)])


def _parts(column: pa.ChunkedArray, rows: int = 1 << 30) -> Iterator[tuple[int, int, list[bytes]]]:
    """Row ranges of about a megabyte and their texts, made one after another."""
    sizes = pc.fill_null(pc.binary_length(column.cast(pa.large_binary())), 0).to_pylist()
    for a, b in slices([n + DEPTH + 1 for n in sizes], PART_BYTES, rows):
        yield a, b, byte_texts(column.slice(a, b - a))


def _requests(table: pa.Table, shards: int) -> pa.RecordBatch:
    """What a block of documents asks for, with how often its training documents hold it."""
    learn = table.column("learn").to_numpy()
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    words, others = Counter(), set()
    for a, b, texts in _parts(table.column("text")):
        for taught in (True, False):
            chosen = [t for t, own in zip(texts, learn[a:b]) if own == taught]
            if not chosen:
                continue
            found, n = sorted_counts(grams(chosen)[0])
            keys.append(found)
            counts.append(n * taught)
            for text in chosen:
                words.update(text.lower().split()) if taught else others.update(text.lower().split())
        if len(keys) > 12:
            merged = counted(np.concatenate(keys), np.concatenate(counts))
            keys, counts = [merged[0]], [merged[1]]
    words.update({word: 0 for word in others if word not in words})
    words[END_TOKEN.encode()] = int(learn.sum())
    found, n = counted(np.concatenate(keys), np.concatenate(counts))
    spans = list(runs(found >> np.uint64(PAIR_SHIFT)))
    dealt: defaultdict[int, list[bytes]] = defaultdict(list)
    for word in words:
        dealt[zlib.crc32(word) % shards].append(word)
    rows = [(int(found[a]) >> PAIR_SHIFT, None, b - a, packed_keys(found[a:b]), squeezed(n[a:b].astype("<u4"))) for a, b in spans]
    rows += [(None, shard, len(held), zstandard.compress(b"\n".join(held), 1),
              squeezed(np.fromiter(map(words.__getitem__, held), "<u4", len(held)))) for shard, held in dealt.items()]
    block = pa.array(np.full(len(rows), table.column("block")[0].as_py(), np.int64))
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([block, *(pa.array(x, t) for x, t in zip(zip(*rows), kinds))], names=["block", "pair", "shard", "n", "grams", "counts"])


def _ask(shards: int):
    """Requests of every run of rows of one block; a block that two tasks share asks twice."""
    def ask(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(blocks, ["block"], 1):
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                made = _requests(table.slice(a, b - a), shards)
                for begin in range(0, made.num_rows, 1 << 13):
                    yield made.slice(begin, 1 << 13)

    return ask


def words_of(stored: bytes) -> list[bytes]:
    return zstandard.decompress(stored).split(b"\n")


VOCABULARY = "shard int, grams binary, counts binary, total long, known long"


def _count_words(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of sorted rows, shard by shard, with their training counts over all blocks."""
    def row(shard: int, counts: Counter) -> pa.RecordBatch:
        n = np.fromiter(counts.values(), "<u8", len(counts))
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([zstandard.compress(b"\n".join(counts), 1)], pa.binary()), pa.array([squeezed(n)], pa.binary()),
             pa.array([int(n.sum())], pa.int64()), pa.array([int(np.count_nonzero(n))], pa.int64())], names=[c.split()[0] for c in VOCABULARY.split(", ")])

    current, counts = None, Counter()
    for rows in blocks:
        for shard, grams, n in zip(*(rows.column(c).to_pylist() for c in ("shard", "grams", "counts"))):
            if current is not None and shard != current:
                yield row(current, counts)
                counts = Counter()
            current = shard
            for word, k in zip(words_of(grams), opened(n, "<u4").tolist()):
                counts[word] += k
    if current is not None:
        yield row(current, counts)


def _answer_words(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks, each after the counted row of its shard, with the counts of the words they ask for."""
    counts: dict[bytes, int] = {}
    for rows in blocks:
        made: list[tuple] = []
        for block, grams, n in zip(*(rows.column(c).to_pylist() for c in ("block", "grams", "counts"))):
            asked = words_of(grams)
            if block is None:
                counts = dict(zip(asked, opened(n, "<u8").tolist()))
            else:
                made.append((block, None, grams, squeezed(np.fromiter(map(counts.__getitem__, asked), "<u8", len(asked)))))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                                             names=["block", "pair", "grams", "value"])


def _in_units(split_pairs: set[int]):
    """Rows of pairs that are split become a row for each third byte."""
    def units(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks:
            made: list[tuple] = []
            for block, pair, grams, counts in zip(*(rows.column(c).to_pylist() for c in ("block", "pair", "grams", "counts"))):
                if pair not in split_pairs:
                    made.append((block, pair, WHOLE_PAIR, grams, counts))
                    continue
                keys, n = unpacked_keys(pair, grams), opened(counts, "<u4")
                third = (keys >> np.uint64(THIRD_SHIFT)).astype(np.int64) & 0xFF
                made += [(block, pair, int(third[a]), packed_keys(keys[a:b]), squeezed(n[a:b])) for a, b in runs(third)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*made) if made else [()] * 5, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                names=["block", "pair", "third", "grams", "counts"])

    return units


UNITS = "block long, pair int, third int, grams binary, counts binary"
MERGED = "pair int, third int, grams binary, counts binary, node array<long>, zeros array<double>, ones array<double>, below array<double>"


def _merge_unit(pair: int, third: int, keys: np.ndarray, counts: np.ndarray, last: bool) -> pa.RecordBatch:
    """A unit's counts over all its blocks and, at the last merge, the sums of its topmost level."""
    node, sums = np.zeros(0, np.int64), [np.zeros(0)] * 3
    if last:
        level = shard_levels(keys, counts, 2 if third == WHOLE_PAIR else 3)[0]
        decision = (level.nodes & np.uint64(0xFF)).astype(np.int64)
        upper = pair >> 8 if third == WHOLE_PAIR else pair
        node, at = np.unique((upper << 8) + decision, return_inverse=True)
        sums = [np.bincount(at, weights=x, minlength=len(node)) for x in (level.zeros, level.ones, level.weighted)]
    return pa.RecordBatch.from_arrays(
        [pa.array([pair], pa.int32()), pa.array([third], pa.int32()), pa.array([packed_keys(keys)], pa.binary()),
         pa.array([squeezed(counts.astype("<u8"))], pa.binary()), pa.array([node], pa.list_(pa.int64())),
         *(pa.array([x], pa.list_(pa.float64())) for x in sums)], names=[c.split()[0] for c in MERGED.split(", ")])


def _merge(kind: str, last: bool):
    """Counts of sorted rows, unit by unit; a unit's rows are merged as they come."""
    def merge(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, keys, counts, pending = None, [], [], 0
        for rows in blocks:
            for pair, third, grams, n in zip(*(rows.column(c).to_pylist() for c in ("pair", "third", "grams", "counts"))):
                if unit is not None and unit != (pair, third):
                    yield _merge_unit(*unit, *counted(np.concatenate(keys), np.concatenate(counts)), last)
                    keys, counts, pending = [], [], 0
                unit = (pair, third)
                keys.append(unpacked_keys(pair, grams))
                counts.append(opened(n, kind).astype(np.int64))
                pending += len(keys[-1])
                if pending > PENDING_GRAMS:
                    key, count = counted(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, pending = [key], [count], 0
        if unit is not None:
            yield _merge_unit(*unit, *counted(np.concatenate(keys), np.concatenate(counts)), last)

    return merge


ANSWERS = "block long, pair int, grams binary, value binary"


def _answer(roots: Roots):
    """Rows of blocks, each after the merged row of its unit, with the log probabilities of the strings they ask for."""
    def answer(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros(0, np.uint64), np.zeros(0)
        for rows in blocks:
            made: list[tuple] = []
            for block, pair, third, grams, n in zip(*(rows.column(c).to_pylist() for c in ("block", "pair", "third", "grams", "counts"))):
                asked = unpacked_keys(pair, grams)
                if block is None:
                    split = third != WHOLE_PAIR
                    levels = shard_levels(asked, opened(n, "<u8").astype(np.int64), 3 if split else 2)
                    keys, values = asked, roots.log10(asked, chances_below(levels), split)
                else:
                    made.append((block, pair, grams, squeezed(values[np.searchsorted(keys, asked)])))
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*made), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["block", "pair", "grams", "value"])

    return answer


def _score_block(docs: pa.Table, answers: pa.Table, total: int, distinct: int, schema: pa.Schema) -> pa.Table:
    keys, logs = [np.zeros(0, np.uint64)], [np.zeros(0)]
    count_of: dict[bytes, int] = {}
    for pair, packed, value in zip(*(answers.column(c).to_pylist() for c in ("pair", "grams", "value"))):
        if pair is not None:
            keys.append(unpacked_keys(pair, packed))
            logs.append(opened(value, "<f8"))
        else:
            count_of.update(zip(words_of(packed), opened(value, "<u8").tolist()))
    known, first = np.unique(np.concatenate(keys), return_index=True)  # a block that two tasks share has some twice
    logs, counts = np.concatenate(logs)[first], np.fromiter(count_of.values(), np.int64, len(count_of))
    number = {word: i for i, word in enumerate(count_of)}
    log_word = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
    end = number[END_TOKEN.encode()] if number else -1
    n = docs.num_rows
    score, base, bytes_ = np.zeros(n), np.zeros(n), np.zeros(n)
    tokens, seen = np.zeros(n, np.int64), np.zeros(n, np.int64)
    shift = np.uint64(64 - 8 * (DEPTH + 1))
    for a, b, texts in _parts(docs.column("text"), 1 << int(shift)):
        found, owner = grams(texts)
        each, many = sorted_counts((found << shift) | owner.astype(np.uint64))
        gram, owner = each >> shift, (each & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
        place = np.searchsorted(known, gram)
        if len(known) == 0 or not np.array_equal(known[np.minimum(place, len(known) - 1)], gram):
            raise ValueError("the rows of a block changed between two readings of the documents")
        score[a:b] = np.bincount(owner, weights=many * logs[place], minlength=b - a)
        for i, text in enumerate(texts, a):
            held = text.lower().split()
            at = np.fromiter(map(number.__getitem__, held), np.int64, len(held))
            tokens[i], bytes_[i] = len(held) + 1, len(text)
            seen[i] = np.count_nonzero(counts[at] > 0) + (counts[end] > 0)
            base[i] = log_word[at].sum() + log_word[end]
    return pa.table([docs.column("id"), docs.column("held_out"), pa.array(tokens), pa.array(seen), pa.array(np.full(n, total, np.int64)),
                     pa.array(base), pa.array(score), pa.array(-score / np.log10(2) / (bytes_ + 1))], schema=schema)


def score(
    docs: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    stored: bool = False,
    block_bytes: int = 24 << 20,
    split_rows: int = 500_000,
) -> DataFrame:
    """One row per document, learning from those for which ``held_out`` (of the id column) is false.

    Columns: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of
    the text with its end mark) and bits_per_byte (its code length). With ``stored``, ``docs`` is a table
    as it was read from files, which is read twice; otherwise a copy is stored first. Pairs of context
    bytes that blocks ask for with more than ``split_rows`` strings in all are split by the third byte.
    """
    spark = docs.sparkSession
    ship_package(spark)
    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                        F.coalesce(~held_out, F.lit(False)).alias("learn"), *([F.col("_metadata").alias("_place")] if stored else []))
    if not stored:
        given = materialize(given, "documentos")
        given = given.select("*", F.col("_metadata").alias("_place"))
    size, count = given.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    rows = max(1, block_bytes * count // max(1, size or 0))
    # Rows lie in a block by their place in the files, so that asking needs no shuffle of texts.
    block = F.xxhash64("_place.file_path", F.floor(F.col("_place.row_index") / rows))
    dealt = given.withColumn("block", block).drop("_place")
    shards = min(max((size or 0) // SHARD_BYTES, WORD_SHARDS[0]), WORD_SHARDS[1])
    asked = materialize(dealt.select("text", "learn", "block").mapInArrow(
        _ask(shards), "block long, pair int, shard int, n long, grams binary, counts binary"), "pedidos")
    no_block = F.lit(None).cast("long").alias("block")

    asked_words = asked.where("shard is not null").select("block", "shard", "grams", "counts")
    vocabulary = materialize(asked_words.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_count_words, VOCABULARY), "palavras")
    total, distinct = vocabulary.agg(F.sum("total"), F.sum("known")).first()
    total, distinct = total or 0, distinct or 0

    asked_grams = asked.where("pair is not null")
    of_pairs = asked_grams.groupBy("pair").agg(F.sum("n").alias("n"), F.count_distinct("block").alias("blocks")).collect()  # 65,536 at most
    tasks = max(1, sum(r["n"] for r in of_pairs) // TASK_GRAMS)
    lots = max(1, -(-max((r["blocks"] for r in of_pairs), default=1) // LOT_BLOCKS))
    units = asked_grams.select("block", "pair", "grams", "counts").mapInArrow(_in_units({r["pair"] for r in of_pairs if r["n"] > split_rows}), UNITS)
    units = units.withColumn("lot", F.pmod(F.xxhash64("block"), F.lit(lots)))

    def in_order(rows: DataFrame, *keys: str) -> DataFrame:
        """Units as neighbours, each in one task; ``lot`` deals the blocks that ask for one among several."""
        return rows.repartition(tasks, *keys).sortWithinPartitions(*keys, F.col("block").asc_nulls_first())

    merged, counts_kind = units, "<u4"
    if lots > 1:
        merged = materialize(in_order(merged, "pair", "third", "lot").mapInArrow(_merge(counts_kind, False), MERGED), "somas")
        merged, counts_kind = merged.select(no_block, "pair", "third", "grams", "counts"), "<u8"
    model = materialize(in_order(merged, "pair", "third").mapInArrow(_merge(counts_kind, True), MERGED), "modelo")
    nodes = model.select((F.col("third") != WHOLE_PAIR).alias("split"), F.explode(F.arrays_zip("node", "zeros", "ones", "below")).alias("_n"))
    summed = nodes.groupBy("split", F.col("_n.node").alias("node")).agg(
        *(F.sum(f"_n.{c}").alias(c) for c in ("zeros", "ones", "below"))).toArrow()  # at most 256 * 256 nodes, and 256 for each split pair
    roots = Roots(*(summed.column(c).to_numpy() for c in ("node", "split", "zeros", "ones", "below")))

    each_lot = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lots - 1).cast("long"))).alias("lot")
    weighted = model.select(no_block, "pair", "third", "grams", "counts", each_lot)
    of_grams = in_order(weighted.unionByName(units), "pair", "third", "lot").mapInArrow(_answer(roots), ANSWERS)
    counted_words = vocabulary.select(no_block, "shard", "grams", "counts").unionByName(asked_words)
    of_words = counted_words.repartition(shards, "shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first()).mapInArrow(_answer_words, ANSWERS)
    kind = docs.schema[id_column].dataType
    out = T.StructType([T.StructField("id", kind), T.StructField("held_out", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in (
        "n_tokens", "n_known", "train_tokens")), *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score", "bits_per_byte"))])

    def finish(one: pa.Table, other: pa.Table) -> pa.Table:
        names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
        schema = pa.schema([one.schema.field("id"), one.schema.field("held_out"), *(
            pa.field(n, pa.int64() if k < 3 else pa.float64()) for k, n in enumerate(names))])
        return _score_block(one, other, total, distinct, schema)

    scored = dealt.drop("learn").groupBy("block").cogroup(of_grams.unionByName(of_words).groupBy("block")).applyInArrow(finish, out)
    return scored.withColumnRenamed("id", id_column)
