"""Byte-level BPE by a pair occurrence index.

A text is cut into pieces by the vocabulary's pattern, the distinct pieces that a worker has
not met yet are laid out in one array, and an index maps every adjacent pair to all positions
where it occurs. The ranks that are active are applied in ascending order: all occurrences of
the pair are merged at once, and the lists of the pairs on either side are updated.

Cases: null text counts as empty and has no ids; empty text has no ids; repeated rows give
repeated results; a text of any length is encoded whole (it is laid out in parts cut only
where a piece starts in any case); extra columns are carried along unchanged.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from cascata.llm.arrays import HashIndex, byte_lengths, byte_texts, ragged, slices
from cascata.session import ship_package

# Code points with the White_Space property.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters that follow an apostrophe in a piece of their own.
SHORT_ENDS = {"s", "t", "m", "d", "re", "ve", "ll"}

END, LETTER, NUMBER, OTHER, SPACE = range(5)
PART_CHARS = 1 << 20
Merge = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def _classes() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            kinds[point] = LETTER
        elif kind == "N":
            kinds[point] = NUMBER
    kinds[WHITE_SPACE] = SPACE
    return kinds


class Vocabulary:
    """Byte-level vocabulary: bytes of each id, merges by pair, special strings."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model = given["model"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        size = max([*model["vocab"].values(), *(t["id"] for t in given["added_tokens"])]) + 1
        self.pieces: list[bytes] = [b""] * size
        for token, i in model["vocab"].items():
            self.pieces[i] = bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        for text, i in self.special.items():
            self.pieces[i] = text.encode()
        ids = {piece: i for i, piece in enumerate(self.pieces)}
        self.byte_ids = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        vocab = model["vocab"]
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.uint64) for k in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.pair_keys = (left << np.uint64(32)) | (right + np.uint64(1))


def cut_pieces(points: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of texts that lie one after another, each closed by an END mark."""
    before = np.empty_like(kinds)
    before[0], before[1:] = END, kinds[:-1]
    blank = points == 0x20
    blank &= kinds == SPACE
    after_blank = np.zeros(len(kinds), bool)
    after_blank[1:] = blank[:-1]
    word = (kinds != END) & (kinds != SPACE)
    start = (kinds != before) & (kinds != END)
    start &= ~(word & after_blank)  # one blank belongs to the word behind it
    start[:-1] |= (kinds[:-1] == SPACE) & word[1:]  # of white space, the last character stands apart
    for i in np.flatnonzero((points == 0x27) & start).tolist():
        if kinds[i] == OTHER and kinds[i + 1] == LETTER:
            one, two = chr(points[i + 1]), chr(points[i + 2]) if kinds[i + 2] == LETTER else ""
            taken = 1 if one in SHORT_ENDS else 2 if two and one + two in SHORT_ENDS else 0
            if taken:
                start[i + 1] = False
                if kinds[i + 1 + taken] == LETTER:
                    start[i + 1 + taken] = True
    marks = np.flatnonzero(start | (kinds == END))
    begins = kinds[marks] != END
    return marks[:-1][begins[:-1]], marks[1:][begins[:-1]]


class Encoder:
    """Encodes lists of texts; remembers the pieces it has met, up to ``most_pieces``."""

    def __init__(self, vocabulary: Vocabulary, most_pieces: int = 600_000, merge: Merge | None = None) -> None:
        """``merge`` gives the ids of distinct pieces and how many each has; by default the pair index does."""
        self.vocabulary, self.most_pieces = vocabulary, most_pieces
        self.merge = merge or self.merge_pieces
        self.kinds = _classes()
        self.pairs = HashIndex(17)
        self.pairs.add(vocabulary.pair_keys)
        self.powers = self.inverse = np.ones(1, np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.known = HashIndex(16)
        self.ids, self.chars = np.empty(0, np.int32), np.empty(0, np.uint32)
        self.id_ends, self.char_ends = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.find((left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) + np.uint64(1)))

    def merge_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, one after another, and how many each has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        symbols = self.vocabulary.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum(lengths)
        after[ends - 1] = -1
        before[(ends - lengths)] = -1
        where: dict[int, list[np.ndarray]] = {}

        def enter(places: np.ndarray) -> None:
            places = places[after[places] >= 0]
            ranks = self._ranks(symbols[places], symbols[after[places]])
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not places.size:
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, part in zip(ranks[np.r_[0, cuts]].tolist(), np.split(places, cuts)):
                if rank in where:
                    where[rank].append(part)
                else:
                    where[rank] = [part]
                    heapq.heappush(active, rank)

        active: list[int] = []
        enter(np.arange(n))
        keys, merged = self.vocabulary.pair_keys, self.vocabulary.merged
        while active:
            rank = heapq.heappop(active)
            parts = where.pop(rank)
            places = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            left, right = int(keys[rank] >> np.uint64(32)), int(keys[rank] & np.uint64(0xFFFFFFFF)) - 1
            places = places[(symbols[places] == left) & (after[places] >= 0)]
            places = places[symbols[after[places]] == right]
            if not places.size:
                continue
            if left == right and len(places) > 1:  # in a run of one symbol, every second place
                places = np.sort(places)
                chained = np.r_[False, after[places[:-1]] == places[1:]]
                number = np.arange(len(places))
                run = np.maximum.accumulate(np.where(chained, 0, number))
                places = places[(number - run) % 2 == 0]
            gone = after[places]
            symbols[places], symbols[gone] = merged[rank], -1
            follower = after[gone]
            after[places] = follower
            inner = follower >= 0
            before[follower[inner]] = places[inner]
            left_of = before[places]
            enter(np.unique(np.concatenate([left_of[left_of >= 0], places])))
        alive = symbols >= 0
        counts = np.add.reduceat(alive, ends - lengths, dtype=np.int64) if n else np.zeros(0, np.int64)
        return symbols[alive], counts

    def _rows(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Row of each piece among the known ones; new pieces are merged and become known."""
        if len(points) >= len(self.powers):
            size = max(2 * len(self.powers), len(points) + 1, PART_CHARS + 4096)
            base = 0x9E3779B97F4A7C15 | 1
            for name, factor in (("powers", base), ("inverse", pow(base, -1, 1 << 64))):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.powers[: len(points)], out=sums[1:])
        keys = (sums[ends] - sums[starts]) * self.inverse[starts]
        rows = self.known.find(keys)
        missing = np.flatnonzero(rows < 0)
        if missing.size:
            fresh, first = np.unique(keys[missing], return_index=True)
            first = missing[first]
            if self.known.size and self.known.size + len(fresh) > self.most_pieces:
                self._forget()
                return self._rows(points, starts, ends)
            chars = points[ragged(starts[first], ends[first] - starts[first])]
            text = chars.astype("<u4").tobytes()
            cuts = np.r_[0, np.cumsum(ends[first] - starts[first])].tolist()
            pieces = [text[4 * a : 4 * b].decode("utf-32-le").encode() for a, b in zip(cuts, cuts[1:])]
            ids, counts = self.merge(pieces)
            self.known.add(fresh)
            self.ids = np.concatenate([self.ids, ids])
            self.id_ends = np.concatenate([self.id_ends, self.id_ends[-1] + np.cumsum(counts)])
            self.chars = np.concatenate([self.chars, chars])
            self.char_ends = np.concatenate([self.char_ends, self.char_ends[-1] + np.cumsum(ends[first] - starts[first])])
            rows[missing] = self.known.find(keys[missing])
        return rows

    def _encode_part(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer(("\0".join(texts) + "\0\0\0").encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        kinds = self.kinds[points]
        kinds[ends] = kinds[-2:] = END
        starts, stops = cut_pieces(points, kinds)
        rows = self._rows(points, starts, stops)
        same = self.char_ends[rows + 1] - self.char_ends[rows] == stops - starts
        if not same.all() or not np.array_equal(self.chars[ragged(self.char_ends[rows], stops - starts)], points[ragged(starts, stops - starts)]):
            return self._encode_plainly(points, starts, stops, ends)
        counts = self.id_ends[rows + 1] - self.id_ends[rows]
        ids = self.ids[ragged(self.id_ends[rows], counts)]
        upto = np.r_[0, np.cumsum(counts)]
        lengths = np.diff(np.r_[0, upto[np.searchsorted(starts, ends)]])
        return ids, lengths

    def _encode_plainly(self, points: np.ndarray, starts: np.ndarray, stops: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same without piece keys, for the rare part in which two pieces share one key."""
        words = [points[a:b].tobytes().decode("utf-32-le").encode() for a, b in zip(starts.tolist(), stops.tolist())]
        distinct = list(dict.fromkeys(words))
        flat, counts = self.merge(distinct)
        of = dict(zip(distinct, np.split(flat, np.cumsum(counts)[:-1])))
        each = [of[w] for w in words]
        upto = np.r_[0, np.cumsum([len(x) for x in each])]
        return np.concatenate([*each, np.empty(0, np.int32)]).astype(np.int32), np.diff(np.r_[0, upto[np.searchsorted(starts, ends)]])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        parts: list[str] = []
        owners: list[int] = []
        fixed: dict[int, int] = {}
        for i, text in enumerate(texts):
            pending = [(text, None)]
            for mark, special in self.vocabulary.special.items():
                if mark in text:
                    split = []
                    for piece, own in pending:
                        if own is not None:
                            split.append((piece, own))
                            continue
                        for k, rest in enumerate(piece.split(mark)):
                            split += [("", special)] * (k > 0) + [(rest, None)]
                    pending = split
            for piece, own in pending:
                if own is not None:
                    fixed[len(parts)] = own
                    parts.append("")
                    owners.append(i)
                elif piece:
                    for sure in safe_parts(piece):
                        parts.append(sure)
                        owners.append(i)
        chunks, lengths = [np.empty(0, np.int32)], np.zeros(len(parts), np.int64)
        for a, b in slices([len(p) + 1 for p in parts], PART_CHARS):
            ids, sizes = self._encode_part(parts[a:b])
            for k in sorted(k for k in fixed if a <= k < b) if fixed else ():
                at = int(sizes[: k - a].sum())
                ids, sizes[k - a] = np.insert(ids, at, fixed[k]), 1
            chunks.append(ids)
            lengths[a:b] = sizes
        owned = np.bincount(np.array(owners, np.int64), weights=lengths, minlength=len(texts)).astype(np.int64)
        return np.concatenate(chunks), owned


def safe_parts(text: str) -> Iterator[str]:
    """Cut a very long text before single blanks between other characters: a piece starts there in any case."""
    begin = 0
    while len(text) - begin > PART_CHARS:
        at = begin + PART_CHARS
        while 0 < (at := text.find(" ", at)) < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at += 1
        if not 0 < at < len(text) - 1:
            break
        yield text[begin:at]
        begin = at
    yield text[begin:]


_encoders: dict[str, Encoder] = {}


def encoder_of(vocabulary: Vocabulary, name: str, merge: Callable[[], Merge] | None = None) -> Encoder:
    """One encoder per worker process and vocabulary, so that later tasks find known pieces."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(vocabulary, merge=merge and merge())
    return _encoders[name]


def encode_blocks(blocks: Iterator[pa.RecordBatch], encoder: Encoder, column: str, ids: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Add a list column of ids to Arrow blocks, a few MB of text at a time."""
    for block in blocks:
        texts = block.column(block.schema.get_field_index(column))
        for a, b in slices(byte_lengths(texts), most):
            flat, lengths = encoder.encode([t.decode("utf-8", "replace") for t in byte_texts(texts.slice(a, b - a))])
            offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            part = block.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, ids])


def decode_blocks(blocks: Iterator[pa.RecordBatch], pieces: list[bytes], ids: str, column: str) -> Iterator[pa.RecordBatch]:
    """Add the text that a list column of ids stands for; bytes that are no UTF-8 become the replacement character."""
    for block in blocks:
        lists = block.column(block.schema.get_field_index(ids))
        flat = np.asarray(lists.flatten())
        ends = np.asarray(lists.offsets).tolist()
        base = ends[0]
        texts = [b"".join(map(pieces.__getitem__, flat[a - base : b - base].tolist())).decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays([*block.columns, pa.array(texts, pa.string())], names=[*block.schema.names, column])


def share(docs: DataFrame, path: str):
    """The vocabulary as a broadcast; the file bounds its size."""
    ship_package(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast(Vocabulary(path))


def encode(docs: DataFrame, path: str, column: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each text as ``array<int>``; an existing column of that name is replaced."""
    shared = share(docs, path)
    kept = docs.drop(ids)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encode_blocks(blocks, encoder_of(shared.value, path), column, ids)

    return kept.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "token_ids", column: str = "decoded") -> DataFrame:
    """``rows`` with the text of each id list; an existing column of that name is replaced."""
    shared = share(rows, path)
    kept = rows.drop(column)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T.StringType())])
    return kept.mapInArrow(lambda blocks: decode_blocks(blocks, shared.value.pieces, ids, column), schema)
