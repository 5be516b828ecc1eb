"""How filters share the work among them, in every order: decision diagrams of failure masks.

Each document gets a mask of the filters it fails. Per part the masks are counted, at most 32
counts for five filters, and become a decision diagram: one level per filter, a pass and
a fail branch at every node, equal sub-diagrams shared, and counts of documents, good and toxic ones at the
leaves. Swapping two adjacent levels rebuilds only the nodes of these two; a
sequence of such swaps visits every order of the filters. On the path on which all filters pass, the
node of a level weighs what the filters before it have let through, its fail branch what this filter
removes and its pass branch what is kept: the steps of that order are read off one path.

Texts are read once. Documents with equal texts are found by the SHA-256 of the whole text; the least
id per text is joined back on the digest, a plain join that Spark's skew join splits where one text
fills a third of the rows. Counts are combined before their shuffle.

Cases: null text counts as empty, a null part as the empty string; a null id has no label, repeats
nothing and makes nothing a repeat; rows that repeat an id are documents of their own and share its
label; several label rows of an id count as one that is good or toxic if any of them is; extra columns are
ignored; an empty table gives an empty result; a text is split a slice at a time.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cascata.llm.arrays import byte_texts
from cascata.session import materialize, ship_package

FILTERS = "ABCDE"
#: Thresholds of the filters, in the order A to C, and the characters D looks for.
LEAST_WORDS, LEAST_DISTINCT_PCT, MOST_CAPITALS_PCT, SYMBOLS = 50, 65, 5, b"#$%&*|"
SLICE_BYTES = 4 << 20
_FOLLOWING = bytes(range(0x80, 0xC0))
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_WHITE = b" \t\n\r\x0b\x0c"

Weight = tuple[int, int, int]


# ------------------------------------------------------------- masks of texts


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words of a text, split in slices of bounded size."""
    if len(text) <= SLICE_BYTES:
        words = text.split()
        return len(words), len(set(words))
    total, seen, begin = 0, set(), 0
    while begin < len(text):
        end = begin + SLICE_BYTES
        while end < len(text) and text[end] not in _WHITE:
            end += 1
        words = text[begin:end].split()
        total += len(words)
        seen.update(words)
        begin = end
    return total, len(seen)


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words, distinct = word_counts(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _FOLLOWING))
    return (
        (words < LEAST_WORDS)
        | (100 * distinct < LEAST_DISTINCT_PCT * words) << 1
        | (100 * capitals > MOST_CAPITALS_PCT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def masked(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, good, toxic) of every document."""

    def judged(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            texts = byte_texts(block.column(2))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), pa.array([text_mask(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], names=["doc_id", "part", "mask", "digest"])

    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text).alias("text"))
    rows = materialize(narrow.mapInArrow(judged, "doc_id long, part string, mask int, digest binary"), "julgados")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_last > _first")
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("int(quality <=> 1)")).alias("good"), F.max(F.expr("int(toxic <=> 1)")).alias("toxic"))
    repeats = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))
    return rows.join(first.select("digest", "_first"), "digest", "left").join(known, "doc_id", "left").select(
        "part", F.when(repeats, F.col("mask").bitwiseOR(F.lit(1 << 4))).otherwise(F.col("mask")).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


# ---------------------------------------------------------- decision diagrams


def _sum(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


@dataclass
class Diagram:
    """Counts by mask as a diagram whose levels can be swapped.

    ``levels[i]`` lists the (pass, fail) children of the nodes of level i, as positions in the next
    level, or among ``leaves`` at the last one. Level 0 has one node. Equal nodes of a level are one.
    """

    order: list[int]
    levels: list[list[tuple[int, int]]] = field(default_factory=list)
    leaves: list[Weight] = field(default_factory=list)
    weights: list[list[Weight]] = field(default_factory=list)

    @classmethod
    def of(cls, counts: dict[int, Weight], filters: int) -> Diagram:
        values = [counts.get(mask, (0, 0, 0)) for mask in range(1 << filters)]
        leaves = list(dict.fromkeys(values))
        below = [leaves.index(v) for v in values]
        made = cls(list(range(filters)), leaves=leaves)
        for level in reversed(range(filters)):  # the first filter is the lowest bit: pair masks that differ in the highest
            half = 1 << level
            pairs = [(below[m], below[m + half]) for m in range(half)]
            nodes = {p: i for i, p in enumerate(dict.fromkeys(pairs))}
            made.levels.insert(0, list(nodes))
            below = [nodes[p] for p in pairs]
        made.weights = [[] for _ in range(filters)]
        for level in reversed(range(filters)):
            made._weigh(level)
        return made

    def _weigh(self, level: int) -> None:
        below = self.leaves if level + 1 == len(self.levels) else self.weights[level + 1]
        self.weights[level] = [_sum(below[a], below[b]) for a, b in self.levels[level]]

    def swap(self, level: int) -> None:
        """Exchange a level with the next; nodes above keep their places, nodes below their children."""
        upper, lower = self.levels[level], self.levels[level + 1]
        nodes: dict[tuple[int, int], int] = {}
        place = lambda pair: nodes.setdefault(pair, len(nodes))
        self.levels[level] = [(place((lower[a][0], lower[b][0])), place((lower[a][1], lower[b][1]))) for a, b in upper]
        self.levels[level + 1] = list(nodes)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        self._weigh(level + 1)  # what a node of the upper level weighs is the same in either order

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Along the path on which all filters pass: the filter, what it removes, and what it lets through."""
        at = 0
        for level, filter_ in enumerate(self.order):
            below = self.leaves if level + 1 == len(self.levels) else self.weights[level + 1]
            passed, failed = self.levels[level][at]
            yield filter_, below[failed], below[passed]
            at = passed


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after another, so that every order of n is met once."""
    if n < 2:
        return
    down = True
    for inner in [*adjacent_swaps(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if inner is not None:
            yield inner + down
        down = not down


def audited(counts: dict[int, Weight], filters: str) -> list[tuple[str, int, int, int, int, int, int, int, int]]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every step of every order."""
    diagram, walked = Diagram.of(counts, len(filters)), []
    moves = adjacent_swaps(len(filters))
    while True:
        walked.append(("".join(filters[f] for f in diagram.order), list(diagram.steps())))
        move = next(moves, None)
        if move is None:
            break
        diagram.swap(move)
    failing, alone, shared = Counter(), Counter(), Counter()
    for _, steps in walked:
        failing[steps[0][0]] = steps[0][1][0]  # the first filter removes all that fail it
        alone[steps[-1][0]] = steps[-1][1][0]  # the last one what fails no other
        for f, gone, _ in steps:
            shared[f] += gone[0]
    return [
        (order, i + 1, kept[0], gone[0], failing[f] - gone[0], alone[f], gone[1], gone[2], shared[f])
        for order, steps in walked for i, (f, gone, kept) in enumerate(steps)
    ]


RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every step of every order of the filters, per part, from rows of ``masked``."""

    def all_orders(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for part, counted in zip(block.column(0).to_pylist(), block.column(1).to_pylist()):
                made = audited({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counted}, filters)
                order, step, *numbers = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(made), pa.string()), pa.array(order, pa.string()), pa.array(np.array(step, np.int32)),
                     *(pa.array(x, pa.int64()) for x in numbers)],
                    names=[c.split()[0] for c in RESULT.split(", ")])

    counted = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    per_part = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return per_part.mapInArrow(all_orders, RESULT)
