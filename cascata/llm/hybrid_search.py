"""Ranked lexical search: summed accumulators of short lists as one iterator among long ones.

The index keeps documents in blocks of bounded size. A block has one row per term, its
documents as gaps and its frequencies, both in as few bytes as they need, and one row with the ids and
lengths of its documents, which stand in the order of their ids. Queries are cut into
chunks; each chunk meets each block that holds one of its terms, in a task of bounded size.

There, the short lists of a query are taken term at a time: their scores are summed into accumulators
by document, and the sorted accumulators become one more iterator, bounded by their largest sum.
Then it goes document at a time, in windows of documents: lists whose bounds together
stay below the least score that can still enter are not walked; documents that the others
name are bounded, and only those that may enter are looked for in the lists that were passed over, by
skipping to them. A block returns its best k per query; Spark ranks these.

All numbers of a score but the weight's logarithm are whole. Counts of documents and terms (N, L, df) come
from the whole index. Every comparison with the least entering score is strict, so that no tie is lost.

Cases: a null text and one without terms have no postings and are never found; a null document id
comes last among equals; rows that repeat an id are documents of their own; rows of queries that share an id
are one query with the terms of all, once each; a query without terms, or with unknown ones only, has no result; extra
columns are ignored; empty tables give empty results; very long texts are taken a piece at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cascata.llm.arrays import byte_texts
from cascata.session import materialize, ship_package

#: A block's texts hold about so many bytes, and it has at most so many documents.
BLOCK_BYTES, BLOCK_DOCS = 16 << 20, 1 << 16
#: Queries of a chunk on average.
CHUNK_QUERIES = 1024
#: Lists are short while together they name at most this share of a block's documents (or few at all).
SHORT_SHARE, SHORT_LEAST = 0.25, 256
#: Documents of a window.
WINDOW_DOCS = 2048
#: What the parts of a score are scaled by, and the share of length in percent.
SCALE, SATURATION, LENGTH_PCT = 1_000_000_000, 20, 50

_PIECE, _PENDING = 1 << 20, 1 << 22
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PATTERN = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
INDEX = "block long, term string, n long, docs binary, tfs binary, ids array<long>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --------------------------------------------------------------------- index


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, about a million bytes of it at a time."""
    plain, begin = text.translate(_TERM), 0
    while begin < len(plain):
        end = begin + _PIECE
        if end < len(plain):
            end = plain.find(b" ", end)
            end = len(plain) if end < 0 else end
        yield plain[begin:end].split()
        begin = end


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count[order], first) if len(key) else count


def _packed(values: np.ndarray, largest: int) -> bytes:
    return values.astype("u1" if largest < 1 << 8 else "<u2" if largest < 1 << 16 else "<u4").tobytes()


def _unpacked(stored: bytes, n: int) -> np.ndarray:
    return np.frombuffer(stored, f"<u{len(stored) // n}").astype(np.int64)


def _block_rows(block: int, ids: list[int | None], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The rows of one block."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    vocabulary: defaultdict[bytes, int] = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    keys, counts, pending, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0, np.zeros(len(ids), np.int64)
    for at, i in enumerate(order):
        for words in _pieces(texts[i]):
            numbers = np.fromiter(map(vocabulary.__getitem__, words), np.uint64, len(words))
            keys.append(numbers << np.uint64(32) | np.uint64(at))
            counts.append(np.ones(len(words), np.int64))
            lengths[at] += len(words)
            pending += len(words)
            if pending > _PENDING:
                key, count = _counted(keys, counts)
                keys, counts, pending = [key], [count], 0
    key, tfs = _counted(keys, counts)
    docs = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begins = np.flatnonzero(np.r_[True, np.diff(key >> np.uint64(32)) > 0]) if len(key) else np.zeros(0, np.int64)
    ends = np.r_[begins[1:], len(key)]
    gaps = np.diff(docs, prepend=0)
    gaps[begins] = docs[begins]
    largest_gap = np.maximum.reduceat(gaps, begins) if len(key) else begins
    largest_tf = np.maximum.reduceat(tfs, begins) if len(key) else begins
    terms = list(vocabulary)
    named = pa.array([[ids[i] for i in order]], pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([None], pa.string()), pa.array([int(lengths.sum())], pa.int64()),
         pa.array([None], pa.binary()), pa.array([lengths.astype("<u4").tobytes()], pa.binary()), named], names=_NAMES)
    for a in range(0, len(terms), 8192):
        b = min(a + 8192, len(terms))
        spans = list(zip(begins[a:b].tolist(), ends[a:b].tolist(), largest_gap[a:b].tolist(), largest_tf[a:b].tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(b - a, block, np.int64)), pa.array(terms[a:b], pa.binary()).cast(pa.string()),
             pa.array((ends - begins)[a:b], pa.int64()), pa.array([_packed(gaps[x:y], g) for x, y, g, _ in spans], pa.binary()),
             pa.array([_packed(tfs[x:y], t) for x, y, _, t in spans], pa.binary()), pa.nulls(b - a, pa.list_(pa.int64()))], names=_NAMES)


_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: a row per block and term, and one without a term per block, with its documents."""

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        ids: list[int | None] = []
        texts: list[bytes] = []
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                if ids and (size + len(t) > BLOCK_BYTES or len(ids) == BLOCK_DOCS):
                    yield from _block_rows(block, ids, texts)
                    block, size, ids, texts = block + 1, 0, [], []
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield from _block_rows(block, ids, texts)

    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return materialize(narrow.mapInArrow(blocks_of, INDEX), "indice")


@dataclass(frozen=True)
class Corpus:
    """N and L: documents with a term, and all terms."""

    documents: int
    terms: int


def corpus_of(index: DataFrame) -> Corpus:
    blocks = index.where("term is null").select("tfs", "n").mapInArrow(_totals, "documents long, terms long")
    found = blocks.agg(F.sum("documents").alias("d"), F.sum("terms").alias("t")).first()
    return Corpus(found["d"] or 0, found["t"] or 0)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        filled = [int(np.count_nonzero(np.frombuffer(x, "<u4"))) for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), batch.column(1).cast(pa.int64())], names=["documents", "terms"])


# -------------------------------------------------------------------- search


@dataclass
class Postings:
    """A list of documents in ascending order with what each would add to a score."""

    docs: np.ndarray
    scores: np.ndarray
    best: int

    @classmethod
    def of(cls, docs: np.ndarray, scores: np.ndarray) -> Postings:
        return cls(docs, scores, int(scores.max()) if len(scores) else 0)

    def added(self, docs: np.ndarray) -> np.ndarray:
        """What the list adds to each of some documents; it is skipped through, not walked."""
        at = np.searchsorted(self.docs, docs)
        at[at == len(self.docs)] = 0
        return np.where(self.docs[at] == docs, self.scores[at], 0)


def accumulated(lists: list[Postings]) -> Postings:
    """Lists taken term at a time: their summed scores by document, as one list."""
    if len(lists) == 1:
        return lists[0]
    docs, scores = np.concatenate([p.docs for p in lists]), np.concatenate([p.scores for p in lists])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    return Postings.of(docs[first], np.add.reduceat(scores[order], first))


def best_of_block(lists: list[Postings], documents: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k documents of a block with the largest scores above 0, equal scores by position; and these scores."""
    lists = sorted((p for p in lists if len(p.docs)), key=lambda p: len(p.docs))
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    together = np.cumsum([len(p.docs) for p in lists])
    short = max(1, int(np.searchsorted(together, max(SHORT_LEAST, SHORT_SHARE * documents), side="right")))
    iterators = [accumulated(lists[:short])] + sorted(lists[short:], key=lambda p: -p.best)
    # with the accumulators first: bounds[i] is what the lists from i on can add to a document
    bounds = np.r_[np.cumsum([p.best for p in iterators][::-1])[::-1], 0]
    floor = 1  # the least score that can still enter
    sums = iterators[0]
    if len(sums.docs) > k:  # the k largest sums, made whole, give a first floor
        probe = np.sort(sums.docs[np.argpartition(-sums.scores, k - 1)[:k]])
        floor = max(floor, int(sum(p.added(probe) for p in iterators).min()))
    top_docs, top_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for begin in range(0, documents, WINDOW_DOCS):
        # lists from ``walked`` on cannot bring a document in by themselves
        walked = max(1, int(np.count_nonzero(bounds[:-1] >= floor)))
        spans = [np.searchsorted(p.docs, (begin, begin + WINDOW_DOCS)) for p in iterators[:walked]]
        if walked == 1:
            a, b = spans[0]
            docs, scores = sums.docs[a:b], sums.scores[a:b]
        else:
            summed, named = np.zeros(WINDOW_DOCS, np.int64), np.zeros(WINDOW_DOCS, bool)
            for p, (a, b) in zip(iterators, spans):
                at = p.docs[a:b] - begin
                summed[at] += p.scores[a:b]
                named[at] = True
            at = np.flatnonzero(named)
            docs, scores = at + begin, summed[at]
        for i in range(walked, len(iterators) + 1):
            may = scores + bounds[i] >= floor
            docs, scores = docs[may], scores[may]
            if not len(docs) or i == len(iterators):
                break
            scores = scores + iterators[i].added(docs)
        if len(docs):
            top_docs, top_scores = np.r_[top_docs, docs], np.r_[top_scores, scores]
            if len(top_docs) > k:
                order = np.lexsort((top_docs, -top_scores))[:k]
                top_docs, top_scores = top_docs[order], top_scores[order]
                floor = max(floor, int(top_scores[-1]))
    return top_docs, top_scores


def query_terms(queries: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term) of every distinct term of every query."""
    plain = F.translate(F.col(text), UPPER, LOWER)
    return queries.select(F.col(id).cast("long").alias("item_id"), F.explode(F.regexp_extract_all(plain, F.lit(PATTERN), F.lit(1))).alias("term")).distinct()


RANKED = "item_id long, doc_id long, score long"


def rank(index: DataFrame, queries: DataFrame, k: int, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each query's k best documents of an index."""
    corpus = corpus_of(index)
    asked = query_terms(queries, id, text)
    chunks = max(1, -(-queries.count() // CHUNK_QUERIES))
    chunked = asked.withColumn("chunk", F.pmod(F.xxhash64("item_id"), F.lit(chunks)))
    lists = index.where("term is not null")
    df = lists.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    ratio = F.lit(2 * corpus.documents + 2).cast("double") / (2 * F.col("df") + 1)
    weighed = materialize(
        chunked.groupBy("chunk", "term").agg(F.collect_list(F.struct("item_id")).alias("items")).join(df, "term")
        .withColumn("weight", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long")).drop("df"), "pesos")
    # narrow, so that Spark can broadcast it where its size allows: which chunks ask for a term
    asking = materialize(weighed.groupBy("term").agg(F.collect_list("chunk").alias("chunks")), "perguntas")
    met = lists.join(asking, "term").withColumn("chunk", F.explode("chunks")).drop("chunks", "ids")
    named = met.join(weighed, ["chunk", "term"])
    each_chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("of_chunk")
    blocks = index.where("term is null").select(F.col("block").alias("of_block"), F.col("ids").alias("doc_ids"), F.col("tfs").alias("lengths"), each_chunk)

    def search(lists: pa.Table, documents: pa.Table) -> pa.Table:
        if not lists.num_rows:
            return _ranked([], [], [])
        ids = documents.column("doc_ids").combine_chunks().flatten()
        lengths = np.frombuffer(documents.column("lengths")[0].as_py(), "<u4").astype(np.int64)
        slow = _length_part(lengths, corpus)
        postings, of_item = [], defaultdict(list)
        columns = [lists.column(c).to_pylist() for c in ("n", "docs", "tfs", "weight", "items")]
        for at, (n, gaps, tfs, weight, items) in enumerate(zip(*columns)):
            docs, tf = np.cumsum(_unpacked(gaps, n)), _unpacked(tfs, n)
            postings.append(Postings.of(docs, weight * (SCALE * tf // (1000 * tf + slow[docs]))))
            for item in items:
                of_item[item["item_id"]].append(at)
        found = [(item, *best_of_block([postings[at] for at in members], len(lengths), k)) for item, members in of_item.items()]
        return _ranked([x for item, docs, _ in found for x in [item] * len(docs)],
                       ids.take(pa.array(np.concatenate([docs for _, docs, _ in found]))), np.concatenate([s for _, _, s in found]))

    best = named.groupBy("block", "chunk").cogroup(blocks.groupBy("of_block", "of_chunk")).applyInArrow(search, RANKED)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _length_part(lengths: np.ndarray, corpus: Corpus) -> np.ndarray:
    """What a document's length adds to a divisor; whole numbers of any size while they are divided."""
    share = LENGTH_PCT * lengths
    if len(lengths) and int(share.max()) * corpus.documents >= 1 << 62:
        share = share.astype(object)
    return SATURATION * (100 - LENGTH_PCT + (share * corpus.documents // max(1, corpus.terms)).astype(np.int64))


def _ranked(items: list, docs: pa.Array | list, scores: np.ndarray | list) -> pa.Table:
    return pa.Table.from_arrays([pa.array(items, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])
