"""Nearest vectors by inner product over randomly rotated one-bit codes.

Every vector is stored with the signs of its randomly rotated direction, packed 64 to a word,
its length and the correction scalar <code, direction>. A turned query is rounded to a few bits, whose
planes lie packed as well, so that its product with a code is a sum of bit counts of words. Divided by the
scalar it estimates the product with the vector, with an error bound that holds with high
probability; what the rounding adds to it is known exactly. Vectors whose upper
bound reaches the k-th best score known so far are reranked on the original vectors.

Queries meet all vectors in blocks of bounded size; each block returns at most k rows a query.

Cases: null, empty, zero and non-finite vectors and null ids take no part, neither as query nor as
candidate; vectors of different lengths are not compared; rows that share the query's id are the
query's own; rows that repeat a query's id and vector ask once, different vectors under one id ask
and are ranked each on its own; a candidate id on several rows is as many candidates; ties go to the smaller id; fewer than k candidates are all returned; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cascata.llm.arrays import ragged, usable, vectors_of
from cascata.session import materialize, ship_package

QUERIES_AT_ONCE = 16
#: Bits that the numbers of a turned query are rounded to.
QUERY_BITS = 6


def rotation(dimension: int, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng([seed, dimension])
    return np.linalg.qr(rng.normal(size=(dimension, dimension)))[0]


def pack_words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words; the last word is filled up with zeros."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    words = -(-packed.shape[1] // 8)
    padded = np.zeros((len(bits), 8 * words), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words, lengths and correction scalars of the rows."""
    lengths = np.linalg.norm(vectors, axis=1)
    turned = (vectors / lengths[:, None]) @ rotation(vectors.shape[1])
    scalars = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return pack_words(turned > 0), lengths, scalars


class Codes:
    """A block of coded vectors that estimates its products with queries."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, scalars: np.ndarray, dimension: int, certainty: float) -> None:
        self.words, self.dimension = np.ascontiguousarray(words), dimension
        self.ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int32)
        self.scale = (lengths / scalars / np.sqrt(dimension)).astype(np.float32)
        spread = np.sqrt(np.maximum(0.0, 1 - scalars**2)) / scalars
        self.slack = (lengths * spread * certainty / np.sqrt(max(1, dimension - 1)) + 1e-5 * lengths).astype(np.float32)
        self.turn = rotation(dimension)

    def estimates(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated product of every query with every vector, and by how much the true one may lie above it."""
        turned = queries @ self.turn
        low = turned.min(axis=1, keepdims=True)
        step = np.maximum((turned.max(axis=1, keepdims=True) - low) / ((1 << QUERY_BITS) - 1), 1e-300)
        levels = np.rint((turned - low) / step).astype(np.int64)
        rounded = low + step * levels
        summed = np.zeros((len(queries), len(self.words)), np.int32)
        for bit in range(QUERY_BITS):
            plane = pack_words((levels >> bit & 1).astype(bool))
            for word in range(self.words.shape[1]):
                summed += np.bitwise_count(self.words[None, :, word] & plane[:, word, None]).astype(np.int32) << bit
        positive = low * self.ones[None, :] + step * summed  # what the set bits add up to; the others count against it
        products = (2 * positive - rounded.sum(axis=1, keepdims=True)).astype(np.float32) * self.scale
        missed = np.linalg.norm(turned - rounded, axis=1) * np.sqrt(self.dimension)
        above = np.linalg.norm(queries, axis=1)[:, None].astype(np.float32) * self.slack + missed[:, None].astype(np.float32) * self.scale
        return products, above


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, codes: Codes, k: int):
    """At most k best rows of a block for each query: positions of query and vector, and the exact products."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rough, norms = vectors.astype(np.float32), np.linalg.norm(vectors, axis=1).astype(np.float32)
    for number, query in enumerate(queries):
        if number % QUERIES_AT_ONCE == 0:
            estimates, above = codes.estimates(queries[number : number + QUERIES_AT_ONCE])
        estimate = estimates[number % QUERIES_AT_ONCE]
        length = np.linalg.norm(query)
        own = np.flatnonzero(ids == query_ids[number])
        estimate[own] = -np.inf
        mask = np.ones(len(ids), bool)
        if len(ids) > 2 * k:
            sure = np.argpartition(estimate, -k)[-k:]
            products = rough[sure] @ query.astype(np.float32)
            products[np.isin(sure, own)] = -np.inf
            mask = estimate + above[number % QUERIES_AT_ONCE] >= products.min()
            mask[sure] = True
        mask[own] = False
        chosen = np.flatnonzero(mask)
        if len(chosen) > 2 * k:  # in single precision first; what cannot be told apart there is kept
            products = rough[chosen] @ query.astype(np.float32)
            margin = np.float32(1e-5 * length) * norms[chosen]
            least = np.partition(products - margin, -k)[-k]
            chosen = chosen[products + margin >= least]
        exact = (vectors[chosen] * query).sum(axis=1)
        best = np.lexsort((ids[chosen], -exact))[:k]
        found.append((np.full(len(best), number), chosen[best], exact[best]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 3


def index(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """One row per usable vector: id, size, vector, code words, length and correction scalar."""
    ship_package(vectors.sparkSession)
    kind = T.FloatType() if vectors.schema[vector_column].dataType.elementType == T.FloatType() else T.DoubleType()
    single = kind == T.FloatType()

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            values, starts, lengths = vectors_of(block.column(1))
            good = usable(values, starts, lengths)
            for size in np.unique(lengths[good]).tolist():
                chosen = np.flatnonzero(good & (lengths == size))
                rows = values[ragged(starts[chosen], lengths[chosen])].reshape(-1, size)
                words, norms, scalars = encode(rows)
                offsets = np.arange(len(chosen) + 1, dtype=np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(offsets * x.shape[1]), pa.array(x.ravel())) for x in (
                    rows.astype(np.float32 if single else np.float64), words.view(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [block.column(0).take(pa.array(chosen)), pa.array(np.full(len(chosen), size, np.int32)), *lists, pa.array(norms), pa.array(scalars)],
                    names=["id", "size", "vector", "words", "norm", "scalar"])

    given = F.col(vector_column) if single else F.col(vector_column).cast("array<double>")
    schema = f"id long, size int, vector array<{kind.simpleString()}>, words array<long>, norm double, scalar double"
    known = vectors.where(F.col(id_column).isNotNull())
    return known.select(F.col(id_column).cast("long").alias("id"), given.alias("vector")).mapInArrow(run, schema)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    certainty: float = 1.9,
    block_rows: int = 16384,
    block_queries: int = 2048,
) -> DataFrame:
    """(query_id, rank, id, score) of the k nearest found of each query among all other rows.

    ``is_query`` is a condition on the id column named ``id``. A larger ``certainty`` widens the
    error bound: fewer true neighbours are missed and more vectors are reranked.
    """
    coded = materialize(index(vectors, id_column, vector_column), "codigos")
    asked = coded.where(is_query).select("id", "size", "vector").dropDuplicates(["id", "vector"]).withColumn("asked", F.xxhash64("vector"))
    n, m = coded.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-m // block_queries))

    def dealt(rows: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return rows.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    left = dealt(asked, "qb", query_blocks, "rb", row_blocks)
    right = dealt(coded, "rb", row_blocks, "qb", query_blocks)

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = pa.schema([("query_id", pa.int64()), ("asked", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
        if not queries.num_rows or not rows.num_rows:
            return out.empty_table()
        size = rows.column("size")[0].as_py()
        asked_rows, held = (vectors_of(t.column("vector"))[0].reshape(-1, size) for t in (queries, rows))
        words = rows.column("words").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, -1)
        codes = Codes(words, rows.column("norm").to_numpy(), rows.column("scalar").to_numpy(), size, certainty)
        query_ids, ids = queries.column("id").to_numpy(), rows.column("id").to_numpy()
        q, r, score = search_block(asked_rows, query_ids, held, ids, codes, k)
        return pa.table([pa.array(query_ids[q]), pa.array(queries.column("asked").to_numpy()[q]), pa.array(ids[r]), pa.array(score)], schema=out)

    keys = ["size", "qb", "rb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, asked long, id long, score double")
    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias(id_column), "score")
