"""Indexed vector search: vectors stored by cell, and only the cells that can matter are read.

A cell holds the vectors nearest to its pivot. Angles obey the triangle inequality, so no
vector of a cell is closer to a query than ``angle(query, pivot) - radius``. A cell whose
bound exceeds the ``k``-th angle already found cannot change the answer: the result is the
exact one, read from a part of the folders.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cascata.functions import vectors
from cascata.operators.search import check_top_k, current_vectors, describe_hits, nearest
from cascata.session import materialize, ship_package

PLACED = "conteudo_id bigint, vetor array<float>, angulo double, celula int"
SLACK = 1e-6
#: Least and largest number of cells.
CELLS = (16, 4096)


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def choose_pivots(stored: DataFrame, cells: int) -> np.ndarray:
    """Pivots drawn by a hash of the id, the same on every run; at most ``cells`` rows reach the driver.

    Any pivots give exact answers, better spread ones only prune more.
    """
    drawn = stored.orderBy(F.xxhash64("conteudo_id"), "conteudo_id").limit(cells).select("vetor").collect()
    found = np.asarray([row["vetor"] for row in drawn], dtype=np.float64)
    length = np.linalg.norm(found, axis=1)
    return found[length > 0] / length[length > 0, None]


def build_index(store: DataFrame, model: str, dimension: int, path: str, cells: int | None = None) -> None:
    """Write the vectors under ``vetores/celula=`` and one row per cell under ``celulas``.

    Unless ``cells`` is given, there are as many as the root of the number of vectors, so that
    cells stay small as the store grows, within ``CELLS`` (the pivots travel with each task).
    """
    ship_package(store.sparkSession)
    stored = current_vectors(store, model, dimension)
    cells = cells or min(max(math.isqrt(stored.count()), CELLS[0]), CELLS[1])
    pivots = choose_pivots(stored, cells)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            if block.num_rows == 0:
                continue
            found = vectors.matrix(block.column("vetor"), dimension)
            length = np.linalg.norm(found, axis=1)
            usable = length > 0
            angles = _angles(found[usable] / length[usable, None], pivots)
            cell = angles.argmin(axis=1)
            kept = block.filter(pa.array(usable))
            yield pa.RecordBatch.from_arrays(
                [kept.column("conteudo_id"), kept.column("vetor").cast(pa.list_(pa.float32())),
                 pa.array(angles[np.arange(len(cell)), cell]), pa.array(cell.astype(np.int32))],
                names=["conteudo_id", "vetor", "angulo", "celula"],
            )

    spark = store.sparkSession
    placed = stored.mapInArrow(place, PLACED)
    dealt = placed.repartition("celula", F.pmod(F.xxhash64("conteudo_id"), F.lit(4)))  # four files to a cell at most
    dealt.write.partitionBy("celula").parquet(f"{path}/vetores")
    sizes = spark.read.schema(PLACED).parquet(f"{path}/vetores").groupBy("celula").agg(
        F.max("angulo").alias("raio"), F.count(F.lit(1)).alias("total")
    )
    pivot_rows = spark.createDataFrame(
        [(i, [float(x) for x in p]) for i, p in enumerate(pivots)], "celula int, pivo array<double>"
    )
    sizes.join(pivot_rows, "celula").coalesce(1).write.parquet(f"{path}/celulas")


def indexed_nearest(spark: SparkSession, path: str, query: list[float], k: int) -> DataFrame:
    """The exact ``k`` nearest vectors of one query, from the cells that can hold them."""
    k = check_top_k(k)
    cells = spark.read.parquet(f"{path}/celulas").collect()
    wanted = np.asarray(query, dtype=np.float64)
    wanted = wanted / np.linalg.norm(wanted)
    away = _angles(np.asarray([c["pivo"] for c in cells]), wanted[None, :])[:, 0]
    bound = away - np.asarray([c["raio"] for c in cells])
    stored = spark.read.schema(PLACED).parquet(f"{path}/vetores")

    first, seen = [], 0
    for i in np.argsort(away):
        first.append(int(i))
        seen += cells[i]["total"]
        if seen >= k:
            break

    def of(chosen: list[int]) -> DataFrame:
        numbers = [cells[i]["celula"] for i in chosen]
        return nearest(stored.where(F.col("celula").isin(numbers)), {"consulta": list(query)}, k)

    found = materialize(of(first), "vizinhos")
    worst = found.agg(F.min("proximidade")).first()[0]
    limit = float(np.arccos(np.clip(worst, -1.0, 1.0))) + SLACK
    rest = [i for i in range(len(cells)) if i not in first and bound[i] <= limit]
    if not rest:
        return found
    both = found.drop("posicao").unionByName(of(rest).drop("posicao"))
    order = Window.partitionBy("consulta").orderBy(F.desc("proximidade"), "conteudo_id")
    return both.withColumn("posicao", F.row_number().over(order)).where(F.col("posicao") <= k)


BATCH_HITS = "consulta string, conteudo_id bigint, proximidade double"
#: Queries that meet a part of a cell in one task, about.
QUERIES_AT_ONCE = 8192


def _cells_of(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number, pivot, radius and size of every cell, ``CELLS[1]`` at most."""
    rows = spark.read.parquet(f"{path}/celulas").collect()
    return (np.array([r["celula"] for r in rows], np.int32), np.array([r["pivo"] for r in rows], np.float64),
            np.array([r["raio"] for r in rows], np.float64), np.array([r["total"] for r in rows], np.int64))


def _asking(queries: DataFrame, cells, choose, dimension: int) -> DataFrame:
    """Each query beside every cell that ``choose(angles, limit)`` picks for it: rows (consulta, vetor, celula)."""
    numbers, pivots, _, _ = cells

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            if block.num_rows == 0:
                continue
            found = vectors.matrix(block.column("vetor"), dimension)
            angles = _angles(found / np.linalg.norm(found, axis=1, keepdims=True), pivots)
            row, cell = np.nonzero(choose(angles, block.column("limite").to_numpy(zero_copy_only=False)))
            picked = block.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([picked.column("consulta"), picked.column("vetor"), pa.array(numbers[cell], pa.int32())],
                                             names=["consulta", "vetor", "celula"])

    return queries.mapInArrow(ask, "consulta string, vetor array<double>, celula int")


def _hits(asking: DataFrame, stored: DataFrame, k: int, lots: int, dimension: int) -> DataFrame:
    """The best k of each query in each part of the cells it asks for; cells nobody asks for are not read.

    Queries of a cell are dealt into lots and a cell's vectors into parts of bounded size, so that neither a
    favourite cell nor a large one meets in one task.
    """
    dealt = asking.withColumn("lote", F.pmod(F.xxhash64("consulta"), F.lit(lots)))
    wanted = dealt.select("celula", "lote").distinct()
    sizes = stored.groupBy("celula").agg(F.ceil(F.count(F.lit(1)) / QUERIES_AT_ONCE).cast("int").alias("partes"))
    wanted = materialize(wanted.join(sizes, "celula"), "pedidos")
    chosen = [row[0] for row in wanted.select("celula").distinct().collect()]  # prunes the folders of the others
    there = stored.where(F.col("celula").isin(chosen)).join(wanted, "celula").withColumn("parte", F.pmod(F.xxhash64("conteudo_id"), F.col("partes")))
    asked = dealt.join(wanted, ["celula", "lote"]).withColumn("parte", F.explode(F.sequence(F.lit(0).cast("long"), F.col("partes").cast("long") - 1)))
    there = there.select("celula", "lote", F.col("parte").cast("long").alias("parte"), "conteudo_id", F.col("vetor").alias("candidato"))

    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        made = {"consulta": [], "conteudo_id": [], "proximidade": []}
        if queries.num_rows and rows.num_rows:
            ids = rows.column("conteudo_id").to_numpy()
            held = vectors.matrix(rows.column("candidato"), dimension)
            held /= np.linalg.norm(held, axis=1, keepdims=True)
            for a in range(0, queries.num_rows, 256):
                part = queries.slice(a, 256)
                given = vectors.matrix(part.column("vetor"), dimension)
                close = np.round((given / np.linalg.norm(given, axis=1, keepdims=True)) @ held.T, 12)
                for name, row in zip(part.column("consulta").to_pylist(), close):
                    first = np.lexsort((ids, -row))[:k]
                    made["consulta"] += [name] * len(first)
                    made["conteudo_id"] += ids[first].tolist()
                    made["proximidade"] += row[first].tolist()
        return pa.table(made, schema=pa.schema([("consulta", pa.string()), ("conteudo_id", pa.int64()), ("proximidade", pa.float64())]))

    keys = ["celula", "lote", "parte"]
    return asked.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(best, BATCH_HITS)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("consulta").orderBy(F.desc("proximidade"), "conteudo_id")
    return hits.withColumn("posicao", F.row_number().over(order)).where(F.col("posicao") <= k)


def indexed_batch(spark: SparkSession, path: str, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The exact ``k`` nearest vectors of every query of a table (consulta, vetor), and how many cells each had to read.

    Two rounds, each a join of the queries with cells: first the nearest cells that hold ``k`` vectors, then
    every other cell whose bound reaches the ``k``-th hit of the first. Queries of another size, null
    and zero vectors find nothing; of rows that share a name one counts.
    """
    k = check_top_k(k)
    ship_package(spark)
    cells = _cells_of(spark, path)
    _, pivots, radius, total = cells
    if not len(pivots):
        raise ValueError("o indice nao tem celulas.")
    dimension = pivots.shape[1]
    stored = spark.read.schema(PLACED).parquet(f"{path}/vetores")
    given = queries.select(F.col("consulta").cast("string").alias("consulta"), F.col("vetor").cast("array<double>").alias("vetor"))
    fit = vectors.with_norm(given.where(F.size("vetor") == dimension), "vetor").groupBy("consulta").agg(F.min("vetor").alias("vetor"))
    asked = materialize(fit.withColumn("limite", F.lit(0.0)), "consultas")
    lots = max(1, -(-asked.count() // QUERIES_AT_ONCE))

    def nearest_cells(angles: np.ndarray, _limit: np.ndarray) -> np.ndarray:
        order = np.argsort(angles, axis=1, kind="stable")
        before = np.cumsum(total[order], axis=1) - total[order]
        picked = np.zeros(angles.shape, bool)
        np.put_along_axis(picked, order, before < k, axis=1)
        return picked

    def others_in_reach(angles: np.ndarray, limit: np.ndarray) -> np.ndarray:
        return (angles - radius[None, :] <= limit[:, None]) & ~nearest_cells(angles, limit)

    first_asking = materialize(_asking(asked, cells, nearest_cells, dimension), "primeiras")
    found = materialize(_ranked(_hits(first_asking, stored, k, lots, dimension), k), "vizinhos")
    worst = found.groupBy("consulta").agg(F.min("proximidade").alias("_pior"))
    reach = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_pior")))) + SLACK
    again = asked.drop("limite").join(worst, "consulta").select("consulta", "vetor", reach.alias("limite"))
    second_asking = materialize(_asking(again, cells, others_in_reach, dimension), "segundas")
    more = _hits(second_asking, stored, k, lots, dimension)
    hits = _ranked(found.drop("posicao").unionByName(more), k)
    read = first_asking.unionByName(second_asking).groupBy("consulta").agg(F.count(F.lit(1)).alias("celulas_lidas"))
    return hits, read


def indexed_search_batch(spark: SparkSession, path: str, contents: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    return describe_hits(indexed_batch(spark, path, queries, k)[0], contents)


def indexed_search(spark: SparkSession, path: str, contents: DataFrame, query: list[float], k: int) -> DataFrame:
    return describe_hits(indexed_nearest(spark, path, query, k), contents).drop("consulta")
