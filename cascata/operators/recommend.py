"""Content recommender: interest signals, centroids, scores, classes and ranked batches.

score = (views index + interest index) / 2 * 100, zero for completed contents. Each index is
the cosine to the user's centroid where both vectors exist, else the share of the content's
category in what the user did.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cascata.functions import vectors
from cascata.functions.metrics import is_conclusion
from cascata.operators.skew import lookup
from cascata.operators.vector_index import CELLS, choose_pivots
from cascata.schemas import CATEGORIES
from cascata.session import materialize, ship_package

# What counts as consumption, and the score limits of the classes.
CONSUMING_TYPES = ["visualização", "início", "conclusão"]
NEGATIVE_UP_TO, POSITIVE_FROM = 40, 70

#: Least and largest number of contents and of users in a block, and how many blocks of each there are in between.
BLOCK_CONTENTS, CONTENT_BLOCKS = (4096, 65536), 8
BLOCK_USERS, USER_BLOCKS = (2048, 32768), 16
#: Users that are scored at once, so that a large block takes no more memory for its scores.
USERS_AT_ONCE = 2048
#: What a bound may be off by rounding, in points.
BOUND_SLACK = 1e-6


def classify(score: Column, open_flag: Column) -> Column:
    """On the rounded score: up to 40 or completed is negative, from 70 positive, else stable."""
    return (
        F.when((open_flag == 0) | (score <= NEGATIVE_UP_TO), "Negativo").when(score >= POSITIVE_FROM, "Positivo").otherwise("Estável")
    )


def rank_and_keep(scored: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """Best ``n`` per key by score, then id; Spark cuts each task's rows to ``n`` before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("pontuacao"), "conteudo_id")
    return scored.withColumn("posicao", F.row_number().over(order)).where(F.col("posicao") <= n)


def signals(interactions: DataFrame, minimum_rating: int = 4) -> DataFrame:
    """One row per user and content: consumed minutes, liked and completed flags."""
    minutes = F.coalesce("tempo_consumido", F.lit(0))
    consumed = F.coalesce(F.col("tipo_interacao").isin(CONSUMING_TYPES), F.lit(False)) | (minutes > 0)
    liked = (F.col("tipo_interacao") == "curtida") | F.coalesce(
        F.col("avaliacao_atribuida") >= minimum_rating, F.lit(False)
    )
    return interactions.groupBy("usuario_id", "conteudo_id").agg(
        F.sum(F.when(consumed, F.greatest(minutes, F.lit(1)))).alias("peso"),
        F.coalesce(F.max(liked), F.lit(False)).alias("positivo"),
        F.coalesce(F.max(is_conclusion()), F.lit(False)).alias("concluido"),
    )


def measured_vectors(store: DataFrame, model: str, dimension: int | None = None) -> DataFrame:
    """Vectors of one model with their length; cosines divide by it instead of scaling the vector.

    With ``dimension`` only vectors of that size; without, a model is taken to have one size.
    """
    kept = store.where(F.col("modelo") == model).select("conteudo_id", "vetor")
    kept = kept if dimension is None else kept.where(F.size("vetor") == dimension)
    return vectors.with_norm(kept, "vetor")


def with_vectors(pairs: DataFrame, measured: DataFrame) -> DataFrame:
    """Signals of contents that have a vector."""
    return lookup(pairs, measured, ["conteudo_id"], "inner")


def centroid_views(pairs: DataFrame, measured: DataFrame) -> DataFrame:
    """Direction of what a user consumed: unit vectors weighted by minutes (the length is left free)."""
    used = with_vectors(pairs.where(F.col("peso").isNotNull()), measured)
    mean = vectors.weighted_mean(F.col("vetor"), F.col("peso") / F.col("norma"))
    return used.groupBy("usuario_id").agg(mean.alias("vis"))


def centroid_likes(pairs: DataFrame, measured: DataFrame) -> DataFrame:
    """Direction of what a user liked: each distinct content counts once."""
    used = with_vectors(pairs.where("positivo"), measured)
    mean = vectors.weighted_mean(F.col("vetor"), F.lit(1.0) / F.col("norma"))
    return used.groupBy("usuario_id").agg(mean.alias("cur"))


def with_category(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    known = contents.select("conteudo_id", "categoria")
    return lookup(pairs, known, ["conteudo_id"])


def category_shares(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """Per user and category: share of consumed minutes and of liked contents.

    Contents outside the catalogue count in the totals and belong to no category. The
    window sees at most one row per category and user.
    """
    per_category = with_category(pairs, contents).groupBy("usuario_id", "categoria").agg(
        F.coalesce(F.sum("peso"), F.lit(0)).alias("_tempo"), F.count_if("positivo").alias("_positivos")
    )
    of_user = Window.partitionBy("usuario_id")
    shared = per_category.withColumns({
        "parte_tempo": F.try_divide("_tempo", F.sum("_tempo").over(of_user)),
        "parte_positivos": F.try_divide("_positivos", F.sum("_positivos").over(of_user)),
    })
    return shared.where(F.col("categoria").isNotNull()).select(
        "usuario_id", "categoria", F.coalesce("parte_tempo", F.lit(0.0)).alias("parte_tempo"),
        F.coalesce("parte_positivos", F.lit(0.0)).alias("parte_positivos"),
    )


def share_vectors(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The same shares as two arrays per user, in the order of the category domain."""
    def spread(amount: Column, name: str) -> Column:
        total = F.sum(amount)
        parts = [F.sum(F.when(F.col("categoria") == c, amount)) for c in CATEGORIES]
        return F.array(*[F.coalesce(F.try_divide(p, total), F.lit(0.0)) for p in parts]).alias(name)

    liked = F.when(F.col("positivo"), 1).otherwise(0)
    return with_category(pairs, contents).groupBy("usuario_id").agg(
        spread(F.coalesce("peso", F.lit(0)), "parte_tempo"), spread(liked, "parte_positivos")
    )


def user_profiles(pairs: DataFrame, contents: DataFrame, measured: DataFrame) -> DataFrame:
    """Everything scoring needs of a user, one row each; every user has a row of shares."""
    return (
        share_vectors(pairs, contents)
        .join(centroid_views(pairs, measured), "usuario_id", "left")
        .join(centroid_likes(pairs, measured), "usuario_id", "left")
    )


def content_matrix(contents: DataFrame, measured: DataFrame) -> DataFrame:
    """Catalogue rows with the position of their category and, if any, their vector."""
    labels = F.array(*[F.lit(c) for c in CATEGORIES])
    slot = (F.array_position(labels, F.col("categoria")) - 1).cast("int")
    return contents.select("conteudo_id", slot.alias("categoria_pos")).join(measured, "conteudo_id", "left")


def round_half_even(values: np.ndarray) -> np.ndarray:
    """Two decimals as Python's ``round`` gives them; only values next to a tie need it."""
    rounded = np.round(values, 2)
    scaled = values * 100
    ties, which = np.unique(values[np.abs(scaled - np.floor(scaled) - 0.5) < 1e-7], return_inverse=True)
    rounded[np.abs(scaled - np.floor(scaled) - 0.5) < 1e-7] = np.array([round(float(x), 2) for x in ties])[which] if len(ties) else 0
    return rounded


ITEM = "struct<conteudo_id:bigint,pontuacao:double,ivis:double,icur:double>"
BLOCK_SCHEMA = f"usuario_id bigint, negativas bigint, concluidas bigint, itens array<{ITEM}>, pontuadas bigint"
PLACED = "conteudo_id bigint, categoria_pos int, vetor array<double>, angulo double, celula int"


def _rows_or_zeros(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a nullable list column, zeros where null, and which rows are there."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    present = column.is_valid().to_numpy(zero_copy_only=False)
    full = np.zeros((len(column), width))
    if present.any():
        full[present] = vectors.matrix(column.drop_null(), width)
    return full, present


def _unit_rows(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with every row scaled to length one; a row of length zero counts as absent."""
    full, _present = _rows_or_zeros(column, width)
    length = np.linalg.norm(full, axis=1)
    return full / np.where(length > 0, length, 1.0)[:, None], length > 0


@dataclass(frozen=True)
class Cells:
    """Contents by angle to a pivot; those without a vector by category, after them.

    A cell knows its radius, which categories it holds and the block it belongs to: blocks gather
    neighbouring cells and have a bounded number of contents a part.
    """

    pivots: np.ndarray
    radius: np.ndarray
    categories: np.ndarray  # cell, category
    block: np.ndarray
    parts: dict[int, int]

    def bounds(self, users: pa.Table | pa.RecordBatch, dimension: int) -> np.ndarray:
        """What no score of a user with a content of a cell exceeds: a row per user, a column per cell."""
        both = np.zeros((users.num_rows, len(self.block)))
        for centroid, shares in (("vis", "parte_tempo"), ("cur", "parte_positivos")):
            direction, have = _unit_rows(users.column(centroid), dimension)
            share, _ = _rows_or_zeros(users.column(shares), len(CATEGORIES))
            most = np.zeros(both.shape)
            for category in range(len(CATEGORIES)):  # the largest share of the categories a cell holds
                most = np.maximum(most, share[:, category, None] * self.categories[None, :, category])
            if have.any() and len(self.pivots):
                angle = np.arccos(np.clip(direction[have] @ self.pivots.T, -1.0, 1.0)) - self.radius[None, :]
                most[np.ix_(have, np.arange(len(self.pivots)))] = np.cos(np.clip(angle, 0.0, np.pi))
            both += np.clip(most, 0.0, 1.0)
        return both / 2.0 * 100.0 + BOUND_SLACK


def place_contents(catalogue: DataFrame, pivots: np.ndarray, dimension: int) -> DataFrame:
    """Catalogue rows with unit vectors and the cell each belongs to."""
    def place(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks:
            if rows.num_rows == 0:
                continue
            found, has = _unit_rows(rows.column("vetor"), dimension)
            category = rows.column("categoria_pos").to_numpy(zero_copy_only=False)
            cell, angle = len(pivots) + category, np.zeros(len(has))
            if has.any():
                angles = np.arccos(np.clip(found[has] @ pivots.T, -1.0, 1.0))
                cell[has], angle[has] = angles.argmin(axis=1), angles.min(axis=1)
            offsets = np.concatenate(([0], np.cumsum(np.where(has, dimension, 0)))).astype(np.int32)
            unit = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[has].ravel()), mask=pa.array(~has))
            yield pa.RecordBatch.from_arrays(
                [rows.column("conteudo_id"), rows.column("categoria_pos"), unit, pa.array(angle), pa.array(cell.astype(np.int32))],
                names=["conteudo_id", "categoria_pos", "vetor", "angulo", "celula"])

    return catalogue.select("conteudo_id", "categoria_pos", "vetor").mapInArrow(place, PLACED)


def cells_of(placed: DataFrame, pivots: np.ndarray, block_contents: int) -> Cells:
    """The cells of placed contents; a few numbers for each of at most as many cells as there are pivots."""
    rows = placed.groupBy("celula").agg(
        F.max("angulo").alias("raio"), F.count(F.lit(1)).alias("total"), F.collect_set("categoria_pos").alias("categorias")).collect()
    count = len(pivots) + len(CATEGORIES)
    radius, total, categories = np.zeros(count), np.zeros(count, np.int64), np.zeros((count, len(CATEGORIES)))
    for r in rows:
        radius[r["celula"]], total[r["celula"]] = r["raio"], r["total"]
        categories[r["celula"], r["categorias"]] = 1.0
    gathered = max(1, -(-int(total[: len(pivots)].sum()) // block_contents))
    near = (pivots @ pivots[:gathered].T).argmax(axis=1) if len(pivots) else np.zeros(0, int)
    block = np.concatenate([near, np.full(len(CATEGORIES), gathered)])
    sizes = np.bincount(block, weights=total)
    return Cells(pivots, radius[: len(pivots)], categories, block, {i: max(1, math.ceil(n / block_contents)) for i, n in enumerate(sizes) if n})


def _index_scores(centroids, have, shares, items, has_vector, slots) -> np.ndarray:
    scores = shares[:, slots]
    if has_vector.any() and have.any():
        scores[np.ix_(have, has_vector)] = centroids[have] @ items[has_vector].T
    return np.clip(scores, 0.0, 1.0, out=scores)


def _score_block(n: int, dimension: int, cells: Cells):
    def score(users: pa.Table, contents: pa.Table) -> pa.Table:
        if users.num_rows == 0 or contents.num_rows == 0:
            return _block_arrow().empty_table()
        contents = contents.sort_by([("celula", "ascending"), ("conteudo_id", "ascending")])
        return pa.concat_tables([score_some(users.slice(a, USERS_AT_ONCE), contents) for a in range(0, users.num_rows, USERS_AT_ONCE)])

    def score_some(users: pa.Table, contents: pa.Table) -> pa.Table:
        ids, cell_of = contents["conteudo_id"].to_numpy(), contents["celula"].to_numpy()
        slots = contents["categoria_pos"].to_numpy()
        items, has_vector = _unit_rows(contents["vetor"], dimension)
        vis, have_vis = _unit_rows(users["vis"], dimension)
        cur, have_cur = _unit_rows(users["cur"], dimension)
        time_share, _ = _rows_or_zeros(users["parte_tempo"], len(CATEGORIES))
        like_share, _ = _rows_or_zeros(users["parte_positivos"], len(CATEGORIES))
        bounds = cells.bounds(users, dimension)
        done = users["concluidos"].combine_chunks()
        closed = np.unique(_pair_keys(np.repeat(np.arange(len(done)), np.asarray(done.value_lengths().fill_null(0))),
                                      np.searchsorted(np.sort(ids), done.flatten().to_numpy(zero_copy_only=False)), len(ids)))
        place = np.argsort(np.argsort(ids))  # of each content among the sorted ids

        kept, scored = [], np.zeros(users.num_rows, np.int64)
        begins = np.flatnonzero(np.r_[True, cell_of[1:] != cell_of[:-1]])
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(ids)]):
            rows = np.flatnonzero(bounds[:, cell_of[begin]] > NEGATIVE_UP_TO)  # the others' scores there are all negative
            if not rows.size:
                continue
            scored[rows] += end - begin
            part = slice(begin, end)
            ivis = _index_scores(vis[rows], have_vis[rows], time_share[rows], items[part], has_vector[part], slots[part])
            icur = _index_scores(cur[rows], have_cur[rows], like_share[rows], items[part], has_vector[part], slots[part])
            points = (ivis + icur) / 2.0 * 100.0
            row, column = np.nonzero(points > NEGATIVE_UP_TO)
            rounded = round_half_even(points[row, column])
            some = rounded > NEGATIVE_UP_TO
            row, column, rounded = row[some], column[some], rounded[some]
            kept.append((rows[row], begin + column, rounded, ivis[row, column], icur[row, column]))
        owner, at, points, ivis, icur = (np.concatenate(x) if kept else np.zeros(0, t) for x, t in zip(
            zip(*kept) if kept else [()] * 5, (np.int64, np.int64, float, float, float)))
        open_ = ~np.isin(_pair_keys(owner, place[at], len(ids)), closed)
        owner, at, points, ivis, icur = (x[open_] for x in (owner, at, points, ivis, icur))
        above = np.bincount(owner, minlength=users.num_rows)

        order = np.lexsort((ids[at], -points, owner))
        starts = np.searchsorted(owner[order], owner[order])
        best = order[np.arange(len(order)) - starts < n]
        offsets = np.concatenate(([0], np.cumsum(np.bincount(owner[best], minlength=users.num_rows)))).astype(np.int32)
        fields = {
            "conteudo_id": pa.array(ids[at[best]], pa.int64()), "pontuacao": pa.array(points[best]),
            "ivis": pa.array(ivis[best]), "icur": pa.array(icur[best]),
        }
        structs = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
        return pa.table({
            "usuario_id": users["usuario_id"].combine_chunks(),
            "negativas": pa.array(-above.astype(np.int64)),
            "concluidas": pa.array(np.zeros(users.num_rows, np.int64)),
            "itens": pa.ListArray.from_arrays(pa.array(offsets), structs),
            "pontuadas": pa.array(scored),
        })

    return score


def _pair_keys(rows: np.ndarray, columns: np.ndarray, width: int) -> np.ndarray:
    return rows.astype(np.int64) * width + columns


def _block_arrow() -> pa.Schema:
    item = pa.struct([("conteudo_id", pa.int64()), ("pontuacao", pa.float64()), ("ivis", pa.float64()), ("icur", pa.float64())])
    return pa.schema([
        ("usuario_id", pa.int64()), ("negativas", pa.int64()), ("concluidas", pa.int64()), ("itens", pa.list_(item)), ("pontuadas", pa.int64()),
    ])


def _in_reach(profiles: DataFrame, cells: Cells, dimension: int) -> DataFrame:
    """Each user beside every block that has a cell in which some score may pass the limit."""
    blocks = sorted(cells.parts)
    if not blocks:
        return profiles.select("usuario_id", "parte_tempo", "parte_positivos", "vis", "cur", F.lit(0).alias("bloco")).limit(0)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows == 0:
                continue
            open_ = cells.bounds(rows, dimension) > NEGATIVE_UP_TO
            user, block = np.nonzero(np.stack([open_[:, cells.block == b].any(axis=1) for b in blocks], axis=1))
            picked = rows.take(pa.array(user))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(np.array(blocks, np.int32)[block])], names=[*rows.schema.names, "bloco"])

    fields = "usuario_id bigint, parte_tempo array<double>, parte_positivos array<double>, vis array<double>, cur array<double>, bloco int"
    names = [f.split()[0] for f in fields.split(", ")][:-1]
    return profiles.select(*[F.col(c).cast("array<double>") if c != "usuario_id" else F.col(c) for c in names]).toDF(*names).mapInArrow(reach, fields)


def _block_size(rows: int, sizes: tuple[int, int], blocks: int) -> int:
    return min(max(math.ceil(rows / blocks), sizes[0]), sizes[1])


def _category_scores(profiles: DataFrame) -> DataFrame:
    """Per user, the categories whose contents without a vector score above the limit; all of one category score alike."""
    schema = "usuario_id bigint, categoria_pos int, pontuacao double, ivis double, icur double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ivis, icur = (np.clip(_rows_or_zeros(rows.column(c), len(CATEGORIES))[0], 0.0, 1.0) for c in ("parte_tempo", "parte_positivos"))
            points = (ivis + icur) / 2.0 * 100.0
            row, slot = np.nonzero(points > NEGATIVE_UP_TO)
            rounded = round_half_even(points[row, slot])
            some = rounded > NEGATIVE_UP_TO
            row, slot, rounded = row[some], slot[some], rounded[some]
            yield pa.RecordBatch.from_arrays(
                [rows.column("usuario_id").take(pa.array(row)), pa.array(slot.astype(np.int32)), pa.array(rounded), pa.array(ivis[row, slot]), pa.array(icur[row, slot])],
                names=["usuario_id", "categoria_pos", "pontuacao", "ivis", "icur"])

    shares = [F.col(c).cast("array<double>").alias(c) for c in ("parte_tempo", "parte_positivos")]
    return profiles.select("usuario_id", *shares).mapInArrow(score, schema)


def _without_vector(profiles: DataFrame, shelf: DataFrame, closed: DataFrame, n: int) -> DataFrame:
    """Block rows of the contents without a vector (``shelf``), from one score per user and category.

    All of a category tie, so the best ``n`` are those of least id that the user has not completed (``closed``: user, content and
    category). They lie among the first ``n`` and as many more as the user completed there.
    """
    finished = closed.groupBy("usuario_id", "categoria_pos").agg(F.count(F.lit(1)).alias("_feitos"))
    sizes = shelf.groupBy("categoria_pos").agg(F.count(F.lit(1)).alias("_todos"))
    open_ = _category_scores(profiles).join(F.broadcast(sizes), "categoria_pos").join(finished, ["usuario_id", "categoria_pos"], "left").withColumn(
        "_feitos", F.coalesce("_feitos", F.lit(0)))
    open_ = materialize(open_, "categorias")
    deepest = n + (open_.agg(F.max("_feitos")).first()[0] or 0)
    by_id = Window.partitionBy("categoria_pos").orderBy("conteudo_id")
    heads = shelf.select("categoria_pos", "conteudo_id", F.row_number().over(by_id).alias("_lugar")).where(F.col("_lugar") <= deepest)
    tried = open_.withColumn("_lugar", F.explode(F.sequence(F.lit(1), (F.lit(n) + F.col("_feitos")).cast("int"))))
    free = tried.join(heads, ["categoria_pos", "_lugar"]).join(closed.select("usuario_id", "conteudo_id"), ["usuario_id", "conteudo_id"], "left_anti")
    item = F.struct("conteudo_id", "pontuacao", "ivis", "icur")
    best = free.groupBy("usuario_id", "categoria_pos").agg(F.slice(F.sort_array(F.collect_list(item)), 1, n).alias("itens"))
    return open_.join(best, ["usuario_id", "categoria_pos"], "left").select(
        "usuario_id", (F.col("_feitos") - F.col("_todos")).alias("negativas"), F.lit(0).cast("bigint").alias("concluidas"),
        F.coalesce("itens", F.array()).cast(f"array<{ITEM}>").alias("itens"), F.lit(1).cast("bigint").alias("pontuadas"))


def score_blocks(
    interactions: DataFrame,
    contents: DataFrame,
    store: DataFrame,
    model: str,
    dimension: int,
    n: int = 5,
    block_contents: int | None = None,
    block_users: int | None = None,
    minimum_rating: int = 4,
    cells: int | None = None,
) -> DataFrame:
    """Scores that are not negative, without scoring every user against every content.

    Contents lie in angular cells, and cells in blocks of bounded size. From the angle to a cell's
    pivot, its radius and the categories it holds follows what no score there can exceed. A cell whose bound
    stays at the limit of negative scores is counted as negative without being scored, and a user
    is not sent to a block all of whose cells are so. A task takes one block of users and one of
    contents, scores what is left and gives back, per user, the best ``n``, how many scores passed the
    limit (taken off the negatives) and how many pairs it scored. One row per user counts all
    contents as negative to begin with, and those completed. Completed contents arrive per block.
    Blocks grow with the tables, so that a row is sent to a bounded number of them. Contents without a
    vector have one score per user and category and are not paired with users (``_without_vector``).
    """
    pairs = materialize(signals(interactions, minimum_rating), "sinais")
    ship_package(interactions.sparkSession)
    measured = measured_vectors(store, model, dimension)
    catalogue = materialize(content_matrix(contents, measured), "catalogo")
    number = catalogue.agg(F.count(F.lit(1)).alias("todos"), F.count("vetor").alias("com_vetor")).first()
    wanted = cells or min(max(math.isqrt(number["com_vetor"]), CELLS[0]), CELLS[1])
    pivots = choose_pivots(catalogue.where(F.col("vetor").isNotNull()), wanted) if number["com_vetor"] else np.zeros((0, dimension))
    placed = materialize(place_contents(catalogue, pivots, dimension), "lugares")
    near, shelf = placed.where(F.col("celula") < len(pivots)), placed.where(F.col("celula") >= len(pivots))
    found = cells_of(near, pivots, block_contents or _block_size(number["com_vetor"], BLOCK_CONTENTS, CONTENT_BLOCKS))
    profiles = materialize(user_profiles(pairs, contents, measured), "perfis")
    users = profiles.count()
    user_blocks = max(1, math.ceil(users / (block_users or _block_size(users, BLOCK_USERS, USER_BLOCKS))))
    completed_pairs = pairs.where("concluido").select("usuario_id", "conteudo_id")

    where_ = [(i, int(b), found.parts[int(b)]) for i, b in enumerate(found.block) if int(b) in found.parts]
    named = interactions.sparkSession.createDataFrame(where_, "celula int, bloco int, partes int")
    part = F.pmod(F.xxhash64("conteudo_id"), F.col("partes")).cast("int")
    located = near.join(named, "celula").withColumn("parte", part)
    done = lookup(completed_pairs, located.select("conteudo_id", "bloco", "parte"), ["conteudo_id"], "inner")
    per_block = done.groupBy("usuario_id", "bloco", "parte").agg(F.collect_list("conteudo_id").alias("concluidos"))

    group = F.pmod(F.xxhash64("usuario_id"), F.lit(user_blocks)).cast("int")
    parts = named.select("bloco", "partes").distinct()
    left = (
        _in_reach(profiles, found, dimension).join(parts, "bloco").withColumn("parte", F.explode(F.sequence(F.lit(0), F.col("partes") - 1)))
        .join(per_block, ["usuario_id", "bloco", "parte"], "left").withColumn("grupo", group)
    )
    right = located.drop("partes", "angulo").withColumn("grupo", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))))
    keys = ["bloco", "parte", "grupo"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_score_block(n, dimension, found), BLOCK_SCHEMA)

    closed = materialize(lookup(completed_pairs, shelf.select("conteudo_id", "categoria_pos"), ["conteudo_id"], "inner"), "concluidos")
    uniform = _without_vector(profiles, shelf, closed, n)
    completed = done.select("usuario_id").unionByName(closed.select("usuario_id")).groupBy("usuario_id").agg(F.count(F.lit(1)).alias("concluidas"))
    begun = profiles.select("usuario_id").join(completed, "usuario_id", "left").select(
        "usuario_id", F.lit(number["todos"]).cast("bigint").alias("negativas"), F.coalesce("concluidas", F.lit(0)).cast("bigint").alias("concluidas"),
        F.array().cast(f"array<{ITEM}>").alias("itens"), F.lit(0).cast("bigint").alias("pontuadas"))
    return begun.unionByName(uniform).unionByName(scored) if found.parts else begun.unionByName(uniform)


def scored_pairs(blocks: DataFrame) -> DataFrame:
    """How many pairs were scored, of all pairs of users and contents."""
    return blocks.agg(F.sum("pontuadas").alias("pontuadas"), F.sum(F.greatest("negativas", F.lit(0))).alias("pares"))


def top_n(blocks: DataFrame, contents: DataFrame, n: int, batch: str) -> DataFrame:
    """Ranked recommendations of a batch: best ``n`` per user over all blocks."""
    ranked = rank_and_keep(blocks.select("usuario_id", F.inline("itens")), n, ["usuario_id"])
    described = lookup(
        ranked, contents.select("conteudo_id", "titulo", "categoria", "tipo"), ["conteudo_id"], "inner",
    )
    return described.select(
        "usuario_id", "conteudo_id", "titulo", "categoria", "tipo",
        F.col("pontuacao").cast("decimal(5,2)").alias("pontuacao"),
        classify(F.col("pontuacao"), F.lit(1)).alias("classificacao"),
        vectors.round_places(F.col("ivis"), 4).alias("ivis"), vectors.round_places(F.col("icur"), 4).alias("icur"),
        F.lit(1).alias("iconc"), "posicao",
        F.lit(batch).cast("timestamp_ntz").alias("gerado_em"),
    )


def summary(blocks: DataFrame, n: int) -> DataFrame:
    """Counters of a batch. A block keeps its best ``n`` per user, enough to count the kept ones."""
    positive = F.size(F.filter("itens", lambda i: i["pontuacao"] >= POSITIVE_FROM))
    per_user = blocks.groupBy("usuario_id").agg(
        F.sum("negativas").alias("negativas"), F.sum("concluidas").alias("concluidas"),
        F.sum(F.size("itens")).alias("_itens"), F.sum(positive).alias("_positivos"),
    )
    kept = F.least("_itens", F.lit(n))
    good = F.least("_positivos", F.lit(n))
    return per_user.agg(
        F.count(F.lit(1)).alias("usuarios_processados"),
        F.count_if(F.col("_itens") == 0).alias("usuarios_sem_recomendacao"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("total"),
        F.coalesce(F.sum(good), F.lit(0)).alias("positivas"),
        F.coalesce(F.sum(kept - good), F.lit(0)).alias("estaveis"),
        F.coalesce(F.sum("negativas"), F.lit(0)).alias("negativas_descartadas"),
        F.coalesce(F.sum("concluidas"), F.lit(0)).alias("negativas_por_conclusao"),
    )


def batch_log(summed: DataFrame, batch: str) -> DataFrame:
    """Log row of a batch: what was evaluated, kept and dropped, taken from the run itself."""
    completed = F.col("negativas_por_conclusao")
    return summed.select(
        F.lit(batch).cast("timestamp_ntz").alias("gerado_em"),
        (F.col("total") + F.col("negativas_descartadas")).alias("total_avaliados"),
        F.col("total").alias("persistidas"), "positivas", "estaveis",
        (F.col("negativas_descartadas") - completed).alias("descartadas_pontuacao"),
        completed.alias("descartadas_conclusao"),
    )


SCORED = "usuario_id bigint, conteudo_id bigint, pontuacao double, ivis double, icur double, iconc int"


def score_pairs(pairs: DataFrame, profiles: DataFrame, catalogue: DataFrame, dimension: int) -> DataFrame:
    """Score given (user, content) pairs a batch at a time, by the arithmetic of the blocks; ``concluido`` closes a pair."""
    ship_package(pairs.sparkSession)
    rows = lookup(pairs.select("usuario_id", "conteudo_id", "concluido"), catalogue.select("conteudo_id", "categoria_pos", "vetor"), ["conteudo_id"], "inner")
    rows = lookup(rows, profiles.select("usuario_id", "vis", "cur", "parte_tempo", "parte_positivos"), ["usuario_id"], "inner")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            if block.num_rows == 0:
                continue
            items, has_vector = _unit_rows(block.column("vetor"), dimension)
            slot = block.column("categoria_pos").to_numpy(zero_copy_only=False)
            found = []
            for centroid, shares in (("vis", "parte_tempo"), ("cur", "parte_positivos")):
                direction, have = _unit_rows(block.column(centroid), dimension)
                share, _ = _rows_or_zeros(block.column(shares), len(CATEGORIES))
                close = (direction * items).sum(axis=1)
                found.append(np.clip(np.where(have & has_vector, close, share[np.arange(len(slot)), slot]), 0.0, 1.0))
            open_ = np.where(block.column("concluido").to_numpy(zero_copy_only=False).astype(bool), 0, 1)
            points = round_half_even((found[0] + found[1]) / 2.0 * 100.0 * open_)
            yield pa.RecordBatch.from_arrays(
                [block.column("usuario_id"), block.column("conteudo_id"), pa.array(points), *(pa.array(f) for f in found), pa.array(open_.astype(np.int32))],
                names=[c.split()[0] for c in SCORED.split(", ")])

    lists = [F.col(c).cast("array<double>").alias(c) for c in ("vetor", "vis", "cur", "parte_tempo", "parte_positivos")]
    scored = rows.select("usuario_id", "conteudo_id", "concluido", "categoria_pos", *lists).mapInArrow(score, SCORED)
    return scored.select(
        "usuario_id", "conteudo_id", "pontuacao", vectors.round_places(F.col("ivis"), 4).alias("ivis"),
        vectors.round_places(F.col("icur"), 4).alias("icur"), "iconc", classify(F.col("pontuacao"), F.col("iconc")).alias("classificacao"))


def for_user(
    interactions: DataFrame, contents: DataFrame, store: DataFrame, user: int, model: str, dimension: int,
    n: int, batch: str,
) -> DataFrame:
    """Recommendations of one user; the filter reaches the scan of the interactions."""
    mine = interactions.where(F.col("usuario_id") == user)
    if mine.limit(1).count() == 0:
        raise ValueError(f"usuario {user} nao encontrado")
    return top_n(score_blocks(mine, contents, store, model, dimension, n), contents, n, batch)


def batch_rows(recommendations: DataFrame) -> DataFrame:
    """Rows to persist: one per user, content and batch, positions from one."""
    best = recommendations.where(F.col("posicao") >= 1)
    return best.groupBy("usuario_id", "conteudo_id", "gerado_em").agg(
        F.max("pontuacao").alias("pontuacao"), F.min("posicao").alias("posicao"),
        F.max("classificacao").alias("classificacao"),
    )
