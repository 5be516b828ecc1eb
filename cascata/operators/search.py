"""Embedding upkeep and semantic top-k search by cosine distance."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cascata.functions import vectors
from cascata.functions.text import text_representation
from cascata.operators.lookups import completed_pairs
from cascata.session import ship_package

HITS = "consulta string, conteudo_id bigint, proximidade double"


def content_texts(contents: DataFrame) -> DataFrame:
    text = text_representation(F.col("titulo"), F.col("descricao"))
    return contents.select("conteudo_id", text.alias("texto_origem"))


def embedding_delta(contents: DataFrame, stored: DataFrame, model: str) -> DataFrame:
    """Each content's state: ``reaproveitado``, ``pendente`` or ``ignorado_sem_texto``."""
    known = stored.select("conteudo_id", F.col("modelo").alias("_modelo"), F.col("texto_origem").alias("_texto"))
    joined = content_texts(contents).join(known, "conteudo_id", "left")
    same = (F.col("_modelo") == model) & (F.col("_texto") == F.col("texto_origem"))
    return joined.select(
        "conteudo_id", "texto_origem",
        F.when(F.col("texto_origem") == "", "ignorado_sem_texto").when(same, "reaproveitado")
        .otherwise("pendente").alias("situacao"),
    )


def delta_report(delta: DataFrame) -> DataFrame:
    return delta.groupBy("situacao").agg(F.count(F.lit(1)).alias("total"))


Encoder = Callable[[list[str]], np.ndarray]


def embed_pending(delta: DataFrame, make_encoder: Callable[[], Encoder], model: str, batch: int = 32) -> DataFrame:
    """Encode the pending texts; the encoder is made once per task and fed ``batch`` texts at a time."""
    ship_package(delta.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder()
        for block in batches:
            for start in range(0, block.num_rows, batch):
                piece = block.slice(start, batch)
                found = np.asarray(encoder(piece.column("texto_origem").to_pylist()), dtype=np.float64)
                length = np.linalg.norm(found, axis=1, keepdims=True)
                found = found / np.where(length > 0, length, 1.0)
                offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.astype(np.float32).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("conteudo_id"), piece.column("texto_origem"), lists],
                    names=["conteudo_id", "texto_origem", "vetor"],
                )

    todo = delta.where(F.col("situacao") == "pendente").select("conteudo_id", "texto_origem")
    made = todo.mapInArrow(encode, "conteudo_id bigint, texto_origem string, vetor array<float>")
    return made.withColumn("modelo", F.lit(model))


def current_vectors(store: DataFrame, model: str, dimension: int) -> DataFrame:
    """Vectors of one model with the declared dimension; others cannot be compared."""
    fit = (F.col("modelo") == model) & (F.size("vetor") == dimension)
    return store.where(fit).select("conteudo_id", "vetor")


def check_top_k(k: int) -> int:
    if int(k) < 1:
        raise ValueError("top_k deve ser um inteiro >= 1.")
    return int(k)


def nearest(vectors_df: DataFrame, queries: dict[str, list[float]], k: int) -> DataFrame:
    """The ``k`` nearest vectors of each query.

    The queries are few and travel with the task. Every Arrow batch is compared by one
    matrix product and only its own best ``k`` rows per query leave the task, which loses
    none of the final ``k``; the window then merges those short lists.
    """
    k = check_top_k(k)
    ship_package(vectors_df.sparkSession)
    names = list(queries)
    wanted = np.asarray([queries[n] for n in names], dtype=np.float64).reshape(len(names), -1)
    wanted = wanted / np.linalg.norm(wanted, axis=1, keepdims=True)
    dimension = wanted.shape[1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            if block.num_rows == 0:
                continue
            stored = vectors.matrix(block.column("vetor"), dimension)
            length = np.linalg.norm(stored, axis=1)
            usable = length > 0
            ids = block.column("conteudo_id").to_numpy(zero_copy_only=False)[usable]
            close = np.round((stored[usable] / length[usable, None]) @ wanted.T, 12)
            for column, name in enumerate(names):
                best = np.lexsort((ids, -close[:, column]))[:k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(best)), pa.array(ids[best]), pa.array(close[best, column])],
                    names=["consulta", "conteudo_id", "proximidade"],
                )

    sized = vectors_df.where(F.size("vetor") == dimension)  # vectors of another size cannot be compared
    hits = sized.select("conteudo_id", "vetor").mapInArrow(score, HITS)
    by_query = Window.partitionBy("consulta").orderBy(F.desc("proximidade"), "conteudo_id")
    return hits.withColumn("posicao", F.row_number().over(by_query)).where(F.col("posicao") <= k)


def describe_hits(hits: DataFrame, contents: DataFrame) -> DataFrame:
    """At most ``k`` rows per query, with the content they stand for."""
    joined = hits.join(contents.select("conteudo_id", "titulo", "categoria", "tipo"), "conteudo_id")
    return joined.select(
        "consulta", "posicao", "conteudo_id", "titulo", "categoria", "tipo",
        F.round("proximidade", 4).alias("similaridade"),
        F.round(1 - F.col("proximidade"), 4).alias("distancia"),
    ).orderBy("consulta", "posicao")


def semantic_search(store: DataFrame, contents: DataFrame, query: list[float], k: int, model: str) -> DataFrame:
    """Contents nearest to a query vector; only those present in the catalogue are ranked."""
    return semantic_search_batch(store, contents, {"consulta": query}, k, model).drop("consulta")


def semantic_search_batch(
    store: DataFrame, contents: DataFrame, queries: dict[str, list[float]], k: int, model: str
) -> DataFrame:
    dimension = len(next(iter(queries.values())))
    known = current_vectors(store, model, dimension).join(contents.select("conteudo_id"), "conteudo_id", "left_semi")
    return describe_hits(nearest(known, queries, k), contents)


def encode_query(text: str, encoder: Encoder) -> list[float]:
    cleaned = (text or "").strip()
    if not cleaned:
        raise ValueError("A consulta semantica nao pode ser vazia.")
    return [float(x) for x in np.asarray(encoder([cleaned]))[0]]


def demonstration(
    store: DataFrame, contents: DataFrame, phrases: list[str], encoder: Encoder, k: int, model: str
) -> DataFrame:
    """Report of at least three different phrases."""
    kept = [p.strip() for p in phrases if p and p.strip()]
    if len(kept) < 3:
        raise ValueError("sao necessarias pelo menos tres consultas semanticas diferentes.")
    return semantic_search_batch(store, contents, {p: encode_query(p, encoder) for p in kept}, k, model)


def vector_of(store: DataFrame, content: int) -> list[float] | None:
    """One stored vector, read by its key."""
    row = store.where(F.col("conteudo_id") == content).select("vetor").first()
    return list(row["vetor"]) if row else None


def similar_contents(store: DataFrame, contents: DataFrame, content: int, k: int) -> DataFrame:
    """Neighbours of a stored vector among all vectors of its size, itself included."""
    query = vector_of(store, content)
    if query is None:
        raise ValueError(f"conteudo {content} sem embedding")
    sized = store.where(F.size("vetor") == len(query)).select("conteudo_id", "vetor")
    known = sized.join(contents.select("conteudo_id"), "conteudo_id", "left_semi")
    return describe_hits(nearest(known, {"consulta": query}, k), contents).drop("consulta")


def user_profile(interactions: DataFrame, store: DataFrame, user: int) -> DataFrame:
    """Mean of the vectors of what one user consumed, a content counted once per interaction.

    Vectors of different sizes have no mean: those of the size that most of the contents have count,
    the larger size on a tie.
    """
    consumed = interactions.where(
        (F.col("usuario_id") == user) & F.col("tipo_interacao").isin("visualização", "início", "conclusão")
    )
    weights = consumed.groupBy("conteudo_id").agg(F.count(F.lit(1)).cast("double").alias("peso"))
    used = weights.join(store, "conteudo_id").withColumn("_tamanho", F.size("vetor"))
    sizes = used.groupBy("_tamanho").count().orderBy(F.desc("count"), F.desc("_tamanho")).limit(1)
    return used.join(sizes, "_tamanho", "left_semi").agg(vectors.weighted_mean(F.col("vetor"), F.col("peso")).alias("vetor"))


def profile_neighbours(
    interactions: DataFrame, store: DataFrame, contents: DataFrame, user: int, k: int
) -> DataFrame:
    """Contents nearest to the user's profile that the user has not completed."""
    row = user_profile(interactions, store, user).first()
    done = completed_pairs(interactions.where(F.col("usuario_id") == user)).select("conteudo_id")
    open_vectors = store.select("conteudo_id", "vetor").join(done, "conteudo_id", "left_anti").join(
        contents.select("conteudo_id"), "conteudo_id", "left_semi"
    )
    if row is None or row["vetor"] is None or not any(row["vetor"]):
        query, open_vectors = [1.0], open_vectors.limit(0)
    else:
        query = list(row["vetor"])
    hits = describe_hits(nearest(open_vectors, {"perfil": query}, k), contents)
    return hits.select("posicao", "conteudo_id", "titulo", "categoria", F.col("similaridade").alias("ivis"))


def hashing_encoder(dimension: int) -> Callable[[], Encoder]:
    """Default encoder: counts of hashed words. Any trained model with this signature can take its place."""

    def make() -> Encoder:
        import zlib

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dimension))
            for row, text in enumerate(texts):
                for word in text.lower().split():
                    out[row, zlib.crc32(word.encode()) % dimension] += 1.0
            return out

        return encode

    return make
