"""Checks, counts and look-ups over the loaded tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cascata.functions import metrics
from cascata.operators.gold import last_batch
from cascata.operators.onerow import side_by_side
from cascata.operators.skew import lookup


def count_entities(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(n).alias("entidade"), "total") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def count_by(rows: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return (
        rows.groupBy(F.col(column).alias(name or column))
        .agg(F.count(F.lit(1)).alias("qtd"))
        .orderBy(F.desc("qtd"), name or column)
    )


def signal_counts(interactions: DataFrame) -> DataFrame:
    signals = ["visualização", "início", "conclusão", "curtida", "avaliação"]
    return count_by(interactions.where(F.col("tipo_interacao").isin(signals)), "tipo_interacao")


def positive_ratings(interactions: DataFrame, minimum: int = 4) -> DataFrame:
    return interactions.agg(F.count_if(F.col("avaliacao_atribuida") >= minimum).alias("avaliacoes_positivas"))


def embedding_totals(store: DataFrame) -> DataFrame:
    """Distinct contents come from a per-content count, models from a per-model one."""
    per_content = store.groupBy("conteudo_id").agg(F.count(F.lit(1)).alias("_n"), F.min("modelo").alias("_menor"),
                                                   F.max("modelo").alias("_maior"))
    sizes = per_content.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_embeddings"), F.count(F.lit(1)).alias("conteudos"))
    models = store.select("modelo").distinct().agg(F.count("modelo").alias("modelos"))
    return side_by_side(sizes, models).select("total_embeddings", "modelos", "conteudos")


def orphan_interactions(interactions: DataFrame, users: DataFrame, contents: DataFrame, row_id: str) -> DataFrame:
    """Ids of the interactions whose user or content is not in its table."""
    known_user = users.select("usuario_id").withColumn("_usuario", F.lit(True))
    known_content = contents.select("conteudo_id").withColumn("_conteudo", F.lit(True))
    narrow = interactions.select(row_id, "usuario_id", "conteudo_id")
    flagged = lookup(narrow, known_user, ["usuario_id"])
    flagged = lookup(flagged, known_content, ["conteudo_id"])
    return flagged.where(F.col("_usuario").isNull() | F.col("_conteudo").isNull()).select(row_id)


def contents_without_category(contents: DataFrame, categories: DataFrame) -> DataFrame:
    return contents.join(categories.select(F.col("nome").alias("categoria")), "categoria", "left_anti").select("conteudo_id")


def orphan_comments(comments: DataFrame, contents: DataFrame) -> DataFrame:
    per_content = comments.groupBy("conteudo_id").agg(F.count(F.lit(1)).alias("comentarios"))
    return per_content.join(contents.select("conteudo_id"), "conteudo_id", "left_anti")


def contents_without_embedding(contents: DataFrame, store: DataFrame) -> DataFrame:
    return (
        contents.join(store.select("conteudo_id"), "conteudo_id", "left_anti")
        .select("conteudo_id", "titulo")
        .orderBy("conteudo_id")
    )


def embedding_sample(store: DataFrame, contents: DataFrame, limit: int = 5) -> DataFrame:
    joined = store.join(contents.select("conteudo_id", "titulo"), "conteudo_id")
    return joined.select(
        "conteudo_id", "titulo", "modelo", F.size("vetor").alias("dimensao")
    ).orderBy("conteudo_id").limit(limit)


def completed_pairs(interactions: DataFrame) -> DataFrame:
    return interactions.where(metrics.is_conclusion()).select("usuario_id", "conteudo_id").distinct()


def completed_leaks(recommendations: DataFrame, interactions: DataFrame) -> DataFrame:
    """Recommended pairs of the last batch that the user had completed; should be empty."""
    return (
        last_batch(recommendations)
        .join(completed_pairs(interactions), ["usuario_id", "conteudo_id"], "left_semi")
        .select("usuario_id", "conteudo_id", "posicao")
        .orderBy("usuario_id", "posicao", "conteudo_id")
    )


def completed_by_user(interactions: DataFrame, contents: DataFrame, user: int) -> DataFrame:
    mine = interactions.where((F.col("usuario_id") == user) & metrics.is_conclusion())
    counted = mine.groupBy("conteudo_id", "tipo_interacao", "percentual_conclusao").agg(F.count(F.lit(1)).alias("vezes"))
    return counted.join(contents.select("conteudo_id", "titulo"), "conteudo_id").select(
        "conteudo_id", "titulo", "tipo_interacao", "percentual_conclusao", "vezes"
    ).orderBy("conteudo_id")


def batch_totals(recommendations: DataFrame) -> DataFrame:
    per_user = recommendations.groupBy("gerado_em", "usuario_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("classificacao") == "Positivo").alias("_p"),
        F.count_if(F.col("classificacao") == "Estável").alias("_e"),
    )
    return per_user.groupBy("gerado_em").agg(
        F.sum("_n").alias("qtd"), F.count(F.lit(1)).alias("usuarios"),
        F.sum("_p").alias("positivas"), F.sum("_e").alias("estaveis"),
    ).orderBy(F.desc("gerado_em"))


def last_batch_classes(recommendations: DataFrame) -> DataFrame:
    return last_batch(recommendations).groupBy("classificacao").agg(F.count(F.lit(1)).alias("qtd"))


def user_ranking(recommendations: DataFrame, contents: DataFrame, user: int) -> DataFrame:
    mine = last_batch(recommendations).where(F.col("usuario_id") == user)
    return mine.join(contents.select("conteudo_id", "titulo", "categoria"), "conteudo_id").select(
        "usuario_id", "posicao", "conteudo_id", "titulo", "categoria", "pontuacao", "classificacao", "gerado_em"
    ).orderBy("posicao")


def comments_of_content(documents: DataFrame, content: int, limit: int = 10) -> DataFrame:
    """Newest first, so that the limit always gives the same rows."""
    return _first(documents.where(F.col("conteudo_id") == content), limit)


def comments_by_tag(documents: DataFrame, tag: str, limit: int = 10) -> DataFrame:
    return _first(documents.where(F.array_contains("tags", tag)), limit)


def comments_by_rating(documents: DataFrame, rating: int, at_least: bool = False, limit: int = 10) -> DataFrame:
    grade = F.col("avaliacao")
    return _first(documents.where(grade >= rating if at_least else grade == rating), limit)


def _first(documents: DataFrame, limit: int) -> DataFrame:
    return documents.orderBy(F.desc("data"), "usuario_id", "conteudo_id").limit(limit)


def comments_per_category(documents: DataFrame) -> DataFrame:
    return (
        documents.groupBy("categoria").agg(F.count(F.lit(1)).alias("quantidade"))
        .orderBy(F.desc("quantidade"), "categoria")
    )


def table_snapshot(tables: dict[str, DataFrame], run_id: str) -> DataFrame:
    """Rows and columns of each published table (``schema.table``)."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(run_id).alias("execucao_id"), F.lit(name.split(".")[0]).alias("esquema"),
            F.lit(name.split(".")[1]).alias("tabela"), "linhas", F.lit(len(df.columns)).alias("colunas"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)
