"""Rows fit to be loaded: every validity rule again, on treated data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cascata.functions import casts, text
from cascata.operators.skew import lookup
from cascata.schemas import CATEGORIES, CONTENT_TYPES, INTERACTION_TYPES, LEVELS


def all_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def loadable_catalog(treated: DataFrame) -> DataFrame:
    rows = treated.withColumn("conteudo_id", F.col("conteudo_id").try_cast("bigint"))
    return rows.where(
        all_present(["conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao"])
        & F.col("tipo").isin(CONTENT_TYPES)
        & F.col("categoria").isin(CATEGORIES)
        & F.col("nivel").isin(LEVELS)
        & (F.col("carga_horaria_min") >= 0)
    )


def loadable_interactions(treated: DataFrame, contents: DataFrame) -> DataFrame:
    rows = treated.withColumns({
        "usuario_id": F.col("usuario_id").try_cast("bigint"),
        "conteudo_id": F.col("conteudo_id").try_cast("bigint"),
    })
    rating = F.col("avaliacao_atribuida")
    fit = rows.where(
        all_present(["usuario_id", "conteudo_id", "tipo_interacao", "data_hora", "tempo_consumido",
                     "percentual_conclusao"])
        & F.col("tipo_interacao").isin(INTERACTION_TYPES)
        & (F.col("tempo_consumido") >= 0)
        & F.col("percentual_conclusao").between(0, 100)
        & (rating.isNull() | rating.between(1, 5))
        & casts.matches_timestamp_format(F.col("data_hora"))
    )
    known = contents.select("conteudo_id")
    return lookup(fit, known, ["conteudo_id"], "left_semi").withColumn(
        "data_hora", F.col("data_hora").try_cast("timestamp_ntz")
    )


def comment_documents(treated: DataFrame, catalog: DataFrame) -> DataFrame:
    """Comments with the category of their content; those of an unknown content are left out."""
    rows = treated.withColumns({
        "usuario_id": F.col("usuario_id").try_cast("bigint"),
        "conteudo_id": F.col("conteudo_id").try_cast("bigint"),
        "comentario": text.clean_text(F.col("comentario")),
    })
    fit = rows.where(
        all_present(["usuario_id", "conteudo_id", "avaliacao", "comentario", "data"])
        & F.col("avaliacao").between(1, 5)
    )
    categories = catalog.select(F.col("conteudo_id").try_cast("bigint").alias("conteudo_id"), "categoria").where(
        F.col("conteudo_id").isNotNull() & F.col("categoria").isin(CATEGORIES)
    )
    joined = lookup(fit, categories, ["conteudo_id"], "inner")
    return joined.select("ordem", "usuario_id", "conteudo_id", "avaliacao", "comentario", "tags", "data", "categoria")


def category_dimension(contents: DataFrame) -> DataFrame:
    """Surrogate keys of the labels in use; the domain has eight of them."""
    labels = F.array(*[F.lit(c) for c in CATEGORIES])
    used = contents.select(F.col("categoria").alias("nome")).distinct()
    return used.select(F.array_position(labels, F.col("nome")).alias("categoria_id"), "nome")


def ingestion_summary(log: DataFrame, loaded: dict[str, DataFrame]) -> DataFrame:
    """The log of each source beside how many of its rows were fit to be loaded."""
    counts = [rows.agg(F.count(F.lit(1)).alias("carregados")).withColumn("fonte", F.lit(source)) for source, rows in loaded.items()]
    joined = log.join(reduce(DataFrame.unionByName, counts), "fonte")
    return joined.select("fonte", "lidos", "validos", "invalidos", "incompletos", "duplicados", "corrigidos", "carregados")
