"""Master data of contents: matching, survivorship, crosswalk and conflicts.

Groups are reduced by aggregation (combined before the shuffle), never by sorting a whole
group in one task: a group of equal titles may be very large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cascata.functions.text import match_text, padded_master_id
from cascata.operators.skew import lookup


def category_crosswalk(raw_catalog: DataFrame, contents: DataFrame) -> DataFrame:
    """Every raw spelling of a category and the official label it stands for."""
    spelled = raw_catalog.select(
        F.trim("conteudo_id").alias("_id"), F.trim("categoria").alias("valor_origem")
    ).where((F.col("valor_origem") != "") & F.col("_id").rlike(r"^\d+$"))
    per_content = spelled.select(F.col("_id").try_cast("bigint").alias("conteudo_id"), "valor_origem").distinct()
    joined = per_content.join(contents.select("conteudo_id", "categoria"), "conteudo_id")
    return joined.groupBy("valor_origem").agg(F.min("categoria").alias("categoria_canonica"))


def match_key() -> Column:
    """One text per match group; nulls take part as values of their own."""
    parts = F.struct(match_text(F.col("titulo")).alias("t"), F.col("tipo").alias("f"), match_text(F.col("autor")).alias("a"))
    return F.to_json(parts, {"ignoreNullFields": "false"})


def keyed(contents: DataFrame) -> DataFrame:
    return contents.withColumn("_chave", match_key())


def groups(contents: DataFrame) -> DataFrame:
    """One row per match group with its first and its most recent record's values."""
    registered = F.col("conteudo_id")
    recency = F.struct(F.coalesce("data_publicacao", F.lit("0001-01-01").cast("date")), "conteudo_id")
    first = {c: F.min_by(c, registered).alias(c) for c in ["titulo", "tipo", "categoria"]}
    return keyed(contents).groupBy("_chave").agg(
        F.min("conteudo_id").alias("_primeiro"),
        *first.values(),
        F.max_by("nivel", recency).alias("nivel"),
        F.coalesce(F.max_by("carga_horaria_min", recency), F.max("carga_horaria_min")).alias("carga_horaria_min"),
        F.coalesce(F.max_by("data_publicacao", recency), F.max("data_publicacao")).alias("data_publicacao"),
        F.count(F.lit(1)).alias("qtd_registros"),
    ).withColumn("mestre_id", padded_master_id(F.col("_primeiro")))


def master(contents: DataFrame) -> DataFrame:
    return groups(contents).select(
        "mestre_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao", "qtd_registros"
    )


def _members(contents: DataFrame, group_columns: list[Column]) -> DataFrame:
    found = groups(contents).select("_chave", *group_columns)
    return lookup(keyed(contents), found, ["_chave"], "inner")


def crosswalk(contents: DataFrame) -> DataFrame:
    members = _members(contents, [F.col("mestre_id"), F.col("_primeiro"), F.col("qtd_registros")])
    return members.select(
        "conteudo_id", "mestre_id",
        F.when(F.col("qtd_registros") == 1, "unico").otherwise("titulo_normalizado+tipo+autor").alias("regra_match"),
        (F.col("conteudo_id") == F.col("_primeiro")).alias("sobrevivente"),
    )


def conflicts(contents: DataFrame) -> DataFrame:
    """Members of groups with more than one record, source values beside surviving ones."""
    members = _members(contents, [
        F.col("mestre_id"), F.col("_primeiro"), F.col("qtd_registros"), F.col("nivel").alias("nivel_mestre"),
        F.col("carga_horaria_min").alias("carga_mestre"), F.col("data_publicacao").alias("data_mestre"),
    ])
    return members.where(F.col("qtd_registros") > 1).select(
        "mestre_id", "conteudo_id", (F.col("conteudo_id") == F.col("_primeiro")).alias("sobrevivente"),
        "titulo", "tipo", "categoria", F.col("nivel").alias("nivel_origem"), "nivel_mestre",
        F.col("carga_horaria_min").alias("carga_origem"), "carga_mestre",
        F.col("data_publicacao").alias("data_origem"), "data_mestre",
    )


def counts(contents: DataFrame) -> DataFrame:
    return groups(contents).agg(
        F.coalesce(F.sum("qtd_registros"), F.lit(0)).alias("registros_origem"),
        F.count(F.lit(1)).alias("mestres"),
        F.count_if(F.col("qtd_registros") > 1).alias("grupos_com_conflito"),
    )
