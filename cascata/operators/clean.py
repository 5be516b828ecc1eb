"""Cleaner: trimmed text, canonical labels, safe casts, first-occurrence dedupe, counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cascata.functions import casts, text
from cascata.operators.skew import mark_repeats
from cascata.schemas import (
    CATALOG_COLUMNS,
    CATEGORIES,
    COMMENT_COLUMNS,
    CONTENT_TYPES,
    INTERACTION_COLUMNS,
    INTERACTION_TYPES,
    LEVELS,
)

ORDER = "ordem"


NEW = "_novo_"


def text_changed(column: str) -> Column:
    """The raw text, ends stripped, differs from the treated value as text."""
    return ~text.strip(F.col(column)).eqNullSafe(F.col(NEW + column).cast("string"))


def any_of(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)


def _treated(raw: DataFrame, new: dict[str, Column], changed: list[Column], keys: list[str]) -> DataFrame:
    """Treated columns plus ``alterado``; rows after the first of a key are marked ``repetida``.

    Treated values are computed once, under names of their own, and then compared.
    """
    staged = raw.withColumns({NEW + c: e for c, e in new.items()})
    judged = staged.withColumn("alterado", any_of(changed)).withColumns({c: F.col(NEW + c) for c in new})
    return mark_repeats(judged.drop(*[NEW + c for c in new]), keys, ORDER)


def treat_catalog(raw: DataFrame) -> DataFrame:
    new = {c: text.clean_text(F.col(c)) for c in ["titulo", "descricao", "autor"]}
    new |= {
        "tipo": text.canonical_label(F.col("tipo"), CONTENT_TYPES),
        "categoria": text.canonical_label(F.col("categoria"), CATEGORIES),
        "nivel": text.canonical_label(F.col("nivel"), LEVELS),
        "carga_horaria_min": casts.whole_number(F.col("carga_horaria_min")),
        "data_publicacao": F.trim("data_publicacao").try_cast("date"),
    }
    return _treated(raw, new, [text_changed(c) for c in new], ["conteudo_id"])


def treat_interactions(raw: DataFrame) -> DataFrame:
    when = F.date_format(F.trim("data_hora").try_cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss")
    percent, rounded = F.trim("percentual_conclusao").try_cast(casts.WIDE), F.col(NEW + "percentual_conclusao")
    new = {
        "tipo_interacao": text.canonical_label(F.col("tipo_interacao"), INTERACTION_TYPES),
        "data_hora": when,
        "tempo_consumido": casts.whole_number(F.col("tempo_consumido")),
        "percentual_conclusao": F.round(percent, 2),
        "avaliacao_atribuida": casts.whole_number(F.col("avaliacao_atribuida")),
    }
    changed = [text_changed(c) for c in new if c != "percentual_conclusao"]
    changed.append(~percent.eqNullSafe(rounded) | (rounded.isNull() & F.col("percentual_conclusao").isNotNull()))
    return _treated(raw, new, changed, ["usuario_id", "conteudo_id", "data_hora"])


def treat_comments(raw: DataFrame) -> DataFrame:
    new = {
        "comentario": text.clean_text(F.col("comentario")),
        "avaliacao": casts.whole_number(F.col("avaliacao")),
        "data": F.trim("data").try_cast("date"),
    }
    changed = [text_changed(c) for c in new]
    changed.append(~F.from_json("tags", "array<string>").eqNullSafe(F.col(NEW + "tags")))
    new["tags"] = text.normalize_tags(F.col("tags"))
    return _treated(raw, new, changed, ["usuario_id", "conteudo_id", "data"])


def kept(treated: DataFrame, columns: list[str]) -> DataFrame:
    """First occurrences only, source columns only."""
    return treated.where(~F.col("repetida")).select(ORDER, *columns)


def clean_catalog(raw: DataFrame) -> DataFrame:
    return kept(treat_catalog(raw), CATALOG_COLUMNS)


def clean_interactions(raw: DataFrame) -> DataFrame:
    return kept(treat_interactions(raw), INTERACTION_COLUMNS)


def clean_comments(raw: DataFrame) -> DataFrame:
    return kept(treat_comments(raw), COMMENT_COLUMNS)


def count_corrected(treated: DataFrame, source: str) -> DataFrame:
    """Rows with a changed field plus duplicates removed, as one row."""
    return treated.agg(
        F.count(F.lit(1)).alias("lidos"),
        F.count_if("alterado").alias("alterados"),
        F.count_if("repetida").alias("removidos"),
        (F.count_if("alterado") + F.count_if("repetida")).alias("corrigidos"),
    ).select(F.lit(source).alias("fonte"), "*")


def count_missing(rows: DataFrame, source: str, columns: list[str]) -> DataFrame:
    """Nulls per column in one pass; nothing is filled in."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("ausentes")) for c in columns]
    return counted.select(F.lit(source).alias("fonte"), F.inline(F.array(*pairs)))


def distinct_users(interactions: DataFrame) -> DataFrame:
    number = F.col("usuario_id").try_cast("bigint").alias("usuario_id")
    ids = interactions.where(F.col("usuario_id").isNotNull()).select(number).distinct()
    return ids.orderBy("usuario_id")
