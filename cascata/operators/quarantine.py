"""Quarantine: status counts and reprocessing of pending rows from their raw payload.

``id`` grows with each entry. A rejected catalogue row goes back in as a new entry; a
rejected interaction or comment simply stays pending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cascata.functions import casts, text
from cascata.operators import rules
from cascata.operators.silver import CONTENT_MESSAGES, bad_comment_rating, content_rules, typed_comment, typed_content
from cascata.operators.skew import lookup, newest_per_key
from cascata.schemas import (
    AUDIT_COLUMNS,
    CATALOG_COLUMNS,
    COMMENT_COLUMNS,
    INTERACTION_COLUMNS,
    INTERACTION_TYPES,
    text_schema,
)
from cascata.session import materialize

# Fixed value: a pending catalogue row is a duplicate when Silver already has its content.
REPROCESS_MESSAGES = CONTENT_MESSAGES | {"DUPLICADO": "conteudo_id ja existe em silver.conteudo; nada a reprocessar"}


def status_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("origem", "status").agg(F.count(F.lit(1)).alias("total"))


def pending_payloads(quarantine: DataFrame, source: str, columns: list[str]) -> DataFrame:
    """Newest pending entry of each record, its payload parsed back into Bronze columns.

    The parsed fields come out of a generator, below which no filter on them can be moved: each payload is parsed once.
    """
    pending = quarantine.where((F.col("status") == "pendente") & (F.col("origem") == source))
    latest = newest_per_key(pending.select("id", "registro_id", "payload_original"), ["registro_id"], "id")
    return latest.select(
        F.col("id").alias("quarentena_id"), "registro_id",
        F.col("payload_original").alias("_payload"),
        F.inline(F.array(F.from_json("payload_original", text_schema(columns + AUDIT_COLUMNS)))),
    )


def only_first(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Among rows about to enter Silver under one key, the one that was quarantined first."""
    firsts = rows.groupBy(*keys).agg(F.min("quarentena_id").alias("_primeira")).select("_primeira")
    return rows.join(firsts.hint("merge"), rows["quarentena_id"] == firsts["_primeira"], "left_semi")


def mark_reprocessed(quarantine: DataFrame, source: str, accepted: DataFrame) -> DataFrame:
    """All pending entries of an accepted record become ``reprocessado``."""
    done = accepted.select("registro_id").distinct().withColumn("_aceito", F.lit(True))
    turned = (F.col("origem") == source) & (F.col("status") == "pendente") & F.col("_aceito").isNotNull()
    return lookup(quarantine, done, ["registro_id"]).select(
        *[c for c in quarantine.columns if c != "status"],
        F.when(turned, "reprocessado").otherwise(F.col("status")).alias("status"),
    ).select(quarantine.columns)


def referenced(rows: DataFrame, contents: DataFrame) -> DataFrame:
    return lookup(rows, contents.select("conteudo_id"), ["conteudo_id"], "left_semi")


def absent_from(rows: DataFrame, silver: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(silver.select(*keys).hint("merge"), keys, "left_anti")


def reprocess_catalog(quarantine: DataFrame, contents: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows for Silver, quarantine with new status, new quarantine entries)."""
    typed = typed_content(pending_payloads(quarantine, "catalogo", CATALOG_COLUMNS))
    known = contents.select("conteudo_id").withColumn("_existe", F.lit(True))
    ordered = content_rules(REPROCESS_MESSAGES, F.col("_existe").isNotNull())
    judged = rules.apply_rules(lookup(typed, known, ["conteudo_id"]), ordered)
    judged = materialize(judged, "rejulgados")
    accepted = only_first(rules.approved(judged), ["conteudo_id"])
    renewed = rules.rejected(judged).select(
        "registro_id", F.lit("catalogo").alias("origem"), "regra_violada", "mensagem",
        F.lit(run_id).alias("execucao_id"), F.col("_payload").alias("payload_original"),
        F.lit("pendente").alias("status"),
    )
    return accepted, mark_reprocessed(quarantine, "catalogo", accepted), renewed


def lowered_label(c: Column) -> Column:
    """Reprocessing accepts any case and the unaccented spellings; unknown text is lower-cased."""
    return text.official_label(F.lower(F.trim(c)), INTERACTION_TYPES)


def pending_interactions(quarantine: DataFrame) -> DataFrame:
    raw = pending_payloads(quarantine, "interacoes", INTERACTION_COLUMNS)
    return raw.withColumns({
        "usuario_id": casts.positive_id(F.col("usuario_id")),
        "conteudo_id": casts.digits_to_long(F.col("conteudo_id")),
        "tipo_interacao": lowered_label(F.col("tipo_interacao")),
        "data_hora": casts.iso_timestamp(F.trim("data_hora")),
        "tempo_consumido": casts.rounded_not_negative(F.trim("tempo_consumido")),
        "percentual_conclusao": casts.rounded_decimal(F.trim("percentual_conclusao"), 2),
        "avaliacao_atribuida": casts.rounded_long(F.trim("avaliacao_atribuida")),
    })


def reprocess_interactions(
    quarantine: DataFrame, contents: DataFrame, interactions: DataFrame, run_id: str
) -> tuple[DataFrame, DataFrame]:
    """(rows for Silver, quarantine with new status)."""
    keys = ["usuario_id", "conteudo_id", "data_hora"]
    fit = pending_interactions(quarantine).where(
        F.col("usuario_id").isNotNull()
        & F.col("tipo_interacao").isin(INTERACTION_TYPES)
        & F.col("data_hora").isNotNull()
        & F.col("percentual_conclusao").between(0, 100)
        & (F.col("avaliacao_atribuida").isNull() | F.col("avaliacao_atribuida").between(1, 5))
    )
    fresh = materialize(absent_from(referenced(fit, contents), interactions, keys), "candidatos")
    accepted = only_first(fresh, keys).withColumn("execucao_id", F.lit(run_id))
    return accepted, mark_reprocessed(quarantine, "interacoes", accepted)


def reprocess_comments(
    quarantine: DataFrame, contents: DataFrame, comments: DataFrame, run_id: str
) -> tuple[DataFrame, DataFrame]:
    keys = ["usuario_id", "conteudo_id", "data"]
    typed = typed_comment(pending_payloads(quarantine, "comentarios", COMMENT_COLUMNS))
    fit = typed.where(
        F.col("usuario_id").isNotNull() & F.col("data").isNotNull() & ~F.coalesce(bad_comment_rating(), F.lit(False))
    )
    fresh = materialize(absent_from(referenced(fit, contents), comments, keys), "candidatos")
    accepted = only_first(fresh, keys).withColumn("execucao_id", F.lit(run_id))
    return accepted, mark_reprocessed(quarantine, "comentarios", accepted)


def reprocess_report(quarantine: DataFrame) -> DataFrame:
    kept = quarantine.where(F.col("origem").isin("interacoes", "comentarios"))
    return kept.groupBy("origem").agg(
        F.count_if(F.col("status") == "reprocessado").alias("reprocessados"),
        F.count_if(F.col("status") == "pendente").alias("ainda_pendentes"),
    )


def corrupt_file_entries(corrupt: DataFrame, run_id: str) -> DataFrame:
    """One entry per unreadable file; an empty file list is not a fault."""
    return corrupt.select(
        F.monotonically_increasing_id().alias("id"),
        F.concat(F.lit("arquivo:"), F.col("arquivo")).alias("registro_id"),
        F.col("origem"), F.lit("ARQUIVO_CORROMPIDO").alias("regra_violada"),
        F.col("erro").alias("mensagem"), F.lit(run_id).alias("execucao_id"),
        F.lit("{}").alias("payload_original"), F.lit("pendente").alias("status"),
    ).where(~F.contains(F.col("mensagem"), F.lit("No file(s) specified")))
