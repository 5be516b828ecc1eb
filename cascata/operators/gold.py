"""Gold: content dimension, daily engagement fact and the KPI tables.

Interactions are counted per content before they meet the catalogue, so the only shuffle
of interaction rows carries partial counts and no hot content reaches a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cascata.functions import metrics
from cascata.operators.onerow import side_by_side
from cascata.schemas import AUDIT_COLUMNS

CONVERTING_TYPES = ["visualização", "início", "conclusão", "curtida"]


def dim_content(contents: DataFrame, run_id: str) -> DataFrame:
    return contents.select(
        "conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao",
        "autor", *[c for c in AUDIT_COLUMNS if c != "execucao_id"],
        F.col("execucao_id").alias("execucao_id_silver"), F.lit(run_id).alias("execucao_id"),
    )


def fact_rows(counted: DataFrame, run_id: str) -> DataFrame:
    """The fact from sums by content and day."""
    return counted.select(
        "conteudo_id", "data", "total_interacoes", "visualizacoes", "inicios", "conclusoes", "curtidas",
        "avaliacoes",
        F.coalesce("soma_avaliacao", F.lit(0)).alias("soma_avaliacao"),
        F.coalesce("tempo_total_min", F.lit(0)).alias("tempo_total_min"),
        F.lit(run_id).alias("execucao_id"),
    )


def fact_engagement_day(interactions: DataFrame, run_id: str) -> DataFrame:
    dated = interactions.withColumn("data", F.to_date("data_hora"))
    return fact_rows(dated.groupBy("conteudo_id", "data").agg(*metrics.engagement_counts()), run_id)


def counts_per_content(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("conteudo_id").agg(*metrics.engagement_counts())


def contents_with_counts(contents: DataFrame, interactions: DataFrame) -> DataFrame:
    """One row per content, contents without activity kept."""
    return contents.join(counts_per_content(interactions), "conteudo_id", "left")


def group_counts(joined: DataFrame, *keys: str) -> DataFrame:
    """Sums by category and type, or by other columns, over contents with their counts.

    The mean workload weighs a content by its joined rows, one at least.
    """
    weight = F.greatest(F.coalesce("total_interacoes", F.lit(0)), F.lit(1))
    weighed = joined.withColumns({
        "_carga": F.col("carga_horaria_min") * weight,
        "_peso": F.when(F.col("carga_horaria_min").isNotNull(), weight),
    })
    return weighed.groupBy(*(keys or ("categoria", "tipo"))).agg(
        F.count(F.lit(1)).alias("qtd_conteudos"), *metrics.merged_counts(),
        F.sum("_carga").alias("soma_carga"), F.sum("_peso").alias("peso_carga"),
    )


def merge_groups(grouped: DataFrame, *keys: str) -> DataFrame:
    """Sums by fewer columns from sums by more."""
    sums = ["qtd_conteudos", *metrics.COUNT_NAMES, "soma_carga", "peso_carga"]
    return grouped.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def category_rows(grouped: DataFrame, run_id: str) -> DataFrame:
    return grouped.select(
        "categoria", "tipo", "qtd_conteudos", "total_interacoes", "visualizacoes", "inicios", "conclusoes",
        metrics.completion_rate().alias("taxa_conclusao_pct"),
        metrics.mean_rating().alias("avaliacao_media"),
        metrics.mean_minutes().alias("tempo_medio_min"),
        F.lit(run_id).alias("execucao_id"),
    )


def kpi_category(contents: DataFrame, interactions: DataFrame, run_id: str) -> DataFrame:
    return category_rows(group_counts(contents_with_counts(contents, interactions)), run_id)


def format_counts(contents: DataFrame, interactions: DataFrame) -> DataFrame:
    return group_counts(contents_with_counts(contents, interactions), "tipo")


def format_rows(grouped: DataFrame, run_id: str) -> DataFrame:
    return grouped.select(
        F.col("tipo").alias("formato"), "qtd_conteudos", "total_interacoes", "visualizacoes", "inicios",
        "conclusoes",
        metrics.completion_rate().alias("taxa_conclusao_pct"),
        metrics.mean_rating().alias("avaliacao_media"),
        metrics.mean_minutes().alias("tempo_medio_min"),
        metrics.ratio(F.col("soma_carga"), F.col("peso_carga"), 1).alias("carga_horaria_media_min"),
        F.lit(run_id).alias("execucao_id"),
    )


def kpi_format(contents: DataFrame, interactions: DataFrame, run_id: str) -> DataFrame:
    return format_rows(format_counts(contents, interactions), run_id)


def merged_days(per_user: DataFrame) -> DataFrame:
    """Sums per day and its distinct users, from sums by day and user."""
    sums = [F.sum(c).alias(c) for c in metrics.COUNT_NAMES]
    return per_user.groupBy("data").agg(F.count("usuario_id").alias("usuarios_ativos"), *sums)


def day_counts(interactions: DataFrame) -> DataFrame:
    """Per day; distinct users are counted over (day, user) partial counts, in two steps."""
    dated = interactions.withColumn("data", F.to_date("data_hora"))
    return merged_days(dated.groupBy("data", "usuario_id").agg(*metrics.engagement_counts()))


def day_rows(days: DataFrame, run_id: str) -> DataFrame:
    return days.select(
        "data", "total_interacoes", "usuarios_ativos", "conclusoes",
        metrics.mean_rating().alias("avaliacao_media"),
        F.coalesce("tempo_total_min", F.lit(0)).alias("tempo_total_min"),
        F.lit(run_id).alias("execucao_id"),
    )


def kpi_day(interactions: DataFrame, run_id: str) -> DataFrame:
    return day_rows(day_counts(interactions), run_id)


def last_batch(recommendations: DataFrame) -> DataFrame:
    newest = recommendations.agg(F.max("gerado_em").alias("gerado_em"))
    return recommendations.join(F.broadcast(newest), "gerado_em")


def converting_pairs(interactions: DataFrame) -> DataFrame:
    kept = interactions.where(F.col("tipo_interacao").isin(CONVERTING_TYPES))
    return kept.select("usuario_id", "conteudo_id").distinct()


def conversion_rows(recommendations: DataFrame, pairs: DataFrame, run_id: str) -> DataFrame:
    """Conversion of the last batch, given the distinct pairs that converted."""
    counted = (
        last_batch(recommendations)
        .join(pairs.withColumn("_convertida", F.lit(1)).hint("merge"), ["usuario_id", "conteudo_id"], "left")
        .agg(
            F.count(F.lit(1)).alias("total_recomendacoes"),
            F.count("_convertida").alias("recomendacoes_com_interacao"),
            F.max("gerado_em").alias("lote_gerado_em"),
        )
    )
    return counted.select(
        "total_recomendacoes", "recomendacoes_com_interacao",
        metrics.rate_pct(F.col("recomendacoes_com_interacao"), F.col("total_recomendacoes")).alias("taxa_conversao_pct"),
        "lote_gerado_em", F.lit(run_id).alias("execucao_id"),
    )


def kpi_rec_conversion(recommendations: DataFrame, interactions: DataFrame, run_id: str) -> DataFrame:
    return conversion_rows(recommendations, converting_pairs(interactions), run_id)


def merged_users(per_user: DataFrame) -> DataFrame:
    """One row of sums and distinct users, from sums by user."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in metrics.COUNT_NAMES]
    return per_user.agg(F.count("usuario_id").alias("usuarios_ativos"), *sums)


def overall_counts(interactions: DataFrame) -> DataFrame:
    """One row over all interactions; users are counted from per-user partial counts."""
    return merged_users(interactions.groupBy("usuario_id").agg(*metrics.engagement_counts()))


def overall_rows(measured: DataFrame, contents: DataFrame, conversion: DataFrame, run_id: str) -> DataFrame:
    """One row of headline numbers from one row of sums."""
    measured = measured.select(
        "usuarios_ativos", "total_interacoes",
        metrics.completion_rate().alias("taxa_conclusao_pct"),
        metrics.mean_rating().alias("avaliacao_media"),
        metrics.mean_minutes().alias("tempo_medio_min"),
    )
    catalogue = contents.agg(F.count(F.lit(1)).alias("total_conteudos"))
    conversion = conversion.select(
        "total_recomendacoes", F.col("taxa_conversao_pct").alias("taxa_conversao_recomendacao_pct")
    )
    return side_by_side(measured, catalogue, conversion).withColumn("execucao_id", F.lit(run_id))


def kpi_overall(
    contents: DataFrame, interactions: DataFrame, conversion: DataFrame, run_id: str
) -> DataFrame:
    return overall_rows(overall_counts(interactions), contents, conversion, run_id)


def engines_agree(left: DataFrame, right: DataFrame) -> DataFrame:
    """Compare a fact computed two ways, as sets of whole rows with their multiplicity.

    Rows are grouped once with a signed count, so neither side is collected or sorted.
    """
    columns = left.columns
    signed = left.withColumn("_lado", F.lit(1)).unionByName(right.select(columns).withColumn("_lado", F.lit(-1)))
    per_row = signed.groupBy(*columns).agg(
        F.sum("_lado").alias("_saldo"),
        F.count_if(F.col("_lado") == 1).alias("_a"),
        F.count_if(F.col("_lado") == -1).alias("_b"),
    )
    return per_row.agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("linhas_a"),
        F.coalesce(F.sum("_b"), F.lit(0)).alias("linhas_b"),
        F.count_if(F.col("_saldo") != 0).alias("linhas_diferentes"),
        (F.count_if(F.col("_saldo") != 0) == 0).alias("iguais"),
    )
