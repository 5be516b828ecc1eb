"""KPI views for dashboards and reports, over Silver and the recommendation batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cascata.functions import metrics
from cascata.operators import gold
from cascata.operators.onerow import side_by_side


def metrics_overall(contents: DataFrame, interactions: DataFrame, recommendations: DataFrame) -> DataFrame:
    """One row of headline numbers."""
    measured = gold.overall_counts(interactions).select(
        F.col("usuarios_ativos").alias("total_usuarios"),
        "total_interacoes",
        F.col("avaliacoes").alias("total_avaliacoes"),
        metrics.mean_rating().alias("avaliacao_media_global"),
        F.col("conclusoes").alias("total_conclusoes"),
        metrics.completion_rate().alias("taxa_conclusao_global_pct"),
        metrics.mean_minutes().alias("tempo_medio_consumo_min"),
    )
    catalogue = contents.agg(F.count(F.lit(1)).alias("total_conteudos"))
    batch = gold.last_batch(recommendations).agg(
        F.count(F.lit(1)).alias("total_recomendacoes_lote"),
        metrics.rate_pct(F.count_if(F.col("classificacao") == "Positivo"), F.count(F.lit(1)))
        .alias("taxa_recomendacoes_positivas_pct"),
    )
    return side_by_side(measured, catalogue, batch)


def category_performance(contents: DataFrame, interactions: DataFrame) -> DataFrame:
    grouped = (
        gold.contents_with_counts(contents, interactions)
        .groupBy(F.col("categoria").alias("categoria_nome"), F.col("tipo").alias("tipo_conteudo"))
        .agg(F.count(F.lit(1)).alias("qtd_conteudos"), *metrics.merged_counts())
    )
    return grouped.select(
        "categoria_nome", "tipo_conteudo", "qtd_conteudos", "total_interacoes", "visualizacoes", "inicios",
        "conclusoes", "curtidas", "avaliacoes",
        metrics.completion_rate().alias("taxa_conclusao_pct"),
        metrics.mean_rating().alias("avaliacao_media"),
        metrics.mean_minutes().alias("tempo_medio_consumido_min"),
    )


def daily_evolution(interactions: DataFrame) -> DataFrame:
    return gold.day_counts(interactions).select(
        "data", "total_interacoes", F.col("usuarios_ativos").alias("usuarios_ativos_dia"), "visualizacoes",
        "inicios", "conclusoes", "curtidas", "avaliacoes",
        metrics.mean_rating().alias("avaliacao_media_dia"),
        F.col("tempo_total_min").alias("tempo_total_consumido_min"),
    )


def last_days(interactions: DataFrame, days: int = 10) -> DataFrame:
    return daily_evolution(interactions).orderBy(F.desc("data")).limit(days)


def content_analysis(contents: DataFrame, interactions: DataFrame) -> DataFrame:
    """Per content with its attributes; distinct users come from (content, user) partial counts."""
    per_user = interactions.groupBy("conteudo_id", "usuario_id").agg(*metrics.engagement_counts())
    sums = [F.sum(c).alias(c) for c in metrics.COUNT_NAMES]
    counted = per_user.groupBy("conteudo_id").agg(F.count("usuario_id").alias("usuarios_distintos"), *sums)
    return contents.join(counted, "conteudo_id", "left").na.fill(
        0, ["total_interacoes", "usuarios_distintos", "visualizacoes", "inicios", "conclusoes", "avaliacoes",
            "com_tempo"]
    ).select(
        "conteudo_id", "titulo", F.col("categoria").alias("categoria_nome"), "tipo", "nivel",
        "carga_horaria_min", "data_publicacao", "autor", "total_interacoes", "usuarios_distintos",
        "visualizacoes", "conclusoes",
        metrics.completion_rate().alias("taxa_conclusao_pct"),
        metrics.mean_rating().alias("avaliacao_media"),
        metrics.mean_minutes().alias("tempo_medio_minutos"),
    )


def top_contents_by_rate(
    contents: DataFrame, interactions: DataFrame, minimum: int = 5, limit: int = 5
) -> DataFrame:
    """Best completion rates; nulls lead a descending order as they do in the source report."""
    return (
        content_analysis(contents, interactions)
        .where(F.col("total_interacoes") >= minimum)
        .orderBy(F.desc_nulls_first("taxa_conclusao_pct"), F.desc_nulls_first("avaliacao_media"), "conteudo_id")
        .limit(limit)
        .select("conteudo_id", "titulo", "categoria_nome", "tipo", "nivel", "taxa_conclusao_pct", "avaliacao_media")
    )


def rec_summary(recommendations: DataFrame, contents: DataFrame) -> DataFrame:
    """Last batch by category and class. Scores carry two decimals, so cents are summed whole."""
    cents = (F.col("pontuacao") * 100).cast("bigint")
    per_content = (
        gold.last_batch(recommendations)
        .groupBy("conteudo_id", "classificacao")
        .agg(
            F.count(F.lit(1)).alias("_n"), F.sum(cents).alias("_soma"), F.min(cents).alias("_min"),
            F.max(cents).alias("_max"), F.max("gerado_em").alias("_lote"),
        )
    )
    grouped = (
        per_content.join(contents.select("conteudo_id", "categoria"), "conteudo_id")
        .groupBy(F.col("categoria").alias("categoria_nome"), "classificacao")
        .agg(
            F.sum("_n").alias("qtd_recomendacoes"), F.sum("_soma").alias("_soma"), F.min("_min").alias("_min"),
            F.max("_max").alias("_max"), F.max("_lote").alias("lote_gerado_em"),
        )
    )
    return grouped.select(
        "categoria_nome", "classificacao", "qtd_recomendacoes",
        metrics.ratio(F.col("_soma"), F.col("qtd_recomendacoes") * 100, 2).alias("pontuacao_media"),
        (F.col("_min") / 100).cast("decimal(5,2)").alias("pontuacao_min"),
        (F.col("_max") / 100).cast("decimal(5,2)").alias("pontuacao_max"),
        "lote_gerado_em",
    )


def format_engagement(contents: DataFrame, interactions: DataFrame) -> DataFrame:
    return (
        gold.format_counts(contents, interactions)
        .select(
            F.col("tipo").alias("formato_conteudo"), F.col("qtd_conteudos").alias("total_conteudos_catalogo"),
            "total_interacoes", "visualizacoes", "inicios", "conclusoes",
            metrics.completion_rate().alias("taxa_conclusao_pct"),
            metrics.mean_rating().alias("avaliacao_media"),
            metrics.mean_minutes().alias("tempo_medio_consumido_min"),
            metrics.ratio(F.col("soma_carga"), F.col("peso_carga"), 1).alias("carga_horaria_media_estimada_min"),
        )
        .orderBy(F.desc("total_interacoes"))
    )


def rec_conversion(recommendations: DataFrame, interactions: DataFrame) -> DataFrame:
    pairs = gold.converting_pairs(interactions).withColumn("_convertida", F.lit(1))
    joined = gold.last_batch(recommendations).join(pairs, ["usuario_id", "conteudo_id"], "left")
    used = F.col("_convertida").isNotNull()
    positive, stable = F.col("classificacao") == "Positivo", F.col("classificacao") == "Estável"
    counted = joined.agg(
        F.count(F.lit(1)).alias("total_recomendacoes_geradas"),
        F.count_if(used).alias("total_recomendacoes_consumidas"),
        F.count_if(positive).alias("total_positivas"),
        F.count_if(positive & used).alias("positivas_consumidas"),
        F.count_if(stable).alias("total_estaveis"),
        F.count_if(stable & used).alias("estaveis_consumidas"),
    )

    def share(part: str, whole: str) -> Column:
        return metrics.rate_pct(F.col(part), F.col(whole))

    return counted.select(
        "*",
        share("total_recomendacoes_consumidas", "total_recomendacoes_geradas").alias("taxa_conversao_global_pct"),
        share("positivas_consumidas", "total_positivas").alias("taxa_conversao_positivos_pct"),
        share("estaveis_consumidas", "total_estaveis").alias("taxa_conversao_estaveis_pct"),
    )


def rec_selectivity(batch_log: DataFrame) -> DataFrame:
    """Persisted share of the evaluated candidates and positive share of the persisted, newest log."""
    newest = batch_log.agg(F.max("gerado_em").alias("gerado_em"))
    return batch_log.join(F.broadcast(newest), "gerado_em").select(
        "gerado_em", F.col("persistidas").alias("recomendacoes_persistidas"), "descartadas_pontuacao",
        "descartadas_conclusao", F.col("total_avaliados").alias("total_candidatos_avaliados"),
        metrics.rate_pct(F.col("persistidas"), F.col("total_avaliados")).alias("taxa_seletividade_pct"),
        metrics.rate_pct(F.col("positivas"), F.col("persistidas")).alias("taxa_alta_afinidade_pct"),
    )


def ingestion_quality(ingestion_log: DataFrame) -> DataFrame:
    """Newest log entry of each source; ``id`` grows with each entry."""
    newest = ingestion_log.groupBy("fonte").agg(F.max("id").alias("id"))
    return ingestion_log.join(newest, ["fonte", "id"]).select(
        "fonte", "lidos", "validos", "corrigidos", "invalidos", "incompletos", "duplicados",
        metrics.rate_pct(F.col("corrigidos"), F.col("lidos")).alias("taxa_correcao_pct"),
        metrics.rate_pct(F.col("validos"), F.col("lidos")).alias("taxa_conformidade_pct"),
    )


def daily_category(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """Dashboard dataset: day x category x type with month and kind of day."""
    return (
        fact.join(dimension.select("conteudo_id", "categoria", "tipo"), "conteudo_id")
        .groupBy("data", "categoria", "tipo")
        .agg(
            F.sum("total_interacoes").alias("total_interacoes"),
            F.sum("conclusoes").alias("conclusoes"),
            F.sum(F.col("inicios") + F.col("visualizacoes")).alias("inicios_visualizacoes"),
        )
        .withColumn("mes", F.trunc("data", "month"))
        .withColumn("tipo_dia", F.when(F.weekday("data") >= 5, "fim de semana").otherwise("dia útil"))
    )


def rate_tier(part: Column, whole: Column) -> Column:
    """Tier of ``100 * part / whole`` without dividing; no rate counts as low."""
    return (
        F.when((whole > 0) & (100 * part >= 30 * whole), "alta")
        .when((whole > 0) & (100 * part >= 20 * whole), "média")
        .otherwise("baixa")
    )


def monthly_category(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    grouped = (
        fact.join(dimension.select("conteudo_id", "categoria"), "conteudo_id")
        .groupBy(F.trunc("data", "month").alias("mes"), "categoria")
        .agg(
            F.sum("conclusoes").alias("conclusoes"),
            F.sum(F.col("inicios") + F.col("visualizacoes")).alias("inicios_visualizacoes"),
        )
    )
    return grouped.select(
        "*",
        metrics.rate_pct(F.col("conclusoes"), F.col("inicios_visualizacoes")).alias("taxa_conclusao_pct"),
        rate_tier(F.col("conclusoes"), F.col("inicios_visualizacoes")).alias("faixa_conclusao"),
    )


def format_ranking(kpi_format: DataFrame) -> DataFrame:
    """Formats by completion rate; the input has one row per content type."""
    by_rate = Window.orderBy(F.desc_nulls_first("taxa_conclusao_pct"))
    return kpi_format.select(
        "formato", "qtd_conteudos", "total_interacoes", "taxa_conclusao_pct", "avaliacao_media",
        F.rank().over(by_rate).alias("posicao_retencao"),
    )


def conversion_status(kpi_conversion: DataFrame, kpi_overall: DataFrame, goal: float = 8) -> DataFrame:
    """Text of the conversion goal beside the number of active users."""
    return side_by_side(kpi_conversion, kpi_overall.select("usuarios_ativos")).select(
        "total_recomendacoes", "recomendacoes_com_interacao", "taxa_conversao_pct", "usuarios_ativos",
        F.when(F.col("taxa_conversao_pct") < goal, "dispara alerta").otherwise("dentro da meta").alias("situacao"),
        F.date_format("lote_gerado_em", "yyyy-MM-dd HH:mm").alias("lote_recomendacao"),
    )


def alert_rec_conversion(kpi_conversion: DataFrame, threshold: float = 8) -> DataFrame:
    return kpi_conversion.select(
        F.col("taxa_conversao_pct").alias("valor"),
        F.lit(threshold).cast("double").alias("limite"),
        F.coalesce(F.col("taxa_conversao_pct") < threshold, F.lit(False)).alias("dispara"),
    )


def tile_active_users(kpi_overall: DataFrame) -> DataFrame:
    return kpi_overall.agg(F.max("usuarios_ativos").alias("usuarios_ativos"))


def tile_sum_by_date(
    daily: DataFrame,
    period: tuple[str, str] | None = None,
    category: list[str] | None = None,
    content_type: list[str] | None = None,
) -> DataFrame:
    """Interactions per day under the dashboard's period, category and type filters."""
    kept = daily
    if period is not None:
        first, after = (F.lit(d).cast("date") for d in period)
        kept = kept.where((F.col("data") >= first) & (F.col("data") < after))
    if category:
        kept = kept.where(F.col("categoria").isin(category))
    if content_type:
        kept = kept.where(F.col("tipo").isin(content_type))
    return kept.groupBy("data").agg(F.sum("total_interacoes").alias("total_interacoes"))


def tile_rate_by_category(kpi_category: DataFrame, category: list[str] | None = None) -> DataFrame:
    kept = kpi_category.where(F.col("categoria").isin(category)) if category else kpi_category
    return kept.groupBy("categoria", "tipo").agg(F.max("taxa_conclusao_pct").alias("taxa_conclusao_pct"))


def tile_sum_by_category(kpi_category: DataFrame) -> DataFrame:
    return kpi_category.groupBy("categoria").agg(F.sum("total_interacoes").alias("total_interacoes"))


def _listed(section: str, rows: DataFrame, item: Column, measures: list[str]) -> DataFrame:
    """One row per measure of each row: section, item, measure, value."""
    entries = [F.struct(F.lit(section).alias("secao"), item.alias("item"), F.lit(m).alias("medida"), F.col(m).cast("double").alias("valor")) for m in measures]
    return rows.select(F.inline(F.array(*entries)))


# The sections of the report and the measures of each.
OPERATIONAL = ["total_usuarios", "total_conteudos", "total_interacoes", "total_avaliacoes", "tempo_medio_consumo_min", "total_recomendacoes_lote"]
STRATEGIC = ["taxa_conclusao_global_pct", "avaliacao_media_global", "taxa_recomendacoes_positivas_pct"]
BY_CATEGORY = ["qtd_conteudos", "total_interacoes", "taxa_conclusao_pct", "avaliacao_media"]
BY_DAY = ["total_interacoes", "visualizacoes", "conclusoes", "avaliacao_media_dia"]
OF_BATCH = ["qtd_recomendacoes", "pontuacao_media"]


def summary_report(contents: DataFrame, interactions: DataFrame, recommendations: DataFrame) -> DataFrame:
    """The whole KPI report as rows: headline numbers, categories, the last ten days, the last batch."""
    head = metrics_overall(contents, interactions, recommendations)
    parts = [
        _listed("metricas_operacionais", head, F.lit("geral"), OPERATIONAL),
        _listed("kpis_estrategicos", head, F.lit("geral"), STRATEGIC),
        _listed("desempenho_por_categoria", category_performance(contents, interactions), F.concat_ws(" / ", "categoria_nome", "tipo_conteudo"), BY_CATEGORY),
        _listed("evolucao_temporal_recente", last_days(interactions), F.date_format("data", "yyyy-MM-dd"), BY_DAY),
        _listed("distribuicao_recomendacoes", rec_summary(recommendations, contents), F.concat_ws(" / ", "categoria_nome", "classificacao"), OF_BATCH),
    ]
    return reduce(DataFrame.unionByName, parts)
