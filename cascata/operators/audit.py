"""Stage events, per-stage summary and the verdict of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cascata.operators.onerow import side_by_side

EVENT_SCHEMA = T.StructType([
    T.StructField("execucao_id", T.StringType()),
    T.StructField("etapa", T.StringType()),
    T.StructField("evento", T.StringType()),
    T.StructField("resultado", T.StringType()),
    T.StructField("instante", T.TimestampType()),
])


def stage_event(spark: SparkSession, run_id: str, stage: str, event: str, result: str | None) -> DataFrame:
    one = spark.range(1).select(
        F.lit(run_id).alias("execucao_id"), F.lit(stage).alias("etapa"), F.lit(event).alias("evento"),
        F.lit(result).cast("string").alias("resultado"), F.current_timestamp().alias("instante"),
    )
    return one


def stage_summary(events: DataFrame, quarantine: DataFrame, run_id: str) -> DataFrame:
    """First start, last end, seconds and result per stage, with the verdict of the whole run."""
    ended = F.col("evento") == "fim"
    stages = events.where(F.col("execucao_id") == run_id).groupBy("etapa").agg(
        F.min(F.when(F.col("evento") == "inicio", F.col("instante"))).alias("inicio"),
        F.max(F.when(ended, F.col("instante"))).alias("fim"),
        F.max(F.when(ended, F.col("resultado"))).alias("resultado"),
    )
    worst = stages.agg(
        F.count_if(F.col("resultado") == "falha").alias("_falhas"),
        F.count_if(F.col("resultado") == "sucesso com ressalvas").alias("_ressalvas"),
    )
    waiting = quarantine.where((F.col("execucao_id") == run_id) & (F.col("status") == "pendente")).agg(
        F.count(F.lit(1)).alias("_pendentes")
    )
    final = side_by_side(worst, waiting).select(
        F.lit(run_id).alias("execucao_id"),
        F.when(F.col("_falhas") > 0, "falha")
        .when((F.col("_ressalvas") > 0) | (F.col("_pendentes") > 0), "sucesso com ressalvas")
        .otherwise("sucesso").alias("resultado_final"),
    )
    seconds = (F.unix_micros(F.col("fim").cast("timestamp")) - F.unix_micros(F.col("inicio").cast("timestamp"))) / 1e6
    return stages.withColumn("execucao_id", F.lit(run_id)).join(final, "execucao_id").select(
        "etapa",
        F.date_format("inicio", "yyyy-MM-dd HH:mm:ss").alias("inicio"),
        F.date_format("fim", "yyyy-MM-dd HH:mm:ss").alias("fim"),
        F.round(seconds, 3).alias("duracao_segundos"),
        "resultado", "resultado_final", "execucao_id",
    ).orderBy("inicio")
