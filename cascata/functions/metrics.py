"""Measures shared by Gold and the KPI views, each written once."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_conclusion() -> Column:
    return (F.col("tipo_interacao") == "conclusão") | (F.col("percentual_conclusao") >= 100)


def is_started_or_viewed() -> Column:
    return F.col("tipo_interacao").isin("início", "visualização")


def ratio(numerator: Column, denominator: Column, places: int, factor: int = 1) -> Column:
    """``factor * numerator / denominator`` rounded half up, exact, null when there is nothing to divide.

    Both inputs are whole and not negative, so the rounding is done on whole numbers:
    a double quotient would round some ties the wrong way.
    """
    scale = 10**places
    scaled = numerator.cast("decimal(30,0)") * (2 * factor * scale) + denominator
    # floor of an exact quotient, via remainder, keeps full precision
    divisor = F.nullif(denominator, F.lit(0)).cast("decimal(30,0)") * 2
    whole = (scaled - F.pmod(scaled, divisor)) / divisor
    return (whole / scale).cast(f"decimal(18,{places})")


def rate_pct(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator, 2, 100)


def engagement_counts() -> list[Column]:
    """Counts every engagement table needs, as plain sums that can be merged again."""
    kind = F.col("tipo_interacao")
    return [
        F.count(F.lit(1)).alias("total_interacoes"),
        F.count_if(kind == "visualização").alias("visualizacoes"),
        F.count_if(kind == "início").alias("inicios"),
        F.count_if(is_conclusion()).alias("conclusoes"),
        F.count_if(kind == "curtida").alias("curtidas"),
        F.count("avaliacao_atribuida").alias("avaliacoes"),
        F.sum("avaliacao_atribuida").alias("soma_avaliacao"),
        F.count("tempo_consumido").alias("com_tempo"),
        F.sum("tempo_consumido").alias("tempo_total_min"),
    ]


COUNT_NAMES = [
    "total_interacoes", "visualizacoes", "inicios", "conclusoes", "curtidas",
    "avaliacoes", "soma_avaliacao", "com_tempo", "tempo_total_min",
]


def merged_counts() -> list[Column]:
    """The same counts summed over already counted rows."""
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNT_NAMES]


def completion_rate() -> Column:
    return rate_pct(F.col("conclusoes"), F.col("inicios") + F.col("visualizacoes"))


def mean_rating() -> Column:
    return ratio(F.col("soma_avaliacao"), F.col("avaliacoes"), 2)


def mean_minutes() -> Column:
    return ratio(F.col("tempo_total_min"), F.col("com_tempo"), 1)
