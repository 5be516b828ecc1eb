"""Ordered record rules: the first one a row breaks decides where the row goes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    code: str
    broken: Column
    message: str


def first_broken(rules: list[Rule]) -> Column:
    return F.coalesce(*[F.when(r.broken, F.lit(r.code)) for r in rules])


def message_of(rules: list[Rule], code: Column) -> Column:
    return F.coalesce(*[F.when(code == r.code, F.lit(r.message)) for r in rules])


def apply_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    judged = rows.withColumn("regra_violada", first_broken(rules))
    return judged.withColumn("mensagem", message_of(rules, F.col("regra_violada")))


def approved(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("regra_violada").isNull())


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("regra_violada").isNotNull())


def record_id(source: str, parts: dict[str, str]) -> Column:
    """``source:key=value,...`` with ``NULL`` in place of a missing value."""
    pieces = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(column), F.lit("NULL")))
        for name, column in parts.items()
    ]
    return F.concat(F.lit(f"{source}:"), F.concat_ws(",", *pieces))


def raw_payload(columns: dict[str, Column]) -> Column:
    """An untouched raw row as JSON text, nulls included."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in columns.items()]), {"ignoreNullFields": "false"})
