"""The daily engagement fact from interactions as they arrive: one-day windows with a watermark.

The watermark trails the latest event seen in earlier batches by some days. Rows of a day that
is still open are merged into that day's sums; what arrives for a closed day goes to quarantine.
Interactions that were seen before are left out, by their business keys, which are kept for open days only.
Sums, keys, watermark and the number of the batch are one commit, so a batch that is
delivered again after a failure changes nothing, and a restart goes on where the last commit stopped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cascata.functions import metrics
from cascata.operators import gold
from cascata.schemas import SILVER_INTERACTION
from cascata.session import materialize, scratch
from cascata.sources import versions
from cascata.sources.versions import Stored, Version
from cascata.sources.writers import append_run

KEYS = ["usuario_id", "conteudo_id", "data_hora"]
SUMS, SEEN = "engajamento", "vistas"
LATE = "DIA_FECHADO"


def _notes(version: Version) -> dict:
    """The first open day, the latest day seen, and the last batch done."""
    return version.tables[SUMS].notes if SUMS in version.tables else {"aberto_desde": None, "ultimo_dia": None, "lote": -1}


def _table(version: Version, name: str) -> Stored:
    return version.tables.get(name, Stored({}, {}, {}))


def _days(rows: DataFrame) -> list[str]:
    return [row[0] for row in rows.select(F.date_format("data", "yyyy-MM-dd")).distinct().collect()]


def take_batch(spark: SparkSession, base: str, batch: DataFrame, number: int, prefix: str, quarantine_path: str, delay_days: int) -> Version:
    """Merge one batch of Silver interactions; the late ones are stored under ``quarantine_path``."""
    before = versions.newest(spark, base)
    if number <= _notes(before)["lote"]:
        return before
    with scratch(spark):
        return _merged(spark, base, before, batch, number, f"{prefix}-{number}", quarantine_path, delay_days)


def _merged(spark: SparkSession, base: str, before: Version, batch: DataFrame, number: int, run: str, quarantine_path: str, delay_days: int) -> Version:
    notes = _notes(before)
    rows = materialize(batch.withColumn("data", F.to_date("data_hora")), "lote")
    opened = notes["aberto_desde"]
    late = F.lit(False) if opened is None else F.col("data") < F.lit(opened).cast("date")
    append_run(rows.where(late).withColumns({"regra_violada": F.lit(LATE), "execucao_id": F.lit(run)}), quarantine_path)

    given = rows.where(~late)
    last = rows.agg(F.date_format(F.max("data"), "yyyy-MM-dd")).first()[0]
    days = _days(given)
    known = _table(before, SEEN)
    fresh = given.dropDuplicates(KEYS)
    if known.parts:
        fresh = fresh.join(versions.read(spark, base, before, SEEN, days), KEYS, "left_anti")
    fresh = materialize(fresh, "novas")
    summed = fresh.groupBy("conteudo_id", "data").agg(*metrics.engagement_counts())
    sums = _table(before, SUMS)
    if sums.parts:
        held = versions.read(spark, base, before, SUMS, _days(fresh))
        summed = summed.unionByName(held).groupBy("conteudo_id", "data").agg(*[F.sum(c).alias(c) for c in metrics.COUNT_NAMES])
    day = F.date_format("data", "yyyy-MM-dd")
    made = versions.stage(summed, base, day)
    keys = versions.stage(fresh.select(*KEYS), base, F.date_format("data_hora", "yyyy-MM-dd"))

    latest = max(d for d in (last, notes["ultimo_dia"], "") if d is not None) or None
    if latest is not None:
        opened = max(opened or "", (dt.date.fromisoformat(latest) - dt.timedelta(days=delay_days)).isoformat())
    seen = {d: known.parts.get(d, []) + keys.parts.get(d, []) for d in known.parts.keys() | keys.parts.keys() if d >= (opened or "")}
    return versions.commit(spark, base, before, run, {
        SUMS: Stored(made.schema, sums.parts | made.parts, {"aberto_desde": opened, "ultimo_dia": latest, "lote": number}),
        SEEN: Stored(keys.schema, seen, {}),
    })


def follow_engagement(
    spark: SparkSession, folder: str, base: str, checkpoint: str, prefix: str, quarantine_path: str, delay_days: int = 2, files_at_once: int = 1000,
) -> StreamingQuery:
    """Take all new Parquet files of Silver interactions under ``folder``, in batches, and stop."""
    arriving = spark.readStream.schema(SILVER_INTERACTION).option("maxFilesPerTrigger", files_at_once).parquet(folder)
    return (
        arriving.writeStream
        .foreachBatch(lambda batch, number: take_batch(spark, base, batch, number, prefix, quarantine_path, delay_days))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def streamed_fact(spark: SparkSession, base: str, run_id: str, closed_only: bool = False) -> DataFrame:
    """The fact as of the last commit: all days, or those whose sums can no longer change."""
    version = versions.newest(spark, base)
    sums = versions.read(spark, base, version, SUMS)
    if closed_only:
        sums = sums.where(F.col("data") < F.lit(_notes(version)["aberto_desde"]).cast("date"))
    return gold.fact_rows(sums, run_id)
