"""Sinks: plain files, month-partitioned Parquet, versioned tables and the Gold publication."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cascata.sources import versions
from cascata.sources.versions import Version


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header; blanks at the ends of a text are data and stay."""
    rows.write.mode("overwrite").options(
        header=True, encoding="UTF-8", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one JSON array per task, streamed batch by batch."""
    def lines(values: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"value": values})

    yield lines(["["])
    comma = ""
    for block in batches:
        records = block.column("value").to_pylist()
        if records:
            yield lines([comma + records[0]] + ["," + r for r in records[1:]])
            comma = ","
    yield lines(["]"])


def write_json(rows: DataFrame, path: str) -> None:
    """Records as JSON, one a line, nulls written out; the files can be split and read in parallel."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_arrays(rows: DataFrame, path: str) -> None:
    """Records as JSON arrays, one per output file, as the source systems deliver them."""
    record = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")
    rows.select(record).mapInArrow(_as_array, "value string").write.mode("overwrite").text(path)


def append_run(rows: DataFrame, path: str) -> None:
    """Rows of one run under ``execucao_id=``; writing the same run again replaces only that run."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("execucao_id").parquet(path)


def write_month_partitions(interactions: DataFrame, path: str, per_month: int = 8) -> None:
    """Interactions under ``ano=/mes=``; the rows of a month go to ``per_month`` tasks by content, one file each."""
    dated = interactions.withColumns({
        "ano": F.date_format("data_hora", "yyyy"), "mes": F.date_format("data_hora", "MM"),
    })
    part = F.pmod(F.xxhash64("conteudo_id"), F.lit(per_month))
    dated.repartition("ano", "mes", part).write.mode("overwrite").partitionBy("ano", "mes").parquet(path)


def read_month_partitions(spark: SparkSession, path: str, schema) -> DataFrame:
    """The declared schema keeps ``ano`` and ``mes`` text, so ``mes = '01'`` prunes folders."""
    folders = [T.StructField("ano", T.StringType()), T.StructField("mes", T.StringType())]
    return spark.read.schema(T.StructType([*schema.fields, *folders])).parquet(path)


def month_slice(partitioned: DataFrame, month: str) -> DataFrame:
    return partitioned.where(F.col("mes") == month)


def write_fact_file(fact: DataFrame, path: str, runner: str) -> None:
    """The engagement fact with its declared column types."""
    fact.select(
        F.col("conteudo_id").cast("bigint"), F.col("data").cast("string"),
        *[F.col(c).cast("bigint") for c in ("total_interacoes", "visualizacoes", "inicios", "conclusoes", "curtidas",
                                             "avaliacoes", "soma_avaliacao", "tempo_total_min")],
        "execucao_id", F.lit(runner).alias("runner"),
    ).write.mode("overwrite").parquet(path)


def append_recommendations(rows: DataFrame, path: str) -> None:
    """A batch per ``gerado_em``: a new batch is added, the same batch is replaced."""
    stamped = rows.withColumn("lote", F.date_format("gerado_em", "yyyyMMdd'T'HHmmss"))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lote").parquet(path)


def publish_version(tables: dict[str, DataFrame], base: str, run_id: str, read_version: Version | None = None) -> Version:
    """Write all tables aside and commit them together as the next version.

    A reader sees the former version until the commit; a failed run leaves it in place. Of two runs that
    started from one version the first to commit wins and the other fails.
    """
    spark = next(iter(tables.values())).sparkSession
    return versions.publish(spark, base, tables, run_id, read_version)


def current_version(spark: SparkSession, base: str) -> str | None:
    """The run that made the newest version."""
    return versions.newest(spark, base).run_id


def read_current(spark: SparkSession, base: str, name: str, version: Version | None = None) -> DataFrame:
    """A table of a version, else of the newest."""
    return versions.read(spark, base, version or versions.newest(spark, base), name)
