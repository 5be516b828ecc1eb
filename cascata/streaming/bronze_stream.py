"""Incremental Bronze: files that arrived since the last run, each taken exactly once.

The batches are those of the nightly load; Structured Streaming only keeps track of which
files were already read, and a restart goes on where the former run stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from cascata.operators.quarantine import corrupt_file_entries
from cascata.schemas import text_schema
from cascata.session import materialize
from cascata.sources.files import CORRUPT, UNREADABLE, unreadable
from cascata.sources.writers import append_run


def new_rows(spark: SparkSession, folder: str, source: str, columns: list[str]) -> DataFrame:
    """All-text rows of the JSON files under ``folder``, with their audit columns."""
    schema = text_schema(columns).add(CORRUPT, T.StringType())
    raw = spark.readStream.schema(schema).options(
        multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    ).json(folder)
    return raw.withColumns({
        "origem": F.lit(source),
        "arquivo_origem": F.col("_metadata.file_name"),
        "data_hora_ingestao": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
    })


def ingest_new_files(
    spark: SparkSession, folder: str, source: str, columns: list[str], bronze_path: str, checkpoint: str, prefix: str,
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Append every new file to Bronze and stop; one run partition per batch.

    A file that cannot be parsed becomes an entry under ``quarantine_path`` (beside Bronze, unless
    named) and no row of Bronze. A batch that is written again after a failure replaces its own partition.
    """
    def store(batch: DataFrame, number: int) -> None:
        run = f"{prefix}-{number}"
        stored = materialize(batch.withColumn("_ilegivel", unreadable(columns)), "lote")
        marked = stored.where(~F.coalesce("_ilegivel", F.lit(False))).withColumns({
            "execucao_id": F.lit(run), "ordem": F.monotonically_increasing_id(),
        })
        append_run(marked.drop("_ilegivel", CORRUPT), bronze_path)
        broken = stored.where("_ilegivel").select(
            F.col("arquivo_origem").alias("arquivo"), "origem", F.lit(UNREADABLE).alias("erro")).distinct()
        append_run(corrupt_file_entries(broken, run), quarantine_path or f"{bronze_path.rstrip('/')}_ilegiveis")

    return (
        new_rows(spark, folder, source, columns)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
