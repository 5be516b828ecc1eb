"""Raw files: typed scans, all-text Bronze with audit columns, unreadable files, batches."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cascata.schemas import CATALOG_COLUMNS, COMMENT_COLUMNS, INTERACTION_COLUMNS, text_schema
from cascata.session import materialize, ship_package

CORRUPT = "_corrompido"
UNREADABLE = "JSON malformado"

CATALOG_SCHEMA = T.StructType([
    T.StructField(c, T.LongType() if c == "conteudo_id" else T.StringType()) for c in CATALOG_COLUMNS
])
INTERACTION_SCHEMA = T.StructType([
    T.StructField("usuario_id", T.LongType()),
    T.StructField("conteudo_id", T.LongType()),
    T.StructField("tipo_interacao", T.StringType()),
    T.StructField("data_hora", T.StringType()),
    T.StructField("tempo_consumido", T.DoubleType()),
    T.StructField("percentual_conclusao", T.DoubleType()),
    T.StructField("avaliacao_atribuida", T.DoubleType()),
])
COMMENT_SCHEMA = T.StructType([
    T.StructField("usuario_id", T.LongType()),
    T.StructField("conteudo_id", T.LongType()),
    T.StructField("avaliacao", T.LongType()),
    T.StructField("comentario", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("data", T.StringType()),
])


def scan_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 CSV with a header; quoted fields may hold line breaks. A bad line fails the read."""
    return (
        spark.read.schema(CATALOG_SCHEMA)
        .options(header=True, encoding="UTF-8", multiLine=True, escape='"', mode="FAILFAST")
        .csv(path)
    )


def scan_interactions_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array per file; many files are read in parallel."""
    return spark.read.schema(INTERACTION_SCHEMA).options(multiLine=True, mode="FAILFAST").json(path)


def scan_comments_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMENT_SCHEMA).options(multiLine=True, mode="FAILFAST").json(path)


def scan_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def scan_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], **options: str) -> DataFrame:
    """A relational table; pass ``partitionColumn`` and its bounds to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)


def with_audit(raw: DataFrame, source: str, run_id: str, instant: str | None = None) -> DataFrame:
    """Audit columns; the ingestion instant is the same for the whole read.

    ``ordem`` follows the row order inside a file. Bronze is written right after this, and
    everything later reads the stored value.
    """
    moment = F.lit(instant).cast("string") if instant else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return raw.withColumns({
        "origem": F.lit(source),
        "arquivo_origem": F.col("_metadata.file_name"),
        "data_hora_ingestao": moment,
        "execucao_id": F.lit(run_id),
        "ordem": F.monotonically_increasing_id(),
    })


def bronze_catalog(spark: SparkSession, path: str, run_id: str, instant: str | None = None) -> DataFrame:
    raw = (
        spark.read.schema(text_schema(CATALOG_COLUMNS))
        .options(header=True, encoding="UTF-8", multiLine=True, escape='"', ignoreLeadingWhiteSpace=False,
                 ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
    return with_audit(raw, "catalogo", run_id, instant)


def unreadable(columns: list[str]) -> Column:
    """Whether a row stands for a file that could not be parsed."""
    return F.col(CORRUPT).isNotNull() & F.col(columns[0]).isNull()


def _json_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-text read of JSON arrays; a missing leaf is null, a nested list keeps its JSON text."""
    schema = text_schema(columns).add(CORRUPT, T.StringType())
    return spark.read.schema(schema).options(
        multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    ).json(path)


def bronze_json(
    spark: SparkSession, path: str, source: str, columns: list[str], run_id: str, instant: str | None = None
) -> DataFrame:
    rows = _json_rows(spark, path, columns)
    return with_audit(rows.where(~unreadable(columns)), source, run_id, instant).drop(CORRUPT)


def bronze_interactions(spark: SparkSession, path: str, run_id: str, instant: str | None = None) -> DataFrame:
    return bronze_json(spark, path, "interacoes", INTERACTION_COLUMNS, run_id, instant)


def bronze_comments(spark: SparkSession, path: str, run_id: str, instant: str | None = None) -> DataFrame:
    return bronze_json(spark, path, "comentarios", COMMENT_COLUMNS, run_id, instant)


def _parser_messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a JSON parser says of each text that Spark could not read."""
    for rows in batches:
        said = []
        for text in rows.column("texto").to_pylist():
            try:
                json.loads(text or "")
                said.append(UNREADABLE)  # JSON, but not an array of records
            except ValueError as error:
                said.append(str(error))
        yield pa.RecordBatch.from_arrays([rows.column("arquivo"), rows.column("origem"), pa.array(said, pa.string())], names=["arquivo", "origem", "erro"])


def _told(broken: DataFrame) -> DataFrame:
    """Unreadable files (arquivo, origem, texto) with the parser's message, which names line and column; one file a row."""
    return broken.mapInArrow(_parser_messages, "arquivo string, origem string, erro string").distinct()


def corrupt_files(spark: SparkSession, path: str, source: str, columns: list[str]) -> DataFrame:
    """One row per file whose JSON cannot be parsed, with what the parser says."""
    ship_package(spark)
    rows = _json_rows(spark, path, columns).where(unreadable(columns))
    return _told(rows.select(F.col("_metadata.file_path").alias("arquivo"), F.lit(source).alias("origem"), F.col(CORRUPT).alias("texto")))


def bronze_and_corrupt(spark: SparkSession, path: str, source: str, columns: list[str], run_id: str) -> tuple[DataFrame, DataFrame]:
    """Bronze rows and unreadable files of one source; the files are parsed once, and what was parsed is stored."""
    ship_package(spark)
    rows = _json_rows(spark, path, columns).withColumn("_arquivo", F.col("_metadata.file_path"))
    parsed = materialize(with_audit(rows, source, run_id), f"lidos_{source}")
    broken = parsed.where(unreadable(columns)).select(F.col("_arquivo").alias("arquivo"), F.lit(source).alias("origem"), F.col(CORRUPT).alias("texto"))
    return parsed.where(~unreadable(columns)).drop(CORRUPT, "_arquivo"), _told(broken)


def latest_batch(bronze: DataFrame) -> DataFrame:
    """Rows of the newest batch; of batches of one instant, the one whose id is last.

    Its id, one value, is looked up first: as a constant it prunes the folders of a Bronze
    partitioned by run, which a join on the id would not.
    """
    newest = bronze.agg(F.max_by("execucao_id", F.struct("data_hora_ingestao", "execucao_id"))).first()[0]
    return bronze.where(F.col("execucao_id") == F.lit(newest).cast("string"))
