"""Tables with a business key: hash buckets, a delta per upsert, the newest row of a key wins.

An upsert writes only its own rows, into the buckets their keys fall in, and commits a version in which
these buckets have one more folder; all other buckets keep their files untouched. A read merges the
buckets that have deltas and passes on the others as they lie. Compaction writes such a bucket anew.

Rows given to an upsert have one row per key (``merge.last_per_key``); null keys are equal to each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cascata.sources import versions
from cascata.sources.versions import Stored, Version

COMMIT, FIRST = "_carga", "_inicial"


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def _marked(rows: DataFrame, number: int, first: bool) -> DataFrame:
    return rows.withColumns({COMMIT: F.lit(number).cast("long"), FIRST: F.lit(first)})


def _under(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with the columns and types of the table, so that equal keys hash alike."""
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _schema(table: Stored) -> T.StructType:
    return T.StructType([f for f in T.StructType.fromJson(table.schema).fields if f.name not in (COMMIT, FIRST)])


def begin(rows: DataFrame, base: str, before: Version, keys: list[str], buckets: int = 16, by: list[str] | None = None) -> Stored:
    """A table to be committed on top of ``before``; its buckets go by the whole key, or by the columns ``by`` of it."""
    notes = {"chaves": keys, "baldes": buckets, "por": by or keys}
    return versions.stage(_marked(rows, before.number + 1, True), base, _bucket(notes["por"], buckets), notes)


def create(rows: DataFrame, base: str, name: str, keys: list[str], run_id: str, buckets: int = 16, by: list[str] | None = None) -> Version:
    """A new table, or a new beginning of one; a bucket should hold about as much as a few tasks read."""
    spark = rows.sparkSession
    before = versions.newest(spark, base)
    return versions.commit(spark, base, before, run_id, {name: begin(rows, base, before, keys, buckets, by)})


def buckets_of(table: Stored, keys: DataFrame) -> set[str]:
    """The buckets in which the given keys (columns ``por`` of the table) lie."""
    schema = _schema(table)
    typed = keys.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in table.notes["por"]])
    return {str(row[0]) for row in typed.select(_bucket(table.notes["por"], table.notes["baldes"])).distinct().collect()}


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key. Only keys that some delta holds are grouped."""
    later = rows.where(f"not {FIRST}").groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(COMMIT).alias("_ultima"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(later.hint("merge"), same, "left").where(F.col("_ultima").isNull() | (F.col(COMMIT) == F.col("_ultima"))).select(*rows.columns)


def read(spark: SparkSession, base: str, name: str, version: Version | None = None, parts: set[str] | None = None) -> DataFrame:
    """The table as of a version, else as of now."""
    version = version or versions.newest(spark, base)
    table = version.tables[name]
    wanted = set(table.parts) if parts is None else parts & set(table.parts)
    alone = {p for p in wanted if len(table.parts[p]) == 1}
    rows = versions.read(spark, base, version, name, alone)
    if wanted - alone:
        rows = rows.unionByName(_merged(versions.read(spark, base, version, name, wanted - alone), table.notes["chaves"]))
    return rows.select(*_schema(table).names)


def delta(spark: SparkSession, base: str, before: Version, name: str, rows: DataFrame) -> Stored:
    """A table with rows inserted or replaced by key, to be committed on top of ``before``."""
    table = before.tables[name]
    given = _under(rows, _schema(table))
    made = versions.stage(_marked(given, before.number + 1, False), base, _bucket(table.notes["por"], table.notes["baldes"]))
    return Stored(table.schema, table.parts | {p: table.parts.get(p, []) + folders for p, folders in made.parts.items()}, table.notes)


def _add(spark: SparkSession, base: str, name: str, rows: DataFrame, before: Version, run_id: str) -> Version:
    changed = delta(spark, base, before, name, rows)
    return before if changed == before.tables[name] else versions.commit(spark, base, before, run_id, {name: changed})


def upsert(spark: SparkSession, base: str, name: str, updates: DataFrame, run_id: str, read_version: Version | None = None) -> Version:
    """Insert or replace by key; writes the given rows and nothing else."""
    before = read_version or versions.newest(spark, base)
    return _add(spark, base, name, updates, before, run_id)


def insert_absent(spark: SparkSession, base: str, name: str, rows: DataFrame, run_id: str, read_version: Version | None = None) -> Version:
    """Insert the rows whose key the table lacks; a first value once committed stays. Reads only the keys of the table."""
    before = read_version or versions.newest(spark, base)
    table = before.tables[name]
    keys = table.notes["chaves"]
    known = versions.read(spark, base, before, name).select(*[F.col(k).alias(f"_{k}") for k in keys])
    given = _under(rows, _schema(table))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return _add(spark, base, name, given.join(known.hint("merge"), same, "left_anti"), before, run_id)


def compact(spark: SparkSession, base: str, name: str, run_id: str, most: int = 4) -> Version:
    """Write the buckets that have more than ``most`` folders anew, one folder each."""
    before = versions.newest(spark, base)
    table = before.tables[name]
    crowded = {p for p, folders in table.parts.items() if len(folders) > most}
    if not crowded:
        return before
    rows = _marked(read(spark, base, name, before, crowded), before.number + 1, True)
    made = versions.stage(rows, base, _bucket(table.notes["por"], table.notes["baldes"]))
    return versions.commit(spark, base, before, run_id, {name: Stored(table.schema, table.parts | made.parts, table.notes)})
