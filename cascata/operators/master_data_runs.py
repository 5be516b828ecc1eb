"""Master data kept from run to run: only groups that new or changed records touch are made again.

Four keyed tables and one commit a run: the match key of every record, the members of every group (in buckets
of the match key), the master record of every group, and the crosswalk with the time from
and until which a row holds. A run reads the members of touched groups only. A group keeps its master
id while the record it was named after is a member; otherwise it is named after its smallest id.
Both sides of its joins grow with the data, so none is broadcast (``skew.lookup``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cascata.functions.text import padded_master_id
from cascata.operators import master_data
from cascata.session import materialize, scratch
from cascata.sources import keyed, versions
from cascata.sources.versions import Version

FIELDS = ["titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao", "autor"]
RECORD = "conteudo_id long, titulo string, tipo string, categoria string, nivel string, carga_horaria_min long, data_publicacao date, autor string"
MASTER = ["titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao", "qtd_registros"]
CROSSWALK = ["mestre_id", "regra_match", "sobrevivente"]
TABLES = {
    "registros": ("conteudo_id long, chave string", ["conteudo_id"], ["conteudo_id"]),
    "membros": (f"chave string, {RECORD}, fora boolean", ["chave", "conteudo_id"], ["chave"]),
    "mestres": ("chave string, mestre_id string, nomeado_por long, titulo string, tipo string, categoria string, nivel string, "
                "carga_horaria_min long, data_publicacao date, qtd_registros long", ["chave"], ["chave"]),
    "de_para": ("conteudo_id long, mestre_id string, regra_match string, sobrevivente boolean, valido_de string, valido_ate string",
                ["conteudo_id", "valido_de"], ["conteudo_id"]),
}


def _begun(spark: SparkSession, base: str, run_id: str) -> Version:
    """The version to start from, with empty tables before the first run."""
    before = versions.newest(spark, base)
    if "registros" in before.tables:
        return before
    made = {n: keyed.begin(spark.createDataFrame([], schema), base, before, keys, by=by) for n, (schema, keys, by) in TABLES.items()}
    return versions.commit(spark, base, before, run_id, made)


def _of(spark: SparkSession, base: str, before: Version, name: str, keys: DataFrame) -> DataFrame:
    """Rows of some keys; only their buckets are read."""
    table = before.tables[name]
    return keyed.read(spark, base, name, before, keyed.buckets_of(table, keys)).join(keys.hint("merge"), keys.columns, "left_semi")


def run(spark: SparkSession, base: str, changes: DataFrame, instant: str, run_id: str) -> Version:
    """Take in new and changed contents (one row each); ``instant`` is when the new crosswalk rows begin to hold.

    Records that are as they were change nothing, so a run can be repeated.
    """
    with scratch(spark):
        return _taken_in(spark, base, changes, instant, run_id)


def _taken_in(spark: SparkSession, base: str, changes: DataFrame, instant: str, run_id: str) -> Version:
    before = _begun(spark, base, run_id)
    given = master_data.keyed(changes).select(F.col("_chave").alias("chave"), "conteudo_id", *FIELDS, F.lit(False).alias("fora"))
    ids = given.select("conteudo_id")
    was = _of(spark, base, before, "registros", ids).select("conteudo_id", F.col("chave").alias("_antes"))
    placed = materialize(given.join(was.hint("merge"), "conteudo_id", "left"), "mudancas")
    touched = materialize(placed.select("chave").unionByName(placed.select(F.col("_antes").alias("chave")).where("chave is not null")).distinct(), "tocados")

    held = _of(spark, base, before, "membros", touched).where("not fora")
    fresh = placed.drop("_antes").select(*held.columns)
    gone = placed.where(F.col("_antes") != F.col("chave")).select(F.col("_antes").alias("chave"), "conteudo_id", *FIELDS, F.lit(True).alias("fora"))
    members = materialize(held.join(ids.hint("merge"), "conteudo_id", "left_anti").select(*held.columns).unionByName(fresh), "membros")

    named = _of(spark, base, before, "mestres", touched).select("chave", F.col("mestre_id").alias("_nome"), "nomeado_por")
    founders = members.select("chave", F.col("conteudo_id").alias("nomeado_por"))
    stays = named.join(founders.hint("merge"), ["chave", "nomeado_por"], "left_semi")
    groups = master_data.groups(members).withColumnRenamed("_chave", "chave").drop("mestre_id")
    rebuilt = groups.join(stays.hint("merge"), "chave", "left").withColumn("nomeado_por", F.coalesce("nomeado_por", "_primeiro"))
    rebuilt = materialize(rebuilt.withColumn("mestre_id", F.coalesce("_nome", padded_master_id(F.col("nomeado_por")))), "grupos")
    emptied = named.join(members.select("chave").distinct().hint("merge"), "chave", "left_anti").select(
        "chave", F.col("_nome").alias("mestre_id"), "nomeado_por", *[F.lit(None).alias(c) for c in MASTER[:-1]], F.lit(0).alias("qtd_registros"))
    masters = rebuilt.select("chave", "mestre_id", "nomeado_por", *MASTER).unionByName(emptied)

    wanted = members.select("chave", "conteudo_id").join(rebuilt.select("chave", "mestre_id", "_primeiro", "qtd_registros").hint("merge"), "chave").select(
        "conteudo_id", "mestre_id", F.when(F.col("qtd_registros") == 1, "unico").otherwise("titulo_normalizado+tipo+autor").alias("regra_match"),
        (F.col("conteudo_id") == F.col("_primeiro")).alias("sobrevivente"))
    valid = _of(spark, base, before, "de_para", members.select("conteudo_id")).where("valido_ate is null")
    same = wanted.join(valid.select("conteudo_id", *CROSSWALK).hint("merge"), ["conteudo_id", *CROSSWALK], "left_anti")
    changed = materialize(same, "de_para")
    closed = valid.join(changed.select("conteudo_id").hint("merge"), "conteudo_id", "left_semi").withColumn("valido_ate", F.lit(instant))
    opened = changed.withColumns({"valido_de": F.lit(instant), "valido_ate": F.lit(None).cast("string")})

    made = {
        "registros": placed.select("conteudo_id", "chave"), "membros": fresh.unionByName(gone.select(*fresh.columns)),
        "mestres": masters, "de_para": closed.select(*opened.columns).unionByName(opened),
    }
    return versions.commit(spark, base, before, run_id, {n: keyed.delta(spark, base, before, n, rows) for n, rows in made.items()})


def master(spark: SparkSession, base: str, version: Version | None = None) -> DataFrame:
    return keyed.read(spark, base, "mestres", version).where("qtd_registros > 0").select("mestre_id", *MASTER)


def crosswalk(spark: SparkSession, base: str, at: str | None = None, version: Version | None = None) -> DataFrame:
    """The crosswalk as it holds now, or held at an instant."""
    rows = keyed.read(spark, base, "de_para", version)
    if at is None:
        return rows.where("valido_ate is null").select("conteudo_id", *CROSSWALK)
    return rows.where((F.col("valido_de") <= at) & (F.col("valido_ate").isNull() | (F.col("valido_ate") > at))).select("conteudo_id", *CROSSWALK)
