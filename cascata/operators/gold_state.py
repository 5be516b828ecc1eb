"""Gold kept up to date by merging: stored sums by (content, day), (user, day) and (user, content).

One scan of a batch gives partial sums for all three grains at once. They are written beside the stored sums of the days
and pair buckets they touch, whose files stay as they are; a read adds up what the loads say of a key, and a part that
many loads have touched is added up in the store. Every Gold
table is made from the sums: distinct users stay exact, as each user has a row of their own per day. A
load that was merged before is not merged again, so a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cascata.functions import metrics
from cascata.operators import gold
from cascata.session import materialize
from cascata.sources import versions
from cascata.sources.versions import Stored, Version

TABLE = "estado"
KEYS = ["estado", "conteudo_id", "usuario_id", "data"]
SUMS = [*metrics.COUNT_NAMES, "conversoes"]
#: Names of the three grains by which of (content, user, day) was summed over.
CONTENT_DAY, USER_DAY, PAIR = "conteudo_dia", "usuario_dia", "par"
PAIR_BUCKETS = 16
#: Loads that may lie beside each other in a part before they are added up in the store.
MOST_LOADS = 4


def partial_sums(interactions: DataFrame) -> DataFrame:
    """Sums of all three grains, from one scan and one shuffle; pairs only where something converts."""
    dated = interactions.withColumn("data", F.to_date("data_hora"))
    grains = [["conteudo_id", "data"], ["usuario_id", "data"], ["usuario_id", "conteudo_id"]]
    summed = dated.groupingSets([[F.col(c) for c in grain] for grain in grains], "conteudo_id", "usuario_id", "data").agg(
        *metrics.engagement_counts(), F.count_if(F.col("tipo_interacao").isin(gold.CONVERTING_TYPES)).alias("conversoes"),
        F.grouping_id().alias("_fora"))
    named = F.when(F.col("_fora") == 2, CONTENT_DAY).when(F.col("_fora") == 4, USER_DAY).otherwise(PAIR)
    return summed.withColumn("estado", named).where((F.col("estado") != PAIR) | (F.col("conversoes") > 0)).select(*KEYS, *SUMS)


def _part(buckets: int = PAIR_BUCKETS):
    bucket = F.pmod(F.xxhash64("usuario_id", "conteudo_id"), F.lit(buckets)).cast("string")
    return F.concat_ws("-", "estado", F.when(F.col("estado") == PAIR, bucket).otherwise(F.date_format("data", "yyyyMMdd")))


def _added(rows: DataFrame) -> DataFrame:
    """One row per key from the rows that several loads wrote of it."""
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def merge(spark: SparkSession, base: str, interactions: DataFrame, load: str) -> Version:
    """Merge a batch of new Silver interactions into the stored sums; a load that is in them already changes nothing."""
    before = versions.newest(spark, base)
    stored = before.tables.get(TABLE, Stored({}, {}, {"cargas": []}))
    if load in stored.notes["cargas"]:
        return before
    made = versions.stage(partial_sums(interactions), base, _part())
    parts = stored.parts | {p: stored.parts.get(p, []) + folders for p, folders in made.parts.items()}
    crowded = [p for p, folders in parts.items() if len(folders) > MOST_LOADS]
    if crowded:
        beside = Version(before.number, load, {TABLE: Stored(made.schema, parts)})
        parts |= versions.stage(_added(versions.read(spark, base, beside, TABLE, crowded)), base, _part()).parts
    notes = {"cargas": [*stored.notes["cargas"], load]}
    return versions.commit(spark, base, before, load, {TABLE: Stored(made.schema, parts, notes)})


def read_loads(spark: SparkSession, base: str, version: Version, grain: str) -> DataFrame:
    """The sums of one grain as the loads wrote them, several rows of a key; the folders of the other grains are not listed."""
    parts = [p for p in version.tables[TABLE].parts if p.startswith(grain + "-")]
    return versions.read(spark, base, version, TABLE, parts).where(F.col("estado") == grain)


def read(spark: SparkSession, base: str, version: Version, grain: str) -> DataFrame:
    """The sums of one grain, one row per key; parts that one load alone touched are passed on as they lie."""
    parts = {p: folders for p, folders in version.tables[TABLE].parts.items() if p.startswith(grain + "-")}
    shared = {p for p, folders in parts.items() if len(folders) > 1}
    if not shared:
        return read_loads(spark, base, version, grain)
    added = _added(versions.read(spark, base, version, TABLE, shared).where(F.col("estado") == grain))
    alone = versions.read(spark, base, version, TABLE, parts.keys() - shared).where(F.col("estado") == grain)
    return alone.unionByName(added) if parts.keys() - shared else added


def tables(spark: SparkSession, base: str, version: Version, contents: DataFrame, recommendations: DataFrame, run_id: str) -> dict[str, DataFrame]:
    """The seven Gold tables from the stored sums, the catalogue and the recommendations."""
    by_day, by_user = (read(spark, base, version, grain) for grain in (CONTENT_DAY, USER_DAY))
    day_loads, user_loads, pair_loads = (read_loads(spark, base, version, grain) for grain in (CONTENT_DAY, USER_DAY, PAIR))
    per_content = day_loads.groupBy("conteudo_id").agg(*[F.sum(c).alias(c) for c in metrics.COUNT_NAMES])
    grouped = materialize(gold.group_counts(contents.join(per_content.hint("merge"), "conteudo_id", "left")), "por_categoria")
    days = gold.merged_days(by_user)
    conversion = gold.conversion_rows(recommendations, pair_loads.select("usuario_id", "conteudo_id").distinct(), run_id)
    users = user_loads.groupBy("usuario_id").agg(*[F.sum(c).alias(c) for c in metrics.COUNT_NAMES])
    return {
        "dim_conteudo": gold.dim_content(contents, run_id),
        "fato_engajamento_dia": gold.fact_rows(by_day, run_id),
        "kpi_desempenho_categoria": gold.category_rows(grouped, run_id),
        "kpi_engajamento_formato": gold.format_rows(gold.merge_groups(grouped, "tipo"), run_id),
        "kpi_evolucao_dia": gold.day_rows(days, run_id),
        "kpi_conversao_recomendacao": conversion,
        "kpi_geral": gold.overall_rows(gold.merged_users(users), contents, conversion, run_id),
    }
