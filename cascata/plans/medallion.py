"""The whole run: Bronze, Silver with quarantine, quality gate, Gold, snapshot, summary."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cascata.operators import audit, gold_state, lookups, quality, quarantine, rules, silver
from cascata.session import materialize, new_folder, scratch
from cascata.sources import files, versions, writers
from cascata.schemas import (
    CATALOG_COLUMNS, COMMENT_COLUMNS, INTERACTION_COLUMNS, QUALITY_RESULT, QUARANTINE_COLUMNS, bronze_schema, quarantine_schema,
)

BRONZE_COLUMNS = {"catalogo": CATALOG_COLUMNS, "interacoes": INTERACTION_COLUMNS, "comentarios": COMMENT_COLUMNS}


#: Of each source: its Silver table, that table's columns, and the key under which a row enters once.
REPROCESSED = {
    "catalogo": ("conteudo", silver.SILVER_CONTENT, ["conteudo_id"]),
    "interacoes": ("interacao", silver.SILVER_INTERACTION, ["usuario_id", "conteudo_id", "data_hora"]),
    "comentarios": ("comentario", silver.SILVER_COMMENT, ["usuario_id", "conteudo_id", "data"]),
}


@dataclass(frozen=True)
class Paths:
    """Input files and the folder the layers are written to."""

    catalog: str
    interactions: str
    comments: str
    base: str

    def layer(self, name: str) -> str:
        return f"{self.base}/{name}"


class Run:
    """One execution: writes begin and end of each stage and stops at the first failure."""

    def __init__(self, spark: SparkSession, paths: Paths, run_id: str | None = None):
        self.spark, self.paths = spark, paths
        self.run_id = quality.new_run_id(run_id)

    def log(self, stage: str, event: str, result: str | None = None) -> None:
        entry = audit.stage_event(self.spark, self.run_id, stage, event, result)
        entry.coalesce(1).write.mode("append").parquet(self.paths.layer("auditoria"))

    def stage(self, name: str, work: Callable[[], str]) -> None:
        self.log(name, "inicio")
        try:
            result = work()
        except Exception:
            self.log(name, "fim", "falha")
            raise
        self.log(name, "fim", result)

    def read(self, layer: str, schema=None) -> DataFrame:
        """A stored layer; run-partitioned ones are read by schema, so ids stay text and an empty one can be read."""
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self.paths.layer(layer))

    def read_bronze(self, name: str) -> DataFrame:
        return files.latest_batch(self.read(f"bronze/{name}", bronze_schema(BRONZE_COLUMNS[name])))

    def read_results(self) -> DataFrame:
        return self.read("qualidade", QUALITY_RESULT)

    def bronze(self) -> str:
        p, s, run = self.paths, self.spark, self.run_id
        writers.append_run(files.bronze_catalog(s, p.catalog, run), p.layer("bronze/catalogo"))
        corrupt = []
        for source, path, columns in (("interacoes", p.interactions, INTERACTION_COLUMNS), ("comentarios", p.comments, COMMENT_COLUMNS)):
            rows, broken = files.bronze_and_corrupt(s, path, source, columns, run)
            writers.append_run(rows, p.layer(f"bronze/{source}"))
            corrupt.append(broken)
        entries = quarantine.corrupt_file_entries(corrupt[0].unionByName(corrupt[1]), run)
        writers.append_run(entries, p.layer("quarentena/arquivos"))
        return "sucesso"

    def silver(self) -> str:
        """Contents first: interactions and comments refer to them."""
        p = self.paths
        catalogue = self.read_bronze("catalogo")
        self._split(silver.judge_content(catalogue), catalogue, silver.SILVER_CONTENT, "catalogo", "conteudo")
        contents = self.read("silver/conteudo")

        def split(name: str, table: str, judge, schema) -> None:
            raw = self.read_bronze(name)
            self._split(judge(raw, contents), raw, schema, name, table)

        with ThreadPoolExecutor(max_workers=2) as pool:  # neither reads what the other writes
            both = [pool.submit(split, *source) for source in (
                ("interacoes", "interacao", silver.judge_interactions, silver.SILVER_INTERACTION),
                ("comentarios", "comentario", silver.judge_comments, silver.SILVER_COMMENT))]
            for work in both:
                work.result()
        return "sucesso"

    def _split(self, judged: DataFrame, raw: DataFrame, schema, source: str, table: str) -> None:
        """Judge once, write once, then route: the two outputs read the stored verdicts, and the tests' counts are taken on the way."""
        staged = self.paths.layer(f"julgados/{source}/{self.run_id}")
        judged.write.mode("overwrite").parquet(staged)
        stored = self.spark.read.parquet(staged)
        counted, watch = quality.observed(rules.approved(stored), table)
        silver.under_contract(counted, schema).write.mode("overwrite").parquet(self.paths.layer(f"silver/{table}"))
        writers.append_run(quality.observed_rows(self.spark, table, watch, self.run_id).coalesce(1), self.paths.layer(f"medidas/{table}"))
        rejected = silver.to_quarantine(stored, source, raw, self.next_id(source))
        writers.append_run(
            rejected.withColumn("execucao_id", F.lit(self.run_id)), self.paths.layer(f"quarentena/{source}")
        )
        versions.remove(self.spark, staged)

    def silver_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.read("silver/conteudo"), self.read("silver/interacao"), self.read("silver/comentario")

    def counted(self) -> DataFrame:
        """What this run's writes of Silver counted."""
        parts = [self.read(f"medidas/{table}", quality.OBSERVED) for table in ("conteudo", "interacao", "comentario")]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("execucao_id") == self.run_id)

    def quality(self) -> str:
        """The tests from those counts; Silver is not read again."""
        results = quality.describe_results(quality.measures_of(self.counted()), self.run_id)
        writers.append_run(results, self.paths.layer("qualidade"))
        return quality.verdict(self.read_results().where(F.col("execucao_id") == self.run_id)).first()["resultado"]

    def gate(self) -> str:
        quality.enforce_gate(self.read_results(), self.run_id)
        return "sucesso"

    def gold(self, recommendations: DataFrame) -> str:
        """Gold from sums by content, day and user: one scan of Silver, which a run loads anew."""
        base = self.paths.layer("gold")
        before = versions.newest(self.spark, base)
        quality.enforce_gate(self.read_results(), self.run_id)
        contents, interactions, _ = self.silver_tables()
        sums = new_folder(self.spark, "estado")
        state = gold_state.merge(self.spark, sums, interactions, self.run_id)
        tables = gold_state.tables(self.spark, sums, state, contents, recommendations, self.run_id)
        writers.publish_version(tables, base, self.run_id, before)
        versions.remove(self.spark, sums)
        return "sucesso"

    def gold_increment(self, interactions: DataFrame, recommendations: DataFrame) -> str:
        """Gold after a batch of new Silver interactions, merged into sums that are kept from run to run."""
        base, sums = self.paths.layer("gold"), self.paths.layer("gold_estado")
        before = versions.newest(self.spark, base)
        state = gold_state.merge(self.spark, sums, interactions, self.run_id)
        tables = gold_state.tables(self.spark, sums, state, self.read("silver/conteudo"), recommendations, self.run_id)
        writers.publish_version(tables, base, self.run_id, before)
        return "sucesso"

    def metadata(self) -> str:
        contents, interactions, comments = self.silver_tables()
        tables = {"silver.conteudo": contents, "silver.interacao": interactions, "silver.comentario": comments}
        base = self.paths.layer("gold")
        version = versions.newest(self.spark, base)
        for name in GOLD_TABLES:
            tables[f"gold.{name}"] = writers.read_current(self.spark, base, name, version)
        writers.append_run(lookups.table_snapshot(tables, self.run_id), self.paths.layer("metadados"))
        return "sucesso"

    def _entries(self, layer: str) -> DataFrame | None:
        """Quarantine entries of a layer; none if nothing was ever written there."""
        try:
            return self.read(layer, quarantine_schema()).select(QUARANTINE_COLUMNS)
        except AnalysisException:
            return None

    def _located(self, source: str) -> DataFrame:
        """All entries of a source with the layer that holds them: those of loads, and those of reprocessing."""
        layers = (f"quarentena/{source}", f"quarentena/{source}_renovados")
        found = [(layer, self._entries(layer)) for layer in layers]
        parts = [rows.withColumn("_camada", F.lit(layer)) for layer, rows in found if rows is not None]
        return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]

    def queue(self, source: str) -> DataFrame:
        return self._located(source).drop("_camada")

    def next_id(self, source: str, all_entries: bool = False) -> int:
        """Number after the last entry of a source; a load leaves out its own, which it replaces when it runs again."""
        loads, renewed = self._entries(f"quarentena/{source}"), self._entries(f"quarentena/{source}_renovados")
        if loads is not None and not all_entries:
            loads = loads.where(F.col("execucao_id") != self.run_id)
        last = [rows.agg(F.max("id")).first()[0] for rows in (loads, renewed) if rows is not None]
        return max([n for n in last if n is not None], default=-1) + 1

    def quarantined(self) -> DataFrame:
        parts = [self.queue(name) for name in (*BRONZE_COLUMNS, "arquivos")]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])

    def reprocess(self) -> DataFrame:
        """Give pending entries another chance against Silver as it is now; contents first.

        What an attempt decides is stored before anything is changed, and carried out from there. An
        attempt that broke off is carried out first: each of its steps leaves out what is done already.
        """
        self._carry_out()
        contents = self.read("silver/conteudo")
        accepted, _, renewed = quarantine.reprocess_catalog(self.queue("catalogo"), contents, self.run_id)
        self._decide("catalogo", accepted, renewed)
        self._carry_out()
        for source, again in (("interacoes", quarantine.reprocess_interactions), ("comentarios", quarantine.reprocess_comments)):
            table, _, _ = REPROCESSED[source]
            accepted, _ = again(self.queue(source), self.read("silver/conteudo"), self.read(f"silver/{table}"), self.run_id)
            self._decide(source, accepted)
            self._carry_out()
        return quarantine.reprocess_report(self.quarantined())

    def _decide(self, source: str, accepted: DataFrame, renewed: DataFrame | None = None) -> None:
        """Store the rows for Silver and the new entries of one attempt, then make the attempt known."""
        attempt, (_, schema, _) = uuid.uuid4().hex, REPROCESSED[source]
        folder = self.paths.layer(f"reprocessos/{attempt}")
        entered = silver.under_contract(accepted.withColumn("_registro", F.col("registro_id")), schema, ["_registro"])
        entered.write.parquet(f"{folder}/aceitos")
        if renewed is not None:
            numbered = renewed.withColumn("id", F.monotonically_increasing_id() + self.next_id(source, all_entries=True))
            numbered.select(QUARANTINE_COLUMNS).write.parquet(f"{folder}/renovados")
        self._note("tentativas_abertas", source, attempt)

    def _note(self, layer: str, source: str, attempt: str) -> None:
        named = self.spark.range(1).select(F.lit(source).alias("origem"), F.lit(attempt).alias("tentativa"))
        named.coalesce(1).write.mode("append").parquet(self.paths.layer(layer))

    def _carry_out(self) -> None:
        """Append to Silver, restate and add entries for every attempt that is open; few ever are."""
        kind = "origem string, tentativa string"
        try:
            known = self.read("tentativas_abertas", kind)
        except AnalysisException:
            return
        try:
            known = known.join(self.read("tentativas_feitas", kind), "tentativa", "left_anti")
        except AnalysisException:
            pass
        for row in known.select("origem", "tentativa").distinct().collect():
            source, folder = row["origem"], f"reprocessos/{row['tentativa']}"
            table, _, keys = REPROCESSED[source]
            accepted = self.read(f"{folder}/aceitos")
            absent = quarantine.absent_from(accepted, self.read(f"silver/{table}"), keys).drop("_registro")
            materialize(absent, "aceitos").write.mode("append").parquet(self.paths.layer(f"silver/{table}"))
            done = accepted.select(F.col("_registro").alias("registro_id"))
            self._restate(quarantine.mark_reprocessed(self._located(source), source, done))
            if source == "catalogo":
                self._add(f"quarentena/{source}_renovados", self.read(f"{folder}/renovados"))
            self._note("tentativas_feitas", source, row["tentativa"])

    def _restate(self, status: DataFrame) -> None:
        """Rewrite the entries whose run has a changed status; other run folders stay as they are."""
        updated = materialize(status, "situacao")
        changed = updated.where("status = 'reprocessado'").select("_camada", "execucao_id").distinct()
        rewritten = materialize(updated.join(changed, ["_camada", "execucao_id"], "left_semi"), "situacao_nova")
        for (layer,) in changed.select("_camada").distinct().collect():  # two at most
            rows = rewritten.where(F.col("_camada") == layer)
            writers.append_run(rows.select(QUARANTINE_COLUMNS), self.paths.layer(layer))

    def _add(self, layer: str, entries: DataFrame) -> None:
        """Add entries to what is stored under their run; those already there are not added again."""
        stored = self._entries(layer)
        if stored is not None:
            fresh = entries.join(stored.select("id"), "id", "left_anti")
            touched = stored.join(fresh.select("execucao_id").distinct(), "execucao_id", "left_semi")
            entries = fresh.select(QUARANTINE_COLUMNS).unionByName(touched.select(QUARANTINE_COLUMNS))
        writers.append_run(materialize(entries, "renovados").select(QUARANTINE_COLUMNS), self.paths.layer(layer))

    def summary(self) -> DataFrame:
        return audit.stage_summary(self.read("auditoria"), self.quarantined(), self.run_id)


GOLD_TABLES = [
    "dim_conteudo", "fato_engajamento_dia", "kpi_desempenho_categoria", "kpi_engajamento_formato",
    "kpi_evolucao_dia", "kpi_conversao_recomendacao", "kpi_geral",
]


def run_medallion(
    spark: SparkSession, paths: Paths, recommendations: DataFrame, run_id: str | None = None
) -> DataFrame:
    """Run all stages in order and return the summary; a failed gate leaves Gold as it was."""
    run = Run(spark, paths, run_id)
    with scratch(spark):
        run.stage("bronze", run.bronze)
        run.stage("silver", run.silver)
        run.stage("qualidade", run.quality)
        run.stage("gate", run.gate)
        run.stage("gold", lambda: run.gold(recommendations))
        run.stage("metadados", run.metadata)
    return run.summary()
