"""From raw files to recommendations: read, validate, clean, load, embed, search, recommend, report.

The base tables are keyed ones under ``loja``, where each stage commits what it changes; a run that is repeated
upserts the same rows and encodes nothing anew. Reports are JSON files under ``relatorios``.
Master data and published pseudonyms are kept from run to run by jobs of their own.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cascata.operators import clean, kpi, load, master_data_runs, privacy, recommend, search, validate
from cascata.operators.gold import dim_content
from cascata.operators.quality import new_run_id
from cascata.plans.medallion import Paths
from cascata.schemas import AUDIT_COLUMNS, CATALOG_COLUMNS, COMMENT_COLUMNS, INTERACTION_COLUMNS
from cascata.session import materialize, scratch
from cascata.sources import files, keyed, versions, writers

SOURCES = ("catalogo", "interacoes", "comentarios")
#: Key of each base table.
KEYS = {
    "usuario": ["usuario_id"], "conteudo": ["conteudo_id"], "interacao": ["usuario_id", "conteudo_id", "data_hora"],
    "comentario": ["usuario_id", "conteudo_id", "data"], "embedding_conteudo": ["conteudo_id"],
}
EMBEDDING = "conteudo_id long, texto_origem string, vetor array<float>, modelo string"


@dataclass(frozen=True)
class Settings:
    """What a run can be told; the encoder makes vectors of ``dimension`` numbers."""

    model: str
    dimension: int
    make_encoder: Callable[[], search.Encoder]
    phrases: tuple[str, ...]
    top_k: int = 5
    top_n: int = 5


class Platform:
    """One run over the files of ``paths``."""

    def __init__(self, spark: SparkSession, paths: Paths, settings: Settings, run_id: str | None = None):
        self.spark, self.paths, self.settings = spark, paths, settings
        self.run_id = new_run_id(run_id)
        self.store = paths.layer("loja")
        self.seconds: dict[str, float] = {}

    # ----------------------------------------------------------- base tables

    def table(self, name: str) -> DataFrame:
        return keyed.read(self.spark, self.store, name)

    def _into(self, name: str, rows: DataFrame, absent_only: bool = False) -> None:
        """Upsert, or insert what is absent; the first run begins the table."""
        if name not in versions.newest(self.spark, self.store).tables:
            keyed.create(rows, self.store, name, KEYS[name], self.run_id)
        elif absent_only:
            keyed.insert_absent(self.spark, self.store, name, rows, self.run_id)
        else:
            keyed.upsert(self.spark, self.store, name, rows, self.run_id)

    def _report(self, name: str, rows: DataFrame) -> None:
        writers.write_json(rows.coalesce(1), self.paths.layer(f"relatorios/{self.run_id}/{name}"))

    # ---------------------------------------------------------------- stages

    def ingest(self) -> None:
        p = self.paths
        self.raw = {"catalogo": materialize(files.bronze_catalog(self.spark, p.catalog, self.run_id), "catalogo")}
        for source, path, columns in (("interacoes", p.interactions, INTERACTION_COLUMNS), ("comentarios", p.comments, COMMENT_COLUMNS)):
            self.raw[source], broken = files.bronze_and_corrupt(self.spark, path, source, columns, self.run_id)
            if unread := [row["arquivo"] for row in broken.limit(5).collect()]:
                raise ValueError(f"arquivos ilegiveis: {', '.join(unread)}")

    def validate(self) -> None:
        judged = (
            validate.validate_catalog(self.raw["catalogo"]), validate.validate_interactions(self.raw["interacoes"], self.raw["catalogo"]),
            validate.validate_comments(self.raw["comentarios"], self.raw["catalogo"], self.raw["interacoes"]))
        stored = [materialize(rows, "validados") for rows in judged]
        self.classes = materialize(validate.report_counts(*stored), "classes")
        validate.report_reasons(*stored).write.mode("overwrite").parquet(self.paths.layer(f"relatorios/{self.run_id}/motivos"))

    def clean(self) -> None:
        treat = {"catalogo": clean.treat_catalog, "interacoes": clean.treat_interactions, "comentarios": clean.treat_comments}
        columns = {"catalogo": CATALOG_COLUMNS, "interacoes": INTERACTION_COLUMNS, "comentarios": COMMENT_COLUMNS}
        treated = {source: materialize(treat[source](self.raw[source]), f"tratado_{source}") for source in SOURCES}
        self.cleaned = {source: clean.kept(treated[source], columns[source]) for source in SOURCES}
        counts = [clean.count_corrected(treated[source], source) for source in SOURCES]
        self.corrected = materialize(counts[0].unionByName(counts[1]).unionByName(counts[2]), "corrigidos")
        folder = self.paths.layer(f"tratados/{self.run_id}")
        writers.write_csv(self.cleaned["catalogo"], f"{folder}/catalogo")
        writers.write_csv(self.cleaned["interacoes"], f"{folder}/interacoes")
        writers.write_json(self.cleaned["comentarios"], f"{folder}/comentarios")

    def load(self) -> None:
        contents = materialize(load.loadable_catalog(self.cleaned["catalogo"]), "carga_conteudo")
        interactions = materialize(load.loadable_interactions(self.cleaned["interacoes"], contents), "carga_interacao")
        documents = materialize(load.comment_documents(self.cleaned["comentarios"], self.cleaned["catalogo"]), "carga_comentario")
        self._into("usuario", interactions.select("usuario_id").distinct(), absent_only=True)
        self._into("conteudo", contents.drop("ordem"))
        self._into("interacao", interactions.drop("ordem"))
        self._into("comentario", documents.drop("ordem"))
        self.loaded = {"catalogo": contents, "interacoes": interactions, "comentarios": documents}

    def embed(self) -> None:
        s = self.settings
        if "embedding_conteudo" not in versions.newest(self.spark, self.store).tables:
            self._into("embedding_conteudo", self.spark.createDataFrame([], EMBEDDING))
        delta = materialize(search.embedding_delta(self.table("conteudo"), self.table("embedding_conteudo"), s.model), "delta")
        self._into("embedding_conteudo", search.embed_pending(delta, s.make_encoder, s.model))
        self._report("embeddings", search.delta_report(delta))

    def search(self) -> None:
        s = self.settings
        found = search.demonstration(self.table("embedding_conteudo"), self.table("conteudo"), list(s.phrases), s.make_encoder(), s.top_k, s.model)
        self._report("busca", found)

    def recommend(self) -> None:
        """Best contents of each user, appended as the batch of this run, with the counters of what was left out."""
        s = self.settings
        contents = self.table("conteudo")
        blocks = materialize(recommend.score_blocks(
            self.table("interacao"), contents, self.table("embedding_conteudo"), s.model, s.dimension, s.top_n), "pontuacoes")
        instant = self.spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).first()[0]
        best = materialize(recommend.top_n(blocks, contents, s.top_n, instant), "melhores")
        writers.append_recommendations(recommend.batch_rows(best), self.paths.layer("recomendacoes"))
        summed = recommend.summary(blocks, s.top_n).withColumns({"gerado_em": F.lit(instant), "modelo": F.lit(s.model), "top_n": F.lit(s.top_n)})
        self._report("resumo_recomendacoes", summed)
        self._report("recomendacoes", best)

    def kpis(self) -> None:
        batches = self.spark.read.parquet(self.paths.layer("recomendacoes"))
        self._report("kpis", kpi.summary_report(self.table("conteudo"), self.table("interacao"), batches))

    def summary(self) -> DataFrame:
        """One row per source: read, judged, corrected and loaded; and the seconds of every stage so far."""
        counts = [F.coalesce(F.sum(F.when(F.col("classificacao") == c, F.col("total"))), F.lit(0)).alias(c)
                  for c in ("validos", "invalidos", "incompletos", "duplicados")]
        log = self.corrected.select("fonte", "lidos", "corrigidos").join(self.classes.groupBy("fonte").agg(*counts), "fonte")
        times = F.lit(sum(self.seconds.values())), F.create_map(*[F.lit(x) for pair in self.seconds.items() for x in pair])
        return load.ingestion_summary(log, self.loaded).withColumns({
            "execucao_id": F.lit(self.run_id), "tempo_total_segundos": F.round(times[0], 3), "tempos_etapas": times[1]})

    # ------------------------------------------------------ jobs of their own

    def keep_masters(self, instant: str) -> None:
        """Master records and the crosswalk, brought up to date with the contents as they are loaded."""
        master_data_runs.run(self.spark, self.paths.layer("mestres"), self.table("conteudo"), instant, self.run_id)

    def publish_private(self, salt: str) -> None:
        """What consumers may see: public contents, and interactions and comments under kept pseudonyms; checked for leaks first."""
        contents, interactions, comments = self.table("conteudo"), self.table("interacao"), self.table("comentario")
        names = self.paths.layer("lgpd_restrito")
        privacy.keep_pseudonyms(self.spark, names, privacy.known_users(interactions, comments), self.run_id)
        pseudonyms = privacy.kept_pseudonyms(self.spark, names)
        dimension = dim_content(contents.withColumns({c: F.lit(None).cast("string") for c in AUDIT_COLUMNS}), self.run_id)
        published = {
            "conteudo_publico": privacy.public_content(dimension, salt), "vw_interacao_pseudonimizada": privacy.interactions_pseudonymised(interactions, pseudonyms),
            "vw_comentario_mascarado": privacy.comments_masked(comments, pseudonyms)}
        leaks = privacy.leak_check(published["conteudo_publico"], dimension, published).where("violacoes > 0").collect()
        if leaks:
            raise ValueError(f"publicacao bloqueada: {', '.join(row['verificacao'] for row in leaks)}")
        writers.publish_version(published, self.paths.layer("lgpd"), self.run_id)


def run_platform(spark: SparkSession, paths: Paths, settings: Settings, run_id: str | None = None, salt: str | None = None) -> Platform:
    """All stages in order, each timed; the first failure ends the run. With a salt, master data and the public tables follow."""
    run = Platform(spark, paths, settings, run_id)
    stages = {
        "ingestao": run.ingest, "validacao": run.validate, "tratamento": run.clean, "persistencia": run.load, "embeddings": run.embed,
        "busca_semantica": run.search, "recomendacoes": run.recommend, "kpis": run.kpis,
    }
    if salt is not None:
        stages |= {"dados_mestres": lambda: run.keep_masters(time.strftime("%Y-%m-%dT%H:%M:%S")), "lgpd": lambda: run.publish_private(salt)}
    with scratch(spark):
        for name, work in stages.items():
            begun = time.perf_counter()
            work()
            run.seconds[name] = round(time.perf_counter() - begun, 3)
        run._report("resumo_ingestao", run.summary())
    return run
