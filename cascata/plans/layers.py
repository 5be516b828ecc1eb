"""Layers built from the given tables, each written once per session and then re-read."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cascata.operators import clean, gold, gold_state, load, lookup_store, master_data_runs, privacy, quality, recommend, rules, silver
from cascata.schemas import SILVER_COMMENT, SILVER_CONTENT, SILVER_INTERACTION
from cascata.session import materialize, new_folder, ship_package
from cascata.sources import driver_tables as given, versions, writers

DIMENSION = 64
MODEL = given.MODEL
RUN = given.RUN
BATCH = "2024-03-01 00:00:00"


def stored_by_run(rows: DataFrame, label: str) -> DataFrame:
    """Rows written under the run they belong to, and read back."""
    path = new_folder(rows.sparkSession, label)
    writers.append_run(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(rows.columns)


class Layers:
    """Bronze, treated and Silver tables, each stored at its first use and read from then on."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}
        self._watches: dict[str, Observation] = {}
        self._lookups: lookup_store.Store | None = None
        self._masters: str | None = None
        self._names: tuple[DataFrame, DataFrame] | None = None
        self._gold: dict[str, DataFrame] | None = None
        self._lock = threading.RLock()

    def _once(self, name: str, build, store: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
        with self._lock:
            if name not in self._stored:
                self._stored[name] = store(build(), name)
            return self._stored[name]

    @property
    def catalog(self) -> DataFrame:
        return self._once("bronze_catalogo", lambda: given.bronze_catalog(self.spark, self.sf_dir))

    @property
    def raw_interactions(self) -> DataFrame:
        return self._once("bronze_interacoes", lambda: given.bronze_interactions(self.spark, self.sf_dir))

    @property
    def raw_comments(self) -> DataFrame:
        return self._once("bronze_comentarios", lambda: given.bronze_comments(self.spark, self.sf_dir))

    @property
    def clean_catalog(self) -> DataFrame:
        return self._once("tratado_catalogo", lambda: clean.clean_catalog(self.catalog))

    @property
    def clean_interactions(self) -> DataFrame:
        return self._once("tratado_interacoes", lambda: clean.clean_interactions(self.raw_interactions))

    @property
    def clean_comments(self) -> DataFrame:
        return self._once("tratado_comentarios", lambda: clean.clean_comments(self.raw_comments))

    def _silver(self, table: str, judged, schema) -> DataFrame:
        """A Silver table, counted for the quality tests while it is written."""
        with self._lock:
            if f"silver_{table}" not in self._stored:
                rows, self._watches[table] = quality.observed(rules.approved(judged()), table)
                self._once(f"silver_{table}", lambda: silver.under_contract(rows, schema))
            return self._stored[f"silver_{table}"]

    @property
    def contents(self) -> DataFrame:
        return self._silver("conteudo", lambda: silver.judge_content(self.catalog), SILVER_CONTENT)

    @property
    def interactions(self) -> DataFrame:
        return self._silver("interacao", lambda: silver.judge_interactions(self.raw_interactions, self.contents), SILVER_INTERACTION)

    @property
    def comments(self) -> DataFrame:
        return self._silver("comentario", lambda: silver.judge_comments(self.raw_comments, self.contents), SILVER_COMMENT)

    @property
    def pseudonyms(self) -> tuple[DataFrame, DataFrame]:
        """The kept pseudonyms after a run over the users of comments, and after a second over all users."""
        with self._lock:
            if self._names is None:
                base = new_folder(self.spark, "pseudonimos")
                privacy.keep_pseudonyms(self.spark, base, self.comments.select("usuario_id").distinct(), "lgpd-1")
                first = versions.newest(self.spark, base)
                privacy.keep_pseudonyms(self.spark, base, privacy.known_users(self.interactions, self.comments), "lgpd-2")
                self._names = privacy.kept_pseudonyms(self.spark, base, first), privacy.kept_pseudonyms(self.spark, base)
            return self._names

    @property
    def lookups(self) -> lookup_store.Store:
        """The tables that look-ups by key read, stored once."""
        with self._lock:
            if self._lookups is None:
                base = new_folder(self.spark, "consultas")
                made = lookup_store.build(self.spark, base, RUN, self.documents, self.interactions, self.recommendations)
                self._lookups = lookup_store.Store(self.spark, base, made)
            return self._lookups

    @property
    def masters(self) -> str:
        """Folder of the master data kept over two runs: the older half of the contents, then the others."""
        with self._lock:
            if self._masters is None:
                base = new_folder(self.spark, "mestres")
                half = self.contents.agg(F.percentile_approx("conteudo_id", 0.5)).first()[0] or 0
                for number, part in enumerate((F.col("conteudo_id") <= half, F.col("conteudo_id") > half)):
                    master_data_runs.run(self.spark, base, self.contents.where(part), f"2024-02-0{number + 1}T00:00:00", f"mdm-{number}")
                self._masters = base
            return self._masters

    @property
    def results(self) -> DataFrame:
        """Results of the quality tests, stored, from what the writes of Silver counted."""
        def build() -> DataFrame:
            self.contents, self.interactions, self.comments
            parts = [quality.observed_rows(self.spark, table, watch, RUN) for table, watch in self._watches.items()]
            return quality.describe_results(quality.measures_of(reduce(DataFrame.unionByName, parts)), RUN)

        return self._once("qualidade", build)

    @property
    def quarantine(self) -> DataFrame:
        """Quarantine of the run, stored as its sink stores it; ``id`` orders the entries of a source by arrival."""
        def build() -> DataFrame:
            parts = [
                (silver.judge_content(self.catalog), "catalogo", self.catalog),
                (silver.judge_interactions(self.raw_interactions, self.contents), "interacoes", self.raw_interactions),
                (silver.judge_comments(self.raw_comments, self.contents), "comentarios", self.raw_comments),
            ]
            frames = [silver.to_quarantine(judged, source, raw) for judged, source, raw in parts]
            return frames[0].unionByName(frames[1]).unionByName(frames[2])

        return self._once("quarentena", build, stored_by_run)

    @property
    def repaired_contents(self) -> DataFrame:
        """Catalogue after a correction: every part is now an approved content."""
        return self._once("conteudo_corrigido", lambda: given.repaired_contents(self.spark, self.sf_dir))

    @property
    def store(self) -> DataFrame:
        return given.embeddings(self.spark, self.sf_dir)

    @property
    def stored_texts(self) -> DataFrame:
        return given.stored_texts(self.spark, self.sf_dir)

    @property
    def recommendations(self) -> DataFrame:
        return self._once("recomendacao", lambda: given.recommendations(self.spark, self.sf_dir))

    @property
    def fact(self) -> DataFrame:
        return gold.fact_engagement_day(self.interactions, RUN)

    @property
    def dimension(self) -> DataFrame:
        return gold.dim_content(self.contents, RUN)

    @property
    def gold(self) -> dict[str, DataFrame]:
        """The seven Gold tables from sums into which the interactions were merged in two loads that share their days."""
        with self._lock:
            if self._gold is None:
                base, loads = new_folder(self.spark, "estado"), F.pmod(F.xxhash64("usuario_id", "conteudo_id", "data_hora"), F.lit(2))
                for number in (0, 1):
                    version = gold_state.merge(self.spark, base, self.interactions.where(loads == number), f"{RUN}-{number}")
                self._gold = gold_state.tables(self.spark, base, version, self.contents, self.recommendations, RUN)
            return self._gold

    @property
    def blocks(self) -> DataFrame:
        """Scores that are not negative, stored: the ranking, its counters and the batch log read the same."""
        return self._once("pontuacoes", lambda: recommend.score_blocks(self.interactions, self.contents, self.store, MODEL, DIMENSION))

    @property
    def documents(self) -> DataFrame:
        return self._once("documentos", lambda: load.comment_documents(self.clean_comments, self.clean_catalog))


_layers: dict[tuple[str, str], Layers] = {}
_layers_lock = threading.Lock()


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    key = (spark.sparkContext.applicationId, sf_dir)
    with _layers_lock:
        if key not in _layers:
            ship_package(spark)
            _layers[key] = Layers(spark, sf_dir)
        return _layers[key]
