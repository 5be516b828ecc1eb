"""Look-ups by key that open a few files: tables in buckets of their key, sorted, with Bloom filters.

A look-up names one key, and with it one bucket: only that bucket's files are listed and opened. Within
them, rows are sorted by the key, so that row groups and pages are skipped by their statistics, and
the Bloom filter of a second column rules out files that hold none of its value. Tags have an index of
their own, from a tag to the keys of its comments, newest first; the comments are then read by content.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cascata.operators import lookups
from cascata.sources import versions
from cascata.sources.versions import Stored, Version

BUCKETS = 32
#: Rows of a Parquet page, so that a look-up can skip most of a row group.
PAGE_ROWS = "2000"


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def _sorted(rows: DataFrame, base: str, key: str, sort: list[str], bloom: str | None = None) -> Stored:
    options = {"parquet.page.row.count.limit": PAGE_ROWS}
    if bloom:
        options[f"parquet.bloom.filter.enabled#{bloom}"] = "true"
    return versions.stage(rows, base, _bucket(F.col(key)), sort=[key, *sort], **options)


def build(spark: SparkSession, base: str, run_id: str, documents: DataFrame, interactions: DataFrame, recommendations: DataFrame) -> Version:
    """Store the tables that look-ups read, as one commit."""
    tagged = documents.select(F.explode("tags").alias("tag"), "conteudo_id", "usuario_id", "data").distinct()
    return versions.commit(spark, base, versions.newest(spark, base), run_id, {
        "comentarios": _sorted(documents, base, "conteudo_id", ["data"], "usuario_id"),
        "tags": _sorted(tagged, base, "tag", ["data"]),
        "interacoes": _sorted(interactions, base, "usuario_id", ["conteudo_id"], "conteudo_id"),
        "recomendacoes": _sorted(recommendations, base, "usuario_id", ["gerado_em"], "conteudo_id"),
    })


@dataclass(frozen=True)
class Store:
    """A version of the stored tables."""

    spark: SparkSession
    base: str
    version: Version

    def of(self, table: str, key: str, values: list) -> DataFrame:
        """Rows of some keys, from the buckets they fall in."""
        kind = self.spark.createDataFrame([(v,) for v in values], f"k {'string' if key == 'tag' else 'bigint'}")
        buckets = {str(row[0]) for row in kind.select(_bucket(F.col("k"))).distinct().collect()}
        return versions.read(self.spark, self.base, self.version, table, buckets).where(F.col(key).isin(values))

    def comments_of_content(self, content: int, limit: int = 10) -> DataFrame:
        return lookups.comments_of_content(self.of("comentarios", "conteudo_id", [content]), content, limit)

    def comments_by_tag(self, tag: str, limit: int = 10) -> DataFrame:
        """The newest of a tag: their keys from the index, then the comments from the buckets of at most ``limit`` contents."""
        keys = ["conteudo_id", "usuario_id", "data"]
        first = self.of("tags", "tag", [tag]).orderBy(F.desc("data"), "usuario_id", "conteudo_id").limit(limit).select(*keys).collect()
        if not first:
            return versions.read(self.spark, self.base, self.version, "comentarios", [])
        named = self.spark.createDataFrame(first, "conteudo_id bigint, usuario_id bigint, data date")
        there = self.of("comentarios", "conteudo_id", sorted({r["conteudo_id"] for r in first}))
        return lookups.comments_by_tag(there.join(named, keys, "left_semi").select(*there.columns), tag, limit)

    def completed_by_user(self, contents: DataFrame, user: int) -> DataFrame:
        return lookups.completed_by_user(self.of("interacoes", "usuario_id", [user]), contents, user)

    def user_ranking(self, contents: DataFrame, user: int, newest) -> DataFrame:
        """One user's rows of the batch ``newest``, which the caller knows; other batches' row groups are skipped."""
        mine = self.of("recomendacoes", "usuario_id", [user]).where(F.col("gerado_em") == F.lit(newest))
        return lookups.user_ranking(mine, contents, user)
