"""A corpus from raw documents to packed windows, as stages that are stored one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cascata.llm import lang_id, quality, queries, simhash
from cascata.session import materialize

#: Least share of the likeliest language.
LEAST_CERTAIN = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter and those left wide open go."""
    found = lang_id.predict(docs, queries.language_model(docs), names=("_lang", "_certain"))
    return found.where((F.col("_lang") != lang_id.UNKNOWN) & (F.col("_certain") >= LEAST_CERTAIN)).select(*docs.columns)


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer trained on weak labels takes for good."""
    return quality.score(docs, quality.fit(docs), names=("_posterior", "_quality", "_keep")).where("_keep").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words."""
    return simhash.keep_first(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2,048 tokens; one row per piece."""
    return queries.packed(docs)


STAGES = [("language", language), ("quality", good_text), ("near_copies", near_copies), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
