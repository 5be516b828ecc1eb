"""Catalogue metadata of published tables: tags of their columns and the tables they are read from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# The tags of the contract.
INDIRECT, SENSITIVE, PERSONAL = "IdentificadorIndireto", "Sensivel", "DadoPessoal"
PSEUDONYM, MASKED, HASHED = "Pseudonimizado", "Mascarado", "HashComSalt"


def tag_of(column: str) -> str | None:
    """Sensitivity of a column by what its name says it holds; none for the others."""
    if column.endswith("_mascarado"):
        return MASKED
    if column.endswith("_hash"):
        return HASHED
    return {"usuario_id": INDIRECT, "comentario": SENSITIVE, "autor": PERSONAL, "pseudo_id": PSEUDONYM}.get(column)


def classified_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Tags of the columns that the named tables (``schema.table``) really have, with their filled rows."""
    parts = []
    for name, rows in tables.items():
        schema, table = name.split(".")
        tagged = [c for c in rows.columns if tag_of(c)]
        if not tagged:
            continue
        counted = rows.agg(*[F.count(c).alias(c) for c in tagged])
        pairs = [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("preenchidos"), F.lit(tag_of(c)).alias("classificacao")) for c in tagged]
        parts.append(counted.select(F.lit(schema).alias("esquema"), F.lit(table).alias("tabela"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


def folders_read(rows: DataFrame) -> list[str]:
    """Root folders of the stored tables that a DataFrame's plan reads."""
    leaves = rows._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("LogicalRelation") or "Relation" in leaf.nodeName():
            roots = leaf.relation().location().rootPaths()
            found.update(str(roots.apply(k).toString()) for k in range(roots.size()))
    return sorted(found)


def lineage(made: dict[str, DataFrame], stored: dict[str, str]) -> DataFrame:
    """(origem, destino) for every made table and every stored one that its plan reads.

    ``stored`` names the folder of each table; the plans are looked at before they are written.
    """
    names = {folder.removeprefix("file:").rstrip("/"): name for name, folder in stored.items()}
    edges = {
        (names[folder], name)
        for name, rows in made.items() for folder in (f.removeprefix("file:").rstrip("/") for f in folders_read(rows)) if folder in names
    }
    spark = next(iter(made.values())).sparkSession
    return spark.createDataFrame(sorted(edges), "origem string, destino string")


def upstream(edges: DataFrame, table: str, depth: int = 4) -> DataFrame:
    """Tables that feed ``table``, over at most ``depth`` layers; the layers are four."""
    reached = edges.where(F.col("destino") == table).select(F.col("origem").alias("tabela"), F.lit(1).alias("distancia"))
    level = reached
    for step in range(2, depth + 1):
        level = (
            level.join(edges, F.col("tabela") == F.col("destino"))
            .select(F.col("origem").alias("tabela"), F.lit(step).alias("distancia")).distinct()
        )
        reached = reached.unionByName(level)
    return reached.groupBy("tabela").agg(F.min("distancia").alias("distancia"))
