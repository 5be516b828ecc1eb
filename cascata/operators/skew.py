"""Joins and first-occurrence marks that stay balanced when one key holds much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup(facts: DataFrame, dimension: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join many facts to a dimension that has one row per key: a plain equi-join over shuffled sides.

    The dimension is never broadcast: it grows with the data, and Spark guesses its size from that of its files, which
    hold such columns in a fraction of what they take in memory on the driver. The skew join splits the facts of a hot key over tasks
    by their measured size, so that only hot keys cost more than one copy of their dimension row.
    """
    return facts.join(dimension.hint("merge"), on, how)


def mark_repeats(rows: DataFrame, keys: list[str], order: str, name: str = "repetida") -> DataFrame:
    """Add a flag that is true on every row of a key but its first.

    ``order`` is unique per row. The first of each key is a plain minimum, which Spark
    computes in part before the shuffle, and is joined back on the unique order value, so
    no task ever receives all rows of a hot key. There may be as many firsts as rows: they are shuffled, not broadcast. Null key parts count as equal.
    """
    firsts = rows.groupBy(*keys).agg(F.min(order).alias("_primeira")).select("_primeira")
    return (
        rows.join(firsts.hint("merge"), rows[order] == firsts["_primeira"], "left")
        .withColumn(name, F.col("_primeira").isNull())
        .drop("_primeira")
    )


def newest_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keep the row with the largest ``order`` of each key, by the same balanced join."""
    newest = rows.groupBy(*keys).agg(F.max(order).alias("_ultima")).select("_ultima")
    return rows.join(newest.hint("merge"), rows[order] == newest["_ultima"], "left_semi")
