"""Insert-or-update and insert-or-ignore on a business key, as DataFrames; ``sources.keyed`` does it on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def last_per_key(updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One update per key, the latest by a unique ``order``; balanced when a key is hot."""
    latest = updates.groupBy(*keys).agg(F.max(order).alias("_ultima")).select("_ultima")
    return updates.join(latest, updates[order] == latest["_ultima"], "left_semi")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """New version of ``target``: rows of ``updates`` replace those with the same key.

    Both sides have one row per key, so the anti join cannot meet a hot key.
    """
    untouched = target.join(updates.select(*keys), keys, "left_anti")
    return untouched.unionByName(updates.select(target.columns))


def insert_absent(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` plus the rows of ``updates`` whose key it lacks."""
    fresh = updates.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(target.columns))
