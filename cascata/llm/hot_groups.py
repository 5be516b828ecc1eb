"""Comparing the members of groups pairwise when a group may hold much of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F


def in_tiles(rows: DataFrame, keys: list[str], item: str, most: int, known: Callable[[DataFrame], DataFrame] = lambda sizes: sizes, weight: str = "1") -> DataFrame:
    """Rows of each group of two or more, laid out as the tiles of a grid.

    A group of at most ``most`` rows is one tile. A larger one is dealt into parts by a hash of
    the item, and each pair of parts (``_lo``, ``_hi``) is a tile of its own, so that every pair
    of members meets in just one tile (pairs within a part in the tile ``_lo = _hi``) and a tile
    holds about two parts at most. ``_first`` tells a tile's two sides apart. ``known`` may mark the table of
    group sizes for broadcasting where the caller knows a bound on the number of groups. ``weight``
    is what a row counts for in ``most``.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum(F.expr(weight)).alias("_weight")).where("_n > 1")
    parts = sizes.select(*keys, F.ceil(F.col("_weight") / most).cast("int").alias("_parts"))
    dealt = rows.join(known(parts), keys).withColumn("_part", F.pmod(F.xxhash64(item), F.col("_parts")).cast("int"))
    copies = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return (
        copies.withColumn("_lo", F.least("_part", "_other")).withColumn("_hi", F.greatest("_part", "_other"))
        .withColumn("_first", F.col("_part") == F.col("_lo")).drop("_part", "_other", "_parts")
    )
