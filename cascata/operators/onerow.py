"""Putting one-row results beside each other."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Columns of several one-row frames in one row.

    The frames are stacked, each filling its own columns, and folded by a maximum that skips
    the gaps: no product of rows is involved, whatever the frames hold.
    """
    stacked = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
