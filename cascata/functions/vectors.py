"""Vector expressions (JVM side) and the Arrow helpers the scoring tasks share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def with_norm(rows: DataFrame, column: str, name: str = "norma") -> DataFrame:
    """Add the length of a vector as a column and drop vectors without one.

    The length stays a column of its own: used inside a lambda it would be computed again
    for every element.
    """
    return rows.withColumn(name, norm(F.col(column))).where(F.col(name) > 0)


def scaled_to_unit(rows: DataFrame, column: str) -> DataFrame:
    """Scale a vector column to length one, a batch at a time; vectors of length zero are dropped."""
    fields = [T.StructField(column, T.ArrayType(T.DoubleType())) if f.name == column else f for f in rows.schema.fields]

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            block = block.filter(pc.fill_null(pc.greater(pc.list_value_length(block.column(column)), 0), False))
            if block.num_rows == 0:
                continue
            found = matrix(block.column(column), len(block.column(column)[0]))
            length = np.linalg.norm(found, axis=1)
            usable = length > 0
            found = found[usable] / length[usable, None]
            offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
            place = block.schema.get_field_index(column)
            yield block.filter(pa.array(usable)).set_column(place, column, lists)

    return rows.mapInArrow(scale, T.StructType(fields))


def round_places(c: Column, places: int) -> Column:
    """Round a double on its binary value, ties to even."""
    return F.rint(c * 10**places) / 10**places


def weighted_mean(v: Column, weight: Column) -> Column:
    """Mean vector of a group, combined in part before the shuffle."""
    return vector_to_array(Summarizer.mean(array_to_vector(v.cast("array<double>")), weight))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """An Arrow column of lists of ``dimension`` numbers as a two-dimensional array, without a Python loop."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pc.any(pc.not_equal(pc.fill_null(pc.list_value_length(column), -1), dimension)).as_py():
        raise ValueError(f"every vector must have {dimension} numbers")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(-1, dimension)
