"""Tables of vectors as numpy matrices, and their components as integers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_integers(vectors: DataFrame, scale: int, shift: int = 0) -> DataFrame:
    """``vec_id`` and ``vec``, the integers ``floor(scale * x) + shift``, of the vectors that
    are not null and hold neither null nor non-finite components."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))))
    return rows.withColumn("vec", F.transform("vec", lambda x: F.floor(scale * x).cast("long") + shift))


def most_frequent_length(rows: DataFrame) -> int | None:
    """The number of components that most vectors have, the smaller one of equally frequent ones."""
    lengths = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), "dim").first()
    return None if first is None else first.dim


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The lists of a column, all of one length, as the rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))
