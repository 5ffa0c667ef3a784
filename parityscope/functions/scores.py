"""Reading and binning model scores."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_array(df: DataFrame, column: str) -> Column | None:
    """The column as an array, or None when it is a plain number."""
    kind = df.schema[column].dataType
    if isinstance(kind, VectorUDT):
        # The conversion fails on null, so a null vector must not reach it.
        return F.when(F.col(column).isNotNull(), vector_to_array(F.col(column)))
    if isinstance(kind, T.ArrayType):
        return F.col(column)
    return None


def positive_score(df: DataFrame, column: str) -> Column:
    """Score of the positive class as a double.

    Vectors and arrays give their second element, or the only one when there is
    just one; a plain number is taken as it is. Null stays null.
    """
    values = _as_array(df, column)
    if values is None:
        return F.col(column).cast("double")
    position = F.when(F.size(values) > 1, 1).otherwise(0)
    return F.get(values, position).cast("double")


def usable_score(df: DataFrame, column: str) -> Column:
    """``positive_score``, null where it is NaN: no operator counts, sums or ranks a NaN."""
    score = positive_score(df, column)
    return F.when(~F.isnan(score), score)


def probability_text(df: DataFrame, column: str) -> Column:
    """Vector or array as text, ``[0.25, 0.75]``, for sinks that hold no nested values.

    Every element keeps all its digits, so the text parses back to the same doubles.
    """
    values = _as_array(df, column)
    if values is None:
        return F.col(column).cast("string")
    parts = F.transform(values, lambda x: x.cast("double").cast("string"))
    return F.when(values.isNotNull(), F.concat(F.lit("["), F.array_join(parts, ", ", "null"), F.lit("]")))


def bin_edges(bins: int = 10) -> list[float]:
    """``bins + 1`` equally spaced doubles from 0 to 1, each edge being ``i * (1 / bins)``."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def score_bin(score: Column, bins: int = 10, include_lowest: bool = False) -> Column:
    """Number (1-based) of the right-closed bin ``(edge, next edge]`` holding the score.

    A score of exactly 0 is in no bin unless ``include_lowest``; null and values
    outside the edges are in none either.
    """
    edges = bin_edges(bins)
    lowest = score >= edges[0] if include_lowest else score > edges[0]
    found = F.when(~lowest, F.lit(None).cast("int"))
    for number, upper in enumerate(edges[1:], start=1):
        found = found.when(score <= upper, F.lit(number))
    return found
