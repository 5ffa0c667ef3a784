"""Mergeable sketches: numbers of different values, and quantiles, of bounded size.

A sketch of a part of a table costs some kilobytes whatever its rows, and sketches of parts
merge to that of the whole, so they can be stored beside the cells of an audit and
merged by day, group or version without reading rows again.

Errors: the number of different values is off by ``DISTINCT_ERROR`` of itself, as a standard
error; the rank of a quantile by ``RANK_ERROR`` of all rows at 99 % confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Registers (their logarithm) of a sketch of different values, and its standard error.
DISTINCT_BITS, DISTINCT_ERROR = 14, 1.04 / 2**7
#: Size of a sketch of quantiles and the error of its ranks.
QUANTILE_SIZE, RANK_ERROR = 800, 0.0035


def sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A row per column, and per value of ``by``: ``column, n`` (values that are not null),
    ``distinct_sketch`` and, for numbers, ``quantile_sketch`` (NaN is left out).

    All columns are sketched in one scan, combined before the shuffle.
    """
    entries = []
    aggregates = []
    for i, c in enumerate(columns):
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        aggregates += [F.count(c).alias(f"n_{i}"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(DISTINCT_BITS)).alias(f"d_{i}")]
        if numeric:
            value = F.col(c).cast("double")
            aggregates.append(F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(QUANTILE_SIZE)).alias(f"q_{i}"))
        quantiles = F.col(f"q_{i}") if numeric else F.lit(None).cast("binary")
        fields = (F.lit(c).alias("column"), F.col(f"n_{i}").alias("n"), F.col(f"d_{i}").alias("distinct_sketch"), quantiles.alias("quantile_sketch"))
        entries.append(F.struct(*fields))
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*entries)))


def merge_sketches(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts as those of the whole, or of the wholes of each value of ``by``."""
    return parts.groupBy(*by, "column").agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def distinct_estimates(found: DataFrame) -> DataFrame:
    """Adds ``distinct_estimate`` to sketches."""
    return found.withColumn("distinct_estimate", F.hll_sketch_estimate("distinct_sketch"))


def quantile_estimates(found: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share`` and ``quantile`` for each share of each numeric column's sketch that has values."""
    some = found.filter(F.col("quantile_sketch").isNotNull() & (F.col("n") > 0))
    kept = [c for c in some.columns if not c.endswith("_sketch")]
    points = [F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(s))).alias("quantile")) for s in shares]
    return some.select(*kept, F.inline(F.array(*points)))
