"""Descriptive statistics of a cleaned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityscope.functions.ratios import safe_ratio


def summary(df: DataFrame, label: str, positive: object = 1) -> DataFrame:
    """One row: ``total_records`` and ``positive_rate``.

    The rate counts rows whose label is missing in its denominator, and is 0 for an
    empty table.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(label) == positive).alias("positives"),
    )
    return counts.select(
        "total_records", safe_ratio(F.col("positives"), F.col("total_records")).alias("positive_rate")
    )


def distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column: ``attribute, value, n``; null is a value.

    All columns are counted in one scan. Counts are combined before the shuffle, so
    a very frequent value costs no more than a rare one.
    """
    texts = df.select([F.col(c).cast("string").alias(c) for c in columns])
    if len(columns) == 1:
        stacked = texts.select(F.lit(columns[0]).alias("attribute"), F.col(columns[0]).alias("value"))
    else:
        stacked = texts.unpivot([], list(columns), "attribute", "value")
    return stacked.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_groups(df: DataFrame, column: str) -> DataFrame:
    """The values of a column, each once, null included; no order."""
    return df.select(column).distinct()


def share_of_total(df: DataFrame, column: str, values: Sequence[object] | None = None) -> DataFrame:
    """Rows per value and their percentage of all rows: ``<column>, n, percent``.

    With ``values``, exactly these are reported, a missing one with 0; an empty
    table gives no row at all.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    if values is not None:
        kind = df.schema[column].dataType
        named = F.explode(F.array(*[F.lit(v).cast(kind) for v in values])).alias(column)
        zeros = df.sparkSession.range(1).select(named).withColumn("n", F.lit(0).cast("bigint"))
        counts = (
            counts.filter(F.col(column).isin(list(values)))
            .unionByName(zeros)
            .groupBy(column)
            .agg(F.sum("n").alias("n"))
        )
    return counts.withColumn("percent", 100.0 * F.col("n") / total).filter(F.col("percent").isNotNull())


def group_label_counts(df: DataFrame, group: str, label: str) -> DataFrame:
    """Rows per (group, label): ``<group>, <label>, n``; nulls are values."""
    return df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))


def group_label_pivot(
    df: DataFrame, group: str, label: str, classes: Sequence[object] = (0, 1), prefix: str = "n_"
) -> DataFrame:
    """One row per group with a count column for each declared class, 0 where there are none."""
    counted = df.groupBy(group).pivot(label, list(classes)).agg(F.count(F.lit(1)))
    return counted.select(
        group,
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(f"{prefix}{c}") for c in classes],
    )


def rate_by_group(df: DataFrame, group: str, label: str) -> DataFrame:
    """Positive rate per group among its rows labelled 0 or 1: ``<group>, n_0, n_1, rate``.

    A group without such rows has a null rate.
    """
    counts = df.groupBy(group).agg(
        F.count_if(F.col(label) == 0).alias("n_0"), F.count_if(F.col(label) == 1).alias("n_1")
    )
    return counts.withColumn("rate", F.try_divide(F.col("n_1"), F.col("n_0") + F.col("n_1")))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Rows in ``bins`` equally wide bins over the column's range: ``bin, lower, upper, n``.

    Bins are left-closed and the last one holds the maximum as well. Empty bins are
    left out, nulls and NaN are in none; a constant column fills bin 0. The range
    comes from an aggregate of the same column, put in as a scalar.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("value")).filter(~F.isnan("value") & F.col("value").isNotNull())
    bounds = values.agg(F.min("value").alias("lower"), F.max("value").alias("upper"))
    lower, upper = bounds.select("lower").scalar(), bounds.select("upper").scalar()
    width = (upper - lower) / F.lit(float(bins))
    number = F.coalesce(F.floor(F.try_divide(F.col("value") - lower, width)), F.lit(0))
    return (
        values.groupBy(F.least(number, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (lower + F.col("bin") * width).alias("lower"),
            (lower + (F.col("bin") + 1) * width).alias("upper"),
            "n",
        )
    )
