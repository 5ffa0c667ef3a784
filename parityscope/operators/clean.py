"""Cleaning: choose, rename, filter, fill, convert and regroup columns.

All of it is row-wise: no operator here shuffles, and filters reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityscope.functions.expressions import band, collapse, integer_or_null, zero_if_null
from parityscope.roles import require_columns


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*_present(df, wanted))


def rename_near_match(df: DataFrame, fragments: Mapping[str, str]) -> DataFrame:
    """Give a missing column the first column whose name contains a fragment.

    ``fragments`` maps the proper name to the fragment, compared without regard to
    case. A proper name that exists already is left alone.
    """
    renames = {}
    for proper, fragment in fragments.items():
        if proper in df.columns:
            continue
        near = [c for c in df.columns if fragment.lower() in c.lower() and c not in renames]
        if near:
            renames[near[0]] = proper
    return df.withColumnsRenamed(renames)


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is null. NaN is a value and stays."""
    require_columns(df, columns)
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def fill_null_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null becomes zero in those of the columns that exist; types stay, NaN stays."""
    return df.withColumns({c: zero_if_null(df, c) for c in _present(df, columns)})


def try_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the columns that exist become int; what is no whole number becomes null."""
    return df.withColumns({c: integer_or_null(df, c) for c in _present(df, columns)})


def collapse_categories(
    df: DataFrame, column: str, keep: Sequence[str], output: str, other: str = "Other"
) -> DataFrame:
    """Add ``output``: the category if it is in ``keep``, otherwise ``other``."""
    return df.withColumn(output, collapse(F.col(column), keep, other))


def band_numeric(
    df: DataFrame, column: str, cuts: Sequence[tuple[float, str]], last: str, output: str
) -> DataFrame:
    """Add ``output``: the name of the left-closed band the number falls in; null is ``last``."""
    return df.withColumn(output, band(F.col(column), cuts, last))


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows in which the column has the value. Null equals nothing."""
    return df.filter(F.col(column) == value)


def table_profile(df: DataFrame, where: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: ``rows``, ``columns``, and the number of rows meeting each named condition.

    All counts come from the same scan.
    """
    conditions = [F.count_if(condition).alias(name) for name, condition in (where or {}).items()]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *conditions)
    return counts.withColumn("columns", F.lit(len(df.columns)))
