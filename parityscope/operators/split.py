"""Repeatable train/test split and union."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HASHES = 2**32


def hash_position(key: str, salt: str = "") -> Column:
    """Position 0..2**32 - 1 of a key, the first 32 bits of its MD5; null for a null key.

    It depends on the key alone, so a row keeps its position whatever the number of
    partitions or executors and however often a task is run again.
    """
    text = F.concat(F.lit(salt), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _limit(fraction: float) -> int:
    """Positions below it are the fraction."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"train fraction {fraction} is not between 0 and 1")
    limit = round(fraction * _HASHES)
    if limit in (0, _HASHES) and fraction not in (0.0, 1.0):
        raise ValueError(f"train fraction {fraction} is too near to 0 or 1 to leave rows on both sides")
    return limit


def stratified_hash_split(
    df: DataFrame,
    key: str,
    label: str,
    train_fraction: float | Mapping[object, float] = 0.8,
    salt: str = "",
    output: str = "split",
) -> DataFrame:
    """Add ``output`` = ``train`` or ``test``, drawn within each class, without a shuffle.

    ``train_fraction`` is one fraction for the classes 0 and 1, or a mapping from
    class to fraction. Rows of any other class, or of none, get null, and so do rows
    without a key, which would otherwise all land on one side; ``split_counts`` tells
    how many. ``key`` should be unique: equal keys always land on the same side.
    """
    if not isinstance(train_fraction, Mapping):
        train_fraction = {0: train_fraction, 1: train_fraction}
    position = hash_position(key, salt)
    chain = F.when(F.col(key).isNull(), F.lit(None).cast("string"))
    for value, fraction in train_fraction.items():
        side = F.when(position < _limit(fraction), F.lit("train")).otherwise(F.lit("test"))
        chain = chain.when(F.col(label) == value, side)
    return df.withColumn(output, chain)


def split_counts(split: DataFrame, key: str, column: str = "split") -> DataFrame:
    """``split, n, without_key``: rows of each side, and of none, and those lacking the key."""
    return split.groupBy(F.col(column).alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("without_key")
    )


def train_and_test(split: DataFrame, column: str = "split") -> tuple[DataFrame, DataFrame]:
    """The two sides of a split, without the split column."""
    train, test = (split.filter(F.col(column) == side).drop(column) for side in ("train", "test"))
    return train, test


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name, repeats kept."""
    return reduce(DataFrame.unionByName, tables)


def multiset_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that one table has more often than the other, each once, with how often each has
    it (``in_first``, ``in_second``).

    Columns are matched by name; null equals null. Both tables are combined before the
    shuffle, so a row that occurs very often is one row per task.
    """
    columns = first.columns
    sides = [df.select(*columns, F.lit(a).alias("__a"), F.lit(b).alias("__b")) for df, a, b in ((first, 1, 0), (second, 0, 1))]
    counts = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("__a").alias("in_first"), F.sum("__b").alias("in_second"))
    return counts.filter("in_first <> in_second")
