"""Parquet tables and bounded exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write the table, replacing what is there, and return the written table.

    The result reads from storage, so it carries no lineage: work done on it never
    repeats the work that made it, also when executors are lost.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def first_rows(df: DataFrame, n: int, order_by: str | list[str]) -> DataFrame:
    """The ``n`` first rows in the given order, nulls last.

    Spark takes the top ``n`` of each partition before merging, so no full sort is
    made. Give a unique key to make the choice definite.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)
