"""As-of join: to each row the latest row of another table that is not later.

Labels and attributes change with time; an audit needs those that held when a prediction
was made. Both tables are stacked and sorted by time, and the last value is carried
forward. Time is cut to slices: values are carried inside a slice of one key, and a slice
begins with the last value of the slices before it, which are one row each. So a key that
holds a large share of all rows is as many tasks as it has slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    time: str,
    right_time: str | None = None,
    columns: Sequence[str] | None = None,
    slice_seconds: int = 30 * 86_400,
    tolerance_seconds: int | None = None,
) -> DataFrame:
    """All rows of ``left`` with ``columns`` of the latest row of ``right`` of equal ``by`` whose time
    is not later, and that row's time as ``<right_time>_matched``.

    ``columns`` are all others of ``right`` by default; their names must be none of ``left``'s.
    Of several right rows of one time the one with the largest columns (in order, null
    least) counts. A row whose key or time is null, or that has no earlier right row, or
    none within the tolerance, gets nulls. ``slice_seconds`` cuts the work, not the result.
    """
    right_time = right_time or time
    matched = f"{right_time}_matched"
    columns = [c for c in right.columns if c not in (*by, right_time)] if columns is None else list(columns)
    if clash := {*columns, matched} & set(left.columns):
        raise ValueError(f"columns {sorted(clash)} are in both tables")
    keys = [f"__key_{i}" for i in range(len(by))]

    def placed(df: DataFrame, at: str) -> list[Column]:
        instant = F.unix_micros(F.col(at).cast("timestamp"))
        part = F.floor(instant / (slice_seconds * 1_000_000))
        return [*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], instant.alias("__at"), part.alias("__slice")]

    def complete(names: list[str]) -> Column:
        whole = F.col("__at").isNotNull()
        for k in names:
            whole &= F.col(k).isNotNull()
        return whole

    value = F.struct(F.col(right_time).alias("__time"), *[F.col(c) for c in columns])
    values = right.select(*placed(right, right_time), value.alias("__value")).filter(complete(keys))
    rows = left.select(*placed(left, time), F.struct(*[F.col(c) for c in left.columns]).alias("__row"))
    lacking = rows.filter(~complete(keys)).select("__row", F.lit(None).cast(values.schema["__value"].dataType).alias("__value"), "__at")
    rows = rows.filter(complete(keys))

    # What a slice begins with: the last value of the slices of its key before it.
    last = values.groupBy(*keys, "__slice").agg(F.max(F.struct("__at", "__value")).alias("__last"))
    slices = rows.select(*keys, "__slice").distinct().join(last, [*keys, "__slice"], "full")
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    begun = slices.select(*keys, "__slice", F.last("__last", ignorenulls=True).over(before).alias("__begun"))

    stacked = rows.select(*keys, "__slice", "__at", F.lit(1).alias("__side"), "__row", F.lit(None).cast(values.schema["__value"].dataType).alias("__value"))
    stacked = stacked.unionAll(
        values.select(*keys, "__slice", "__at", F.lit(0).alias("__side"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), "__value")
    )
    carried = Window.partitionBy(*keys, "__slice").orderBy("__at", "__side", "__value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = stacked.withColumn("__found", F.last("__value", ignorenulls=True).over(carried)).filter("__side = 1")
    found = found.join(begun, [*keys, "__slice"], "left").select(
        "__row", F.coalesce("__found", F.col("__begun.__value")).alias("__value"), "__at"
    )
    if tolerance_seconds is not None:
        near = F.col("__at") - F.unix_micros(F.col("__value.__time").cast("timestamp")) <= tolerance_seconds * 1_000_000
        found = found.withColumn("__value", F.when(near, F.col("__value")))
    result = found.unionAll(lacking)
    return result.select("__row.*", F.col("__value.__time").alias(matched), *[F.col(f"__value.`{c}`").alias(c) for c in columns])
