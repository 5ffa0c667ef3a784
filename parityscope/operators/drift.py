"""Group metrics and disparities over sliding windows of days.

Rows are counted once, per attribute, group and day; windows are frames over these
counts, so no row is copied for the windows it lies in. A window ends on every day on
which its attribute has rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parityscope.functions.ratios import safe_ratio
from parityscope.operators.fairness import disparity, not_nan, stacked_attributes
from parityscope.roles import AuditRoles, require_columns

_COUNTS = ("n", "tp", "fp", "tn", "fn", "positives", "predicted", "predictions")


def daily_counts(df: DataFrame, roles: AuditRoles, time: str) -> DataFrame:
    """``attribute, group, day`` and counts: rows, confusion counts, ``positives`` (label 1), the
    sum ``predicted`` and number ``predictions`` of predictions. Rows without a time are on no day."""
    require_columns(df, [roles.label, roles.prediction, time, *roles.attributes])
    values = {"__y": F.col(roles.label), "__yhat": not_nan(F.col(roles.prediction)), "__day": F.unix_date(F.col(time).cast("date"))}
    y, yhat = F.col("__y"), F.col("__yhat")
    return (
        stacked_attributes(df, roles, values)
        .filter(F.col("__day").isNotNull())
        .groupBy("attribute", "group", F.col("__day").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if((y == 1) & (yhat == 1)).alias("tp"),
            F.count_if((y == 0) & (yhat == 1)).alias("fp"),
            F.count_if((y == 0) & (yhat == 0)).alias("tn"),
            F.count_if((y == 1) & (yhat == 0)).alias("fn"),
            F.count_if(y == 1).alias("positives"),
            F.sum(yhat.cast("double")).alias("predicted"),
            F.count(yhat).alias("predictions"),
        )
    )


def rolling_counts(daily: DataFrame, days: int = 7) -> DataFrame:
    """The counts of the ``days`` days up to and with each ``day``, for groups that have rows in them."""
    ends = daily.select("attribute", "day").distinct()
    groups = daily.select("attribute", F.col("group").alias("__group")).distinct()
    # Every group on every day of its attribute: counts, and rows of none, side by side.
    grid = ends.join(groups, "attribute").withColumnRenamed("__group", "group")
    grid = grid.select("attribute", "group", "day", *[F.lit(0).cast(daily.schema[c].dataType).alias(c) for c in _COUNTS])
    per_day = daily.select(*grid.columns).unionAll(grid).groupBy("attribute", "group", "day").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    frame = Window.partitionBy("attribute", "group").orderBy("day").rangeBetween(1 - days, Window.currentRow)
    return per_day.select("attribute", "group", "day", *[F.sum(c).over(frame).alias(c) for c in _COUNTS]).filter("n > 0")


def rolling_metrics(df: DataFrame, roles: AuditRoles, time: str, days: int = 7) -> DataFrame:
    """``attribute, group, window_end`` (the last day), ``n``, ``prediction_rate``, ``tpr``, ``fpr``,
    ``opportunity`` (true positive rate over all positives) and ``positives``."""
    c = F.col
    return rolling_counts(daily_counts(df, roles, time), days).select(
        "attribute",
        "group",
        F.date_from_unix_date("day").alias("window_end"),
        "n",
        F.try_divide(c("predicted"), c("predictions")).alias("prediction_rate"),
        safe_ratio(c("tp"), c("tp") + c("fn")).alias("tpr"),
        safe_ratio(c("fp"), c("fp") + c("tn")).alias("fpr"),
        safe_ratio(c("tp"), c("positives")).alias("opportunity"),
        "positives",
    )


def rolling_disparity(df: DataFrame, roles: AuditRoles, time: str, days: int = 7, null_group: str = "exclude") -> DataFrame:
    """``attribute, window_end, metric, value``: the four disparities of each window, by the rules of
    ``fairness.disparity``; the groups of a window are those with rows in it."""
    metrics = rolling_metrics(df, roles, time, days)
    gaps = {"prediction_rate": "demographic_parity_disparity", "tpr": "tpr_disparity", "fpr": "fpr_disparity"}
    by = ("window_end",)
    found = disparity(metrics, gaps, null_group=null_group, by=by)
    equal = disparity(metrics, {"opportunity": "equal_opportunity_disparity"}, F.col("positives") > 0, null_group, by)
    return found.unionByName(equal)
