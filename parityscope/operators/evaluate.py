"""Quality of predictions: confusion counts, class-weighted metrics, AUC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parityscope.functions.ratios import safe_ratio
from parityscope.functions.scores import usable_score
from parityscope.roles import AuditRoles


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)


def _class_of(df: DataFrame, column: str) -> Column:
    """The class that a value names, as an int.

    Null for null, NaN, and any value that is not a whole number: 0.9 is not class 0.
    """
    value = F.col(column)
    if isinstance(df.schema[column].dataType, _WHOLE):
        return value.cast("int")
    number = value.try_cast("double")
    return F.when((F.abs(number) < 2.0**31) & (number == F.floor(number)), number.cast("int"))


def _observed_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``label, prediction, n`` over all rows, null standing for no class."""
    classes = df.select(_class_of(df, label).alias("label"), _class_of(df, prediction).alias("prediction"))
    return classes.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_counts(
    df: DataFrame, label: str, prediction: str, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """``label, prediction, n`` for every pair of the declared classes, 0 where none occurs.

    Rows missing the label or the prediction, or holding another class, are not counted.
    """
    kinds = F.array(*[F.lit(c) for c in classes])
    grid = (
        df.sparkSession.range(1)
        .select(F.explode(kinds).alias("label"))
        .select("label", F.explode(kinds).alias("prediction"), F.lit(0).cast("bigint").alias("n"))
    )
    observed = _observed_counts(df, label, prediction).filter(
        F.col("label").isin(list(classes)) & F.col("prediction").isin(list(classes))
    )
    return observed.unionByName(grid).groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """One row per declared actual class, one column ``predicted_<class>`` per declared class."""
    counts = confusion_counts(df, label, prediction, classes)
    return counts.groupBy("label").agg(
        *[
            F.sum(F.when(F.col("prediction") == c, F.col("n")).otherwise(0)).alias(f"predicted_{c}")
            for c in classes
        ]
    )


def _per_class(counts: DataFrame) -> DataFrame:
    """Per class, from ``label, prediction, n``; rows without either are passed over."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    as_actual = F.struct(
        F.col("label").alias("class"), F.col("n").alias("actual"),
        F.lit(0).cast("bigint").alias("predicted"), hit.alias("tp"),
    )
    as_predicted = F.struct(
        F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("actual"),
        F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp"),
    )
    both = F.when(F.col("label").isNotNull() & F.col("prediction").isNotNull(), F.array(as_actual, as_predicted))
    per_class = (
        counts.select(F.inline(both))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "actual", "predicted")])
        .withColumn("precision", safe_ratio(F.col("tp"), F.col("predicted")))
        .withColumn("recall", safe_ratio(F.col("tp"), F.col("actual")))
    )
    p, r = F.col("precision"), F.col("recall")
    return per_class.withColumn("f1", safe_ratio(2 * p * r, p + r))


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class: ``class, tp, actual, predicted, precision, recall, f1``; empty ratios are 0.

    Classes are whole numbers. Rows whose label or prediction is null, NaN or no whole
    number are left out.
    """
    return _per_class(_observed_counts(df, label, prediction))


def classification_metrics(df: DataFrame, roles: AuditRoles) -> DataFrame:
    """One row: accuracy, class-weighted precision, recall and F1, the same three for
    the positive class alone, and ``auc`` when the roles name a score.

    Classes are weighted by how often they are the true class. On no rows every ratio
    is null. The table is read once: rows are counted per score, label and prediction,
    and both the classes and the ranking are computed from these counts.
    """
    if roles.score is None:
        counts = _observed_counts(df, roles.label, roles.prediction)
    else:
        classes = {"label": _class_of(df, roles.label), "prediction": _class_of(df, roles.prediction)}
        cells = (
            df.select(usable_score(df, roles.score).alias("score"), *[c.alias(n) for n, c in classes.items()])
            .groupBy("score", "label", "prediction")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        counts = cells.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    per_class = _per_class(counts)
    total = F.sum("actual")

    def weighted(metric: str):
        return F.try_divide(F.sum(F.col(metric) * F.col("actual")), total)

    def of_positive(metric: str):
        value = F.max(F.when(F.col("class") == 1, F.col(metric)))
        return F.when(total > 0, F.coalesce(value, F.lit(0.0)))

    metrics = per_class.agg(
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1_score"),
        of_positive("precision").alias("positive_precision"),
        of_positive("recall").alias("positive_recall"),
        of_positive("f1").alias("positive_f1"),
    )
    if roles.score is None:
        return metrics

    # Scores are judged inside the sums, not by a filter, which Spark would move below the
    # counts: as it is, the shuffle of the cells is the same as above and is computed once.
    def counted(label: int):
        return F.sum(F.when(F.col("score").isNotNull() & (F.col("label") == label), F.col("n")).otherwise(0))

    by_score = cells.groupBy("score").agg(counted(1).alias("pos"), counted(0).alias("neg"))
    return metrics.withColumn("auc", _area(by_score.filter(F.col("pos") + F.col("neg") > 0)).scalar())


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row, ``auc``: exact area under the ROC curve, ties counting half.

    Rows labelled other than 0 or 1, and rows whose score is null or NaN, are left
    out; the area is null when either class is absent.

    Rows are first combined per distinct score, so a score held by very many rows is
    one row afterwards.
    """
    scored = df.select(F.col(label).alias("label"), usable_score(df, score).alias("score"))
    scored = scored.filter(F.col("label").isin(0, 1) & F.col("score").isNotNull())
    return _area(
        scored.groupBy("score").agg(
            F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
        )
    )


def _area(by_score: DataFrame) -> DataFrame:
    """``auc`` from the numbers of positives and negatives of each score.

    Scores are dealt out by ranges, as many as there are shuffle partitions. A running
    sum inside each range, and one over the ranges, give the number of negatives
    ranked below every score; a single task only sees one row per range.
    """
    ranked = by_score.repartitionByRange("score").withColumn("range", F.spark_partition_id())
    up_to_here = Window.partitionBy("range").orderBy("score").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    below = F.sum("neg").over(up_to_here) - F.col("neg")
    per_range = (
        ranked.withColumn("area", F.col("pos") * (below + F.col("neg") / 2))
        .groupBy("range")
        .agg(F.sum("area").alias("area"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )

    up_to_range = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("neg").over(up_to_range) - F.col("neg")
    whole = per_range.withColumn("area", F.col("area") + F.col("pos") * before.cast("double"))
    return whole.agg(
        F.try_divide(
            F.sum("area"), F.sum("pos").cast("double") * F.sum("neg").cast("double")
        ).alias("auc")
    )
