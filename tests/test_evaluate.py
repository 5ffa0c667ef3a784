import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from parityscope.operators import evaluate, fairness
from parityscope.plans.audit_views import LINES_ROLES, audit_lines
from parityscope.roles import AuditRoles


def _brute_force_auc(rows):
    """Share of (positive, negative) pairs ranked rightly, ties counting half."""
    positives = [s for y, s in rows if y == 1 and s is not None]
    negatives = [s for y, s in rows if y == 0 and s is not None]
    won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    return won / (len(positives) * len(negatives))


def test_auc_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1)], "y int, s double")
    assert evaluate.auc(df, "y", "s").first().auc == 0.875


@pytest.mark.parametrize("partitions", [1, 8, 300])
@pytest.mark.parametrize("kind", ["spread", "ties", "hot"])
def test_auc_against_brute_force(spark, partitions, kind):
    draw = random.Random(partitions)
    rows = []
    for _ in range(600):
        y = draw.choice([0, 0, 1, None, 2])
        score = {
            "spread": draw.gauss(0, 1) + (y or 0),
            "ties": float(draw.randint(0, 4)),
            "hot": 0.5 if draw.random() < 0.4 else draw.random(),
        }[kind]
        rows.append((y, None if draw.random() < 0.05 else score))
    df = spark.createDataFrame(rows, "y int, s double")
    expected = _brute_force_auc(rows)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for parts in (1, 16):
            found = evaluate.auc(df.repartition(parts), "y", "s").first().auc
            assert found == pytest.approx(expected, abs=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_auc_passes_over_nan_scores(spark):
    rows = [(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1), (0, float("nan")), (1, float("nan"))]
    assert evaluate.auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc == 0.875


def test_auc_without_a_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4)], "y int, s double")
    assert evaluate.auc(df, "y", "s").first().auc is None
    assert evaluate.auc(df.limit(0), "y", "s").first().auc is None


def test_metrics_equal_the_library_evaluators(spark, sf_medium):
    lines = audit_lines(spark, sf_medium).withColumns(
        {"label": F.col("label").cast("double"), "prediction": F.col("prediction").cast("double")}
    ).cache()
    ours = evaluate.classification_metrics(lines, LINES_ROLES).first()
    names = {
        "accuracy": "accuracy", "precision": "weightedPrecision",
        "recall": "weightedRecall", "f1_score": "f1",
    }
    for mine, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(metricName=theirs)
        assert ours[mine] == pytest.approx(evaluator.evaluate(lines), abs=1e-12)
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert ours.auc == pytest.approx(exact.evaluate(lines), abs=1e-12)
    assert ours.recall == pytest.approx(ours.accuracy, abs=1e-12)
    lines.unpersist()


def test_class_never_predicted_has_precision_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (None, 1), (1, None)], "y int, p int")
    rows = {r["class"]: r for r in evaluate.class_metrics(df, "y", "p").collect()}
    assert rows[1].precision == 0.0 and rows[1].f1 == 0.0
    assert rows[0].precision == 0.5 and rows[0].recall == 1.0
    metrics = evaluate.classification_metrics(df, AuditRoles("y", "p")).first()
    assert metrics.accuracy == 0.5 and metrics.positive_precision == 0.0
    assert "auc" not in metrics.asDict()


def test_metrics_of_nothing_are_null(spark):
    df = spark.createDataFrame([], "y int, p int, s double")
    metrics = evaluate.classification_metrics(df, AuditRoles("y", "p", score="s")).first()
    assert set(metrics.asDict().values()) == {None}


def test_confusion_grid_is_full(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (None, 1.0), (3, 1.0)], "y int, p double")
    counts = {(r.label, r.prediction): r.n for r in evaluate.confusion_counts(df, "y", "p").collect()}
    assert counts == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}
    matrix = {r.label: (r.predicted_0, r.predicted_1) for r in evaluate.confusion_matrix(df, "y", "p").collect()}
    assert matrix == {0: (0, 0), 1: (0, 2)}


def test_values_that_name_no_class_are_not_counted(spark):
    nan = float("nan")
    rows = [(1.0, 1.0), (1.0, 0.9), (0.0, 1.5), (1.0, nan), (nan, 1.0), (0.0, None), (None, 0.0), (0.0, 2.0), (0.0, 0.0), (1.0, 0.0), (0.5, 0.0)]
    df = spark.createDataFrame([(*r, "g", 0.5) for r in rows], "y double, p double, g string, s double")
    counts = {(r.label, r.prediction): r.n for r in evaluate.confusion_counts(df, "y", "p").collect()}
    assert counts == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 1}
    group = fairness.confusion_by_group(df, AuditRoles("y", "p", ("g",))).first()
    assert (group.tn, group.fp, group.fn, group.tp) == (1, 0, 1, 1)
    classes = {r["class"]: (r.tp, r.actual, r.predicted) for r in evaluate.class_metrics(df, "y", "p").collect()}
    assert classes == {0: (1, 2, 2), 1: (1, 2, 1), 2: (0, 0, 1)}
    for score in (None, "s"):
        assert evaluate.classification_metrics(df, AuditRoles("y", "p", score=score)).first().accuracy == 0.5


def test_metrics_with_missing_and_nan_scores(spark):
    rows = [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 0, 0.1), (0, 1, float("nan")), (1, 1, None), (0, None, 0.2)]
    df = spark.createDataFrame(rows, "y int, p int, s double")
    metrics = evaluate.classification_metrics(df, AuditRoles("y", "p", score="s")).first()
    assert metrics.accuracy == pytest.approx(4 / 6)
    assert metrics.auc == evaluate.auc(df, "y", "s").first().auc == pytest.approx(5.5 / 6)
