"""Training and scoring of the classifiers, and their most important features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityscope.functions.scores import positive_score
from parityscope.operators.features import ASSEMBLED, SCALED, feature_stages
from parityscope.roles import require_columns

# Settings of the audited random forest.
FOREST_SETTINGS = {
    "numTrees": 300,
    "maxDepth": 25,
    "minInstancesPerNode": 1,
    "minInfoGain": 0.0,
    "maxBins": 128,
    "subsamplingRate": 0.85,
    "featureSubsetStrategy": "sqrt",
    "impurity": "gini",
    "seed": 42,
}

_ESTIMATORS = {"rf": RandomForestClassifier, "logreg": LogisticRegression}


# Tasks that train on sorted rows, unless the caller says otherwise. Bagging draws rows per
# partition, so this number is part of what makes a forest repeatable: it depends neither
# on the rows nor on the session. Each forest task holds statistics of many tree nodes (up
# to maxMemoryInMB); raise the number with the cluster.
TRAINING_PARTITIONS = 8


def fit_classifier(
    train: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    estimator: str = "rf",
    scale: bool = True,
    order_by: str | None = None,
    training_partitions: int = TRAINING_PARTITIONS,
    **settings,
) -> PipelineModel:
    """Fit feature stages and classifier together on the training rows.

    ``estimator`` is ``rf`` (random forest, with ``FOREST_SETTINGS`` unless overridden)
    or ``logreg`` (logistic regression). Further keyword arguments are settings of the
    MLlib estimator. With ``order_by``, a unique key, the rows are spread over
    ``training_partitions`` and sorted by that key first, so that bagging draws the same
    rows however the input was laid out; the same number gives the same forest.

    Fitting passes over the rows several times, so the needed columns are kept, in
    memory and beyond that on disk, until it is done; the source is read once.
    """
    if estimator not in _ESTIMATORS:
        raise ValueError(f"unknown estimator {estimator!r}; choose one of {sorted(_ESTIMATORS)}")
    keys = [] if order_by is None else [order_by]
    needed = list(dict.fromkeys([*keys, label, *numeric, *categorical]))
    rows = require_columns(train, needed).select(*needed).filter(F.col(label).isNotNull())
    if order_by is not None:
        rows = rows.repartition(training_partitions, order_by).sortWithinPartitions(order_by)
    if estimator == "rf":
        settings = {**FOREST_SETTINGS, **settings}
    classifier = _ESTIMATORS[estimator](
        labelCol=label, featuresCol=SCALED if scale else ASSEMBLED, **settings
    )
    stages = feature_stages(numeric, categorical, scale).getStages()
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[*stages, classifier]).fit(rows)
    finally:
        rows.unpersist()


def score(model: PipelineModel, df: DataFrame, output: str = "score") -> DataFrame:
    """Add the model's columns and ``output``, the probability of class 1."""
    scored = model.transform(df)
    return scored.withColumn(output, positive_score(scored, "probability"))


def feature_importance(model: PipelineModel, spark, k: int | None = None) -> DataFrame:
    """``feature, importance`` of a fitted forest, largest first; the ``k`` largest if given."""
    forest = model.stages[-1]
    if not hasattr(forest, "featureImportances"):
        raise ValueError("the classifier has no feature importances")
    (assembler,) = [s for s in model.stages if isinstance(s, VectorAssembler)]
    weights = [float(w) for w in forest.featureImportances.toArray()]
    table = spark.createDataFrame(
        list(zip(assembler.getInputCols(), weights)), "feature string, importance double"
    )
    ranked = table.orderBy(F.desc("importance"), F.asc("feature"))
    return ranked if k is None else ranked.limit(k)
