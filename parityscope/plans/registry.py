"""One query per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityscope import roles
from parityscope.functions import (
    all_flag,
    flag,
    positive_score,
    power,
    probability_text,
    product,
    range_flag,
    row_sum,
)
from parityscope.operators import clean, evaluate, fairness, features, model, profile, split
from parityscope.plans import state_queries
from parityscope.plans.audit_views import (
    DOCS_ROLES,
    LINES_ROLES,
    ORDERS_CATEGORICAL,
    ORDERS_NUMERIC,
    ORDERS_ROLES,
    audit_docs,
    audit_lines,
    audit_orders,
    table,
)
from parityscope.plans.scratch import scratch_path
from parityscope.sources import (
    first_rows,
    load_model,
    read_csv,
    save_model,
    write_parquet,
    write_predictions_csv,
)

Query = Callable[[SparkSession, str], DataFrame]

DOCS_BY_LANG = replace(DOCS_ROLES, attributes=("lang",))
LINES_BY_SEGMENT = replace(LINES_ROLES, attributes=("c_mktsegment",))
PAIR = ("BUILDING", "MACHINERY")
SMALL_FOREST = {"numTrees": 10, "maxDepth": 4, "featureSubsetStrategy": "all"}


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Sources and sinks


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    path = scratch_path(spark, "customer_csv")
    customer.write.mode("overwrite").option("header", True).csv(path)
    return read_csv(spark, path, schema=customer.schema)


def csv_inferred_types(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "customer_csv")
    table(spark, folder, "customer").write.mode("overwrite").option("header", True).csv(path)
    return read_csv(spark, path)


def csv_duplicate_header(spark: SparkSession, folder: str) -> DataFrame:
    # A blank after the name lets Spark write it twice; the reader trims header names.
    twice = table(spark, folder, "customer").select(
        "c_custkey", "c_acctbal", "c_name", (-F.col("c_acctbal")).alias("c_acctbal ")
    )
    path = scratch_path(spark, "twice_csv")
    twice.write.mode("overwrite").option("header", True).csv(path)
    return read_csv(spark, path, schema="c_custkey bigint, c_acctbal double, c_name string")


def parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return write_parquet(table(spark, folder, "orders"), scratch_path(spark, "orders"))


def predictions_csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    length = F.col("n_chars").cast("double")
    positive = length / (length + 1000)
    chars = table(spark, folder, "documents").select("doc_id", positive.alias("p"))
    scored = audit_docs(spark, folder).join(chars, "doc_id")
    scored = scored.withColumn("probability", array_to_vector(F.array(1 - F.col("p"), F.col("p"))))
    path = scratch_path(spark, "predictions_csv")
    columns = ["doc_id", "label", "prediction", "lang"]
    write_predictions_csv(scored, path, columns)
    back = read_csv(
        spark, path, "doc_id bigint, label int, prediction int, lang string, probability_str string"
    )
    parsed = F.from_json("probability_str", "array<double>")
    return back.select(*columns, F.get(parsed, 1).alias("positive_probability"))


def vector_to_text(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("vector")
    )
    texts = vectors.select("vec_id", probability_text(vectors, "vector").alias("text"))
    values = F.from_json("text", "array<double>")
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return texts.select("vec_id", F.size(values).alias("n_values"), F.round(total, 6).alias("total"))


def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    return first_rows(table(spark, folder, "orders"), 100, order_by="o_orderkey")


# Roles, cleaning and scalar expressions


def column_report(spark: SparkSession, folder: str) -> DataFrame:
    return roles.column_report(
        table(spark, folder, "orders"),
        required=["o_orderkey", "o_orderstatus"],
        optional=["o_totalprice", "o_comment"],
        count_values=True,
    )


def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return clean.table_profile(table(spark, folder, "orders"), {"urgent": urgent})


def select_available(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["o_totalprice", "o_comment", "o_orderkey", "o_clerk", "o_orderstatus"]
    return clean.select_available(table(spark, folder, "orders"), wanted)


def rename_near_match(spark: SparkSession, folder: str) -> DataFrame:
    orders = clean.rename_near_match(
        table(spark, folder, "orders"), {"price": "PRICE", "o_orderkey": "key"}
    )
    return orders.select("o_orderkey", "price")


def _documents_and_labels(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    return documents.join(table(spark, folder, "labels"), "doc_id", "left")


def require_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return clean.require_not_null(_documents_and_labels(spark, folder), ["quality", "toxic"])


def fill_null_zero(spark: SparkSession, folder: str) -> DataFrame:
    return clean.fill_null_zero(_documents_and_labels(spark, folder), ["quality", "toxic", "absent"])


def try_int(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).alias("level"),
        F.col("o_orderpriority").alias("no_number"),
    )
    return clean.try_int(texts, ["level", "no_number"])


def collapse_categories(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return clean.collapse_categories(customer, "c_mktsegment", ["BUILDING", "MACHINERY"], "segment_group")


def band_numeric(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    return clean.band_numeric(part, "p_size", [(15, "Small"), (35, "Medium")], "Large", "size_band")


def polynomial_features(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.select(
        "p_partkey",
        power(part, "p_size", 2).alias("size_squared"),
        power(part, "p_size", 3).alias("size_cubed"),
    )


def threshold_flags(spark: SparkSession, folder: str) -> DataFrame:
    quantity, discount = F.col("l_quantity"), F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        flag(quantity < 10).alias("is_small"),
        flag(quantity >= 40).alias("is_large"),
        range_flag(quantity, 10, 25).alias("is_medium"),
        flag(discount > 0).alias("has_discount"),
        all_flag(quantity >= 40, discount > 0.05).alias("large_and_discounted"),
    )


def row_sum_interactions(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        row_sum(lines, "l_quantity", "l_discount", "l_tax").alias("total"),
        product(lines, "l_extendedprice", "l_discount").alias("price_discount"),
        product(lines, "l_linenumber", "l_linenumber").alias("number_squared"),
    )


def class_filter(spark: SparkSession, folder: str) -> DataFrame:
    return clean.equals(table(spark, folder, "labels"), "quality", 1)


# Feature stages


def string_index(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return features.string_index_stage(["c_mktsegment"]).fit(customer).transform(customer)


def assemble_skip(spark: SparkSession, folder: str) -> DataFrame:
    inputs = ["n_chars", "quality", "toxic"]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip")
    assembled = assembler.transform(_documents_and_labels(spark, folder))
    values = vector_to_array("features")
    return assembled.select("doc_id", *[F.get(values, i).alias(f"f_{c}") for i, c in enumerate(inputs)])


def assembly_report(spark: SparkSession, folder: str) -> DataFrame:
    return features.assembly_report(_documents_and_labels(spark, folder), ["n_chars", "quality", "toxic"])


def standardize(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return _rounded(features.standardize(customer, "c_acctbal", "scaled"), "scaled")


def feature_set(spark: SparkSession, folder: str) -> DataFrame:
    orders = split.stratified_hash_split(audit_orders(spark, folder), "o_orderkey", "label")
    # Fitting and scoring pass over the rows three times: the join is made once.
    orders = write_parquet(orders, scratch_path(spark, "orders"))
    numeric, categorical = features.available_features(
        orders, [*ORDERS_NUMERIC, "o_absent"], ["c_absent", *ORDERS_CATEGORICAL]
    )
    train = orders.filter(F.col("split") == "train")
    scaled = features.feature_stages(numeric, categorical).fit(train).transform(orders)
    values = vector_to_array(features.SCALED)
    names = [*numeric, *categorical]
    return scaled.select(
        "o_orderkey", "split", *[F.round(F.get(values, i), 6).alias(f"f_{c}") for i, c in enumerate(names)]
    )


# Split and union


def _orders_with_label(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label")
    )


def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.stratified_hash_split(
        _orders_with_label(spark, folder), "o_orderkey", "label", {0: 0.8, 1: 0.9}
    )


def union_all(spark: SparkSession, folder: str) -> DataFrame:
    orders = split.stratified_hash_split(_orders_with_label(spark, folder), "o_orderkey", "label")
    train, test = split.train_and_test(orders)
    return split.union_all(test, train)


# Models


def _separable(spark: SparkSession, folder: str) -> DataFrame:
    """Orders labelled by a limit on one feature, which a tree finds whatever rows it draws."""
    return audit_orders(spark, folder).withColumn("label", (F.col("c_nationkey") < 12).cast("int"))


def _fit_forest(train: DataFrame) -> PipelineModel:
    return model.fit_classifier(
        train, "label", ORDERS_NUMERIC, ORDERS_CATEGORICAL, order_by="o_orderkey", **SMALL_FOREST
    )


def _split(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split.train_and_test(split.stratified_hash_split(orders, "o_orderkey", "label"))


def _scored_orders(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(_separable(spark, folder))
    return model.score(_fit_forest(train), test)


def rf_train_score(spark: SparkSession, folder: str) -> DataFrame:
    return _scored_orders(spark, folder).select("o_orderkey", "label", "prediction", "score")


def logreg_train_score(spark: SparkSession, folder: str) -> DataFrame:
    """All test rows with prediction and score, which follow from no SQL; tests compare them with
    another fit. Where the fit has converged, the mean score of the training rows is the mean
    of their labels, as the intercept is not penalised."""
    train, test = _split(audit_orders(spark, folder))
    fitted = model.fit_classifier(
        train, "label", ORDERS_NUMERIC, ORDERS_CATEGORICAL, "logreg", order_by="o_orderkey",
        regParam=0.01, maxIter=200, tol=1e-10,
    )
    mean = model.score(fitted, train).agg(F.avg("score").alias("mean")).scalar()
    return model.score(fitted, test).select(
        "o_orderkey",
        "label",
        F.round(mean, 6).alias("mean_training_score"),
        F.col("score").between(0, 1).alias("is_probability"),
        ((F.col("score") > 0.5) == (F.col("prediction") == 1)).alias("prediction_fits"),
    )


def logreg_cell_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction and score of all test rows. With two flags and their product as features and
    no penalty, the likeliest score of a row is the mean label of the training rows of its flags."""
    orders = audit_orders(spark, folder).withColumns(
        {"dear": flag(F.col("o_totalprice") > 150_000), "rich": flag(F.col("c_acctbal") > 4_000)}
    )
    orders = orders.withColumn("both", F.col("dear") * F.col("rich"))
    train, test = _split(orders.select("o_orderkey", "label", "dear", "rich", "both"))
    fitted = model.fit_classifier(
        train, "label", ["dear", "rich", "both"], [], "logreg", order_by="o_orderkey", regParam=0.0, maxIter=500, tol=1e-14
    )
    scored = model.score(fitted, test).select("o_orderkey", "label", "prediction", "score")
    return _rounded(scored, "score", digits=5)


def top_k_importance(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _split(_separable(spark, folder))
    return model.feature_importance(_fit_forest(train), spark, k=3)


def model_save_load(spark: SparkSession, folder: str) -> DataFrame:
    """Rows scored by the saved and reloaded model, and those on which it differs from the original."""
    train, test = _split(audit_orders(spark, folder))
    fitted = _fit_forest(train)
    path = scratch_path(spark, "model")
    save_model(fitted, path)
    first = model.score(fitted, test, "before").select("o_orderkey", *_INPUTS, "before")
    again = model.score(load_model(path), first, "after")
    return again.agg(
        F.count(F.lit(1)).alias("scored"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("different"),
    )


_INPUTS = (*ORDERS_NUMERIC, *ORDERS_CATEGORICAL)


def train_and_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Split, train, score, and report bias. The report reads the scored rows once."""
    scored = _scored_orders(spark, folder).select(*ORDERS_ROLES.columns())
    return _rounded(fairness.bias_report(scored, ORDERS_ROLES), "value")


# Evaluation


def auc(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(evaluate.auc(audit_lines(spark, folder), "label", "score"), "auc", digits=9)


def auc_many_scores(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), "l_extendedprice"
    )
    return _rounded(evaluate.auc(lines, "label", "l_extendedprice"), "auc", digits=9)


def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluate.classification_metrics(audit_lines(spark, folder), LINES_ROLES)
    return _rounded(metrics, *metrics.columns, digits=9)


def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluate.class_metrics(audit_docs(spark, folder), "label", "prediction")
    return _rounded(metrics, "f1", digits=9)


def confusion_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion_counts(audit_docs(spark, folder), "label", "prediction", (0, 1, 2))


def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion_matrix(audit_docs(spark, folder), "label", "prediction")


def class_metrics_odd_values(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions that name no class: fractions, NaN and null, beside classes 0, 1 and 2."""
    return _rounded(evaluate.class_metrics(_odd_lines(spark, folder), "label", "prediction"), "f1", digits=9)


def auc_nan_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(evaluate.auc(_odd_lines(spark, folder), "label", "score"), "auc", digits=9)


def calibration_means_nan_scores(spark: SparkSession, folder: str) -> DataFrame:
    means = fairness.calibration_means(_odd_lines(spark, folder), LINES_ROLES)
    return _rounded(means, "mean_predicted", "mean_actual")


def bias_report_nan_scores(spark: SparkSession, folder: str) -> DataFrame:
    report = fairness.bias_report(_odd_lines(spark, folder), LINES_ROLES, include_lowest=True)
    return _rounded(report, "value")


def _odd_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines with NaN, null and fractional values, by the score they had."""
    lines = audit_lines(spark, folder)
    place = F.round(F.col("score") * 49).cast("int")
    prediction = (
        F.when(place == 5, F.lit(0.9)).when(place == 6, F.lit(float("nan"))).when(place == 7, F.lit(None))
        .when(place == 8, F.lit(2.0)).otherwise(F.col("prediction").cast("double"))
    )
    score = F.when(place == 9, F.lit(float("nan"))).when(place == 10, F.lit(None)).otherwise(F.col("score"))
    return lines.withColumns({"prediction": prediction, "score": score})


# Statistics


def summary_stats(spark: SparkSession, folder: str) -> DataFrame:
    return profile.summary(audit_docs(spark, folder), "label")


def distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distribution(audit_docs(spark, folder), ["lang", "source"])


def distinct_groups(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_groups(audit_docs(spark, folder), "source")


def share_of_total(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.share_of_total(table(spark, folder, "customer"), "c_mktsegment"), "percent")


def share_of_named(spark: SparkSession, folder: str) -> DataFrame:
    named = ["BUILDING", "NO SUCH SEGMENT"]
    return _rounded(profile.share_of_total(table(spark, folder, "customer"), "c_mktsegment", named), "percent")


def group_label_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.group_label_counts(audit_docs(spark, folder), "lang", "label")


def group_label_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return profile.group_label_pivot(audit_docs(spark, folder), "source", "label")


def rate_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return profile.rate_by_group(audit_lines(spark, folder), "c_mktsegment", "label")


def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.histogram(table(spark, folder, "documents"), "n_chars", 30)


# Fairness


def group_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.group_metrics(audit_docs(spark, folder), DOCS_BY_LANG)


def group_metrics_lines(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.group_metrics(audit_lines(spark, folder), LINES_BY_SEGMENT)


def multi_attribute_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.group_metrics(audit_lines(spark, folder), LINES_ROLES)


def multi_attribute_combined(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.group_metrics(audit_lines(spark, folder), LINES_ROLES, pre_aggregate=True)


def comparison_table(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.comparison_table(group_metrics(spark, folder))


def metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.metrics_long(group_metrics(spark, folder))


def pair_disparity(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.pair_disparity(group_metrics_lines(spark, folder), PAIR)


def pair_disparity_largest(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.pair_disparity(fairness.group_metrics(audit_docs(spark, folder), DOCS_ROLES))


def demographic_parity(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(fairness.demographic_parity(audit_lines(spark, folder), LINES_ROLES), "prediction_rate")


def parity_disparity(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(fairness.parity_disparity(audit_lines(spark, folder), LINES_ROLES), "value")


def equalized_odds(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.equalized_odds(audit_docs(spark, folder), DOCS_ROLES)


def odds_disparity(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.odds_disparity(audit_docs(spark, folder), DOCS_ROLES)


def equal_opportunity(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.equal_opportunity(audit_docs(spark, folder), DOCS_ROLES)


def opportunity_disparity(spark: SparkSession, folder: str) -> DataFrame:
    return fairness.opportunity_disparity(audit_docs(spark, folder), DOCS_ROLES)


def severity_bands(spark: SparkSession, folder: str) -> DataFrame:
    gaps = split.union_all(
        fairness.odds_disparity(audit_docs(spark, folder), DOCS_ROLES),
        fairness.odds_disparity(audit_lines(spark, folder), LINES_ROLES),
    )
    return fairness.severity(gaps)


def score_extract(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    return embeddings.select("vec_id", positive_score(embeddings, "embedding").alias("score"))


def calibration_bins(spark: SparkSession, folder: str) -> DataFrame:
    bins = fairness.calibration_bins(audit_lines(spark, folder), LINES_BY_SEGMENT)
    return _rounded(bins, "predicted", "actual")


def calibration_curves(spark: SparkSession, folder: str) -> DataFrame:
    curves = fairness.calibration_curves(audit_lines(spark, folder), LINES_BY_SEGMENT)
    points = curves.select("attribute", "group", F.posexplode("calibration_data").alias("position", "point"))
    return points.select(
        "attribute",
        "group",
        (F.col("position") + 1).alias("position"),
        F.col("point.bin").alias("bin"),
        F.round("point.predicted", 6).alias("predicted"),
        F.round("point.actual", 6).alias("actual"),
        F.col("point.count").alias("count"),
    )


def calibration_means(spark: SparkSession, folder: str) -> DataFrame:
    means = fairness.calibration_means(audit_lines(spark, folder), LINES_ROLES)
    return _rounded(means, "mean_predicted", "mean_actual")


def bias_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(fairness.bias_report(audit_lines(spark, folder), LINES_ROLES), "value")


def bias_report_combined(spark: SparkSession, folder: str) -> DataFrame:
    report = fairness.bias_report(audit_lines(spark, folder), LINES_ROLES, pre_aggregate=True)
    return _rounded(report, "value")


_QUERIES: tuple[Query, ...] = (
    csv_round_trip, csv_inferred_types, csv_duplicate_header, parquet_round_trip,
    predictions_csv_round_trip, vector_to_text, sample_rows,
    column_report, table_profile, select_available, rename_near_match, require_not_null,
    fill_null_zero, try_int, collapse_categories, band_numeric, polynomial_features,
    threshold_flags, row_sum_interactions, class_filter,
    string_index, assemble_skip, assembly_report, standardize, feature_set,
    stratified_split, union_all,
    rf_train_score, logreg_train_score, logreg_cell_scores, top_k_importance, model_save_load, train_and_audit,
    auc, auc_many_scores, auc_nan_scores, classification_metrics, class_metrics, class_metrics_odd_values,
    confusion_counts, confusion_matrix,
    summary_stats, distribution, distinct_groups, share_of_total, share_of_named,
    group_label_counts, group_label_pivot, rate_by_group, histogram,
    group_metrics, group_metrics_lines, multi_attribute_metrics, multi_attribute_combined,
    comparison_table, metrics_long, pair_disparity, pair_disparity_largest,
    demographic_parity, parity_disparity, equalized_odds, odds_disparity,
    equal_opportunity, opportunity_disparity, severity_bands,
    score_extract, calibration_bins, calibration_curves, calibration_means, calibration_means_nan_scores,
    bias_report, bias_report_combined, bias_report_nan_scores,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES} | state_queries.queries()
