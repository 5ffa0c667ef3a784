"""Cleaning, features, split and statistics on small tables."""

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from parityscope.operators import clean, features, profile, split


def _rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def test_select_available_keeps_the_wanted_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert clean.select_available(df, ["c", "x", "a"]).columns == ["c", "a"]


def test_rename_near_match(spark):
    df = spark.createDataFrame([(1, 2)], "Priors_Count14 int, b int")
    assert clean.rename_near_match(df, {"priors_count": "priors", "b": "b"}).columns == ["priors_count", "b"]
    there = spark.createDataFrame([(1, 2)], "priors_count int, priors_other int")
    assert clean.rename_near_match(there, {"priors_count": "priors"}).columns == there.columns


def test_require_not_null_keeps_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "x"), (float("nan"), "x"), (1.0, None)], "a double, b string")
    assert clean.require_not_null(df, ["a", "b"]).count() == 2


def test_table_profile(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "a int")
    row = clean.table_profile(df, {"ones": F.col("a") == 1}).first()
    assert (row.rows, row.ones, row.columns) == (3, 2, 1)


def test_string_index_ties_and_null(spark):
    df = spark.createDataFrame([("c",), ("c",), ("a",), ("b",), (None,)], "s string")
    indexed = features.string_index_stage(["s"]).fit(df).transform(df)
    assert {(r.s, r.s_indexed) for r in indexed.collect()} == {("c", 0.0), ("a", 1.0), ("b", 2.0), (None, 3.0)}


def test_assembling_skips_incomplete_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1.0, 1), (nan, 1), (None, 1), (2.0, None), (3.0, 3)], "a double, b int"
    )
    kept = VectorAssembler(inputCols=["a", "b"], outputCol="v", handleInvalid="skip").transform(df).count()
    report = features.assembly_report(df, ["a", "b"]).first()
    assert (report.kept, report.dropped) == (kept, 3) == (2, 3)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    stages = features.feature_stages(["a", "b"])
    values = vector_to_array(features.SCALED)
    rows = stages.fit(df).transform(df).select(F.get(values, 0), F.get(values, 1)).collect()
    assert sorted(r[0] for r in rows) == pytest.approx([-math.sqrt(0.5), math.sqrt(0.5)])
    assert [r[1] for r in rows] == [0.0, 0.0]
    scaled = features.standardize(features.standardize(df, "a", "za"), "b", "zb").collect()
    assert sorted(r.za for r in scaled) == pytest.approx([-math.sqrt(0.5), math.sqrt(0.5)])
    assert [r.zb for r in scaled] == [0.0, 0.0]


def test_standardize_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "a double")
    assert sum(r.z is None for r in features.standardize(df, "a", "z").collect()) == 1


def test_available_features(spark):
    df = spark.createDataFrame([(1, "x")], "n int, c string")
    assert features.available_features(df, ["m", "n"], ["c", "d"]) == (["n"], ["c"])


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("label", (F.col("id") % 3).cast("int"))
    one = split.stratified_hash_split(df.repartition(1), "id", "label")
    many = split.stratified_hash_split(df.repartition(16), "id", "label")
    assert _rows(one) == _rows(many)


def test_split_fractions_per_class(spark):
    df = spark.range(30000).withColumn("label", F.when(F.col("id") % 3 < 2, F.col("id") % 3))
    done = split.stratified_hash_split(df, "id", "label", {0: 0.8, 1: 0.5}, salt="s")
    counts = {(r.label, r.split): r["count"] for r in done.groupBy("label", "split").count().collect()}
    assert counts[(0, "train")] / 10000 == pytest.approx(0.8, abs=0.02)
    assert counts[(1, "train")] / 10000 == pytest.approx(0.5, abs=0.02)
    assert counts[(None, None)] == 10000
    train, test = split.train_and_test(done)
    assert train.columns == df.columns
    assert train.count() + test.count() == 20000
    with pytest.raises(ValueError):
        split.stratified_hash_split(df, "id", "label", 1.5)


def test_salt_changes_the_split(spark):
    df = spark.range(1000).withColumn("label", F.lit(1))
    first = split.stratified_hash_split(df, "id", "label", 0.5, salt="a")
    second = split.stratified_hash_split(df, "id", "label", 0.5, salt="b")
    assert _rows(first) != _rows(second)


def test_union_all_keeps_repeats(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "s string, i int")
    assert _rows(split.union_all(a, b)) == [(1, "x"), (1, "x"), (2, "y")]


def test_summary_of_missing_labels_and_of_nothing(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (1,)], "y int")
    assert tuple(profile.summary(df, "y").first()) == (4, 0.5)
    assert tuple(profile.summary(df.filter("y > 5"), "y").first()) == (0, 0.0)


def test_distribution_counts_null(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 2)], "s string, i int")
    assert _rows(profile.distribution(df, ["s", "i"])) == [
        ("i", "1", 2), ("i", "2", 1), ("s", None, 1), ("s", "a", 2),
    ]
    assert _rows(profile.distribution(df, ["s"])) == [("s", None, 1), ("s", "a", 2)]


def test_distinct_groups(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "s string")
    assert _rows(profile.distinct_groups(df, "s")) == [(None,), ("a",)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    assert _rows(profile.share_of_total(df, "s")) == [(None, 1, 25.0), ("a", 2, 50.0), ("b", 1, 25.0)]
    assert _rows(profile.share_of_total(df, "s", ["a", "z"])) == [("a", 2, 50.0), ("z", 0, 0.0)]
    assert _rows(profile.share_of_total(df.limit(0), "s", ["a"])) == []


def test_rates_leave_out_other_labels(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 0), ("a", None), ("a", 2), ("b", None)], "g string, y int"
    )
    assert _rows(profile.rate_by_group(df, "g", "y")) == [("a", 1, 1, 0.5), ("b", 0, 0, None)]
    assert _rows(profile.group_label_pivot(df, "g", "y")) == [("a", 1, 1), ("b", 0, 0)]
    assert len(profile.group_label_counts(df, "g", "y").collect()) == 5


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)] + [(None,), (float("nan"),)], "x double")
    rows = sorted(profile.histogram(df, "x", 5).collect())
    assert [(r.bin, r.n) for r in rows] == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
    assert rows[0].lower == 0.0 and rows[-1].upper == 10.0
    constant = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert [(r.bin, r.lower, r.upper, r.n) for r in profile.histogram(constant, "x").collect()] == [(0, 4.0, 4.0, 2)]
    assert profile.histogram(df.limit(0), "x").count() == 0


def test_split_fractions_are_not_rounded(spark):
    df = spark.range(200_000).select(F.col("id"), F.lit(1).alias("label"))
    counts = {r["split"]: r["n"] for r in split.split_counts(split.stratified_hash_split(df, "id", "label", 0.9999), "id").collect()}
    assert 5 <= counts["test"] <= 45
    counts = {r["split"]: r["n"] for r in split.split_counts(split.stratified_hash_split(df, "id", "label", 0.99999), "id").collect()}
    assert 0 < counts.get("test", 0) <= 10
    with pytest.raises(ValueError):
        split.stratified_hash_split(df, "id", "label", 1 - 1e-12)


def test_rows_without_key_are_on_no_side(spark):
    df = spark.createDataFrame([(None, 1), (None, 0), (1, 1), (2, None)], "id int, label int")
    rows = split.stratified_hash_split(df, "id", "label", 0.5).collect()
    assert [r.split for r in rows if r.id is None or r.label is None] == [None] * 3
    counts = {r["split"]: (r.n, r.without_key) for r in split.split_counts(split.stratified_hash_split(df, "id", "label", 0.5), "id").collect()}
    assert counts[None] == (3, 2)
