"""The whole audit on a small CSV file with the header and defects of the real one."""

import math
import random

import pytest

from parityscope import __main__ as command_line
from parityscope.operators import evaluate, fairness, model
from parityscope.plans import recidivism
from parityscope.roles import MissingColumnsError
from parityscope.sources import load_model

HEADER = (
    "id,name,sex,age,age_cat,race,juv_fel_count,decile_score,juv_misd_count,juv_other_count,"
    "priors_count,is_recid,is_violent_recid,v_decile_score,v_score_text,score_text,"
    "decile_score,priors_count,two_year_recid"
)
ROWS = 1200


def _lines():
    draw = random.Random(7)
    yield HEADER
    for i in range(ROWS):
        age = draw.randint(18, 70)
        cat = "Less than 25" if age < 25 else "25 - 45" if age <= 45 else "Greater than 45"
        race = draw.choices(["African-American", "Caucasian", "Hispanic", "Asian"], [5, 3, 1, 1])[0]
        priors = max(0, int(draw.gauss(3, 4)))
        decile = min(10, max(1, int(priors + draw.gauss(3, 2))))
        again = int(draw.random() < 1 / (1 + math.exp(-(decile - 5) / 2)))
        filled = "" if i % 50 == 0 else str(decile)
        sex = "" if i == 3 else draw.choice(["Male", "Male", "Male", "Female"])
        yield (
            f'{i},"Doe, J{i}",{sex},{age},{cat},{race},{draw.randint(0, 1)},{filled},'
            f"{draw.randint(0, 2)},0,{priors},{again},0,{draw.randint(1, 10)},Low,Low,99,88,{again}"
        )


@pytest.fixture(scope="module")
def csv_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("input") / "recidivism.csv"
    path.write_text("\n".join(_lines()) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def output(tmp_path_factory):
    return str(tmp_path_factory.mktemp("output"))


@pytest.fixture(scope="module")
def audit(spark, csv_path, output):
    return recidivism.run(spark, csv_path, output, numTrees=8, maxDepth=5)


def test_first_copy_of_repeated_columns_is_kept(spark, csv_path):
    table = recidivism.prepared(spark, csv_path)
    assert table.count() == ROWS - 1
    values = table.agg({"decile_score": "max", "priors_count": "max"}).first()
    assert values["max(decile_score)"] <= 10
    assert values["max(priors_count)"] < 88
    assert table.filter("id = 50").first().decile_score == 0


def test_all_features_are_derived(spark, csv_path):
    table = recidivism.prepared(spark, csv_path)
    assert set(recidivism.NUMERIC_FEATURES) <= set(table.columns)
    assert set(recidivism.CATEGORICAL_FEATURES) <= set(table.columns)
    assert len(recidivism.NUMERIC_FEATURES) == 26
    row = table.filter("id = 7").first()
    assert row.age_squared == row.age**2
    assert row.age_cubed == row.age**3
    assert row.total_juv_count == row.juv_fel_count + row.juv_misd_count + row.juv_other_count
    assert row.decile_priors == row.decile_score * row.priors_count
    assert row.medium_risk == float(4 <= row.decile_score < 7)
    assert row.young_high_risk == float(row.age < 25 and row.decile_score >= 7)


def test_features_follow_the_columns_there_are(spark, csv_path):
    raw = recidivism.prepared(spark, csv_path).select(
        "id", "sex", "age", "race", "two_year_recid", "juv_fel_count"
    )
    table = recidivism.with_features(recidivism.cleaned(raw))
    assert {"age_squared", "has_juv_fel"} <= set(table.columns)
    assert not {"priors_squared", "total_juv_count", "age_decile"} & set(table.columns)


def test_missing_critical_column_raises(spark):
    with pytest.raises(MissingColumnsError):
        recidivism.cleaned(spark.createDataFrame([(1, 1)], "id int, two_year_recid int"))


def test_predictions_cover_the_test_rows(audit):
    n = audit.predictions.count()
    assert 0.15 * ROWS < n < 0.25 * ROWS
    assert audit.predictions.select("id").distinct().count() == n
    assert audit.predictions.filter("prediction NOT IN (0, 1) OR score < 0 OR score > 1").count() == 0


def test_model_finds_the_planted_signal(audit):
    metrics = audit.metrics().first()
    assert metrics.auc > 0.65
    assert metrics.recall == pytest.approx(metrics.accuracy)
    assert audit.importances(3).count() == 3


def test_confusion_matrix_adds_up(audit):
    rows = audit.confusion_matrix().collect()
    assert len(rows) == 2
    assert sum(r.predicted_0 + r.predicted_1 for r in rows) == audit.predictions.count()


def test_group_metrics_add_up_for_every_attribute(audit):
    n = audit.predictions.count()
    for attribute in recidivism.ATTRIBUTES:
        rows = audit.group_metrics().filter(f"attribute = '{attribute}'").collect()
        assert sum(r.n for r in rows) == n
        for r in rows:
            assert r.tp + r.fp + r.tn + r.fn == r.n


def test_report_has_all_sections(audit):
    sections = {r.section for r in audit.bias_report().select("section").distinct().collect()}
    assert sections == {"demographic_parity", "equalized_odds", "equal_opportunity", "calibration"}


def test_written_outputs(spark, audit, output):
    header = spark.read.csv(f"{output}/predictions", header=True)
    assert header.columns == ["id", "two_year_recid", "prediction", "race_binary", "sex", "probability_str"]
    assert header.count() == audit.predictions.count()
    again = load_model(f"{output}/model")
    test_rows = audit.table.join(audit.predictions.select("id"), "id", "left_semi")
    rescored = model.score(again, test_rows).select("id", "score")
    both = rescored.withColumnRenamed("score", "other").join(audit.predictions, "id")
    assert both.filter("score <> other").count() == 0
    assert both.count() == audit.predictions.count()


def test_dashboard_tables(audit):
    assert audit.statistics().first().total_records == ROWS - 1
    assert {r.attribute for r in audit.distributions().collect()} == set(recidivism.ATTRIBUTES)
    (share,) = audit.shares("sex", ["Male"]).collect()
    assert 60 < share.percent < 90
    assert audit.sample(100).count() == 100
    assert sum(r.n for r in audit.age_histogram().collect()) == ROWS - 1
    assert {r.race_binary for r in audit.label_rates("race_binary").collect()} == {
        "African-American", "Caucasian", "Other",
    }
    assert {r.severity for r in audit.pair_disparity().collect()} <= {"low", "medium", "high"}


def test_ml_vector_scores_work_in_calibration(audit):
    by_vector = fairness.calibration_means(
        audit.predictions, recidivism.AuditRoles("two_year_recid", "prediction", ("sex",), "probability")
    )
    by_number = fairness.calibration_means(
        audit.predictions, recidivism.AuditRoles("two_year_recid", "prediction", ("sex",), "score")
    )
    assert sorted(by_vector.collect()) == sorted(by_number.collect())
    assert (
        evaluate.auc(audit.predictions, "two_year_recid", "probability").first()
        == evaluate.auc(audit.predictions, "two_year_recid", "score").first()
    )


def test_logistic_regression(spark, csv_path, tmp_path):
    audit = recidivism.run(spark, csv_path, str(tmp_path), estimator="logreg", maxIter=20)
    assert audit.metrics().first().auc > 0.65
    with pytest.raises(ValueError):
        audit.importances()


def test_command_line_writes_every_table(spark, csv_path, tmp_path, capsys):
    command_line.main(["--input", csv_path, "--output", str(tmp_path), "--trees", "4", "--depth", "4", "--include-lowest"])
    report = spark.read.parquet(f"{tmp_path}/bias_report")
    assert {r.section for r in report.select("section").distinct().collect()} == {
        "demographic_parity", "equalized_odds", "equal_opportunity", "calibration",
    }
    gaps = {(r.section, r.attribute, r.metric) for r in report.filter("is_disparity").collect()}
    assert len(gaps) == 4 * len(recidivism.ATTRIBUTES)
    printed = capsys.readouterr().out
    for name in ("statistics", "distributions", "metrics", "confusion_matrix", "group_metrics", "pair_disparity",
                 "bias_report", "importances", "split_counts"):
        rows = spark.read.parquet(f"{tmp_path}/{name}").count()
        assert rows > 0 and f"{name}: {rows} rows in" in printed


def test_same_forest_whatever_the_shuffle_partitions(spark, csv_path, tmp_path):
    usual, scores = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (2, 4, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            audit = recidivism.run(spark, csv_path, f"{tmp_path}/{n}", numTrees=4, maxDepth=4)
            scores.append(sorted((r.id, r.score) for r in audit.predictions.select("id", "score").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert scores[0] == scores[1] == scores[2]


def test_bad_text_in_a_number_is_null(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,sex,age,race,two_year_recid,priors_n\n1,Male,x,Asian,1,3\n2,Male,30,Asian,1,y\n3,Male,31,Asian,0,4\n")
    rows = recidivism.prepared(spark, str(path)).orderBy("id").collect()
    assert [(r.id, r.age, r.priors_count) for r in rows] == [(2, 30, 0), (3, 31, 4)]


def test_command_line_options_of_the_tables(spark, csv_path, tmp_path):
    command_line.main([
        "--input", csv_path, "--output", str(tmp_path), "--trees", "2", "--depth", "2", "--infer-schema", "--histogram-bins", "5",
        "--sample-rows", "7", "--shares-of", "Caucasian", "Nobody", "--pair", "Caucasian", "Other",
    ])
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    assert read("sample").count() == 7 and read("age_histogram").count() == 5
    assert read("age_histogram").agg({"n": "sum"}).first()[0] == ROWS - 1
    shares = {r.race_binary: r.n for r in read("shares_race_binary").collect()}
    assert shares["Nobody"] == 0 and 0 < shares["Caucasian"] < ROWS and len(shares) == 2
    rates = read("label_rates_sex").collect()
    assert {r.sex for r in rates} == {"Male", "Female"} and all(0 < r.rate < 1 for r in rates)
    assert {r.attribute for r in read("pair_disparity").collect()} == {"race_binary"}
