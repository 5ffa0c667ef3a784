import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from parityscope.operators import fairness
from parityscope.roles import AuditRoles, MissingColumnsError

ROLES = AuditRoles("y", "p", ("g",))
SCHEMA = "g string, y int, p int"


@pytest.fixture
def frame(spark):
    return lambda rows, schema=SCHEMA: spark.createDataFrame(rows, schema)


def _by_group(df):
    return {r["group"]: r for r in df.collect()}


def _values(df):
    return {(r.attribute, r.metric): r.value for r in df.collect()}


def test_group_without_positives(frame):
    df = frame([("a", 1, 1), ("a", 0, 1), ("b", 0, 0), ("b", 0, 1)])
    rows = _by_group(fairness.group_metrics(df, ROLES))
    assert rows["b"].tpr == 0.0 and rows["b"].fnr == 0.0 and rows["b"].fpr == 0.5
    assert _values(fairness.odds_disparity(df, ROLES)) == {
        ("g", "tpr_disparity"): 1.0, ("g", "fpr_disparity"): 0.5,
    }
    assert _values(fairness.opportunity_disparity(df, ROLES)) == {("g", "equal_opportunity_disparity"): 0.0}


def test_null_group_policy(frame):
    df = frame([("a", 1, 1), ("b", 1, 1), (None, 1, 0)])
    assert set(_by_group(fairness.group_metrics(df, ROLES))) == {"a", "b", None}
    for gaps in (fairness.odds_disparity, fairness.opportunity_disparity, fairness.parity_disparity):
        assert set(_values(gaps(df, ROLES)).values()) == {0.0}
        assert max(_values(gaps(df, ROLES, null_group="include")).values()) == 1.0
    with pytest.raises(ValueError):
        fairness.odds_disparity(df, ROLES, null_group="maybe")


def test_null_and_other_values_count_only_in_n(frame):
    df = frame([("a", 1, 1), ("a", 1, None), ("a", None, 1), ("a", 2, 1), ("a", 0, 3)])
    row = _by_group(fairness.group_metrics(df, ROLES))["a"]
    assert (row.n, row.tp, row.fp, row.tn, row.fn) == (5, 1, 0, 0, 0)
    assert row.base_rate == row.selection_rate == row.accuracy == 0.2
    opportunity = _by_group(fairness.equal_opportunity(df, ROLES))["a"]
    assert opportunity.positive_count == 2 and opportunity.true_positive_rate == 0.5
    parity = _by_group(fairness.demographic_parity(df, ROLES))["a"]
    assert parity["count"] == 5 and parity.prediction_rate == 6 / 4


def test_single_group_has_no_disparity(frame):
    df = frame([("a", 1, 1), ("a", 0, 1), (None, 1, 0)])
    for gaps in (fairness.odds_disparity, fairness.opportunity_disparity, fairness.parity_disparity):
        assert gaps(df, ROLES).count() == 0
    assert fairness.pair_disparity(fairness.group_metrics(df, ROLES)).count() == 0
    assert fairness.bias_report(df, ROLES).filter("is_disparity").count() == 0


def test_group_named_disparity_survives(frame):
    df = frame([("disparity", 1, 1), ("b", 1, 0)])
    assert set(_by_group(fairness.equalized_odds(df, ROLES))) == {"disparity", "b"}
    report = fairness.bias_report(df, ROLES)
    assert report.filter("group = 'disparity' AND NOT is_disparity").count() > 0


def test_group_with_no_predictions_is_passed_over(frame):
    df = frame([("a", 1, 1), ("b", 1, 0), ("c", 1, None)])
    assert _values(fairness.parity_disparity(df, ROLES)) == {("g", "demographic_parity_disparity"): 1.0}


def test_pair_is_the_two_largest_by_name(frame):
    df = frame([("c", 1, 1)] * 3 + [("b", 1, 0)] * 2 + [("a", 1, 1)] * 2 + [(None, 1, 1)] * 9)
    metrics = fairness.group_metrics(df, ROLES)
    assert set(_values(fairness.pair_disparity(metrics)).values()) == {0.0}
    named = _values(fairness.pair_disparity(metrics, ("b", "c")))
    assert named == {
        ("g", "equalized_odds_disparity"): 1.0,
        ("g", "demographic_parity_disparity"): 1.0,
        ("g", "equal_opportunity_disparity"): 1.0,
    }
    assert fairness.pair_disparity(metrics, ("b", "nobody")).count() == 0


def test_severity_limits(spark):
    df = spark.createDataFrame([(0.11,), (0.1,), (0.05,), (0.049,), (None,)], "value double")
    assert [r.severity for r in fairness.severity(df).collect()] == ["high", "medium", "medium", "low", None]


def test_empty_input_gives_empty_tables(frame):
    df = frame([], SCHEMA + ", s double")
    roles = replace(ROLES, score="s")
    assert fairness.group_metrics(df, roles).count() == 0
    assert fairness.calibration_bins(df, roles).count() == 0
    assert fairness.bias_report(df, roles).count() == 0


def test_roles_are_checked(frame):
    df = frame([("a", 1, 1)])
    with pytest.raises(MissingColumnsError):
        fairness.group_metrics(df, AuditRoles("y", "p", ("missing",)))
    with pytest.raises(ValueError):
        fairness.group_metrics(df, AuditRoles("y", "p"))
    with pytest.raises(ValueError):
        fairness.calibration_bins(df, ROLES)


def test_attributes_may_have_any_name(frame):
    df = frame([("u", "v", 1, 1)], "y string, score string, label int, p int")
    rows = fairness.group_metrics(df, AuditRoles("label", "p", ("y", "score"))).collect()
    assert {(r.attribute, r["group"], r.tp) for r in rows} == {("y", "u", 1), ("score", "v", 1)}


def test_calibration_edges_and_means(frame):
    df = frame(
        [("a", 1, 1, 0.0), ("a", 1, 1, 0.05), ("a", 0, 1, 0.1), ("a", None, 1, 0.95), ("a", 0, 1, None)],
        SCHEMA + ", s double",
    )
    roles = replace(ROLES, score="s")
    rows = {r.bin: r for r in fairness.calibration_bins(df, roles).collect()}
    assert set(rows) == {1, 10}
    assert rows[1]["count"] == 2 and rows[1].actual == 0.5 and rows[10].actual is None
    assert {r.bin: r["count"] for r in fairness.calibration_bins(df, roles, include_lowest=True).collect()} == {1: 3, 10: 1}
    means = fairness.calibration_means(df, roles).first()
    assert means.mean_predicted == pytest.approx(1.1 / 4) and means.mean_actual == 0.5
    (curve,) = fairness.calibration_curves(df, roles).collect()
    assert [p.bin for p in curve.calibration_data] == [1, 10]


def _random_rows(n=400):
    draw = random.Random(11)
    return [
        (
            draw.choices(["a", "b", "c", None], [6, 2, 1, 1])[0],
            draw.choice([1, 2, 3]),
            draw.choice([0, 1, 1, None]),
            draw.choice([0, 1, None, 2]),
            draw.choice([0.0, 1.0, None, draw.random()]),
        )
        for _ in range(n)
    ]


_WIDE = "g string, h int, y int, p int, s double"
_WIDE_ROLES = AuditRoles("y", "p", ("g", "h"), score="s")


def _report_rows(df):
    return sorted(
        (r.section, r.attribute, str(r["group"]), r.is_disparity, r.bin or 0, r.metric,
         None if r.value is None else round(r.value, 9))
        for r in df.collect()
    )


@pytest.mark.parametrize("pre_aggregate", [False, True])
@pytest.mark.parametrize("null_group", ["exclude", "include"])
def test_report_agrees_with_the_single_operators(frame, pre_aggregate, null_group):
    df = frame(_random_rows(), _WIDE)
    report = fairness.bias_report(df, _WIDE_ROLES, null_group=null_group, pre_aggregate=pre_aggregate)
    found = _report_rows(report)

    def section(name, table, metrics, bin_column=None):
        for r in table.collect():
            for metric in metrics:
                value = r[metric]
                yield (
                    name, r.attribute, str(r["group"]), False, r[bin_column] if bin_column else 0,
                    metric, None if value is None else round(float(value), 9),
                )

    expected = [
        *section("demographic_parity", fairness.demographic_parity(df, _WIDE_ROLES), ["prediction_rate", "count"]),
        *section("equalized_odds", fairness.equalized_odds(df, _WIDE_ROLES),
                 ["true_positive_rate", "false_positive_rate"]),
        *section("equal_opportunity", fairness.equal_opportunity(df, _WIDE_ROLES),
                 ["true_positive_rate", "positive_count"]),
        *section("calibration", fairness.calibration_means(df, _WIDE_ROLES), ["mean_predicted", "mean_actual"]),
        *section("calibration", fairness.calibration_bins(df, _WIDE_ROLES), ["predicted", "actual", "count"], "bin"),
    ]
    for name, gaps in (
        ("demographic_parity", fairness.parity_disparity),
        ("equalized_odds", fairness.odds_disparity),
        ("equal_opportunity", fairness.opportunity_disparity),
    ):
        for r in gaps(df, _WIDE_ROLES, null_group=null_group).collect():
            metric = r.metric if name == "equalized_odds" else "disparity"
            expected.append((name, r.attribute, "None", True, 0, metric, round(r.value, 9)))
    assert found == sorted(expected)


def test_counts_do_not_depend_on_partitions_or_strategy(frame):
    df = frame(_random_rows(), _WIDE)
    results = [
        sorted(map(str, fairness.group_metrics(df.repartition(n), _WIDE_ROLES, pre_aggregate=p).collect()))
        for n in (1, 16) for p in (False, True)
    ]
    assert all(r == results[0] for r in results)


def test_identities(frame):
    df = frame(_random_rows(), _WIDE)
    for r in fairness.group_metrics(df, _WIDE_ROLES).collect():
        assert r.tp + r.fp + r.tn + r.fn <= r.n
        assert r.tpr + r.fnr == pytest.approx(1.0 if r.tp + r.fn else 0.0)
        assert r.fpr + r.tnr == pytest.approx(1.0 if r.fp + r.tn else 0.0)
    inside = df.filter(F.col("s") > 0).count()
    total = sum(r["count"] for r in fairness.calibration_bins(df, replace(_WIDE_ROLES, attributes=("g",))).collect())
    assert total == inside


def test_comparison_and_long_form(frame):
    metrics = fairness.group_metrics(frame([("a", 1, 1), ("b", 0, 0)]), ROLES)
    assert fairness.comparison_table(metrics).columns == ["attribute", "group", "tpr", "fpr", "ppv", "accuracy"]
    assert fairness.metrics_long(metrics).count() == 8


def test_a_nan_score_is_passed_over(spark):
    rows = [("a", 1, 1, 0.5), ("a", 0, 1, float("nan")), ("a", 0, 0, 0.0), ("b", 1, 1, None), ("b", 1, 0, 0.3)]
    df = spark.createDataFrame(rows, "g string, y int, p int, s double")
    roles = AuditRoles("y", "p", ("g",), score="s")
    means = {r.group: (r.mean_predicted, r.mean_actual) for r in fairness.calibration_means(df, roles).collect()}
    assert means == {"a": (0.25, pytest.approx(1 / 3)), "b": (0.3, 1.0)}
    for lowest in (False, True):
        report = fairness.bias_report(df, roles, include_lowest=lowest).filter("section = 'calibration'").collect()
        found = {(r.group, r.metric): r.value for r in report if r.bin is None}
        assert found["a", "mean_predicted"] == 0.25 and found["b", "mean_predicted"] == 0.3
        assert sum(r.value for r in report if r.metric == "count") == 2 + lowest
