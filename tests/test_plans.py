"""Shape of the physical plans: what is scanned, shuffled and pushed down."""

import json
import os
import re
import subprocess
import sys

import pytest

from parityscope.operators import evaluate, fairness, split
from parityscope.plans import registry
from parityscope.plans.audit_views import LINES_ROLES, audit_lines, table

TRAINED = {"rf_train_score", "logreg_train_score", "logreg_cell_scores", "top_k_importance", "model_save_load",
           "train_and_audit", "feature_set", "string_index"}
NOT_WANTED = re.compile(
    "BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin"
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _executed(df):
    df.collect()
    text = _plan(df)
    return text[: text.rindex("== Initial Plan ==")] if "== Initial Plan ==" in text else text


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - TRAINED))
def test_no_python_workers_and_no_pairing_of_all_rows(spark, sf_small, name):
    assert not NOT_WANTED.search(_plan(registry.queries()[name](spark, sf_small)))


@pytest.fixture(scope="module")
def written(spark, sf_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "t")
    audit_lines(spark, sf_small).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("pre_aggregate", [False, True])
def test_report_reads_the_table_once(written, pre_aggregate):
    plan = _plan(fairness.bias_report(written, LINES_ROLES, pre_aggregate=pre_aggregate))
    assert plan.count("FileScan") == 1
    assert "SinglePartition" not in plan


def test_group_metrics_combine_before_the_only_shuffle(written):
    plan = _plan(fairness.group_metrics(written, LINES_ROLES))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    below = plan[plan.index("Exchange"):]
    assert "partial_count" in below


def test_disparities_read_the_table_once(written):
    for gaps in (fairness.parity_disparity, fairness.odds_disparity, fairness.opportunity_disparity):
        assert _plan(gaps(written, LINES_ROLES)).count("FileScan") == 1


def test_only_needed_columns_are_read(written):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", _plan(fairness.demographic_parity(written, LINES_ROLES)))
    assert {c.split(":")[0] for c in schema.group(1).split(",")} == {"prediction", "c_mktsegment", "o_orderpriority"}


def test_auc_reads_once_and_ranks_inside_ranges(written):
    plan = _executed(evaluate.auc(written, "label", "score"))
    assert plan.count("FileScan") == 1 and "rangepartitioning(score" in plan
    ranking = [line for line in plan.splitlines() if "Window" in line and "score#" in line]
    assert ranking and all(re.search(r"\], \[range#\d+\], \[score#", line) for line in ranking)


def _records_read(spark, tmp_path, action):
    """Records that tasks read from files, by the event log of a session of its own."""
    script = tmp_path / "run.py"
    script.write_text(action)
    logs = tmp_path / "events"
    logs.mkdir()
    subprocess.run(
        [sys.executable, str(script), str(logs)], check=True, capture_output=True, timeout=300,
        env=os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))},
    )
    total, scanning = 0, set()
    for log in logs.rglob("*"):
        for line in log.open() if log.is_file() and not log.name.endswith(".crc") else ():
            event = json.loads(line)
            if event["Event"] == "SparkListenerStageSubmitted":  # reading a cache counts as input, too
                if any("Scan parquet" in r.get("Scope", "") for r in event["Stage Info"]["RDD Info"]):
                    scanning.add(event["Stage Info"]["Stage ID"])
            if event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in scanning:
                total += (event.get("Task Metrics") or {}).get("Input Metrics", {}).get("Records Read", 0)
    return total


_START = """
import sys
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
    .config("spark.eventLog.dir", "file://" + sys.argv[1]).getOrCreate()
)
from parityscope.operators import evaluate, model
from parityscope.plans import registry
from parityscope.plans.audit_views import LINES_ROLES, ORDERS_CATEGORICAL, ORDERS_NUMERIC, audit_lines, audit_orders
folder = "/root/testdata/sf0.001"
"""


def test_metrics_read_their_table_once(spark, sf_small, tmp_path):
    one = sum(table(spark, sf_small, t).count() for t in ("lineitem", "orders", "customer"))
    action = _START + "evaluate.classification_metrics(audit_lines(spark, folder), LINES_ROLES).collect()\nspark.stop()"
    assert _records_read(spark, tmp_path, action) == one


def test_fitting_reads_its_table_once(spark, sf_small, tmp_path):
    one = sum(table(spark, sf_small, t).count() for t in ("orders", "customer"))
    action = _START + (
        "model.fit_classifier(audit_orders(spark, folder), 'label', ORDERS_NUMERIC, ORDERS_CATEGORICAL, "
        "order_by='o_orderkey', numTrees=3, maxDepth=3)\nspark.stop()"
    )
    assert _records_read(spark, tmp_path, action) == one


def test_share_counts_the_table_once(spark, sf_small):
    assert "ReusedExchange" in _executed(registry.share_of_total(spark, sf_small))


def test_two_largest_groups_are_limited_before_the_shuffle(written):
    plan = _plan(fairness.pair_disparity(fairness.group_metrics(written, LINES_ROLES)))
    assert "WindowGroupLimit" in plan


def test_split_and_row_wise_operators_do_not_shuffle(spark, sf_small):
    orders = registry._orders_with_label(spark, sf_small)
    assert "Exchange" not in _plan(split.stratified_hash_split(orders, "o_orderkey", "label"))
    for name in ("threshold_flags", "row_sum_interactions", "polynomial_features", "try_int",
                 "band_numeric", "collapse_categories", "select_available", "class_filter", "score_extract"):
        assert "Exchange" not in _plan(registry.queries()[name](spark, sf_small)), name


def test_filters_reach_the_scan(spark, sf_small):
    assert "EqualTo(quality,1)" in _plan(registry.class_filter(spark, sf_small))


def test_first_rows_are_taken_without_a_full_sort(spark, sf_small):
    assert "TakeOrderedAndProject" in _plan(registry.sample_rows(spark, sf_small))


def test_histogram_bounds_come_from_one_aggregate(spark, sf_small):
    plan = _executed(registry.histogram(spark, sf_small))
    assert plan.count("FileScan") - plan.count("ReusedSubquery") <= 2
    assert "Join" not in plan


def test_parquet_schema_of_views(spark, sf_small):
    lines = audit_lines(spark, sf_small)
    assert lines.count() == table(spark, sf_small, "lineitem").count()
