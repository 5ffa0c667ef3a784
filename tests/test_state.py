"""Stored and streamed audits, intersections, drift, as-of joins, sketches and layouts."""

import datetime as dt
import itertools
import random
import shutil
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parityscope import AuditRoles
from parityscope.operators import fairness, features, sketches, split
from parityscope.operators.asof import asof_join
from parityscope.operators.audit_state import AuditStore
from parityscope.operators.drift import rolling_disparity, rolling_metrics
from parityscope.plans import state_queries
from parityscope.plans.audit_views import LINES_ROLES
from parityscope.sources import read_csv
from parityscope.streaming import latest_cells, late_rows, start_audit_stream, window_cells

ROLES = AuditRoles("label", "prediction", ("sex", "town"), score="score")
SCHEMA = "label int, prediction int, score double, sex string, town string, at timestamp"


def _rows(n, seed=1, start=dt.datetime(2024, 1, 1), days=20):
    draw = random.Random(seed)
    return [
        (
            draw.choice([0, 1, 1, None]), draw.choice([0, 1]), draw.choice([None, 0.0, float("nan"), draw.random(), draw.random()]),
            draw.choice(["f", "m", None]), draw.choice(["a", "b", "c", None]), start + dt.timedelta(hours=draw.randrange(24 * days)),
        )
        for _ in range(n)
    ]


def _table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _cells(df, roles=ROLES):
    return fairness.audit_cells(df, roles, exact=True)


def _report(df):
    return sorted((str(r[:-1]), None if r.value is None else round(r.value, 9)) for r in map(tuple_with_value, df.collect()))


def tuple_with_value(row):
    class Row(tuple):
        value = row["value"]

    return Row(row)


def _facts(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def store(spark, tmp_path):
    return AuditStore(spark, str(tmp_path / "store"))


def test_two_days_are_one_audit_without_the_first_days_rows(spark, store, tmp_path):
    days = [_rows(300, seed) for seed in (1, 2)]
    for i, rows in enumerate(days):
        path = str(tmp_path / f"day{i}")
        _table(spark, rows).write.parquet(path)
        store.add(_cells(spark.read.parquet(path)), f"day{i}")
        shutil.rmtree(path)  # nothing of an earlier day can be read again
    assert _report(store.report()) == _report(fairness.bias_report(_table(spark, days[0] + days[1]), ROLES))
    assert _report(store.report(version=1)) == _report(fairness.bias_report(_table(spark, days[0]), ROLES))


def test_taking_back_leaves_no_trace(spark, store):
    first, second, third = (_cells(_table(spark, _rows(200, seed))) for seed in (3, 4, 5))
    assert [store.add(c, b) for c, b in ((first, "a"), (second, "b"), (third, "c"))] == [1, 2, 3]
    assert store.add(second, "b") is None and store.remove("nobody") is None
    before = _facts(store.cells(version=1).unionAll(third.select(*store.cells().columns)).groupBy("attribute", "group", "label", "prediction", "bin").agg(F.sum("n")))
    assert store.remove("b") == 4 and store.remove("b") is None
    assert _facts(store.cells().groupBy("attribute", "group", "label", "prediction", "bin").agg(F.sum("n"))) == before
    assert store.add(second, "b") == 5
    assert _facts(store.cells()) == _facts(store.cells(version=3))


def test_order_of_batches_does_not_matter(spark, tmp_path):
    parts = [_cells(_table(spark, _rows(150, seed))) for seed in (6, 7, 8)]
    stores = [AuditStore(spark, str(tmp_path / str(i))) for i in range(2)]
    for store, order in zip(stores, ((0, 1, 2), (2, 0, 1)), strict=True):
        for i in order:
            store.add(parts[i], str(i))
    assert _facts(stores[0].cells()) == _facts(stores[1].cells())


def test_snapshots_and_unfinished_versions(spark, store, tmp_path):
    assert store.compact() is None and store.report().count() == 0
    parts = [_cells(_table(spark, _rows(100, seed))) for seed in (9, 10, 11)]
    store.add(parts[0], "a")
    (tmp_path / "store" / "version=2").mkdir()  # a writer that failed
    assert store.add(parts[1], "b") == 3 and store.versions() == [1, 3]
    whole = _facts(store.cells())
    assert store.compact() == 3 and store.compact() == 3
    assert _facts(store.cells()) == whole
    shutil.rmtree(tmp_path / "store" / "version=1")  # the snapshot alone is read
    assert _facts(store.cells()) == whole
    assert store.add(parts[2], "c") == 4
    assert store.cells().agg(F.sum("n")).first()[0] == 600


def test_store_without_score(spark, store):
    roles = AuditRoles("label", "prediction", ("sex",))
    rows = _table(spark, _rows(80))
    store.add(_cells(rows, roles), "a")
    sections = {r.section for r in store.report().filter("section <> 'calibration'").collect()}
    assert sections == {"demographic_parity", "equalized_odds", "equal_opportunity"}


def _stream(spark, tmp_path, files, delay, name="s"):
    folder = str(tmp_path / name)
    for rows in files:
        _table(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = start_audit_stream(stream, ROLES, "at", f"{folder}/out", f"{folder}/state", width="1 day", delay=delay, availableNow=True)
    query.awaitTermination()
    return query, folder


def test_stream_with_late_rows_is_the_audit_of_all(spark, tmp_path):
    files = [_rows(150, 1, days=5), _rows(150, 2, dt.datetime(2024, 1, 20), 5), _rows(100, 3, days=5)]
    query, folder = _stream(spark, tmp_path, files, "60 days")
    assert late_rows(query) == 0
    found = fairness.report_from_cells(latest_cells(spark, f"{folder}/out").drop("window_start"))
    assert _report(found) == _report(fairness.bias_report(_table(spark, sum(files, [])), ROLES))


def test_rows_beyond_the_delay_are_dropped_and_counted(spark, tmp_path):
    files = [_rows(150, 1, days=5), _rows(150, 2, dt.datetime(2024, 1, 20), 5), _rows(100, 3, days=5)]
    query, folder = _stream(spark, tmp_path, files, "2 days")
    assert late_rows(query) > 0
    # The third trigger judges lateness by the watermark that the second began with.
    watermark = max(r[5] for r in files[0]) - dt.timedelta(days=2)
    in_time = [r for r in files[2] if dt.datetime.combine(r[5].date(), dt.time()) + dt.timedelta(days=1) > watermark]
    assert 0 < len(in_time) < len(files[2])
    found = fairness.report_from_cells(latest_cells(spark, f"{folder}/out").drop("window_start"))
    assert _report(found) == _report(fairness.bias_report(_table(spark, files[0] + files[1] + in_time), ROLES))


def test_a_stream_that_starts_again_counts_nothing_twice(spark, tmp_path):
    files = [_rows(80, seed, days=4) for seed in (1, 2, 3)]
    _stream(spark, tmp_path, files[:2], "30 days")
    query, folder = _stream(spark, tmp_path, files[2:], "30 days")
    cells = latest_cells(spark, f"{folder}/out")
    assert _facts(cells) == _facts(window_cells(_table(spark, sum(files, [])), ROLES, "at", "1 day", "30 days"))


def test_partitions_of_the_state_are_tasks_of_their_own(spark, tmp_path):
    query, _ = _stream(spark, tmp_path, [_rows(200, 1, days=5)], "30 days")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(job).stageIds]
    assert max(s.numTasks for s in stages if s is not None) == 8


def test_a_stream_of_joined_lines_is_not_written_by_one_task(spark, tmp_path, monkeypatch):
    """The whole query on rows of its own, where nothing merges or broadcasts small partitions."""
    draw = random.Random(4)
    tables = {
        "customer": ([(c, draw.choice(["a", "b", None])) for c in range(20)], "c_custkey bigint, c_mktsegment string"),
        "orders": (
            [(o, draw.randrange(20), draw.choice(["1-URGENT", "5-LOW"]), dt.datetime(1998, 1, 1) + dt.timedelta(days=draw.randrange(300))) for o in range(200)],
            "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderdate timestamp_ntz",
        ),
        "lineitem": ([(draw.randrange(200), float(draw.randrange(1, 51)), draw.choice("RAN")) for _ in range(600)], "l_orderkey bigint, l_quantity double, l_returnflag string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(state_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = state_queries.streaming_audit(spark, str(tmp_path))
        want = fairness.bias_report(state_queries._dated_lines(spark, str(tmp_path)), LINES_ROLES).withColumn("value", F.round("value", 6))
        assert _report(found) == _report(want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "stream" / "in").glob("part-*.parquet"))) > 3


def _brute_intersections(rows, names, depth, least):
    found = {}
    for size in range(1, depth + 1):
        for chosen in itertools.combinations(range(len(names)), size):
            counts = Counter(tuple(r[i] for i in chosen) for r in rows)
            found |= {(" & ".join(names[i] for i in chosen), v): n for v, n in counts.items() if n >= least}
    return found


def test_intersections(spark):
    draw = random.Random(2)
    rows = [(draw.choice("ab"), draw.choice(["x", "y", None]), draw.choice([1, 2, 3, 4, 5, 6, 7, 8]), draw.randrange(2), draw.randrange(2)) for _ in range(400)]
    table = spark.createDataFrame(rows, "p string, q string, r int, label int, prediction int")
    roles = AuditRoles(attributes=("p", "q", "r"))
    for depth, least in ((1, 1), (2, 30), (3, 1), (3, 12)):
        want = _brute_intersections(rows, "pqr", depth, least)
        found = fairness.intersections(table, roles, depth, least).collect()
        read = {(r.attribute, tuple(None if v is None else type(w)(v) for v, w in zip(__import__("json").loads(r.group), _kinds(r.attribute), strict=True))): r.n for r in found}
        assert read == want
        assert all(r.tp + r.fp + r.tn + r.fn == r.n for r in found)
    with pytest.raises(ValueError, match="depth"):
        fairness.intersections(table, roles, 4)


def _kinds(attribute):
    return [0 if a == "r" else "" for a in attribute.split(" & ")]


def test_intersections_read_the_table_once(spark, tmp_path):
    _table(spark, _rows(200)).write.parquet(str(tmp_path / "t"))
    found = fairness.intersections(spark.read.parquet(str(tmp_path / "t")), ROLES, 2, 5)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert final.count("FileScan") - final.count("ReusedExchange") <= 1 or final.count("FileScan") == 1


def _brute_rolling(rows, days):
    by = defaultdict(list)
    for label, prediction, _, sex, town, at in rows:
        for attribute, group in (("sex", sex), ("town", town)):
            by[attribute].append((group, at.date(), label, prediction))
    found = {}
    for attribute, own in by.items():
        for end in {d for _, d, _, _ in own}:
            inside = [r for r in own if end - dt.timedelta(days=days) < r[1] <= end]
            for group in {r[0] for r in inside}:
                here = [r for r in inside if r[0] == group]
                tp, fn = (sum(r[2] == 1 and r[3] == p for r in here) for p in (1, 0))
                predicted = [r[3] for r in here if r[3] is not None]
                found[attribute, group, end] = (len(here), sum(predicted) / len(predicted), tp / (tp + fn) if tp + fn else 0.0)
    return found


@pytest.mark.parametrize("days", [1, 7])
def test_rolling_metrics(spark, days):
    rows = [r for r in _rows(150, 4, days=40) if r[5].day % 5]
    found = rolling_metrics(_table(spark, rows), ROLES, "at", days).collect()
    want = _brute_rolling(rows, days)
    assert {(r.attribute, r.group, r.window_end) for r in found} == set(want)
    for r in found:
        n, rate, tpr = want[r.attribute, r.group, r.window_end]
        assert (r.n, round(r.prediction_rate, 9), round(r.tpr, 9)) == (n, round(rate, 9), round(tpr, 9))


def test_rolling_disparity_over_all_days_is_that_of_the_table(spark):
    rows = _rows(200, 5)
    table = _table(spark, rows)
    last = max(r[5] for r in rows).date()
    found = rolling_disparity(table, ROLES, "at", 100).filter(F.col("window_end") == F.lit(last)).collect()
    whole = {(r.attribute, r.metric): r.value for r in fairness.odds_disparity(table, ROLES).unionByName(fairness.opportunity_disparity(table, ROLES)).collect()}
    read = {(r.attribute, r.metric): r.value for r in found if r.metric != "demographic_parity_disparity"}
    assert read.keys() == whole.keys() and all(abs(read[k] - whole[k]) < 1e-12 for k in read)
    assert rolling_disparity(_table(spark, []), ROLES, "at").count() == 0


def _brute_asof(left, right, tolerance):
    found = []
    for key, at, name in left:
        known = [(t, v is not None, v or "", v) for k, t, v in right if k is not None and k == key and t is not None and at is not None and t <= at]
        best = max(known) if known else None
        if best and tolerance is not None and (at - best[0]).total_seconds() > tolerance:
            best = None
        found.append((key, at, name, best[0] if best else None, best[3] if best else None))
    return sorted(map(str, found))


@pytest.mark.parametrize("slice_seconds", [3_600, 86_400 * 400])
@pytest.mark.parametrize("tolerance", [None, 7_200])
def test_asof_join(spark, slice_seconds, tolerance):
    draw = random.Random(3)
    at = lambda: draw.choice([None, *[dt.datetime(2024, 3, 1) + dt.timedelta(minutes=draw.randrange(3000)) for _ in range(20)]])
    key = lambda: draw.choice([None, 1, 1, 1, 2, 3])
    left = [(key(), at(), f"l{i}") for i in range(200)]
    right = [(key(), at(), draw.choice([None, "u", "v"])) for _ in range(60)]
    left += left[:3] + [(1, right[0][1], "same time"), (9, dt.datetime(2024, 3, 2), "no key")]
    right += right[:2] + [(1, dt.datetime(2024, 3, 1, 12), "u"), (1, dt.datetime(2024, 3, 1, 12), "v")]
    left.append((1, dt.datetime(2024, 3, 1, 12), "tie"))
    tables = spark.createDataFrame(left, "k int, at timestamp, name string"), spark.createDataFrame(right, "k int, since timestamp, value string")
    found = asof_join(*tables, ["k"], "at", "since", slice_seconds=slice_seconds, tolerance_seconds=tolerance)
    assert found.columns == ["k", "at", "name", "since_matched", "value"]
    assert sorted(str((r.k, r.at, r.name, r.since_matched, r.value)) for r in found.collect()) == _brute_asof(left, right, tolerance)


def test_asof_join_with_empty_tables(spark):
    left = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "k int, at timestamp")
    right = spark.createDataFrame([], "k int, since timestamp, value string")
    assert [tuple(r) for r in asof_join(left, right, ["k"], "at", "since").collect()] == [(1, dt.datetime(2024, 1, 1), None, None)]
    assert asof_join(left.limit(0), right, ["k"], "at", "since").count() == 0
    with pytest.raises(ValueError, match="both tables"):
        asof_join(left, right.withColumn("at", F.lit(1)), ["k"], "at", "since")


def test_sketches_of_parts_are_those_of_the_whole(spark):
    numbers = [(i % 5, i % 700, float(i % 1000) if i % 11 else float("nan"), None) for i in range(20_000)]
    table = spark.createDataFrame(numbers, "part int, a int, b double, c string")
    merged = sketches.merge_sketches(sketches.sketches(table, ["a", "b", "c"], by=["part"]))
    for found in (merged, sketches.sketches(table, ["a", "b", "c"])):
        rows = {r.column: r for r in sketches.distinct_estimates(found).collect()}
        assert abs(rows["a"].distinct_estimate - 700) <= 4 * sketches.DISTINCT_ERROR * 700
        assert (rows["c"].n, rows["c"].distinct_estimate) == (0, 0)
        for r in sketches.quantile_estimates(found, (0.1, 0.5, 0.9)).filter("column = 'b'").collect():
            assert abs(r.quantile - 1000 * r.share) <= 1000 * 3 * sketches.RANK_ERROR + 1
    assert sketches.merge_sketches(sketches.sketches(table.limit(0), ["a"], by=["part"])).count() == 0


def test_string_index_table_is_the_indexers(spark):
    draw = random.Random(4)
    values = [(draw.choice(["ä", "b", "c", "d", "é", "", None, *map(str, range(60))]),) for _ in range(500)]
    table = spark.createDataFrame(values, "v string")
    fitted = features.string_index_stage(["v"]).fit(table.filter("v is not null"))
    unseen = table.unionAll(spark.createDataFrame([("nobody",)], "v string"))
    want = sorted(map(str, fitted.transform(unseen).select("v", "v_indexed").collect()))
    for ranges in (1, 7, 200):
        index = features.string_index_table(table, "v", ranges=ranges)
        assert sorted(map(str, features.apply_string_index(unseen, index, "v").select("v", "v_indexed").collect())) == want


def test_string_index_of_a_million_values(spark):
    table = spark.range(1_000_000).select(F.concat(F.lit("value "), F.col("id")).alias("v"))
    index = features.string_index_table(table, "v")
    assert index.agg(F.count_distinct("index"), F.min("index"), F.max("index")).first()[:] == (1_000_000, 0.0, 999_999.0)
    sampled = index.filter("index % 99991 = 0").orderBy("index").collect()
    assert [r.value for r in sampled] == sorted(r.value for r in sampled)


def test_string_index_of_nothing(spark):
    table = spark.createDataFrame([(None,)], "v string")
    index = features.string_index_table(table, "v")
    assert index.count() == 0 and features.apply_string_index(table, index, "v").first().v_indexed == 0.0


def test_multiset_difference_is_except_all_both_ways(spark):
    draw = random.Random(5)
    sides = [[(draw.choice(["a", "b", None]), draw.choice([1.0, float("nan"), None])) for _ in range(n)] for n in (60, 40)]
    first, second = (spark.createDataFrame(s, "x string, y double") for s in sides)
    found = split.multiset_difference(first, second.select("y", "x")).collect()
    for a, b, sign in ((first, second, 1), (second, first, -1)):
        want = Counter(map(str, a.exceptAll(b).collect()))
        more = {str((r.x, r.y)): sign * (r.in_first - r.in_second) for r in found if sign * (r.in_first - r.in_second) > 0}
        assert {k.replace("Row(x=", "(").replace("y=", ""): n for k, n in want.items()} == more
    assert split.multiset_difference(first, first).count() == 0


LAYOUTS = {
    "a.csv": "id,name,size\n1,\"x, y\",3.5\n2,,\n",
    "b.csv": " size ,id,name,id\n4.5,3,z,99\nbad,4,w,99\n",
    "c.csv": "\nname,id\nonly,5\n",
}


def _layouts(tmp_path, copies=1):
    folder = tmp_path / f"layouts{copies}"
    folder.mkdir()
    for name, text in LAYOUTS.items():
        for i in range(copies):
            (folder / f"{i}{name}").write_text(text)
    return str(folder)


def test_csv_files_of_different_layouts(spark, tmp_path):
    path = _layouts(tmp_path)
    found = read_csv(spark, path, "id int, name string, size double", optional=("size",), layouts="by name")
    assert sorted((r.id, r.name, r.size) for r in found.collect()) == [(1, "x, y", 3.5), (2, None, None), (3, "z", 4.5), (4, "w", None), (5, "only", None)]
    with pytest.raises(ValueError, match="size"):
        read_csv(spark, path, "id int, size double", layouts="by name")
    with pytest.raises(ValueError, match="schema"):
        read_csv(spark, path, layouts="by name")
    with pytest.raises(ValueError, match="differs"):
        read_csv(spark, path, "id int")


def test_reading_layouts_takes_as_many_jobs_for_many_files(spark, tmp_path):
    jobs = {}
    for copies in (1, 8):
        spark.sparkContext.setJobGroup(f"layouts {copies}", "")
        read_csv(spark, _layouts(tmp_path, copies), "id int, name string", layouts="by name").collect()
        jobs[copies] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"layouts {copies}"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[1] == jobs[8]


def test_predictions_that_are_no_numbers_are_not_in_the_mean(spark):
    rows = [("a", 1, 1.0), ("a", 0, float("nan")), ("a", 1, None), ("b", 1, 0.5), ("b", 0, 0.0)]
    table = spark.createDataFrame(rows, "g string, label int, prediction double")
    roles = AuditRoles(attributes=("g",))
    assert {r.group: (r.prediction_rate, r["count"]) for r in fairness.demographic_parity(table, roles).collect()} == {"a": (1.0, 3), "b": (0.25, 2)}
    report = fairness.bias_report(table, roles).filter("metric = 'prediction_rate'")
    assert {r.group: r.value for r in report.collect()} == {"a": 1.0, "b": 0.25}
