"""Queries of stored, streamed and time-dependent audits, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parityscope.operators import fairness, features, sketches, split
from parityscope.operators.asof import asof_join
from parityscope.operators.audit_state import AuditStore
from parityscope.operators.drift import rolling_disparity
from parityscope.operators.drift import rolling_metrics as rolling
from parityscope.plans.audit_views import LINES_ROLES, ORDERS_ROLES, audit_lines, audit_orders, table
from parityscope.plans.scratch import scratch_path
from parityscope.sources import read_csv
from parityscope.streaming import latest_cells, start_audit_stream

Query = Callable[[SparkSession, str], DataFrame]

#: Attributes of three kinds: of the customer, of the order, and of the customer's country.
ORDERS_BY_THREE = replace(ORDERS_ROLES, attributes=("c_mktsegment", "o_orderpriority", "c_nationkey"), score=None)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _dated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``audit_lines`` with the day of the order, ``ordered``."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") == "R").cast("int").alias("label"),
        ((F.col("l_quantity") - 1) / 49).alias("score"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("ordered"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return lines.join(orders.join(customers, "c_custkey"), "o_orderkey").select(
        "label", "score", (F.col("score") > 0.5).cast("int").alias("prediction"), "c_mktsegment", "o_orderpriority", "ordered"
    )


def _cells(rows: DataFrame) -> DataFrame:
    return fairness.audit_cells(rows, LINES_ROLES, exact=True)


def _year_store(spark: SparkSession, folder: str) -> AuditStore:
    """A store to which the lines of each year of order were added as a batch."""
    lines = _dated_lines(spark, folder)
    store = AuditStore(spark, scratch_path(spark, "audit-store"))
    years = [r.year for r in lines.select(F.year("ordered").alias("year")).distinct().orderBy("year").collect()]
    for year in years:
        store.add(_cells(lines.filter(F.year("ordered") == year)), str(year))
    return store


def audit_state_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a store filled year by year, of which a batch was added twice, taken back
    and added again, and which was compacted on the way."""
    store = _year_store(spark, folder)
    again = _cells(_dated_lines(spark, folder).filter(F.year("ordered") == 1996))
    store.add(again, "1996")
    store.remove("1996")
    store.compact()
    store.add(again, "1996")
    return _rounded(store.report(), "value")


def audit_state_cells(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of a store's cells when one year was taken back."""
    store = _year_store(spark, folder)
    store.remove("1997")
    return _rounded(store.cells().withColumn("score_sum", F.col("score_sum").cast("double")), "score_sum")


def streaming_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a stream that goes on twice, at last with rows of the first ones' days."""
    lines = _dated_lines(spark, folder)
    path = scratch_path(spark, "stream")
    late = F.pmod(F.hash("o_orderpriority", "ordered"), F.lit(10)) == 0
    early = F.col("ordered") < F.to_timestamp(F.lit("1998-06-01"))
    # What came since the last run is one trigger, whatever the number of its files.
    for rows in (lines.filter(~late & early), lines.filter(~late & ~early), lines.filter(late)):
        rows.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        query = start_audit_stream(
            stream, LINES_ROLES, "ordered", f"{path}/out", f"{path}/checkpoint", width="30 days", delay="4000 days", availableNow=True
        )
        query.awaitTermination()
    cells = latest_cells(spark, f"{path}/out").drop("window_start")
    return _rounded(fairness.report_from_cells(cells), "value")


def intersections(spark: SparkSession, folder: str) -> DataFrame:
    """All single values, pairs and triples of three attributes that 20 rows have."""
    rows = _predicted_orders(spark, folder)
    return fairness.intersections(rows, ORDERS_BY_THREE, depth=3, least=20)


def intersection_disparity(spark: SparkSession, folder: str) -> DataFrame:
    """Gaps between the values of each attribute, and between those of each pair of them."""
    rows = fairness.intersections(_predicted_orders(spark, folder), ORDERS_BY_THREE, depth=2, least=20)
    return fairness.disparity(rows, {"tpr": "tpr_disparity", "fpr": "fpr_disparity", "selection_rate": "selection_disparity"})


def _predicted_orders(spark: SparkSession, folder: str) -> DataFrame:
    return audit_orders(spark, folder).withColumn("prediction", (F.col("o_totalprice") > 150_000).cast("int"))


def sketch_estimates(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of each order priority merged to those of all orders, beside exact numbers."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    whole = sketches.distinct_estimates(sketches.merge_sketches(sketches.sketches(orders, columns, by=["o_orderpriority"])))
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot([], columns, "column", "exact")
    found = whole.join(exact, "column")
    off = F.abs(F.col("distinct_estimate") - F.col("exact")) <= 4 * sketches.DISTINCT_ERROR * F.col("exact")
    return found.select("column", "n", F.col("exact").alias("distinct"), off.alias("distinct_within_error"))


def sketch_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Merged quantiles: whether the share of the rows up to each one is the share asked for."""
    orders = table(spark, folder, "orders").select("o_totalprice", "o_orderpriority")
    whole = sketches.merge_sketches(sketches.sketches(orders, ["o_totalprice"], by=["o_orderpriority"]))
    found = sketches.quantile_estimates(whole, (0.1, 0.25, 0.5, 0.75, 0.9))
    # Five quantiles, as one value beside the rows, in one scan.
    points = found.agg(F.sort_array(F.collect_list(F.struct("share", "quantile"))).alias("points")).scalar()
    beside = orders.select("o_totalprice", F.inline(points))
    ranks = beside.groupBy("share").agg(F.count_if(F.col("o_totalprice") <= F.col("quantile")).alias("below"), F.count(F.lit(1)).alias("rows"))
    return ranks.select("share", "rows", (F.abs(F.col("below") / F.col("rows") - F.col("share")) <= 3 * sketches.RANK_ERROR).alias("rank_within_error"))


def string_index_large(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by the index of their customer, a column of very many values."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    index = features.string_index_table(orders.filter("o_orderkey % 3 > 0"), "customer")
    return features.apply_string_index(orders, index, "customer")


def asof_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Each event with its user's latest order that was not later, dates taken to one span."""
    events = table(spark, folder, "events").select("event_id", F.col("user_id").alias("who"), F.col("ts").cast("timestamp").alias("ts"))
    # Orders lie years before the events: their days, squeezed to minutes, end with the events'.
    minutes = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp")) + F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")) * 1080
    orders = table(spark, folder, "orders").select(
        (F.col("o_custkey") % 150).alias("who"), F.timestamp_seconds(minutes).alias("at"), "o_orderkey", "o_orderpriority"
    )
    found = asof_join(events, orders, ["who"], "ts", "at", ["o_orderkey", "o_orderpriority"], slice_seconds=5 * 86_400)
    return found.select("event_id", "who", "o_orderkey", "o_orderpriority", F.unix_seconds("at_matched").alias("matched_seconds"))


def _dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    dates = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return _predicted_orders(spark, folder).join(dates, "o_orderkey")


def rolling_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = rolling(_dated_orders(spark, folder), replace(ORDERS_BY_THREE, attributes=("c_mktsegment", "o_orderpriority")), "o_orderdate", 7)
    return _rounded(found, "prediction_rate", "tpr", "fpr", "opportunity")


def rolling_disparities(spark: SparkSession, folder: str) -> DataFrame:
    roles = replace(ORDERS_BY_THREE, attributes=("c_mktsegment", "o_orderpriority"))
    return _rounded(rolling_disparity(_dated_orders(spark, folder), roles, "o_orderdate", 7), "value")


def csv_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one folder with different orders of columns, one with a repeated header."""
    customer = table(spark, folder, "customer")
    path = scratch_path(spark, "layouts")
    layouts: list[list[str | Column]] = [
        ["c_custkey", "c_name", "c_acctbal"],
        ["c_acctbal", "c_custkey", "c_name"],
        ["c_name", "c_acctbal", "c_custkey", (-F.col("c_acctbal")).alias("c_acctbal ")],
    ]
    for part, columns in enumerate(layouts):
        rows = customer.filter(F.col("c_custkey") % 3 == part).select(*columns)
        rows.write.mode("append").option("header", True).csv(path)
    return read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double", layouts="by name")


def prediction_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of two sets of predictions, by two limits, that differ in their numbers of rows."""
    lines = audit_lines(spark, folder).select("c_mktsegment", "o_orderpriority", "label", "score")
    sides = [lines.select("c_mktsegment", "o_orderpriority", "label", (F.col("score") > limit).cast("int").alias("prediction")) for limit in (0.5, 0.6)]
    return split.multiset_difference(*sides)


_QUERIES: tuple[Query, ...] = (
    streaming_audit, audit_state_report, audit_state_cells, intersections, intersection_disparity,
    sketch_estimates, sketch_quantiles, string_index_large, asof_labels, rolling_metrics, rolling_disparities,
    csv_layouts, prediction_changes,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}
