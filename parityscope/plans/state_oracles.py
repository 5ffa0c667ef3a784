"""SQL of the queries of stored, streamed and time-dependent audits."""

from __future__ import annotations

_DATED = """lines AS (
  SELECT label, score, CASE WHEN score > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS prediction, c_mktsegment, o_orderpriority, ordered
  FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, (l_quantity - 1) / CAST(49 AS DOUBLE) AS score,
               c_mktsegment, o_orderpriority, o_orderdate AS ordered
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey))"""

# Right edges of the ten score bins, as doubles of i * 0.1.
_EDGES = [i * 0.1 for i in range(1, 10)] + [1.0]
_BIN = "CASE WHEN score IS NULL OR score <= 0 THEN NULL " + " ".join(
    f"WHEN score <= CAST({edge!r} AS DOUBLE) THEN {number}" for number, edge in enumerate(_EDGES, start=1)
) + " END"

_ORDERS = """src AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS prediction,
         c_mktsegment, o_orderpriority, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(o_orderdate AS DATE) AS day
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

_COUNTS = """count(*) AS n,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn"""


def _ratio(numerator: str, denominator: str) -> str:
    return f"CASE WHEN ({denominator}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({numerator} AS DOUBLE) / ({denominator}) END"


_RATES = f"""{_ratio('tp', 'tp + fn')} AS tpr, {_ratio('fp', 'fp + tn')} AS fpr,
  {_ratio('tn', 'tn + fp')} AS tnr, {_ratio('fn', 'fn + tp')} AS fnr,
  {_ratio('tp', 'tp + fp')} AS ppv, {_ratio('tn', 'tn + fn')} AS npv,
  {_ratio('tp + fn', 'n')} AS base_rate, {_ratio('tp + fp', 'n')} AS selection_rate,
  {_ratio('tp + tn', 'n')} AS accuracy"""


def _lattice(depth: int) -> str:
    names = ("c_mktsegment", "o_orderpriority", "c_nationkey")
    sets = [[a] for a in names]
    sets += [[names[i], names[j]] for i in range(3) for j in range(i + 1, 3)] if depth > 1 else []
    sets += [list(names)] if depth > 2 else []
    parts = [
        f"SELECT '{' & '.join(s)}' AS attribute, CAST(to_json([{', '.join(s)}]) AS VARCHAR) AS \"group\", {_COUNTS} "
        f"FROM src GROUP BY {', '.join(s)} HAVING count(*) >= 20"
        for s in sets
    ]
    return f"{_ORDERS}, counts AS ({' UNION ALL '.join(parts)}), metrics AS (SELECT *, {_RATES} FROM counts)"


def _gap(column: str, name: str) -> str:
    return f"SELECT attribute, '{name}' AS metric, max({column}) - min({column}) AS value FROM metrics GROUP BY attribute HAVING count(*) >= 2"


_ROLLING = f"""{_ORDERS}, stacked AS (
  SELECT 'c_mktsegment' AS attribute, c_mktsegment AS "group", day, label, prediction FROM src
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, day, label, prediction FROM src
), ends AS (SELECT DISTINCT attribute, day AS window_end FROM stacked),
counts AS (
  SELECT e.attribute, s."group", e.window_end, count(*) FILTER (WHERE label = 1) AS positives,
         avg(CAST(prediction AS DOUBLE)) AS prediction_rate, {_COUNTS}
  FROM ends e JOIN stacked s ON s.attribute = e.attribute AND s.day <= e.window_end AND s.day > e.window_end - 7
  GROUP BY 1, 2, 3
), metrics AS (
  SELECT attribute, "group", window_end, n, prediction_rate, {_ratio('tp', 'tp + fn')} AS tpr, {_ratio('fp', 'fp + tn')} AS fpr,
         {_ratio('tp', 'positives')} AS opportunity, positives
  FROM counts)"""


def _rolling_gap(column: str, name: str, where: str = "true") -> str:
    gap = f"max({column}) FILTER (WHERE {where}) - min({column}) FILTER (WHERE {where})"
    return f"SELECT attribute, window_end, '{name}' AS metric, round({gap}, 6) AS value FROM metrics GROUP BY 1, 2 HAVING count(*) >= 2"


def oracle_sql(report: str) -> dict[str, str]:
    """SQL per query key; ``report`` is that of ``bias_report``."""
    stacked = " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, {a} AS \"group\", label, prediction, score FROM lines WHERE year(ordered) <> 1997"
        for a in ("c_mktsegment", "o_orderpriority")
    )
    return {
        "streaming_audit": report,
        "audit_state_report": report,
        "audit_state_cells": f"""WITH {_DATED}, stacked AS ({stacked})
            SELECT attribute, "group", CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, CAST({_BIN} AS INTEGER) AS bin,
                   count(*) AS n, count(score) AS scored, round(sum(score), 6) AS score_sum
            FROM stacked GROUP BY 1, 2, 3, 4, 5""",
        "intersections": f"""WITH {_lattice(3)} SELECT attribute, "group", n, tp, fp, tn, fn, tpr, fpr, tnr, fnr, ppv, npv,
            base_rate, selection_rate, accuracy FROM metrics""",
        "intersection_disparity": f"""WITH {_lattice(2)} {_gap('tpr', 'tpr_disparity')}
            UNION ALL {_gap('fpr', 'fpr_disparity')} UNION ALL {_gap('selection_rate', 'selection_disparity')}""",
        "sketch_estimates": """SELECT 'o_orderkey' AS "column", count(o_orderkey) AS n, count(DISTINCT o_orderkey) AS "distinct",
                   true AS distinct_within_error FROM orders
            UNION ALL SELECT 'o_custkey', count(o_custkey), count(DISTINCT o_custkey), true FROM orders
            UNION ALL SELECT 'o_totalprice', count(o_totalprice), count(DISTINCT o_totalprice), true FROM orders""",
        "sketch_quantiles": """SELECT CAST(s AS DOUBLE) AS share, (SELECT count(*) FROM orders) AS "rows", true AS rank_within_error
            FROM (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]) AS s)""",
        "string_index_large": """WITH src AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders),
            idx AS (SELECT customer, CAST(row_number() OVER (ORDER BY count(*) DESC, customer) - 1 AS DOUBLE) AS i
                    FROM src WHERE o_orderkey % 3 > 0 GROUP BY customer)
            SELECT o_orderkey, src.customer, coalesce(i, (SELECT CAST(count(*) AS DOUBLE) FROM idx)) AS customer_indexed
            FROM src LEFT JOIN idx ON src.customer = idx.customer""",
        "asof_labels": """WITH orders_at AS (
              SELECT o_custkey % 150 AS who, o_orderkey, o_orderpriority,
                     1704067200 + date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 1080 AS seconds FROM orders
            ), latest AS (
              SELECT who, seconds, max((o_orderkey, o_orderpriority)) AS v FROM orders_at GROUP BY who, seconds
            ), timed AS (SELECT event_id, user_id AS who, epoch_us(ts) AS us FROM events),
            matched AS (
              SELECT t.event_id, t.who, l.v, l.seconds FROM timed t ASOF LEFT JOIN (SELECT *, seconds * 1000000 AS us FROM latest) l
              ON t.who = l.who AND t.us >= l.us)
            SELECT event_id, who, v[1] AS o_orderkey, v[2] AS o_orderpriority, seconds AS matched_seconds FROM matched""",
        "rolling_metrics": f"""WITH {_ROLLING} SELECT attribute, "group", window_end, n, round(prediction_rate, 6) AS prediction_rate,
            round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(opportunity, 6) AS opportunity, positives FROM metrics""",
        "rolling_disparities": f"""WITH {_ROLLING} SELECT * FROM ({_rolling_gap('prediction_rate', 'demographic_parity_disparity')}
            UNION ALL {_rolling_gap('tpr', 'tpr_disparity')} UNION ALL {_rolling_gap('fpr', 'fpr_disparity')}
            UNION ALL {_rolling_gap('opportunity', 'equal_opportunity_disparity', 'positives > 0')}) WHERE value IS NOT NULL""",
        "csv_layouts": "SELECT c_custkey, c_name, c_acctbal FROM customer",
        "prediction_changes": f"""WITH {_DATED}, sides AS (
              SELECT c_mktsegment, o_orderpriority, label, CASE WHEN score > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS prediction, 1 AS a, 0 AS b FROM lines
              UNION ALL
              SELECT c_mktsegment, o_orderpriority, label, CASE WHEN score > CAST(0.6 AS DOUBLE) THEN 1 ELSE 0 END, 0, 1 FROM lines)
            SELECT c_mktsegment, o_orderpriority, label, prediction, CAST(sum(a) AS BIGINT) AS in_first, CAST(sum(b) AS BIGINT) AS in_second
            FROM sides GROUP BY 1, 2, 3, 4 HAVING sum(a) <> sum(b)""",
    }
