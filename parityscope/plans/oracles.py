"""The same results as the registered queries, as SQL over the same tables.

What a trained model gives follows from the tables where the label is a limit on one
feature, or where a converged fit balances its scores. Counts are cast to BIGINT because
the SQL engine sums integers into a wider type.
"""

from __future__ import annotations

from collections.abc import Iterable

from parityscope.plans import state_oracles

DOCS = """audit_docs AS (
  SELECT l.doc_id, l.quality AS label, CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS prediction,
         d.lang, d.source
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

LINES = """audit_lines AS (
  SELECT label, score, CASE WHEN score > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS prediction,
         c_mktsegment, o_orderpriority
  FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
               (l_quantity - 1) / CAST(49 AS DOUBLE) AS score, c_mktsegment, o_orderpriority
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey))"""

DOCS_LABELS = """SELECT d.doc_id, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

# Right edges of the ten score bins, as doubles of i * 0.1.
EDGES = [i * 0.1 for i in range(1, 10)] + [1.0]

DOC_ATTRIBUTES = ("lang", "source")
LINE_ATTRIBUTES = ("c_mktsegment", "o_orderpriority")


def _is_train(key: str, fraction: str = "0.8") -> str:
    position = f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"
    return f"{position} < CAST(round({fraction} * 4294967296) AS BIGINT)"


# Test orders whose label is a limit on one feature: prediction and score equal the label.
SEPARABLE = f"""audit_lines AS (
  SELECT label, CAST(label AS DOUBLE) AS score, label AS prediction, c_mktsegment, o_orderpriority
  FROM (SELECT CASE WHEN c_nationkey < 12 THEN 1 ELSE 0 END AS label, c_mktsegment, o_orderpriority
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE NOT {_is_train('o_orderkey')}))"""

# Order lines with values that name no class; predictions and scores that are NaN are null here.
ODD = LINES.replace("audit_lines AS", "plain_lines AS") + """, audit_lines AS (
  SELECT label, CASE WHEN place IN (9, 10) THEN NULL ELSE score END AS score,
         CASE WHEN place IN (6, 7) THEN NULL WHEN place = 5 THEN CAST(0.9 AS DOUBLE) WHEN place = 8 THEN 2 ELSE prediction END AS prediction,
         c_mktsegment, o_orderpriority
  FROM (SELECT *, CAST(round(score * 49) AS INTEGER) AS place FROM plain_lines))"""


def _ratio(numerator: str, denominator: str) -> str:
    return (
        f"CASE WHEN ({denominator}) = 0 THEN CAST(0 AS DOUBLE) "
        f"ELSE CAST({numerator} AS DOUBLE) / ({denominator}) END"
    )


def _stack(view: str, attributes: Iterable[str], columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS \"group\", {columns} FROM {view}"
        for a in attributes
    )


def _counts(view: str, attributes: Iterable[str]) -> str:
    return f"""counts AS (
  SELECT attribute, "group", count(*) AS n,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE label = 1) AS positives,
         avg(CAST(prediction AS DOUBLE)) AS prediction_rate
  FROM ({_stack(view, attributes, 'label, prediction')}) GROUP BY 1, 2)"""


_RATES = f"""{_ratio('tp', 'tp + fn')} AS tpr, {_ratio('fp', 'fp + tn')} AS fpr,
  {_ratio('tn', 'tn + fp')} AS tnr, {_ratio('fn', 'fn + tp')} AS fnr,
  {_ratio('tp', 'tp + fp')} AS ppv, {_ratio('tn', 'tn + fn')} AS npv,
  {_ratio('tp + fn', 'n')} AS base_rate, {_ratio('tp + fp', 'n')} AS selection_rate,
  {_ratio('tp + tn', 'n')} AS accuracy"""


def _metrics(source: str, view: str, attributes: Iterable[str]) -> str:
    return f"""{source}, {_counts(view, attributes)},
metrics AS (SELECT attribute, "group", n, tp, fp, tn, fn, {_RATES}, positives, prediction_rate,
  {_ratio('tp', 'positives')} AS found_rate FROM counts)"""


_METRIC_COLUMNS = (
    'attribute, "group", n, tp, fp, tn, fn, tpr, fpr, tnr, fnr, ppv, npv, base_rate, selection_rate, accuracy'
)
_DOCS_LANG = _metrics(DOCS, "audit_docs", ["lang"])
_DOCS_ALL = _metrics(DOCS, "audit_docs", DOC_ATTRIBUTES)
_LINES_SEGMENT = _metrics(LINES, "audit_lines", ["c_mktsegment"])
_LINES_ALL = _metrics(LINES, "audit_lines", LINE_ATTRIBUTES)


def _gap(column: str, name: str, where: str = "true", value: str = "{}") -> str:
    shown = value.format(f"max({column}) FILTER (WHERE {where}) - min({column}) FILTER (WHERE {where})")
    return (
        f"SELECT attribute, '{name}' AS metric, {shown} AS value FROM metrics "
        f'WHERE "group" IS NOT NULL GROUP BY attribute HAVING count(*) >= 2'
    )


def _long(names: Iterable[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT attribute, \"group\", '{m}' AS metric, {m} AS value FROM metrics" for m in names
    )


def _pair(chosen: str) -> str:
    gaps = (
        "SELECT attribute, max(tpr) - min(tpr) AS t, max(selection_rate) - min(selection_rate) AS s "
        f"FROM ({chosen}) GROUP BY attribute HAVING count(*) = 2"
    )
    named = (("equalized_odds", "t"), ("demographic_parity", "s"), ("equal_opportunity", "t"))
    return " UNION ALL ".join(
        f"SELECT attribute, '{name}_disparity' AS metric, {column} AS value FROM ({gaps})"
        for name, column in named
    )


_BIN = "CASE WHEN score IS NULL OR score <= 0 THEN NULL " + " ".join(
    f"WHEN score <= CAST({edge!r} AS DOUBLE) THEN {number}" for number, edge in enumerate(EDGES, start=1)
) + " END"


def _bins(attributes: Iterable[str], include_lowest: bool = False) -> str:
    return f"""bins AS (
  SELECT attribute, "group", CAST(bin AS INTEGER) AS bin, round(avg(score), 6) AS predicted,
         round(avg(CAST(label AS DOUBLE)), 6) AS actual, count(*) AS "count"
  FROM (SELECT *, {_BIN.replace('score <= 0', 'score < 0') if include_lowest else _BIN} AS bin FROM ({_stack('audit_lines', attributes, 'label, score')}))
  WHERE bin IS NOT NULL GROUP BY 1, 2, 3)"""


def _means(attributes: Iterable[str]) -> str:
    return f"""means AS (
  SELECT attribute, "group", round(avg(score), 6) AS mean_predicted,
         round(avg(CAST(label AS DOUBLE)), 6) AS mean_actual
  FROM ({_stack('audit_lines', attributes, 'label, score')}) GROUP BY 1, 2)"""


def _report(view: str = LINES, include_lowest: bool = False) -> str:
    def rows(section: str, metric: str, value: str, table: str = "metrics", bin_number: str = "NULL") -> str:
        return (
            f"SELECT '{section}' AS section, attribute, \"group\", false AS is_disparity, "
            f"CAST({bin_number} AS INTEGER) AS bin, '{metric}' AS metric, "
            f"round(CAST({value} AS DOUBLE), 6) AS value FROM {table}"
        )

    def gaps(section: str, metric: str, column: str, where: str = "true") -> str:
        return (
            f"SELECT '{section}', attribute, NULL, true, NULL, '{metric}', value "
            f"FROM ({_gap(column, metric, where, 'round({}, 6)')})"
        )

    parts = [
        rows("demographic_parity", "prediction_rate", "prediction_rate"),
        rows("demographic_parity", "count", "n"),
        rows("equalized_odds", "true_positive_rate", "tpr"),
        rows("equalized_odds", "false_positive_rate", "fpr"),
        rows("equal_opportunity", "true_positive_rate", _ratio("tp", "positives")),
        rows("equal_opportunity", "positive_count", "positives"),
        rows("calibration", "mean_predicted", "mean_predicted", "means"),
        rows("calibration", "mean_actual", "mean_actual", "means"),
        rows("calibration", "predicted", "predicted", "bins", "bin"),
        rows("calibration", "actual", "actual", "bins", "bin"),
        rows("calibration", "count", '"count"', "bins", "bin"),
        gaps("demographic_parity", "disparity", "prediction_rate"),
        gaps("equalized_odds", "tpr_disparity", "tpr"),
        gaps("equalized_odds", "fpr_disparity", "fpr"),
        gaps("equal_opportunity", "disparity", "found_rate", "positives > 0"),
    ]
    return (
        f"WITH {_metrics(view, 'audit_lines', LINE_ATTRIBUTES)}, "
        f"{_bins(LINE_ATTRIBUTES, include_lowest)}, {_means(LINE_ATTRIBUTES)} "
        + " UNION ALL ".join(parts)
    )


def _auc(source: str) -> str:
    return f"""WITH {source},
by_score AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
             FROM scored WHERE label IN (0, 1) AND score IS NOT NULL GROUP BY score),
ranked AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM by_score)
SELECT round(sum(CAST(pos AS DOUBLE) * (below + CAST(neg AS DOUBLE) / 2))
             / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 9) AS auc FROM ranked"""


_AUC_LINES = _auc(f"{LINES}, scored AS (SELECT label, score FROM audit_lines)")


def _class_table(view: str) -> str:
    return f"""per_class AS (
  SELECT class, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(actual) AS BIGINT) AS actual,
         CAST(sum(predicted) AS BIGINT) AS predicted
  FROM (SELECT label AS class, CASE WHEN label = prediction THEN 1 ELSE 0 END AS tp, 1 AS actual, 0 AS predicted
        FROM {view} WHERE label IS NOT NULL AND prediction IS NOT NULL
        UNION ALL
        SELECT prediction, 0, 0, 1 FROM {view} WHERE label IS NOT NULL AND prediction IS NOT NULL)
  GROUP BY class),
rated AS (SELECT *, {_ratio('tp', 'predicted')} AS precision, {_ratio('tp', 'actual')} AS recall FROM per_class),
class_metrics AS (SELECT *, {_ratio('2 * precision * recall', 'precision + recall')} AS f1 FROM rated)"""


_STATS_ORDERS = f"""src AS (
  SELECT o_orderkey, o_totalprice, c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_mktsegment,
         o_orderpriority, CASE WHEN {_is_train('o_orderkey')} THEN 'train' ELSE 'test' END AS split
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _index(column: str) -> str:
    return (
        f"idx_{column} AS (SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 "
        f"AS DOUBLE) AS i_{column} FROM src WHERE split = 'train' GROUP BY {column})"
    )


def _feature_set() -> str:
    numeric = ["o_totalprice", "c_acctbal", "c_nationkey"]
    categorical = ["c_mktsegment", "o_orderpriority"]
    inputs = numeric + [f"i_{c}" for c in categorical]
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in inputs)
    shown = ", ".join(
        f"round(({c} - m_{c}) / s_{c}, 6) AS f_{name}" for c, name in zip(inputs, numeric + categorical)
    )
    return f"""WITH {_STATS_ORDERS}, {_index('c_mktsegment')}, {_index('o_orderpriority')},
indexed AS (SELECT src.*, i_c_mktsegment, i_o_orderpriority FROM src
            JOIN idx_c_mktsegment USING (c_mktsegment) JOIN idx_o_orderpriority USING (o_orderpriority)),
stats AS (SELECT {stats} FROM indexed WHERE split = 'train')
SELECT o_orderkey, split, {shown} FROM indexed, stats"""


def _histogram() -> str:
    return """WITH bounds AS (SELECT CAST(min(n_chars) AS DOUBLE) AS lo, CAST(max(n_chars) AS DOUBLE) AS hi FROM documents),
widths AS (SELECT lo, (hi - lo) / CAST(30 AS DOUBLE) AS w FROM bounds),
binned AS (SELECT CAST(least(floor((CAST(n_chars AS DOUBLE) - lo) / w), 29) AS INTEGER) AS bin, lo, w
           FROM documents, widths)
SELECT bin, lo + bin * w AS lower, lo + (bin + 1) * w AS upper, count(*) AS n
FROM binned GROUP BY bin, lo, w"""


def oracle_sql() -> dict[str, str]:
    """SQL per query key. The text uses only the given tables."""
    flag = "CAST(CASE WHEN {} THEN 1 ELSE 0 END AS DOUBLE)".format
    split_orders = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"
    sql = {
        "csv_round_trip": "SELECT * FROM customer",
        "csv_inferred_types": """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey,
            c_acctbal, c_mktsegment FROM customer""",
        "csv_duplicate_header": "SELECT c_custkey, c_acctbal, c_name FROM customer",
        "parquet_round_trip": "SELECT * FROM orders",
        "predictions_csv_round_trip": f"""WITH {DOCS}
            SELECT a.doc_id, a.label, a.prediction, a.lang,
                   CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 1000) AS positive_probability
            FROM audit_docs a JOIN documents d ON a.doc_id = d.doc_id""",
        "vector_to_text": """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_values,
            round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
        "sample_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
        "column_report": """
            SELECT 'o_orderkey' AS "column", true AS required, true AS present, 'bigint' AS type,
                   count(o_orderkey) AS n_values FROM orders
            UNION ALL SELECT 'o_orderstatus', true, true, 'string', count(o_orderstatus) FROM orders
            UNION ALL SELECT 'o_totalprice', false, true, 'double', count(o_totalprice) FROM orders
            UNION ALL SELECT 'o_comment', false, false, NULL, 0""",
        "table_profile": """SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
            CAST(6 AS INTEGER) AS columns FROM orders""",
        "select_available": "SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders",
        "rename_near_match": "SELECT o_orderkey, o_totalprice AS price FROM orders",
        "require_not_null": f"SELECT * FROM ({DOCS_LABELS}) WHERE quality IS NOT NULL AND toxic IS NOT NULL",
        "fill_null_zero": f"""SELECT doc_id, n_chars, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
            FROM ({DOCS_LABELS})""",
        "try_int": """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
            TRY_CAST(o_orderpriority AS INTEGER) AS no_number FROM orders""",
        "collapse_categories": """SELECT c_custkey, c_mktsegment,
            CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE 'Other' END AS segment_group
            FROM customer""",
        "band_numeric": """SELECT p_partkey, p_size,
            CASE WHEN p_size < 15 THEN 'Small' WHEN p_size < 35 THEN 'Medium' ELSE 'Large' END AS size_band
            FROM part""",
        "polynomial_features": """SELECT p_partkey, CAST(p_size AS BIGINT) * p_size AS size_squared,
            CAST(p_size AS DOUBLE) * p_size * p_size AS size_cubed FROM part""",
        "threshold_flags": f"""SELECT l_orderkey, l_linenumber, {flag('l_quantity < 10')} AS is_small,
            {flag('l_quantity >= 40')} AS is_large, {flag('l_quantity >= 10 AND l_quantity < 25')} AS is_medium,
            {flag('l_discount > 0')} AS has_discount,
            {flag('l_quantity >= 40 AND l_discount > CAST(0.05 AS DOUBLE)')} AS large_and_discounted
            FROM lineitem""",
        "row_sum_interactions": """SELECT l_orderkey, l_linenumber, l_quantity + l_discount + l_tax AS total,
            l_extendedprice * l_discount AS price_discount,
            CAST(l_linenumber AS BIGINT) * l_linenumber AS number_squared FROM lineitem""",
        "class_filter": "SELECT * FROM labels WHERE quality = 1",
        "string_index": """WITH idx AS (SELECT c_mktsegment,
              CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS i
              FROM customer GROUP BY c_mktsegment)
            SELECT c_custkey, c_mktsegment, i AS c_mktsegment_indexed FROM customer JOIN idx USING (c_mktsegment)""",
        "assemble_skip": f"""SELECT doc_id, CAST(n_chars AS DOUBLE) AS f_n_chars, CAST(quality AS DOUBLE) AS f_quality,
            CAST(toxic AS DOUBLE) AS f_toxic FROM ({DOCS_LABELS})
            WHERE n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""",
        "assembly_report": f"""SELECT
            count(*) FILTER (WHERE n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL) AS kept,
            count(*) FILTER (WHERE n_chars IS NULL OR quality IS NULL OR toxic IS NULL) AS dropped
            FROM ({DOCS_LABELS})""",
        "standardize": """SELECT c_custkey, c_acctbal, round((c_acctbal - m) / s, 6) AS scaled
            FROM customer, (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer)""",
        "feature_set": _feature_set(),
        "stratified_split": f"""SELECT o_orderkey, {split_orders} AS label,
            CASE WHEN {_is_train('o_orderkey', "CASE WHEN o_orderstatus = 'F' THEN 0.9 ELSE 0.8 END")}
                 THEN 'train' ELSE 'test' END AS split FROM orders""",
        "union_all": f"SELECT o_orderkey, {split_orders} AS label FROM orders",
        "model_save_load": f"""SELECT count(*) AS scored, CAST(0 AS BIGINT) AS different
            FROM orders JOIN customer ON o_custkey = c_custkey WHERE NOT {_is_train('o_orderkey')}""",
        "rf_train_score": f"""SELECT o_orderkey, CASE WHEN c_nationkey < 12 THEN 1 ELSE 0 END AS label,
            CAST(CASE WHEN c_nationkey < 12 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
            CAST(CASE WHEN c_nationkey < 12 THEN 1 ELSE 0 END AS DOUBLE) AS score
            FROM orders JOIN customer ON o_custkey = c_custkey WHERE NOT {_is_train('o_orderkey')}""",
        "logreg_train_score": f"""WITH src AS (SELECT o_orderkey, {split_orders} AS label,
              {_is_train('o_orderkey')} AS train FROM orders JOIN customer ON o_custkey = c_custkey)
            SELECT o_orderkey, label, (SELECT round(avg(CAST(label AS DOUBLE)), 6) FROM src WHERE train) AS mean_training_score,
                   true AS is_probability, true AS prediction_fits FROM src WHERE NOT train""",
        "logreg_cell_scores": f"""WITH src AS (SELECT o_orderkey, {split_orders} AS label, {_is_train('o_orderkey')} AS train,
              o_totalprice > 150000 AS dear, c_acctbal > 4000 AS rich FROM orders JOIN customer ON o_custkey = c_custkey),
            cells AS (SELECT dear, rich, avg(CAST(label AS DOUBLE)) AS score FROM src WHERE train GROUP BY 1, 2)
            SELECT o_orderkey, label, CAST(CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, round(score, 5) AS score
            FROM src JOIN cells USING (dear, rich) WHERE NOT train""",
        "top_k_importance": """SELECT unnest(['c_nationkey', 'c_acctbal', 'c_mktsegment_indexed']) AS feature,
            unnest([CAST(1 AS DOUBLE), 0, 0]) AS importance""",
        "train_and_audit": _report(SEPARABLE),
        "auc": _AUC_LINES,
        "auc_many_scores": _auc(
            "scored AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, "
            "l_extendedprice AS score FROM lineitem)"
        ),
        "classification_metrics": f"""WITH {LINES}, {_class_table('audit_lines')}
            SELECT round(CAST(sum(tp) AS DOUBLE) / sum(actual), 9) AS accuracy,
                   round(sum(precision * actual) / sum(actual), 9) AS precision,
                   round(sum(recall * actual) / sum(actual), 9) AS recall,
                   round(sum(f1 * actual) / sum(actual), 9) AS f1_score,
                   round(max(precision) FILTER (WHERE class = 1), 9) AS positive_precision,
                   round(max(recall) FILTER (WHERE class = 1), 9) AS positive_recall,
                   round(max(f1) FILTER (WHERE class = 1), 9) AS positive_f1,
                   (SELECT auc FROM ({_AUC_LINES})) AS auc
            FROM class_metrics""",
        "auc_nan_scores": _auc(f"{ODD}, scored AS (SELECT label, score FROM audit_lines)"),
        "class_metrics_odd_values": f"""WITH {ODD}, whole AS (SELECT * REPLACE (CAST(prediction AS INTEGER) AS prediction) FROM audit_lines WHERE prediction = floor(prediction)),
            {_class_table('whole')}
            SELECT class, tp, actual, predicted, precision, recall, round(f1, 9) AS f1 FROM class_metrics""",
        "calibration_means_nan_scores": f"WITH {ODD}, {_means(LINE_ATTRIBUTES)} SELECT * FROM means",
        "bias_report_nan_scores": _report(ODD, include_lowest=True),
        "class_metrics": f"""WITH {DOCS}, {_class_table('audit_docs')}
            SELECT class, tp, actual, predicted, precision, recall, round(f1, 9) AS f1 FROM class_metrics""",
        "confusion_counts": f"""WITH {DOCS}, classes AS (SELECT unnest([0, 1, 2]) AS c)
            SELECT a.c AS label, b.c AS prediction, count(d.doc_id) AS n
            FROM classes a CROSS JOIN classes b
            LEFT JOIN audit_docs d ON d.label = a.c AND d.prediction = b.c GROUP BY 1, 2""",
        "confusion_matrix": f"""WITH {DOCS}, classes AS (SELECT unnest([0, 1]) AS c)
            SELECT c AS label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
                   count(*) FILTER (WHERE prediction = 1) AS predicted_1
            FROM classes LEFT JOIN audit_docs ON label = c GROUP BY c""",
        "summary_stats": f"""WITH {DOCS} SELECT count(*) AS total_records,
            CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / count(*) AS positive_rate FROM audit_docs""",
        "distribution": f"""WITH {DOCS}
            SELECT 'lang' AS attribute, lang AS value, count(*) AS n FROM audit_docs GROUP BY lang
            UNION ALL SELECT 'source', source, count(*) FROM audit_docs GROUP BY source""",
        "distinct_groups": f"WITH {DOCS} SELECT DISTINCT source FROM audit_docs",
        "share_of_total": """SELECT c_mktsegment, count(*) AS n,
            round(CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM customer), 6) AS percent
            FROM customer GROUP BY c_mktsegment""",
        "share_of_named": """SELECT v AS c_mktsegment, count(c_custkey) AS n,
            round(CAST(100 AS DOUBLE) * count(c_custkey) / (SELECT count(*) FROM customer), 6) AS percent
            FROM (SELECT unnest(['BUILDING', 'NO SUCH SEGMENT']) AS v) LEFT JOIN customer ON c_mktsegment = v
            GROUP BY v""",
        "group_label_counts": f"WITH {DOCS} SELECT lang, label, count(*) AS n FROM audit_docs GROUP BY 1, 2",
        "group_label_pivot": f"""WITH {DOCS} SELECT source, count(*) FILTER (WHERE label = 0) AS n_0,
            count(*) FILTER (WHERE label = 1) AS n_1 FROM audit_docs GROUP BY source""",
        "rate_by_group": f"""WITH {LINES}, c AS (SELECT c_mktsegment, count(*) FILTER (WHERE label = 0) AS n_0,
              count(*) FILTER (WHERE label = 1) AS n_1 FROM audit_lines GROUP BY c_mktsegment)
            SELECT *, CAST(n_1 AS DOUBLE) / nullif(n_0 + n_1, 0) AS rate FROM c""",
        "histogram": _histogram(),
        "group_metrics": f"WITH {_DOCS_LANG} SELECT {_METRIC_COLUMNS} FROM metrics",
        "group_metrics_lines": f"WITH {_LINES_SEGMENT} SELECT {_METRIC_COLUMNS} FROM metrics",
        "multi_attribute_metrics": f"WITH {_LINES_ALL} SELECT {_METRIC_COLUMNS} FROM metrics",
        "multi_attribute_combined": f"WITH {_LINES_ALL} SELECT {_METRIC_COLUMNS} FROM metrics",
        "comparison_table": f'WITH {_DOCS_LANG} SELECT attribute, "group", tpr, fpr, ppv, accuracy FROM metrics',
        "metrics_long": f"WITH {_DOCS_LANG} {_long(('tpr', 'fpr', 'ppv', 'accuracy'))}",
        "pair_disparity": f"""WITH {_LINES_SEGMENT}
            {_pair('''SELECT * FROM metrics WHERE "group" IN ('BUILDING', 'MACHINERY')''')}""",
        "pair_disparity_largest": f"""WITH {_DOCS_ALL} {_pair('''SELECT * FROM metrics QUALIFY
            row_number() OVER (PARTITION BY attribute ORDER BY n DESC, "group") <= 2''')}""",
        "demographic_parity": f"""WITH {_LINES_ALL} SELECT attribute, "group",
            round(prediction_rate, 6) AS prediction_rate, n AS "count" FROM metrics""",
        "parity_disparity": f"""WITH {_LINES_ALL}
            {_gap('prediction_rate', 'demographic_parity_disparity', value='round({}, 6)')}""",
        "equalized_odds": f"""WITH {_DOCS_ALL} SELECT attribute, "group", tpr AS true_positive_rate,
            fpr AS false_positive_rate FROM metrics""",
        "odds_disparity": f"""WITH {_DOCS_ALL} {_gap('tpr', 'tpr_disparity')}
            UNION ALL {_gap('fpr', 'fpr_disparity')}""",
        "equal_opportunity": f"""WITH {_DOCS_ALL} SELECT attribute, "group",
            {_ratio('tp', 'positives')} AS true_positive_rate, positives AS positive_count FROM metrics""",
        "opportunity_disparity": f"""WITH {_DOCS_ALL} SELECT * FROM
            ({_gap('tpr', 'equal_opportunity_disparity', 'positives > 0')}) WHERE value IS NOT NULL""",
        "severity_bands": f"""SELECT attribute, metric, value, CASE WHEN value > CAST(0.1 AS DOUBLE) THEN 'high'
            WHEN value >= CAST(0.05 AS DOUBLE) THEN 'medium' ELSE 'low' END AS severity FROM (
              SELECT * FROM (WITH {_DOCS_ALL} {_gap('tpr', 'tpr_disparity')}
                UNION ALL {_gap('fpr', 'fpr_disparity')})
              UNION ALL
              SELECT * FROM (WITH {_LINES_ALL} {_gap('tpr', 'tpr_disparity')}
                UNION ALL {_gap('fpr', 'fpr_disparity')}))""",
        "score_extract": """SELECT vec_id, CAST(CASE WHEN len(embedding) > 1 THEN embedding[2]
            ELSE embedding[1] END AS DOUBLE) AS score FROM embeddings""",
        "calibration_bins": f"WITH {LINES}, {_bins(['c_mktsegment'])} SELECT * FROM bins",
        "calibration_curves": f"""WITH {LINES}, {_bins(['c_mktsegment'])} SELECT attribute, "group",
            CAST(row_number() OVER (PARTITION BY attribute, "group" ORDER BY bin) AS INTEGER) AS position,
            bin, predicted, actual, "count" FROM bins""",
        "calibration_means": f"WITH {LINES}, {_means(LINE_ATTRIBUTES)} SELECT * FROM means",
        "bias_report": _report(),
        "bias_report_combined": _report(),
    }
    return sql | state_oracles.oracle_sql(_report())
