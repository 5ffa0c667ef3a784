"""Group fairness: confusion counts per protected group and everything derived from them.

Each operator is one scan, combined per group before the shuffle, so its shuffle
carries one row per (task, group) however large or uneven the groups are. Rates,
disparities and reports are computed from those few rows. Results have one row per
(attribute, group), with the group as text.

Shared rules. A label or prediction that is null or neither 0 nor 1 counts towards
``n`` and nothing else. A ratio over nothing is 0. A null attribute is a group of its
own in group tables and, unless ``null_group="include"``, left out of disparities.
An attribute with fewer than two groups has no disparity row.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parityscope.functions.ratios import safe_ratio
from parityscope.functions.scores import score_bin, usable_score
from parityscope.roles import AuditRoles, require_columns

_KEYS = ("attribute", "group")

# Names of the values carried beside the attributes, chosen not to clash with them.
_Y, _YHAT, _SCORE, _BIN, _N, _SCORED = "__y", "__yhat", "__score", "__bin", "__n", "__scored"
#: Columns of a cell, under the names they are carried by and those they are returned by.
CELL_NAMES = {_Y: "label", _YHAT: "prediction", _BIN: "bin", _N: "n", _SCORE: "score_sum", _SCORED: "scored"}

# Limits and names of the severity bands.
HIGH_ABOVE = 0.1
MEDIUM_FROM = 0.05


def not_nan(value: Column) -> Column:
    """The value, null if it is NaN."""
    return F.when(~F.isnan(value), value)


def stacked_attributes(df: DataFrame, roles: AuditRoles, values: Mapping[str, Column]) -> DataFrame:
    """``attribute, group`` and the given values, one row per input row and attribute.

    The names of the values must differ from those of the attributes.
    """
    if not roles.attributes:
        raise ValueError("the roles name no protected attribute")
    carried = [column.alias(name) for name, column in values.items()]
    if len(roles.attributes) == 1:
        (only,) = roles.attributes
        return df.select(F.lit(only).alias("attribute"), F.col(only).cast("string").alias("group"), *carried)
    texts = [F.col(a).cast("string").alias(a) for a in roles.attributes]
    return df.select(*texts, *carried).unpivot(list(values), list(roles.attributes), "attribute", "group")


def _confusion_aggregates(weight: str | None = None) -> list[Column]:
    """n, tp, fp, tn, fn over label and prediction, rows counted or weighted."""

    def count(condition: Column) -> Column:
        if weight is None:
            return F.count_if(condition)
        return F.sum(F.when(condition, F.col(weight)).otherwise(0))

    y, yhat = F.col(_Y), F.col(_YHAT)
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return [
        total.alias("n"),
        count((y == 1) & (yhat == 1)).alias("tp"),
        count((y == 0) & (yhat == 1)).alias("fp"),
        count((y == 0) & (yhat == 0)).alias("tn"),
        count((y == 1) & (yhat == 0)).alias("fn"),
    ]


def _combinations(df: DataFrame, roles: AuditRoles, keys: Mapping[str, Column], sums: Mapping[str, Column]) -> DataFrame:
    """Rows per combination of all attributes and the keys, as ``__n``, and sums per combination."""
    attributes = [F.col(a).cast("string").alias(a) for a in roles.attributes]
    return (
        df.select(*attributes, *[c.alias(n) for n, c in {**keys, **sums}.items()])
        .groupBy(*roles.attributes, *keys)
        .agg(F.count(F.lit(1)).alias(_N), *[F.sum(name).alias(name) for name in sums])
    )


def confusion_by_group(df: DataFrame, roles: AuditRoles, pre_aggregate: bool = False) -> DataFrame:
    """``attribute, group, n, tp, fp, tn, fn`` for all protected attributes in one scan.

    By default every row is stacked once per attribute on its way into the aggregate;
    only combined rows are shuffled. ``pre_aggregate`` counts the combinations of all
    attributes first and stacks those instead: less work per row when the attributes
    have few combinations, a larger shuffle when they have many.
    """
    require_columns(df, [roles.label, roles.prediction, *roles.attributes])
    outcome = {_Y: F.col(roles.label), _YHAT: F.col(roles.prediction)}
    if not pre_aggregate:
        return stacked_attributes(df, roles, outcome).groupBy(*_KEYS).agg(*_confusion_aggregates())
    combined = _combinations(df, roles, outcome, {})
    stacked = stacked_attributes(combined, roles, {c: F.col(c) for c in (_Y, _YHAT, _N)})
    return stacked.groupBy(*_KEYS).agg(*_confusion_aggregates(_N))


def group_metrics(df: DataFrame, roles: AuditRoles, pre_aggregate: bool = False) -> DataFrame:
    """Counts and the nine rates per protected group.

    ``selection_rate`` and ``base_rate`` divide by all rows of the group.
    """
    return _with_rates(confusion_by_group(df, roles, pre_aggregate))


def _with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    return counts.select(
        "*",
        safe_ratio(tp, tp + fn).alias("tpr"),
        safe_ratio(fp, fp + tn).alias("fpr"),
        safe_ratio(tn, tn + fp).alias("tnr"),
        safe_ratio(fn, fn + tp).alias("fnr"),
        safe_ratio(tp, tp + fp).alias("ppv"),
        safe_ratio(tn, tn + fn).alias("npv"),
        safe_ratio(tp + fn, n).alias("base_rate"),
        safe_ratio(tp + fp, n).alias("selection_rate"),
        safe_ratio(tp + tn, n).alias("accuracy"),
    )


def intersections(df: DataFrame, roles: AuditRoles, depth: int = 2, least: int = 1) -> DataFrame:
    """``group_metrics`` of every combination of values of up to ``depth`` attributes that at
    least ``least`` rows have.

    ``attribute`` joins the names of the attributes with `` & ``, in the order of the roles;
    ``group`` is a JSON array of their values, in which a null attribute is null.

    The table is read once, into counts per combination of all attributes. Sets of ``k``
    attributes are counted only where all their sets of ``k - 1`` had enough rows: as rows
    of a set are rows of each smaller set, nothing that has ``least`` rows is left out.
    """
    require_columns(df, [roles.label, roles.prediction, *roles.attributes])
    if not 1 <= depth <= len(roles.attributes):
        raise ValueError("depth must lie between 1 and the number of attributes")
    combined = _combinations(df, roles, {_Y: F.col(roles.label), _YHAT: F.col(roles.prediction)}, {})
    found, kept = [], {}
    for size in range(1, depth + 1):
        for names in itertools.combinations(roles.attributes, size):
            rows = combined
            for smaller in itertools.combinations(names, size - 1):
                if smaller:
                    enough = kept[smaller].select(*[F.col(a).alias(f"__{a}") for a in smaller])
                    same = [F.col(a).eqNullSafe(F.col(f"__{a}")) for a in smaller]
                    rows = rows.join(enough, reduce(and_, same), "left_semi")
            counts = rows.groupBy(*names).agg(*_confusion_aggregates(_N)).filter(F.col("n") >= least)
            kept[names] = counts
            group = F.to_json(F.array(*[F.col(a) for a in names]), {"ignoreNullFields": "false"})
            found.append(counts.select(F.lit(" & ".join(names)).alias("attribute"), group.alias("group"), "n", "tp", "fp", "tn", "fn"))
    return _with_rates(reduce(DataFrame.unionAll, found))


def comparison_table(metrics: DataFrame) -> DataFrame:
    """``attribute, group, tpr, fpr, ppv, accuracy`` of a ``group_metrics`` table."""
    return metrics.select(*_KEYS, "tpr", "fpr", "ppv", "accuracy")


def metrics_long(metrics: DataFrame, names: Sequence[str] = ("tpr", "fpr", "ppv", "accuracy")) -> DataFrame:
    """Group metrics in long form: ``attribute, group, metric, value``."""
    return metrics.unpivot(list(_KEYS), list(names), "metric", "value")


def demographic_parity(df: DataFrame, roles: AuditRoles) -> DataFrame:
    """``attribute, group, prediction_rate, count``.

    The rate is the mean of the predictions that are there, neither null nor NaN; the count
    is of all rows.
    """
    stacked = stacked_attributes(df, roles, {_YHAT: not_nan(F.col(roles.prediction))})
    return stacked.groupBy(*_KEYS).agg(
        F.avg(_YHAT).alias("prediction_rate"), F.count(F.lit(1)).alias("count")
    )


def equalized_odds(df: DataFrame, roles: AuditRoles) -> DataFrame:
    """``attribute, group, true_positive_rate, false_positive_rate``."""
    return group_metrics(df, roles).select(
        *_KEYS, F.col("tpr").alias("true_positive_rate"), F.col("fpr").alias("false_positive_rate")
    )


def equal_opportunity(df: DataFrame, roles: AuditRoles) -> DataFrame:
    """``attribute, group, true_positive_rate, positive_count``.

    The rate divides by all positives of the group, also those without a prediction.
    """
    stacked = stacked_attributes(df, roles, {_Y: F.col(roles.label), _YHAT: F.col(roles.prediction)})
    positive = F.col(_Y) == 1
    counts = stacked.groupBy(*_KEYS).agg(
        F.count_if(positive).alias("positive_count"),
        F.count_if(positive & (F.col(_YHAT) == 1)).alias("found"),
    )
    return counts.select(
        *_KEYS,
        safe_ratio(F.col("found"), F.col("positive_count")).alias("true_positive_rate"),
        "positive_count",
    )


def _check_null_group(null_group: str) -> None:
    if null_group not in ("exclude", "include"):
        raise ValueError("null_group must be 'exclude' or 'include'")


def disparity(
    groups: DataFrame,
    metrics: Mapping[str, str],
    eligible: Column | None = None,
    null_group: str = "exclude",
    by: Sequence[str] = (),
) -> DataFrame:
    """Largest minus smallest value over the groups of each attribute, and of ``by``.

    ``metrics`` maps a column of the group table to the name reported. Only groups
    meeting ``eligible`` enter, but the rule of two groups counts all of them. Groups
    whose value is null are passed over; with none left there is no row.
    Returns ``attribute``, the columns of ``by``, ``metric, value``.
    """
    _check_null_group(null_group)
    named = groups if null_group == "include" else groups.filter(F.col("group").isNotNull())
    gate = F.lit(True) if eligible is None else eligible
    gaps = named.groupBy("attribute", *by).agg(
        F.count(F.lit(1)).alias("__groups"),
        *[
            (F.max(F.when(gate, F.col(c))) - F.min(F.when(gate, F.col(c)))).alias(name)
            for c, name in metrics.items()
        ],
    )
    return (
        gaps.filter(F.col("__groups") >= 2)
        .unpivot(["attribute", *by], list(metrics.values()), "metric", "value")
        .filter(F.col("value").isNotNull())
    )


def parity_disparity(df: DataFrame, roles: AuditRoles, null_group: str = "exclude") -> DataFrame:
    """Gap in mean prediction between the groups of each attribute."""
    groups = demographic_parity(df, roles)
    return disparity(groups, {"prediction_rate": "demographic_parity_disparity"}, null_group=null_group)


def odds_disparity(df: DataFrame, roles: AuditRoles, null_group: str = "exclude") -> DataFrame:
    """Gaps in true and false positive rate; a group without positives or negatives enters as 0."""
    gaps = {"true_positive_rate": "tpr_disparity", "false_positive_rate": "fpr_disparity"}
    return disparity(equalized_odds(df, roles), gaps, null_group=null_group)


def opportunity_disparity(df: DataFrame, roles: AuditRoles, null_group: str = "exclude") -> DataFrame:
    """Gap in true positive rate over the groups that have positives."""
    return disparity(
        equal_opportunity(df, roles),
        {"true_positive_rate": "equal_opportunity_disparity"},
        eligible=F.col("positive_count") > 0,
        null_group=null_group,
    )


def pair_disparity(
    metrics: DataFrame, pair: tuple[str, str] | None = None, null_group: str = "exclude"
) -> DataFrame:
    """Absolute differences between two groups of a ``group_metrics`` table.

    Without ``pair``, the two largest groups of each attribute are compared, equal
    sizes taken by name. An attribute lacking either group has no rows.
    Returns ``attribute, metric, value`` with the true positive rate gap under both
    its names and the selection rate gap.
    """
    _check_null_group(null_group)
    named = metrics if null_group == "include" else metrics.filter(F.col("group").isNotNull())
    if pair is not None:
        chosen = named.filter(F.col("group").isin(*pair))
    else:
        by_size = Window.partitionBy("attribute").orderBy(F.desc("n"), F.asc_nulls_last("group"))
        chosen = named.withColumn("__rank", F.row_number().over(by_size)).filter(F.col("__rank") <= 2)
    gaps = chosen.groupBy("attribute").agg(
        F.count(F.lit(1)).alias("__groups"),
        (F.max("tpr") - F.min("tpr")).alias("tpr_gap"),
        (F.max("selection_rate") - F.min("selection_rate")).alias("selection_gap"),
    )
    named_gaps = gaps.filter(F.col("__groups") == 2).select(
        "attribute",
        F.col("tpr_gap").alias("equalized_odds_disparity"),
        F.col("selection_gap").alias("demographic_parity_disparity"),
        F.col("tpr_gap").alias("equal_opportunity_disparity"),
    )
    return named_gaps.unpivot(["attribute"], named_gaps.columns[1:], "metric", "value")


def severity(disparities: DataFrame, value: str = "value", output: str = "severity") -> DataFrame:
    """Add the severity of each disparity: above 0.1 high, from 0.05 medium, below low."""
    size = F.col(value)
    level = F.when(size > HIGH_ABOVE, "high").when(size >= MEDIUM_FROM, "medium").when(size.isNotNull(), "low")
    return disparities.withColumn(output, level)


def _need_score(roles: AuditRoles) -> str:
    if roles.score is None:
        raise ValueError("the roles name no score column")
    return roles.score


def calibration_bins(
    df: DataFrame, roles: AuditRoles, bins: int = 10, include_lowest: bool = False
) -> DataFrame:
    """Mean score and mean label per group and score bin: ``attribute, group, bin, predicted, actual, count``.

    Bins are right-closed; a score of 0 is in none unless ``include_lowest``. Empty
    bins have no row.
    """
    values = {_SCORE: usable_score(df, _need_score(roles)), _Y: F.col(roles.label)}
    binned = stacked_attributes(df, roles, values).withColumn("bin", score_bin(F.col(_SCORE), bins, include_lowest))
    return (
        binned.filter(F.col("bin").isNotNull())
        .groupBy(*_KEYS, "bin")
        .agg(F.avg(_SCORE).alias("predicted"), F.avg(_Y).alias("actual"), F.count(F.lit(1)).alias("count"))
    )


def calibration_curves(
    df: DataFrame, roles: AuditRoles, bins: int = 10, include_lowest: bool = False
) -> DataFrame:
    """The rows of ``calibration_bins`` as one array of at most ``bins`` structs per group."""
    points = F.sort_array(F.collect_list(F.struct("bin", "predicted", "actual", "count")))
    return calibration_bins(df, roles, bins, include_lowest).groupBy(*_KEYS).agg(points.alias("calibration_data"))


def calibration_means(df: DataFrame, roles: AuditRoles) -> DataFrame:
    """``attribute, group, mean_predicted, mean_actual`` over all rows, scores of 0 included.

    A NaN score is passed over like a null one.
    """
    values = {_SCORE: usable_score(df, _need_score(roles)), _Y: F.col(roles.label)}
    return stacked_attributes(df, roles, values).groupBy(*_KEYS).agg(
        F.avg(_SCORE).alias("mean_predicted"), F.avg(_Y).alias("mean_actual")
    )


def bias_report(
    df: DataFrame,
    roles: AuditRoles,
    bins: int = 10,
    null_group: str = "exclude",
    pre_aggregate: bool = False,
    include_lowest: bool = False,
) -> DataFrame:
    """Parity, odds, opportunity and, when the roles name a score, calibration, in long form.

    Returns ``section, attribute, group, is_disparity, bin, metric, value``. Disparity
    rows have a null group and ``is_disparity`` set, so that they cannot be taken for the
    row of a null group.

    The data is read once, into the cells of ``audit_cells``; cells are combined per bin,
    bins per group, and groups per attribute. ``pre_aggregate`` is as in
    ``confusion_by_group``, ``include_lowest`` as in ``calibration_bins``.
    """
    _check_null_group(null_group)
    return report_from_cells(audit_cells(df, roles, bins, pre_aggregate, include_lowest), null_group)


def audit_cells(
    df: DataFrame,
    roles: AuditRoles,
    bins: int = 10,
    pre_aggregate: bool = False,
    include_lowest: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Rows counted per cell: ``attribute, group, label, prediction`` and, when the roles name
    a score, ``bin``; ``n`` rows, of which ``scored`` have a score, with the sum ``score_sum``.

    Labels and predictions are classes, so there are few cells. Everything a report says
    follows from them. With ``exact`` sums are decimals of 18 places, so that cells added and
    taken back in any order are the same to the last digit.
    """
    require_columns(df, [c for c in roles.columns() if c != roles.id])
    keys = {_Y: F.col(roles.label), _YHAT: F.col(roles.prediction)}
    sums = {}
    if roles.score is not None:
        score = usable_score(df, roles.score)
        keys[_BIN] = score_bin(score, bins, include_lowest)
        amount = score.cast("decimal(38,18)") if exact else score
        sums = {_SCORE: amount, _SCORED: F.when(score.isNotNull(), 1).otherwise(0)}
    if pre_aggregate:
        rows = _combinations(df, roles, keys, sums)
        stacked = stacked_attributes(rows, roles, {c: F.col(c) for c in (*keys, *sums, _N)})
    else:
        stacked = stacked_attributes(df, roles, {**keys, **sums, _N: F.lit(1)})
    cells = stacked.groupBy(*_KEYS, *keys).agg(*[F.sum(c).alias(c) for c in (_N, *sums)])
    return cells.withColumnsRenamed({hidden: shown for hidden, shown in CELL_NAMES.items() if hidden in cells.columns})


def report_from_cells(cells: DataFrame, null_group: str = "exclude") -> DataFrame:
    """The report of ``bias_report`` from the cells that ``audit_cells`` counts."""
    _check_null_group(null_group)
    cells = cells.withColumnsRenamed({shown: hidden for hidden, shown in CELL_NAMES.items()})
    has_score = _BIN in cells.columns
    sums = [_SCORE, _SCORED] if has_score else []

    y, yhat, n = (not_nan(F.col(c).cast("double")) for c in (_Y, _YHAT, _N))
    totals = [
        *_confusion_aggregates(_N),
        F.sum(F.when(y == 1, n).otherwise(0)).alias("positives"),
        F.sum(yhat * n).alias("yhat_sum"),
        F.sum(F.when(yhat.isNotNull(), n).otherwise(0)).alias("yhat_n"),
        F.sum(y * n).alias("y_sum"),
        F.sum(F.when(y.isNotNull(), n).otherwise(0)).alias("y_n"),
        *[F.sum(c).alias(c) for c in sums],
    ]
    mean_score = F.try_divide(F.col(_SCORE).cast("double"), F.col(_SCORED))
    mean_label = F.try_divide(F.col("y_sum"), F.col("y_n"))
    curve = []
    if has_score:
        per_bin = cells.groupBy(*_KEYS, _BIN).agg(*totals)
        at_bin = F.struct(
            F.col(_BIN).alias("bin"),
            mean_score.alias("predicted"),
            mean_label.alias("actual"),
            F.col("n").alias("count"),
        )
        per_group = per_bin.groupBy(*_KEYS).agg(
            *[F.sum(c).alias(c) for c in per_bin.columns if c not in (*_KEYS, _BIN)],
            F.collect_list(F.when(F.col(_BIN).isNotNull(), at_bin)).alias("curve"),
        )
        per_group = per_group.withColumns({"mean_predicted": mean_score, "mean_actual": mean_label})
        curve = [F.first(c).alias(c) for c in ("curve", "mean_predicted", "mean_actual")]
    else:
        per_group = cells.groupBy(*_KEYS).agg(*totals)

    rates = per_group.withColumns(
        {
            "prediction_rate": F.try_divide(F.col("yhat_sum"), F.col("yhat_n")),
            "tpr": safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")),
            "fpr": safe_ratio(F.col("fp"), F.col("fp") + F.col("tn")),
            "found_rate": safe_ratio(F.col("tp"), F.col("positives")),
            "counted": F.lit(True) if null_group == "include" else F.col("group").isNotNull(),
        }
    )

    # Each group row is also counted towards its attribute: one level holds the groups,
    # the other the attributes, and on the group level every maximum is the group's own.
    counted = F.col("counted")
    gap = {
        "demographic_parity_disparity": F.when(counted, F.col("prediction_rate")),
        "tpr_disparity": F.when(counted, F.col("tpr")),
        "fpr_disparity": F.when(counted, F.col("fpr")),
        "equal_opportunity_disparity": F.when(counted & (F.col("positives") > 0), F.col("found_rate")),
    }
    levels = rates.groupingSets([["attribute", "group"], ["attribute"]], "attribute", "group").agg(
        F.grouping("group").alias("is_attribute"),
        F.count_if(counted).alias("groups"),
        *[F.max(c).alias(c) for c in ("prediction_rate", "tpr", "fpr", "found_rate", "n", "positives")],
        *[(F.max(v) - F.min(v)).alias(name) for name, v in gap.items()],
        *curve,
    )

    def entry(section: str, metric: str, value: str, bin_number: str = "NULL") -> str:
        return (
            f"struct('{section}' AS section, CAST({bin_number} AS int) AS bin, "
            f"'{metric}' AS metric, CAST({value} AS double) AS value)"
        )

    def array(*entries: str) -> str:
        return f"array({', '.join(entries)})"

    group_entries = array(
        entry("demographic_parity", "prediction_rate", "prediction_rate"),
        entry("demographic_parity", "count", "n"),
        entry("equalized_odds", "true_positive_rate", "tpr"),
        entry("equalized_odds", "false_positive_rate", "fpr"),
        entry("equal_opportunity", "true_positive_rate", "found_rate"),
        entry("equal_opportunity", "positive_count", "positives"),
    )
    if has_score:
        means = array(
            entry("calibration", "mean_predicted", "mean_predicted"),
            entry("calibration", "mean_actual", "mean_actual"),
        )
        point = array(*[entry("calibration", m, f"p.{m}", "p.bin") for m in ("predicted", "actual", "count")])
        group_entries = f"concat({group_entries}, {means}, flatten(transform(curve, p -> {point})))"
    gaps = array(
        entry("demographic_parity", "disparity", "demographic_parity_disparity"),
        entry("equalized_odds", "tpr_disparity", "tpr_disparity"),
        entry("equalized_odds", "fpr_disparity", "fpr_disparity"),
        entry("equal_opportunity", "disparity", "equal_opportunity_disparity"),
    )
    entries = F.expr(
        f"CASE WHEN is_attribute = 0 THEN {group_entries} "
        f"WHEN groups >= 2 THEN filter({gaps}, e -> e.value IS NOT NULL) END"
    )
    return levels.select(
        "attribute", "group", F.expr("is_attribute = 1").alias("is_disparity"), F.inline(entries)
    ).select("section", "attribute", "group", "is_disparity", "bin", "metric", "value")
