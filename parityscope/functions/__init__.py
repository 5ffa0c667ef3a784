"""Column-to-Column building blocks; all of them stay inside the JVM."""

from parityscope.functions.expressions import (
    all_flag,
    band,
    collapse,
    flag,
    integer_or_null,
    power,
    product,
    range_flag,
    row_sum,
    zero_if_null,
)
from parityscope.functions.ratios import safe_ratio
from parityscope.functions.scores import bin_edges, positive_score, probability_text, score_bin, usable_score

__all__ = [
    "all_flag",
    "band",
    "bin_edges",
    "collapse",
    "flag",
    "integer_or_null",
    "positive_score",
    "power",
    "probability_text",
    "product",
    "range_flag",
    "row_sum",
    "safe_ratio",
    "score_bin",
    "usable_score",
    "zero_if_null",
]
