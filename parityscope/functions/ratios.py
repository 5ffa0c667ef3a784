"""Division with the audit's zero rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double; 0.0 where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))
