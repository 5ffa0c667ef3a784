"""Column roles of an audited table, and checks that the columns are there."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MissingColumnsError(ValueError):
    """A column the operator cannot do without is absent."""


@dataclass(frozen=True)
class AuditRoles:
    """Which column plays which part in an audit.

    ``attributes`` are the protected attributes. ``score`` may be a number, an
    array of class probabilities or an ML vector; it is only needed for
    calibration and AUC.
    """

    label: str = "label"
    prediction: str = "prediction"
    attributes: tuple[str, ...] = ()
    score: str | None = None
    id: str | None = None

    def __post_init__(self) -> None:
        if isinstance(self.attributes, str):
            object.__setattr__(self, "attributes", (self.attributes,))
        else:
            object.__setattr__(self, "attributes", tuple(self.attributes))

    def columns(self) -> list[str]:
        """Every column the roles name, without repeats."""
        named = [self.id, self.label, self.prediction, self.score, *self.attributes]
        return list(dict.fromkeys(c for c in named if c is not None))


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise ``MissingColumnsError`` naming what is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing columns {missing}; the table has {df.columns}")
    return df


def column_report(
    df: DataFrame,
    required: Iterable[str],
    optional: Iterable[str] = (),
    count_values: bool = False,
) -> DataFrame:
    """One row per wanted column: ``column, required, present, type``.

    Reads the schema only. A missing required column raises; a missing optional
    column is reported with ``present = false`` and a null type. ``count_values`` adds
    ``n_values``, the number of rows in which the column is not null, from one scan.
    """
    required, optional = list(required), list(optional)
    require_columns(df, required)
    types = dict(df.dtypes)

    def row(name: str, needed: bool) -> Column:
        fields = [
            F.lit(name).alias("column"),
            F.lit(needed).alias("required"),
            F.lit(name in types).alias("present"),
            F.lit(types.get(name)).cast("string").alias("type"),
        ]
        if count_values:
            values = F.col(name) if name in types else F.lit(0).cast("bigint")
            fields.append(values.alias("n_values"))
        return F.struct(*fields)

    present = [c for c in [*required, *optional] if c in types]
    source = df.sparkSession.range(1)
    if count_values:
        source = df.agg(*[F.count(c).alias(c) for c in present])
    rows = [row(c, True) for c in required] + [row(c, False) for c in optional]
    return source.select(F.inline(F.array(*rows)))
