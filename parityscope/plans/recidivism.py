"""The whole audit of a recidivism classifier, from the CSV file to the bias report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityscope.functions import all_flag, flag, power, product, range_flag, row_sum
from parityscope.operators import clean, evaluate, fairness, model, profile, split
from parityscope.operators.features import available_features
from parityscope.roles import AuditRoles, require_columns
from parityscope.sources import first_rows, read_csv, save_model, write_parquet, write_predictions_csv

# Column names, categories and limits of the audited table.
ID = "id"
LABEL = "two_year_recid"
COLUMNS = (
    "id", "sex", "age", "age_cat", "race", "juv_fel_count", "juv_misd_count", "juv_other_count",
    "priors_count", "decile_score", "score_text", "is_recid", "two_year_recid", "is_violent_recid",
    "v_decile_score", "v_score_text",
)
CRITICAL = ("two_year_recid", "race", "sex", "age")
ZERO_IF_NULL = (
    "juv_fel_count", "juv_misd_count", "juv_other_count", "priors_count", "decile_score", "v_decile_score",
)
INTEGERS = ("decile_score", "v_decile_score", "two_year_recid", "is_recid")
RACES = ("African-American", "Caucasian")
AGE_BANDS = ((25, "Young"), (45, "Middle"))
LAST_AGE_BAND = "Old"
NUMERIC_FEATURES = (
    "decile_score", "priors_count", "age", "juv_fel_count", "juv_misd_count", "juv_other_count",
    "v_decile_score",
    "age_squared", "age_cubed", "decile_squared", "priors_squared", "v_decile_squared",
    "is_young", "high_risk", "medium_risk", "violent_high_risk", "has_priors", "multiple_priors",
    "has_juv_fel", "has_juv_misd", "total_juv_count", "has_juv_record",
    "age_decile", "young_high_risk", "age_priors", "decile_priors",
)
CATEGORICAL_FEATURES = ("sex", "race_binary", "age_cat")
ATTRIBUTES = ("race_binary", "sex")
DISPLAYED = ("age", "race_binary", "sex", "priors_count", "decile_score", "two_year_recid")

ROLES = AuditRoles(LABEL, "prediction", ATTRIBUTES, score="score", id=ID)

# Fields that are converted afterwards, as they may hold decimals, are read as text.
_READ_AS_INTEGERS = (ID, "age", "priors_count", "juv_fel_count", "juv_misd_count", "juv_other_count")
SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c in _READ_AS_INTEGERS else T.StringType()) for c in COLUMNS]
)
OPTIONAL = tuple(c for c in COLUMNS if c not in (ID, *CRITICAL))
#: Part of the name of a column that may stand in for a missing one.
NEAR_NAMES = {"priors_count": "priors"}

_JUVENILE = ("juv_fel_count", "juv_misd_count", "juv_other_count")

# Limits of the derived features.
# Derived feature -> (columns it needs, how it is made). A feature is made only when
# all the columns it needs are there.
_DERIVED: dict[str, tuple[tuple[str, ...], Callable[[DataFrame], Column]]] = {
    "age_squared": (("age",), lambda df: power(df, "age", 2)),
    "age_cubed": (("age",), lambda df: power(df, "age", 3)),
    "is_young": (("age",), lambda df: flag(F.col("age") < 25)),
    "decile_squared": (("decile_score",), lambda df: power(df, "decile_score", 2)),
    "high_risk": (("decile_score",), lambda df: flag(F.col("decile_score") >= 7)),
    "medium_risk": (("decile_score",), lambda df: range_flag(F.col("decile_score"), 4, 7)),
    "v_decile_squared": (("v_decile_score",), lambda df: power(df, "v_decile_score", 2)),
    "violent_high_risk": (("v_decile_score",), lambda df: flag(F.col("v_decile_score") >= 7)),
    "priors_squared": (("priors_count",), lambda df: power(df, "priors_count", 2)),
    "has_priors": (("priors_count",), lambda df: flag(F.col("priors_count") > 0)),
    "multiple_priors": (("priors_count",), lambda df: flag(F.col("priors_count") >= 3)),
    "has_juv_fel": (("juv_fel_count",), lambda df: flag(F.col("juv_fel_count") > 0)),
    "has_juv_misd": (("juv_misd_count",), lambda df: flag(F.col("juv_misd_count") > 0)),
    "total_juv_count": (_JUVENILE, lambda df: row_sum(df, *_JUVENILE)),
    "has_juv_record": (_JUVENILE, lambda df: flag(row_sum(df, *_JUVENILE) > 0)),
    "age_decile": (("age", "decile_score"), lambda df: product(df, "age", "decile_score")),
    "young_high_risk": (
        ("age", "decile_score"),
        lambda df: all_flag(F.col("age") < 25, F.col("decile_score") >= 7),
    ),
    "age_priors": (("age", "priors_count"), lambda df: product(df, "age", "priors_count")),
    "decile_priors": (
        ("decile_score", "priors_count"),
        lambda df: product(df, "decile_score", "priors_count"),
    ),
}


def cleaned(raw: DataFrame) -> DataFrame:
    """Wanted columns, complete rows, filled and converted numbers, race and age groups."""
    named = clean.rename_near_match(raw, NEAR_NAMES)
    require_columns(named, CRITICAL)
    kept = clean.require_not_null(clean.select_available(named, COLUMNS), CRITICAL)
    numbers = clean.try_int(clean.fill_null_zero(kept, ZERO_IF_NULL), INTEGERS)
    races = clean.collapse_categories(numbers, "race", RACES, "race_binary")
    return clean.band_numeric(races, "age", AGE_BANDS, LAST_AGE_BAND, "age_group")


def with_features(table: DataFrame) -> DataFrame:
    """Add every derived feature whose columns the cleaned table has."""
    made = {
        name: build(table)
        for name, (needed, build) in _DERIVED.items()
        if all(c in table.columns for c in needed)
    }
    return table.withColumns(made)


def prepared(
    spark: SparkSession, path: str, schema: T.StructType | str | None = SCHEMA
) -> DataFrame:
    """The cleaned table with its derived features, from the CSV file.

    With the declared schema the file is read once and types do not depend on the data:
    a number that is none is null. ``schema=None`` infers them, in a pass of its own.
    """
    return with_features(cleaned(read_csv(spark, path, schema, optional=OPTIONAL, aliases=NEAR_NAMES)))


@dataclass(frozen=True)
class Audit:
    """Result tables of an audit. Each is computed when it is acted on, from written rows."""

    model: PipelineModel
    table: DataFrame
    predictions: DataFrame
    roles: AuditRoles
    split_counts: DataFrame
    pre_aggregate: bool = False
    include_lowest: bool = False
    null_group: str = "exclude"
    histogram_bins: int = 30
    sample_rows: int = 100
    #: Values whose shares are wanted, also where no row has them; all there are by default.
    named_values: tuple[str, ...] | None = None
    #: The two groups to compare; the two largest of each attribute by default.
    pair: tuple[str, str] | None = None

    def tables(self) -> dict[str, DataFrame]:
        """Every result table by the name it is written under."""
        made = {
            "split_counts": self.split_counts,
            "statistics": self.statistics(),
            "distributions": self.distributions(),
            "metrics": self.metrics(),
            "confusion_matrix": self.confusion_matrix(),
            "group_metrics": self.group_metrics(),
            "pair_disparity": self.pair_disparity(),
            "bias_report": self.bias_report(),
            "sample": self.sample(),
            "age_histogram": self.age_histogram(),
        }
        for attribute in self.roles.attributes:
            made[f"shares_{attribute}"] = self.shares(attribute)
            made[f"label_rates_{attribute}"] = self.label_rates(attribute)
        if hasattr(self.model.stages[-1], "featureImportances"):
            made["importances"] = self.importances()
        return made

    def write_tables(self, output: str) -> dict[str, DataFrame]:
        """Write every result table as Parquet under ``output`` and return what was written."""
        return {name: write_parquet(table, f"{output}/{name}") for name, table in self.tables().items()}

    def statistics(self) -> DataFrame:
        return profile.summary(self.table, LABEL)

    def distributions(self) -> DataFrame:
        return profile.distribution(self.table, self.roles.attributes)

    def shares(self, attribute: str, values: list[str] | None = None) -> DataFrame:
        return profile.share_of_total(self.table, attribute, values or self.named_values)

    def sample(self, n: int | None = None) -> DataFrame:
        return first_rows(clean.select_available(self.table, (ID, *DISPLAYED)), n or self.sample_rows, order_by=ID)

    def age_histogram(self, bins: int | None = None) -> DataFrame:
        return profile.histogram(self.table, "age", bins or self.histogram_bins)

    def label_rates(self, attribute: str) -> DataFrame:
        return profile.rate_by_group(self.table, attribute, LABEL)

    def metrics(self) -> DataFrame:
        return evaluate.classification_metrics(self.predictions, self.roles)

    def confusion_matrix(self) -> DataFrame:
        return evaluate.confusion_matrix(self.predictions, LABEL, self.roles.prediction)

    def group_metrics(self) -> DataFrame:
        return fairness.group_metrics(self.predictions, self.roles, self.pre_aggregate)

    def pair_disparity(self, pair: tuple[str, str] | None = None) -> DataFrame:
        return fairness.severity(fairness.pair_disparity(self.group_metrics(), pair or self.pair, self.null_group))

    def bias_report(self) -> DataFrame:
        return fairness.bias_report(
            self.predictions, self.roles, null_group=self.null_group,
            pre_aggregate=self.pre_aggregate, include_lowest=self.include_lowest,
        )

    def importances(self, k: int = 10) -> DataFrame:
        return model.feature_importance(self.model, self.table.sparkSession, k)


def run(
    spark: SparkSession,
    path: str,
    output: str,
    schema: T.StructType | str | None = SCHEMA,
    attributes: tuple[str, ...] = ATTRIBUTES,
    train_fraction: float = 0.8,
    estimator: str = "rf",
    pre_aggregate: bool = False,
    include_lowest: bool = False,
    null_group: str = "exclude",
    histogram_bins: int = 30,
    sample_rows: int = 100,
    named_values: tuple[str, ...] | None = None,
    pair: tuple[str, str] | None = None,
    **settings,
) -> Audit:
    """Prepare, split, train, score and write; the returned audit reads what was written.

    Under ``output``: ``processed`` (Parquet), ``model``, ``scored`` (Parquet) and
    ``predictions`` (CSV); ``Audit.write_tables`` adds the result tables. Rows without an id
    are on neither side of the split; ``split_counts`` says how many. ``pre_aggregate``
    counts combinations of all attributes first, for a few attributes of low cardinality.
    Preprocessing is fitted on the training rows only. The CSV is
    parsed and the test rows are scored once, as every later step reads the written tables.
    """
    roles = AuditRoles(LABEL, "prediction", attributes, score="score", id=ID)
    table = write_parquet(prepared(spark, path, schema), f"{output}/processed")
    require_columns(table, [ID, LABEL, *attributes])

    sides = split.stratified_hash_split(table, ID, LABEL, train_fraction)
    train, test = split.train_and_test(sides)
    numeric, categorical = available_features(table, NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    fitted = model.fit_classifier(
        train, LABEL, numeric, categorical, estimator, order_by=ID, **settings
    )
    save_model(fitted, f"{output}/model")

    scored = model.score(fitted, test).select(ID, LABEL, *attributes, "prediction", "probability", "score")
    predictions = write_parquet(scored, f"{output}/scored")
    columns = [ID, LABEL, "prediction", *attributes]
    write_predictions_csv(predictions, f"{output}/predictions", columns)
    counts = split.split_counts(sides, ID)
    return Audit(
        fitted, table, predictions, roles, counts, pre_aggregate, include_lowest, null_group,
        histogram_bins, sample_rows, named_values, pair,
    )
