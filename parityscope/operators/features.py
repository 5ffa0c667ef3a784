"""Feature definition, indexing, assembling and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

INDEXED_SUFFIX = "_indexed"
ASSEMBLED = "features"
SCALED = "scaled_features"


def available_features(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """The numeric and the categorical features the table has, in the given order."""
    return [c for c in numeric if c in df.columns], [c for c in categorical if c in df.columns]


def string_index_stage(columns: Sequence[str]) -> StringIndexer:
    """Indexer of several columns at once: most frequent value 0, ties by name.

    Null and values not seen when fitting get the number of values as their index.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + INDEXED_SUFFIX for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def string_index_table(df: DataFrame, column: str, ranges: int = 200, sample: int = 20_000) -> DataFrame:
    """``value, n, index`` of every value of a column: the numbers that ``string_index_stage``
    gives, as a table, for columns of any number of values.

    Nothing but a bounded sample of values, which cuts the work to ranges, reaches the driver.
    Values of one frequency are numbered inside each range; a window over one row for each
    frequency and range tells how many come before. Any cuts give the same numbers.
    """
    counts = df.select(F.col(column).cast("string").alias("value")).filter("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    drawn = counts.select("value").orderBy(F.xxhash64("value"), "value").limit(sample).collect()
    values = sorted(r.value for r in drawn)
    cuts = sorted({values[len(values) * i // ranges] for i in range(1, ranges)}) if values else []
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("value"))) if cuts else F.lit(0)
    placed = counts.withColumn("range", place)
    # As many rows as there are frequencies, times the ranges at most.
    sizes = placed.groupBy("n", "range").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy(F.desc("n"), "range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("n", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("n", "range").orderBy("value")) - 1
    numbered = placed.withColumn("own", own).join(offsets, ["n", "range"])
    return numbered.select("value", "n", (F.col("before") + F.col("own")).cast("double").alias("index"))


def apply_string_index(df: DataFrame, index: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Add the index of each row's value; null and unknown values get the number of values."""
    output = output or column + INDEXED_SUFFIX
    unknown = index.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    known = index.select(F.col("value").alias("__value"), F.col("index").alias(output))
    found = df.join(known, F.col(column).cast("string") == F.col("__value"), "left").drop("__value")
    return found.withColumn(output, F.coalesce(F.col(output), unknown))


def feature_stages(numeric: Sequence[str], categorical: Sequence[str] = (), scale: bool = True) -> Pipeline:
    """Unfitted stages: index the categoricals, assemble everything, standardise.

    Fit them on the training rows only. Rows with a null or NaN in any numeric input
    are dropped when assembling; ``assembly_report`` counts them.
    """
    stages = [string_index_stage(categorical)] if categorical else []
    inputs = [*numeric, *[c + INDEXED_SUFFIX for c in categorical]]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=ASSEMBLED, handleInvalid="skip"))
    if scale:
        stages.append(StandardScaler(inputCol=ASSEMBLED, outputCol=SCALED, withMean=True, withStd=True))
    return Pipeline(stages=stages)


def _incomplete(df: DataFrame, inputs: Sequence[str]) -> Column:
    """True for rows the assembler drops."""
    tests = []
    for c in inputs:
        tests.append(F.col(c).isNull())
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            tests.append(F.coalesce(F.isnan(c), F.lit(False)))
    return reduce(or_, tests)


def assembly_report(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """One row, ``kept, dropped``: how many rows assembling these numeric inputs keeps."""
    bad = _incomplete(df, inputs)
    return df.agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("dropped"))


def standardize(df: DataFrame, column: str, output: str) -> DataFrame:
    """Add ``output``: (value - mean) / sample standard deviation over the whole table.

    A constant column gives 0.0; null stays null. Mean and deviation come from one
    aggregate of the column, put in as scalars.
    """
    value = F.col(column).cast("double")
    stats = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    mean, sd = stats.select("mean").scalar(), stats.select("sd").scalar()
    scaled = F.coalesce(F.try_divide(value - mean, sd), F.lit(0.0))
    return df.withColumn(output, F.when(value.isNotNull(), scaled))
