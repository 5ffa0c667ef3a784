import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityscope.functions import (
    all_flag,
    band,
    bin_edges,
    collapse,
    flag,
    integer_or_null,
    positive_score,
    power,
    probability_text,
    product,
    range_flag,
    row_sum,
    safe_ratio,
    score_bin,
    zero_if_null,
)


def _values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0), (None, 3)], "a int, b int")
    assert _values(df, safe_ratio(F.col("a"), F.col("b"))) == [0.5, 0.0, 0.0, 0.0]


def test_powers_do_not_overflow(spark):
    df = spark.createDataFrame([(2000, 2**31 - 1, 2**62), (None, 3, 4)], "age int, big int, huge bigint")
    assert _values(df, power(df, "age", 3)) == [8_000_000_000, None]
    assert _values(df, power(df, "big", 2)) == [(2**31 - 1) ** 2, 9]
    assert _values(df, product(df, "huge", "huge")) == [float(2**62) ** 2, 16.0]
    assert _values(df, product(df, "age", "big")) == [2000 * (2**31 - 1), None]
    assert _values(df, row_sum(df, "big", "big")) == [2**32 - 2, 6]


def test_row_sum_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3)], "a int, b int, c int")
    assert _values(df, row_sum(df, "a", "b", "c")) == [6, None]


def test_flags_are_zero_on_null(spark):
    df = spark.createDataFrame([(3,), (4,), (6,), (7,), (None,)], "x int")
    assert _values(df, flag(F.col("x") >= 7)) == [0.0, 0.0, 0.0, 1.0, 0.0]
    assert _values(df, range_flag(F.col("x"), 4, 7)) == [0.0, 1.0, 1.0, 0.0, 0.0]
    pairs = spark.createDataFrame([(1, 1), (1, 0), (1, None), (None, None)], "a int, b int")
    assert _values(pairs, all_flag(F.col("a") > 0, F.col("b") > 0)) == [1.0, 0.0, 0.0, 0.0]


def test_integer_or_null(spark):
    df = spark.createDataFrame(
        [("x",), ("3",), (None,), (" 7 ",), ("3.9",), ("-2",), ("3.x",), ("99999999999",), ("",)], "s string"
    )
    assert _values(df, integer_or_null(df, "s")) == [None, 3, None, 7, 3, -2, None, None, None]
    numbers = spark.createDataFrame([(3.9,), (1e12,), (None,)], "d double")
    assert _values(numbers, integer_or_null(numbers, "d")) == [3, None, None]


def test_zero_if_null_keeps_type_and_nan(spark):
    df = spark.createDataFrame([(None, None, None), (2, "x", float("nan"))], "i int, s string, d double")
    filled = df.select(*[zero_if_null(df, c).alias(c) for c in df.columns])
    assert filled.dtypes == df.dtypes
    first, second = filled.collect()
    assert tuple(first) == (0, "0", 0.0)
    assert second.i == 2 and second.d != second.d


def test_band_boundaries(spark):
    df = spark.createDataFrame([(24,), (25,), (44,), (45,), (None,)], "age int")
    bands = band(F.col("age"), [(25, "Young"), (45, "Middle")], "Old")
    assert _values(df, bands) == ["Young", "Middle", "Middle", "Old", "Old"]
    with pytest.raises(ValueError):
        band(F.col("age"), [(45, "Middle"), (25, "Young")], "Old")


def test_collapse(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "s string")
    assert _values(df, collapse(F.col("s"), ["a", "b"])) == ["a", "b", "Other", "Other"]


def test_positive_score_forms(spark):
    schema = T.StructType(
        [T.StructField("v", VectorUDT()), T.StructField("a", T.ArrayType(T.FloatType())),
         T.StructField("n", T.DoubleType())]
    )
    df = spark.createDataFrame(
        [(Vectors.dense(0.25, 0.75), [0.5], 0.125), (Vectors.sparse(2, [0], [1.0]), [0.5, 0.25], None),
         (None, None, 1.0)],
        schema,
    )
    assert _values(df, positive_score(df, "v")) == [0.75, 0.0, None]
    assert _values(df, positive_score(df, "a")) == [0.5, 0.25, None]
    assert _values(df, positive_score(df, "n")) == [0.125, None, 1.0]


def test_probability_text(spark):
    df = spark.createDataFrame([(Vectors.dense(0.25, 0.1 + 0.2),), (None,)], T.StructType([T.StructField("v", VectorUDT())]))
    text, missing = _values(df, probability_text(df, "v"))
    assert text == "[0.25, 0.30000000000000004]"
    assert missing is None


def test_bin_edges_are_the_exact_doubles():
    assert bin_edges(10)[3] == 0.30000000000000004
    assert bin_edges(10)[6] == 0.6000000000000001
    assert bin_edges(10)[7] == 0.7000000000000001
    assert len(bin_edges(10)) == 11 and bin_edges(10)[-1] == 1.0


def test_score_bins_are_right_closed(spark):
    scores = [0.0, 0.1, 0.3, 0.30000000000000004, 0.7, 1.0, 1.1, -0.1, None]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    assert _values(df, score_bin(F.col("s"))) == [None, 1, 3, 3, 7, 10, None, None, None]
    assert _values(df, score_bin(F.col("s"), include_lowest=True)) == [1, 1, 3, 3, 7, 10, None, None, None]


def test_text_that_is_no_number_is_null(spark):
    df = spark.createDataFrame([("x", "2"), ("3", None)], "a string, b string")
    assert _values(df, power(df, "a", 2)) == [None, 9.0]
    assert _values(df, product(df, "a", "b")) == [None, None]
    assert _values(df, row_sum(df, "a")) == [None, 3.0]


def test_booleans_as_integers(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "a boolean")
    assert _values(df, integer_or_null(df, "a")) == [1, 0, None]
