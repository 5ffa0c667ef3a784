"""Scalar expressions used to clean columns and to derive features from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SMALL_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)
_WHOLE_NUMBER = r"^\s*([+-]?0*\d{1,10})(\.\d*)?\s*$"


def _widened(df: DataFrame, columns: Sequence[str], factors: int) -> list[Column]:
    """Columns in a type in which multiplying ``factors`` of them cannot overflow.

    Two integers of at most 32 bits fit in a bigint; anything longer or wider
    goes to double. Text that holds no number is null.
    """
    small = all(isinstance(df.schema[c].dataType, _SMALL_INTEGERS) for c in columns)
    target = "bigint" if small and factors <= 2 else "double"
    return [F.col(c).try_cast(target) for c in columns]


def power(df: DataFrame, column: str, exponent: int) -> Column:
    """``column`` to a whole power, by multiplication in a widened type. Null stays null."""
    (base,) = _widened(df, [column], exponent)
    return reduce(mul, [base] * exponent)


def product(df: DataFrame, *columns: str) -> Column:
    """Product of columns in a widened type; null when any of them is null."""
    return reduce(mul, _widened(df, columns, len(columns)))


def row_sum(df: DataFrame, *columns: str) -> Column:
    """Sum across columns in a widened type; null when any of them is null."""
    return reduce(add, _widened(df, columns, 1))


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it does not or is null."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def range_flag(column: Column, lower: float, upper: float) -> Column:
    """1.0 where ``lower <= column < upper``, else 0.0 (null included)."""
    return flag((column >= lower) & (column < upper))


def all_flag(*conditions: Column) -> Column:
    """1.0 where every condition holds, else 0.0 (null included)."""
    return flag(reduce(and_, conditions))


def zero_if_null(df: DataFrame, column: str) -> Column:
    """The column with nulls replaced by zero, in the column's own type. NaN is kept."""
    return F.coalesce(F.col(column), F.lit(0).cast(df.schema[column].dataType))


def integer_or_null(df: DataFrame, column: str) -> Column:
    """The column as an int, null where it holds no whole 32-bit number.

    A decimal fraction is cut off, in text as well as in numbers. Only values that
    convert reach the cast: failed casts cost an exception each, which shows on
    columns with much bad text.
    """
    source = F.col(column)
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return source.cast("int")
    if isinstance(df.schema[column].dataType, T.StringType):
        digits = F.nullif(F.regexp_extract(source, _WHOLE_NUMBER, 1), F.lit(""))
        source = digits.cast("bigint")
    fits = (source > F.lit(-(2**31) - 1)) & (source < F.lit(2**31))
    return F.when(fits, source.cast("int"))


def collapse(column: Column, keep: Sequence[str], other: str = "Other") -> Column:
    """The value itself when it is one of ``keep``, otherwise ``other`` (null included)."""
    return F.when(column.isin(list(keep)), column).otherwise(F.lit(other))


def band(column: Column, cuts: Sequence[tuple[float, str]], last: str) -> Column:
    """Name of the first band whose upper limit is above the value.

    ``cuts`` are (limit, name) in rising order; a value at or above every limit,
    and a null, gets ``last``.
    """
    if [limit for limit, _ in cuts] != sorted(limit for limit, _ in cuts):
        raise ValueError("band limits must rise")
    chain = F
    for limit, name in cuts:
        chain = chain.when(column < limit, F.lit(name))
    return chain.otherwise(F.lit(last))
