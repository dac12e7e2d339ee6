"""Null discipline: NaN never leaves an operator, every ratio is guarded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def no_nan(value: Column) -> Column:
    """NaN becomes NULL, so comparisons and averages skip it."""
    return F.when(~F.isnan(value), value)


def number(df: DataFrame, name: str) -> Column:
    """A numeric column as a double without NaN."""
    as_double = F.col(f"`{name}`").cast("double")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return no_nan(as_double)
    return as_double


def present(df: DataFrame, name: str) -> Column:
    """True where the column holds a value (NaN counts as missing)."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def clamp(value: Column, low: float, high: float) -> Column:
    """Clip to a range; NULL stays NULL (``least``/``greatest`` alone would drop it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))))


def guarded_corr(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson correlation; NULL when either side is constant."""
    paired_x = F.when(y.isNotNull(), x)
    paired_y = F.when(x.isNotNull(), y)
    return F.try_divide(
        F.covar_pop(x, y),
        F.stddev_pop(paired_x) * F.stddev_pop(paired_y),
    )


def corrected_skew(value: Column) -> Column:
    """Bias-corrected skewness from Spark's population form; NULL below 3 values."""
    n = F.count(value).cast("double")
    spread = F.stddev_pop(value)
    g1 = F.when(spread > 0, F.skewness(value))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
