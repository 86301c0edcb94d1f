"""Column helpers: NaN/NULL normalisation, dtype classes, rounding of result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: list[str] | tuple = ()) -> list[str]:
    """Columns of a numeric dtype class (P16, ``select_dtypes(include='number')``)."""
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: list[str] | tuple = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def clean_value(df: DataFrame, name: str) -> Column:
    """The column with NaN mapped to NULL (pandas' missing-value model); other types unchanged."""
    c = F.col(quote(name))
    if isinstance(dtype_of(df, name), FLOAT_TYPES):
        return F.when(~F.isnan(c), c)
    return c


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Map NaN to NULL in every float/double column (or in ``cols``)."""
    cols = cols if cols is not None else df.columns
    targets = {c for c in cols if isinstance(dtype_of(df, c), FLOAT_TYPES)}
    if not targets:
        return df
    return df.select([clean_value(df, c).alias(c) if c in targets else F.col(quote(c)) for c in df.columns])


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for float columns."""
    c = F.col(quote(name))
    if isinstance(dtype_of(df, name), FLOAT_TYPES):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column (result tables compared across engines)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, FLOAT_TYPES):
            out.append(F.round(F.col(quote(f.name)).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(quote(f.name)))
    return df.select(out)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 (ANSI mode would raise)."""
    return F.when(b != 0, a / b)

