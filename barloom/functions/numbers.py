"""Numeric coercion and the single notion of "missing" (NULL; NaN never survives)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.DoubleType, T.FloatType)


def without_nan(c: Column, kind: str | T.DataType = "double") -> Column:
    # One reference to ``c``: pushed-down filters inline it, and nested CASEs would double each time.
    return F.nanvl(c, F.lit(None).cast(kind))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in the floating-point columns (of ``cols``, or of the whole frame)."""
    wanted = set(df.columns if cols is None else cols)
    floating = {f.name: f.dataType for f in df.schema if f.name in wanted and isinstance(f.dataType, _FLOATING)}
    return df.withColumns({c: without_nan(F.col(c), kind) for c, kind in floating.items()}) if floating else df


#: Decimal numbers as text, infinity and NaN; Java's own reading also knows type suffixes and hexadecimals.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*([+-]?inf(inity)?|nan)\s*$"


def number(c: Column) -> Column:
    """Number or NULL, never an error; NaN stays NaN. ``typeof`` is a constant, so only text is matched."""
    return F.when((F.typeof(c) != "string") | c.cast("string").rlike(NUMBER), c).try_cast("double")


def lenient_double(c: Column) -> Column:
    """Number or NULL, never an error."""
    return without_nan(number(c))


def lenient_long(c: Column) -> Column:
    """Whole number or NULL: text and fractions are accepted, the fraction is cut off.

    Only numbers too large for a double to hold exactly are read as ``bigint`` text; trying that first
    would raise and catch an error for every other row that is not a plain integer.
    """
    number = lenient_double(c)
    exact = F.abs(number) < F.lit(float(1 << 53))
    return F.when(exact, number.try_cast("bigint")).when(
        number.isNotNull(), F.coalesce(c.cast("string").try_cast("bigint"), number.try_cast("bigint"))
    )
