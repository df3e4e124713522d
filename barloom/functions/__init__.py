"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from barloom.functions.numbers import lenient_double, lenient_long, nan_to_null, without_nan
from barloom.functions.symbols import canonical, stable_bucket, strip, ticker, upper_symbol
from barloom.functions.times import iso_utc, micros, period_start, utc

__all__ = [
    "canonical", "iso_utc", "lenient_double", "lenient_long", "micros", "nan_to_null",
    "period_start", "stable_bucket", "strip", "ticker", "upper_symbol", "utc", "without_nan",
]
