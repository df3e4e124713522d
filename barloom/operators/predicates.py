"""Row filters. The ones built from columns alone reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.numbers import lenient_double, nan_to_null
from barloom.operators.aggregates import all_of, any_of
from barloom.schemas import EQUITY_PRICES, SYMBOL, TIME


def in_range(start, end, time_col: str = TIME) -> Column:
    """``start <= time <= end`` on timestamps: of the end day only midnight belongs to the range."""
    return F.col(time_col).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))


def in_day_range(start, end, time_col: str = TIME) -> Column:
    """The days ``start`` to ``end``, both whole."""
    t = F.col(time_col)
    return (t >= F.lit(start).cast("timestamp")) & (t < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))


def symbol_in(symbols: list[str] | None, col: str = SYMBOL) -> Column:
    """Membership; an empty or missing list does not filter at all."""
    return F.col(col).isin(list(symbols)) if symbols else F.lit(True)


def with_symbols(df: DataFrame, symbols: list[str] | None, col: str = SYMBOL) -> DataFrame:
    """``symbol_in`` as a filter; Catalyst turns long lists into a set."""
    return df.filter(symbol_in(symbols, col))


def for_symbol(df: DataFrame, symbol: str) -> DataFrame:
    return df.filter(F.col(SYMBOL) == symbol)


def corrupt(prices: list[str] = EQUITY_PRICES, volume: str = "volume") -> Column:
    """A known price that is not positive, or a known negative volume; missing values pass."""
    bad = [F.coalesce(lenient_double(F.col(p)) <= 0, F.lit(False)) for p in prices]
    return any_of([*bad, F.coalesce(lenient_double(F.col(volume)) < 0, F.lit(False))])


def drop_corrupt(df: DataFrame, prices: list[str] = EQUITY_PRICES, volume: str = "volume") -> DataFrame:
    """Keep rows whose known prices are positive and whose volume, if known, is not negative."""
    fine = [F.coalesce(lenient_double(F.col(p)) > 0, F.lit(True)) for p in prices]
    return df.filter(all_of([*fine, F.coalesce(lenient_double(F.col(volume)) >= 0, F.lit(True))]))


def drop_unkeyed(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[TIME, SYMBOL])


def missing_close(df: DataFrame) -> DataFrame:
    return nan_to_null(df, ["close"]).filter(F.col("close").isNull())
