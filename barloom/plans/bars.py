"""The bar query: a time range, optionally some symbols, in (symbol, time) order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.operators.ordering import sort_bars
from barloom.operators.predicates import in_range, with_symbols


def get_bars(df: DataFrame, start, end, symbols: list[str] | None = None) -> DataFrame:
    return sort_bars(with_symbols(df.filter(in_range(start, end)), symbols))
