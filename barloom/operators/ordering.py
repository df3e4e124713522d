"""Sorting and top rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.schemas import ORD, SYMBOL, TIME


def _ties(df: DataFrame) -> list[str]:
    return [ORD] if ORD in df.columns else []


def sort_bars(df: DataFrame) -> DataFrame:
    return df.orderBy(SYMBOL, TIME, *_ties(df))


def sort_time(df: DataFrame, tiebreak: str | None = None) -> DataFrame:
    return df.orderBy(TIME, *([tiebreak] if tiebreak else _ties(df)))


def scan_times(df: DataFrame, time_col: str = TIME) -> DataFrame:
    return df.select(time_col).orderBy(time_col)


def latest_rows(df: DataFrame, n: int, ties: tuple[str, ...] = (SYMBOL,)) -> DataFrame:
    """The ``n`` latest rows; ``ties`` decides between equal times."""
    return df.orderBy(F.col(TIME).desc_nulls_last(), *ties).limit(n)


def head_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def latest_bar(df: DataFrame, symbol: str) -> DataFrame:
    """Most recent bar of one symbol."""
    return df.filter(F.col(SYMBOL) == symbol).orderBy(F.col(TIME).desc_nulls_last(), *[F.desc(c) for c in _ties(df)]).limit(1)


def earliest_bar(df: DataFrame, symbol: str) -> DataFrame:
    """First bar of one symbol."""
    return df.filter(F.col(SYMBOL) == symbol).orderBy(F.col(TIME).asc_nulls_last(), *_ties(df)).limit(1)


def latest_bar_per_symbol(df: DataFrame) -> DataFrame:
    return _end_bar(df, latest=True)


def earliest_bar_per_symbol(df: DataFrame) -> DataFrame:
    return _end_bar(df, latest=False)


def _end_bar(df: DataFrame, latest: bool) -> DataFrame:
    """The bar of each symbol at its last (first) time; the ordinal decides between equal times.

    One scan: Spark keeps the first row of a rank per task before the shuffle.
    """
    by = F.desc if latest else F.asc
    timed = df.filter(F.col(TIME).isNotNull())
    w = Window.partitionBy(SYMBOL).orderBy(*[by(c) for c in (TIME, *_ties(df))])
    return timed.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
