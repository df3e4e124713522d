"""Joins in relational terms and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.symbols import ticker
from barloom.operators.dedupe import KEYS, dedupe_first
from barloom.schemas import ORD, SYMBOL, TIME


def anti_times(expected: DataFrame, actual: DataFrame, keys=KEYS) -> DataFrame:
    """Expected keys that are not present."""
    return expected.join(actual.select(*keys).distinct(), list(keys), "left_anti").select(*expected.columns)


def only_universe(bars: DataFrame, universe: DataFrame, symbol: str = SYMBOL) -> DataFrame:
    """Bars of the symbols in the universe."""
    wanted = universe.select(F.col(symbol).alias(SYMBOL)).distinct()
    return bars.join(wanted, SYMBOL, "left_semi").select(*bars.columns)


def attach_type(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """Add ``instrumentType``. A symbol listed several times has the smallest of its types."""
    kinds = universe.groupBy(SYMBOL).agg(F.min("instrumentType").alias("instrumentType"))
    return bars.join(kinds, SYMBOL, "left").select(*bars.columns, "instrumentType")


def priority_union(lists: list[DataFrame], col: str = "ticker", pos: str = "pos") -> DataFrame:
    """Distinct tickers of several lists: the earliest list and position wins, blanks are dropped.

    Returns ``ticker`` with its place (``priority``, ``pos``), in that order.
    """
    ranked = [
        df.select(ticker(F.col(col)).alias("ticker"), F.lit(i).alias("priority"), F.col(pos).cast("bigint").alias("pos"))
        for i, df in enumerate(lists)
    ]
    merged = reduce(DataFrame.unionByName, ranked).filter(F.col("ticker") != "")
    first = merged.groupBy("ticker").agg(F.min(F.struct("priority", "pos")).alias("_at"))
    return first.select("ticker", "_at.priority", "_at.pos").orderBy("priority", "pos")


def union_chunks(frames: list[DataFrame], keys=KEYS, order=(ORD,)) -> DataFrame:
    """Chunk results by column name. Neighbouring chunks share a day, so the first copy is kept."""
    if not frames:
        raise ValueError("no chunks to combine")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return dedupe_first(merged, keys, order)


def difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Distinct rows of ``expected`` that ``actual`` lacks (NULLs compare as equal)."""
    return expected.subtract(actual.select(*expected.columns))


def missing_baseline(universe: DataFrame, baseline: DataFrame, col: str = "dataSymbol") -> DataFrame:
    """Baseline symbols the universe lacks."""
    return baseline.select(col).distinct().join(universe.select(col).distinct(), col, "left_anti")


def time_span(df: DataFrame, time_col: str = TIME) -> DataFrame:
    return df.agg(F.min(time_col).alias("start"), F.max(time_col).alias("end"))
