"""Renames, required fields, typing and spelling of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.numbers import lenient_double, lenient_long, number
from barloom.functions.symbols import canonical, strip, ticker, upper_symbol
from barloom.functions.times import iso_utc, utc
from barloom.schemas import (
    ASSET_TYPES, EQUITY_FIELD_NAMES, EQUITY_FIELDS, EQUITY_FLOATS, FUTURES_FIELDS, OHLC, ORD, ROLL_RULES,
    SYMBOL, TIME,
)


class MissingFields(ValueError):
    """Raised when a frame lacks columns its product line requires."""

BAD_TIME = "_bad_time"


def normalize_time_column(df: DataFrame) -> DataFrame:
    """Futures bars may arrive with their time in ``ts_event``."""
    return df.withColumnRenamed("ts_event", TIME)


def rename_fields(df: DataFrame, mapping: dict[str, str] = EQUITY_FIELD_NAMES) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def missing_fields(df: DataFrame, fields: list[str]) -> list[str]:
    return [f for f in fields if f not in df.columns]


def require_fields(df: DataFrame, fields: list[str] = FUTURES_FIELDS, allow_empty: bool = False) -> DataFrame:
    """Fail on absent columns, and on an empty frame; further columns are kept."""
    absent = missing_fields(df, fields)
    if absent:
        raise MissingFields(f"missing required fields: {absent}")
    if not allow_empty and df.isEmpty():
        raise ValueError("no rows to clean")
    return df


def require_and_slice(df: DataFrame, fields: list[str] = EQUITY_FIELDS) -> DataFrame:
    """Fail on absent columns and keep exactly ``fields``; an empty frame is fine."""
    return require_fields(df, fields, allow_empty=True).select(*fields)


def keep_columns(df: DataFrame, fields: list[str] = FUTURES_FIELDS) -> DataFrame:
    return df.select(*[c for c in df.columns if c in fields])


def strict_failure(df: DataFrame) -> Column:
    """Why a row cannot be typed strictly: the first reason, or NULL if it can.

    A missing price stays missing; a missing volume has no integer form and is a failure.
    """
    numeric = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema}
    volume = F.col("volume")
    # Columns that are numbers already need no reading of text.
    unreadable = [(f"bad {c}", F.col(c).isNotNull() & number(F.col(c)).isNull()) for c in OHLC if not numeric[c]]
    blank = lenient_double(volume).isNull() if numeric["volume"] else _blank(volume)
    if BAD_TIME in df.columns:
        unreadable.insert(0, ("bad time", F.col(BAD_TIME)))
    checks = [*unreadable, ("missing volume", blank), ("bad volume", lenient_long(volume).isNull())]
    return F.coalesce(*[F.when(test, F.lit(reason)) for reason, test in checks])


def _blank(c: Column) -> Column:
    text = F.lower(strip(c.cast("string")))
    return c.isNull() | (text == "") | (text == "nan")


def coerce_strict(df: DataFrame) -> DataFrame:
    """Prices to double, volume to integer; a value that cannot be cast fails the query."""
    problem = strict_failure(df)
    volume = F.when(problem.isNull(), lenient_long(F.col("volume"))).otherwise(
        F.raise_error(F.concat(F.lit("cannot type bar: "), problem)).cast("bigint")
    )
    prices = {c: lenient_double(F.col(c)) for c in OHLC}
    return df.withColumns({**prices, "volume": volume})


def coerce_lenient(df: DataFrame, floats: list[str] = EQUITY_FLOATS, volume: str = "volume") -> DataFrame:
    """Unreadable numbers become NULL; rows without a readable volume are dropped."""
    typed = {c: lenient_double(F.col(c)) for c in floats}
    return df.withColumns({**typed, volume: lenient_long(F.col(volume))}).filter(F.col(volume).isNotNull())


def read_times(df: DataFrame, time_col: str = TIME) -> DataFrame:
    """Times to UTC, NULL where they cannot be read; ``_bad_time`` marks those rows."""
    read = iso_utc(F.col(time_col))
    return df.withColumn(BAD_TIME, F.col(time_col).isNotNull() & read.isNull()).withColumn(time_col, read)


def to_utc(df: DataFrame, time_col: str = TIME, tz: str | None = None) -> DataFrame:
    return df.withColumn(time_col, utc(F.col(time_col), tz))


def parse_time_lenient(df: DataFrame, time_col: str = TIME) -> DataFrame:
    """ISO-8601 text to UTC; rows whose time is not one are dropped."""
    return df.withColumn(time_col, iso_utc(F.col(time_col))).filter(F.col(time_col).isNotNull())


def canonical_symbol(
    df: DataFrame, roll: str = "v", rank: str | int = 0, symbol: str = "dataSymbol",
    kind: str = "instrumentType", out: str = SYMBOL,
) -> DataFrame:
    if roll not in ROLL_RULES:
        raise ValueError(f"unknown roll rule: {roll}")
    return df.withColumn(out, canonical(F.col(symbol), F.col(kind), roll, rank))


def asset_mismatch(kind: Column, asset: str) -> Column:
    """Why a row's asset type does not fit the configured one, or NULL if it does."""
    shown = F.coalesce(kind, F.lit("none"))
    return F.when(
        ~kind.eqNullSafe(F.lit(asset)), F.concat(F.lit("listed as "), shown, F.lit(f", loading {asset}"))
    ).when(~F.coalesce(kind.isin(*ASSET_TYPES), F.lit(False)), F.concat(F.lit("no such asset type here: "), shown))


def check_asset_type(df: DataFrame, asset: str, kind: str = "instrumentType") -> tuple[DataFrame, DataFrame]:
    """Rows of the configured asset type, and the others with the ``reason`` they were refused."""
    tagged = df.withColumn("reason", asset_mismatch(F.col(kind), asset))
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())


def normalize_symbol(df: DataFrame, col: str = SYMBOL) -> DataFrame:
    return df.withColumn(col, upper_symbol(F.col(col)))


def normalize_ticker(df: DataFrame, col: str = "ticker") -> DataFrame:
    return df.withColumn(col, ticker(F.col(col)))


def normalize_contracts(df: DataFrame, ord_col: str = ORD) -> DataFrame:
    """Strip symbols and upper-case types; of symbols that then collide the last one wins."""
    kept = F.max_by(F.struct(F.upper("instrumentType").alias("kind")), F.col(ord_col))
    return (
        df.groupBy(strip(F.col("dataSymbol")).alias("dataSymbol"))
        .agg(kept.alias("_kept"))
        .select("dataSymbol", F.col("_kept.kind").alias("instrumentType"))
    )
