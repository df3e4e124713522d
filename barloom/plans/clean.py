"""Cleaning of futures and equity bars, all symbols at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.numbers import lenient_double, lenient_long
from barloom.functions.symbols import upper_symbol
from barloom.functions.times import iso_utc
from barloom.operators.adjust import back_adjust
from barloom.operators.aggregates import all_of, any_of
from barloom.operators.dedupe import dedupe_first
from barloom.operators.fill import enabled_policies, handle_missing
from barloom.operators.ordering import sort_bars
from barloom.operators.project import (
    BAD_TIME, coerce_strict, keep_columns, normalize_time_column, read_times, require_and_slice, require_fields,
)
from barloom.operators.quality import isolate_failures
from barloom.operators.series import SEGMENT_ROWS
from barloom.schemas import EQUITY_FIELDS, EQUITY_FLOATS, EQUITY_PRICES, FUTURES_FIELDS, ORD, SYMBOL, TIME

# The policies the two product lines run by default.
FUTURES_POLICIES = ("zero_fill",)
EQUITY_POLICIES = ("drop_nan",)


def clean_futures(
    df: DataFrame, policies=FUTURES_POLICIES, series: str = SYMBOL, order=(TIME, ORD), value=0,
    isolate: bool = False, max_rows: int = SEGMENT_ROWS, for_storage: bool = False,
):
    """Futures bars, typed, in series and time order, back-adjusted across volume rolls.

    ``series`` names the column that holds contracts of one product together; with the default every
    contract is its own series and no roll can occur. With ``isolate`` the result is a pair: the
    clean rows of the series that could be typed, and a status row per series. Without it a row
    that cannot be typed fails the query. ``for_storage`` keeps the order columns and leaves out the
    final sort, which the table layout replaces.
    """
    df = read_times(require_fields(normalize_time_column(df), FUTURES_FIELDS))
    drop_cols = [c for c in df.columns if c not in (ORD, TIME, BAD_TIME)]
    if "drop_nan" in enabled_policies(policies):
        # A time that cannot be read is no missing time: it fails its series.
        df = df.filter(F.col(TIME).isNotNull() | F.col(BAD_TIME))
    df = handle_missing(df, policies, value, (series,), order, max_rows, drop_cols, untouched=(BAD_TIME,))
    status = None
    if isolate:
        df, status = isolate_failures(df, key=series, order=order)
    typed = keep_columns(coerce_strict(df), [*FUTURES_FIELDS, series, *order])
    adjusted = back_adjust(typed, series, order, max_rows=max_rows)
    if for_storage:
        clean = adjusted.select(*dict.fromkeys([*FUTURES_FIELDS, *order]))
    else:
        clean = adjusted.orderBy(series, *order).select(*dict.fromkeys([series, *FUTURES_FIELDS]))
    return (clean, status) if isolate else clean


def _typed_equities(df: DataFrame, policies, order, value, max_rows) -> DataFrame:
    """Equity rows after the missing-data policies with typed columns, nothing dropped yet.

    Series are told apart by the normalised symbol and ordered by the parsed time. ``_time`` and
    ``_symbol`` keep what arrived, ``_v`` the volume with its fraction.
    """
    absent = [c for c in order if c not in df.columns]
    if absent:
        raise ValueError(f"missing order columns: {absent}")
    sliced = require_and_slice(df, [*EQUITY_FIELDS, *order])
    keyed = sliced.withColumns({"_key": upper_symbol(F.col(SYMBOL)), "_at": iso_utc(F.col(TIME))})
    # Time and symbol as they came still decide what counts as missing, but are not filled.
    hidden = keyed.withColumnsRenamed({TIME: "_time", SYMBOL: "_symbol"})
    data = [c for c in EQUITY_FIELDS if c not in (TIME, SYMBOL)]
    filled = handle_missing(
        hidden, policies, value, ("_key",), ("_at", *order), max_rows,
        drop_cols=["_time", "_symbol", *data], untouched=("_time", "_symbol"),
    )
    typed = {**{c: lenient_double(F.col(c)) for c in EQUITY_FLOATS}, "_v": lenient_double(F.col("volume"))}
    typed["volume"] = lenient_long(F.col("volume"))
    return filled.withColumns(typed).withColumnsRenamed({"_at": TIME, "_key": SYMBOL})


def _refusals() -> list[tuple[str, list[Column]]]:
    """Why a typed row is refused, in order of precedence; any one condition of a group suffices."""
    return [
        ("unkeyed", [F.col("_time").isNull(), F.col("_symbol").isNull()]),
        ("corrupt", [*[F.col(p) <= 0 for p in EQUITY_PRICES], F.col("_v") < 0]),
        ("bad time", [F.col(TIME).isNull()]),
        ("bad volume", [F.col("volume").isNull()]),
    ]


def screen_equities(
    df: DataFrame, policies=EQUITY_POLICIES, order=(ORD,), value=0, max_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Typed equity rows, each with the ``reason`` it would be refused for (NULL if it would not)."""
    typed = _typed_equities(df, policies, tuple(order), value, max_rows)
    reason = F.coalesce(*[F.when(any_of(tests), F.lit(name)) for name, tests in _refusals()])
    return typed.select(*EQUITY_FIELDS, *order, reason.alias("reason"))


def accepted_equities(screened: DataFrame, order=(ORD,)) -> DataFrame:
    """What screening refuses no row of: the first row per (symbol, time), with the order columns."""
    kept = dedupe_first(screened.filter(F.col("reason").isNull()), (SYMBOL, TIME), tuple(order))
    return kept.select(*EQUITY_FIELDS, *order)


def clean_equities(
    df: DataFrame, policies=EQUITY_POLICIES, order=(ORD,), value=0, max_rows: int = SEGMENT_ROWS,
    for_storage: bool = False,
) -> DataFrame:
    """Equity bars: readable, positive, one row per (symbol, time), in that order."""
    typed = _typed_equities(df, policies, tuple(order), value, max_rows)
    # Separate conditions, so that each is pushed down on its own.
    passes = [~F.coalesce(test, F.lit(False)) for _, tests in _refusals() for test in tests]
    kept = dedupe_first(typed.filter(all_of(passes)), (SYMBOL, TIME), order)
    if for_storage:
        return kept.select(*EQUITY_FIELDS, *order)
    return sort_bars(kept.select(*EQUITY_FIELDS))


def equity_rejections(screened: DataFrame) -> DataFrame:
    """Rows per outcome of screened equities, counting later copies of a key as duplicates.

    Two aggregations instead of a rank per row: copies of one key are combined before the shuffle.
    """
    ok = F.col("reason").isNull()
    sizes = screened.groupBy(
        "reason", F.when(ok, F.col(SYMBOL)).alias("_s"), F.when(ok, F.col(TIME)).alias("_t")
    ).agg(F.count(F.lit(1)).alias("n"))
    outcome = F.expr(
        "stack(2, coalesce(reason, 'retained'), if(reason IS NULL, 1L, n),"
        " 'duplicate', if(reason IS NULL, n - 1, 0L)) AS (reason, n)"
    )
    return sizes.select(outcome).groupBy("reason").agg(F.sum("n").alias("rows")).filter(F.col("rows") > 0)
