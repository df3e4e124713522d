"""Volume-roll detection and back-adjustment of futures prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.numbers import without_nan
from barloom.operators.series import SEGMENT_ROWS, Series, arrange, neighbour, running_sum
from barloom.schemas import OHLC, ORD, SYMBOL, TIME

_BEFORE = "_before"
_EXACT = "decimal(38,15)"


def roll_points(
    df: DataFrame, series: str, order=(TIME, ORD), contract: str = SYMBOL, max_rows=SEGMENT_ROWS
) -> DataFrame:
    """Add ``is_roll`` and ``roll_factor`` (previous close minus new open, on roll rows only).

    A row is a roll when its contract differs from the row before it in the series and it trades
    strictly more volume.
    """
    marked = _mark_rolls(arrange(df, [series], order, max_rows), contract)
    return marked.with_columns({"roll_factor": without_nan(F.col("roll_factor"))}).rows()


def back_adjust(
    df: DataFrame, series: str, order=(TIME, ORD), contract: str = SYMBOL, max_rows=SEGMENT_ROWS
) -> DataFrame:
    """Shift each row's prices by the factors of all rolls strictly after it; volume is untouched.

    A roll without a factor (missing price) leaves every earlier adjusted price missing.
    """
    marked = _mark_rolls(arrange(df, [series], order, max_rows), contract).settled()
    # Decimals add up to the same sum in any grouping, so segments do not show in the prices.
    factor = F.col("roll_factor")
    sums = {
        "_shift": F.coalesce(F.nanvl(factor, F.lit(0.0)).cast(_EXACT), F.lit(0).cast(_EXACT)),
        "_unknown": F.coalesce(F.isnan(factor), F.lit(False)).cast("bigint"),
    }
    shifted = running_sum(marked, sums, reverse=True, inclusive=False)
    shift = F.when(F.col("_unknown") == 0, F.col("_shift").cast("double"))
    prices = {c: without_nan(F.col(c) + shift) for c in OHLC}
    return shifted.with_columns(prices).without("_shift", "_unknown", "is_roll", "roll_factor").rows()


def _mark_rolls(s: Series, contract: str) -> Series:
    seen = F.struct(F.col(contract).alias("contract"), "close", "volume")
    s = neighbour(s, {_BEFORE: seen})
    before = F.col(_BEFORE)
    changed = before.isNotNull() & ~F.col(contract).eqNullSafe(before["contract"])
    is_roll = F.coalesce(changed & (F.col("volume") > before["volume"]), F.lit(False))
    # NaN, not NULL, marks an unknown factor: sums keep it, while they would skip a NULL.
    factor = F.when(is_roll, F.coalesce(before["close"] - F.col("open"), F.lit(float("nan"))))
    return s.with_columns({"is_roll": is_roll, "roll_factor": factor}).without(_BEFORE)
