"""Calendars, missing timestamps, gaps, chunking and range resolution."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.times import micros
from barloom.operators.series import SEGMENT_ROWS, arrange, match_keys, neighbour
from barloom.schemas import SYMBOL, TIME

#: Frequency -> step inside a day; days themselves are generated first.
_STEPS = {"D": None, "B": None, "H": "INTERVAL 1 HOUR", "MIN": "INTERVAL 1 MINUTE"}
_UNITS = {"daily": "DAY", "hourly": "HOUR", "min": "MINUTE"}
_CELLS_PER_BLOCK = 1 << 20
#: Seconds between two calendar times, and how many are generated in one array.
_WIDTHS = {"D": 86_400, "B": 86_400, "H": 3_600, "MIN": 60}
_GENERATED = 4096


def expand_calendar(spans: DataFrame, freq: str, start: str = "start", end: str = "end", out: str = TIME) -> DataFrame:
    """Every time from ``start`` to ``end`` (inclusive) of each row at ``freq``: D, B, H or min.

    Times are anchored at ``start``. Days are generated first and divided afterwards, so no array
    is longer than the number of days or the steps of one day.
    """
    step = freq.upper()
    if step not in _STEPS:
        raise ValueError(f"unsupported frequency: {freq}")
    rest = [c for c in spans.columns if c not in (start, end)]
    spans = spans.filter(F.col(start) <= F.col(end)).withColumns(
        {start: F.col(start).cast("timestamp"), end: F.col(end).cast("timestamp")}
    )
    days = spans.select(
        *rest, end, F.explode(F.expr(f"sequence(`{start}`, greatest(`{start}`, `{end}`), INTERVAL 1 DAY)")).alias("_day")
    )
    if step == "B":
        days = days.filter(F.weekday("_day") < 5)
    if _STEPS[step] is None:
        return days.select(*rest, F.col("_day").alias(out))
    within = F.expr(
        f"sequence(_day, least(_day + INTERVAL 1 DAY - {_STEPS[step]}, `{end}`), {_STEPS[step]})"
    )
    return days.select(*rest, F.explode(within).alias(out))


def calendar(bars: DataFrame, freq: str, keys=(SYMBOL,), time_col: str = TIME) -> DataFrame:
    """Complete calendar of each series, from its first to its last time."""
    bounds = [F.min(time_col).alias("start"), F.max(time_col).alias("end")]
    return expand_calendar(bars.groupBy(*keys).agg(*bounds), freq, out=time_col)


def missing_timestamps(
    bars: DataFrame, freq: str = "D", keys=(SYMBOL,), time_col: str = TIME, max_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Calendar times without a bar, per series. ``B`` knows weekends but no holidays.

    No calendar is built: bars on the grid of their series (from its first time, by the step) are made distinct, each looks up the next, and
    only what lies between two of them, or after the last, is generated. The work follows the bars and what is missing. The
    look-up runs over segments, so a series that holds most bars is spread.
    """
    if time_col not in bars.columns:
        raise ValueError(f"time column not found: {time_col}")
    if freq.upper() not in _WIDTHS:
        raise ValueError(f"unsupported frequency: {freq}")
    width, names = _WIDTHS[freq.upper()] * 1_000_000, {k: f"_key{i}" for i, k in enumerate(keys)}
    stamped = bars.select(*[F.col(k).alias(v) for k, v in names.items()], micros(F.col(time_col).cast("timestamp")).alias("_t")).filter(F.col("_t").isNotNull())
    spans = stamped.groupBy(*[F.col(v).alias(f"_s{v}") for v in names.values()]).agg(F.min("_t").alias("_from"), F.max("_t").alias("_to"))
    placed = stamped.distinct().join(spans, match_keys({v: f"_s{v}" for v in names.values()})).withColumn("_off", F.col("_t") - F.col("_from"))
    slots = placed.filter(F.expr(f"_off % {width}L = 0")).select(*names.values(), "_from", "_to", F.expr(f"_off div {width}L").alias("_slot"))
    ahead = neighbour(arrange(slots, list(names.values()), ["_slot"], max_rows), {"_next": F.col("_slot")}, reverse=True).rows()
    last = F.expr(f"(_to - _from) div {width}L")
    gaps = ahead.select(*names.values(), "_from", (F.col("_slot") + 1).alias("_lo"), (F.coalesce(F.col("_next"), last + 1) - 1).alias("_hi")).filter("_lo <= _hi")
    # Long gaps are cut first, so that no array is long.
    cut = gaps.withColumn("_lo", F.explode(F.expr(f"sequence(_lo, _hi, {_GENERATED}L)")))
    absent = cut.withColumn("_slot", F.explode(F.expr(f"sequence(_lo, least(_hi, _lo + {_GENERATED - 1}L))")))
    times = absent.select(*[F.col(v).alias(k) for k, v in names.items()], F.timestamp_micros(F.col("_from") + F.col("_slot") * width).alias(time_col))
    return times.filter(F.weekday(time_col) < 5) if freq.upper() == "B" else times


def with_gap_report(bars: DataFrame, freq: str = "D", keys=(SYMBOL,), time_col: str = TIME):
    """The bars, unchanged, together with their missing timestamps."""
    return bars, missing_timestamps(bars, freq, keys, time_col)


def _steps(df: DataFrame, seconds: float, partition, time_col: str) -> DataFrame:
    """All pairs of consecutive times that can be further apart than ``seconds``.

    Time is cut into cells as wide as the threshold. Two times in one cell are closer than that, so
    only the step from the last time of a cell to the first of the next occupied cell matters. The
    cells are aggregated before any shuffle and there are no more of them than the calendar has
    room for, however many rows there are. Levels of blocks, as many as times can span, keep each ordered pass short.
    """
    width = int(round(seconds * 1_000_000))
    if width <= 0:
        raise ValueError("the gap threshold must be positive")
    by = list(partition or [])
    at = df.select(*by, F.col(time_col).cast("timestamp").alias("_t")).filter(F.col("_t").isNotNull())
    cells = (
        at.withColumn("_m", micros(F.col("_t")))
        .withColumn("_cell", F.expr(f"(_m - pmod(_m, {width}L)) div {width}L"))
        .groupBy(*by, "_cell")
        .agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
        .withColumn("_block", F.expr(f"(_cell - pmod(_cell, {_CELLS_PER_BLOCK}L)) div {_CELLS_PER_BLOCK}L"))
    )
    pair = lambda rows, w: rows.select(*by, F.lag("_hi").over(w).alias("prev_time"), F.col("_lo").alias("cur_time"))
    steps = pair(cells, Window.partitionBy(*by, "_block").orderBy("_cell"))
    # The range of times is less than 2**64 microseconds, so after so many levels one block is left.
    levels = math.ceil((64 - math.log2(width)) / math.log2(_CELLS_PER_BLOCK))
    for _ in range(max(1, levels) - 1):
        cells = (
            cells.groupBy(*by, F.col("_block").alias("_cell"))
            .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
            .withColumn("_block", F.expr(f"(_cell - pmod(_cell, {_CELLS_PER_BLOCK}L)) div {_CELLS_PER_BLOCK}L"))
        )
        steps = steps.unionByName(pair(cells, Window.partitionBy(*by, "_block").orderBy("_cell")))
    blocks = cells.groupBy(*by, "_block").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    return steps.unionByName(pair(blocks, Window.partitionBy(*by).orderBy("_block")))


def _is_gap(seconds: float):
    width = int(round(seconds * 1_000_000))
    return micros(F.col("cur_time")) - micros(F.col("prev_time")) > F.lit(width)


def count_gaps(df: DataFrame, seconds: float = 60, partition=None, time_col: str = TIME) -> DataFrame:
    """How many rows are followed by one more than ``seconds`` later (per ``partition``, if any)."""
    steps = _steps(df, seconds, partition, time_col)
    return steps.groupBy(*(partition or [])).agg(F.count_if(_is_gap(seconds)).alias("gap_count"))


def list_gaps(df: DataFrame, seconds: float = 86_400, partition=None, time_col: str = TIME) -> DataFrame:
    """Consecutive times more than ``seconds`` apart, as ``prev_time`` and ``cur_time``."""
    return _steps(df, seconds, partition, time_col).filter(_is_gap(seconds))


def chunk_ranges(spans: DataFrame, unit: str, n: int, start: str = "start", end: str = "end") -> DataFrame:
    """Cut each row's range into contiguous chunks of ``n`` units, the last one clipped.

    Adds ``chunk_start`` and ``chunk_end`` (timestamps) and their text form: a date for daily chunks,
    date and time otherwise. A range that is empty or inverted has no chunks.
    """
    if not isinstance(unit, str) or unit.lower() not in _UNITS:
        raise ValueError(f"unsupported time unit: {unit}")
    if type(n) is not int:
        raise TypeError("the number of units per chunk must be an integer")
    if n < 1:
        raise ValueError("the number of units per chunk must be positive")
    step = f"INTERVAL {n} {_UNITS[unit.lower()]}"
    shape = "yyyy-MM-dd" if unit.lower() == "daily" else "yyyy-MM-dd HH:mm:ss"
    ranges = spans.withColumns({start: F.col(start).cast("timestamp"), end: F.col(end).cast("timestamp")})
    return (
        ranges.filter(F.col(start) < F.col(end))
        .withColumn(
            # greatest(): folded constants reach sequence() even where the filter leaves no rows.
            "chunk_start",
            F.explode(
                F.expr(f"sequence(`{start}`, greatest(`{start}`, `{end}` - INTERVAL 1 MICROSECOND), {step})")
            ),
        )
        .withColumn("chunk_end", F.expr(f"least(chunk_start + {step}, `{end}`)"))
        .withColumn("start_text", F.date_format("chunk_start", shape))
        .withColumn("end_text", F.date_format("chunk_end", shape))
    )


def time_chunks(spark, start, end, unit: str, n: int) -> DataFrame:
    """Chunks of one range."""
    one = spark.range(1).select(F.lit(start).cast("timestamp").alias("start"), F.lit(end).cast("timestamp").alias("end"))
    return chunk_ranges(one, unit, n).select("chunk_start", "chunk_end", "start_text", "end_text")


def fan_out(universe: DataFrame, start, end, unit: str, n: int) -> DataFrame:
    """One row per symbol and chunk of the range: the units of work of a backfill.

    Each symbol's row is exploded in place, so neither a cross join nor a list of chunks is needed.
    """
    spans = universe.withColumns({"_start": F.lit(start).cast("timestamp"), "_end": F.lit(end).cast("timestamp")})
    return chunk_ranges(spans, unit, n, "_start", "_end").select(*universe.columns, "chunk_start", "chunk_end")


def _day(value):
    """A date literal; empty text counts as not given."""
    return F.lit(value or None).cast("date")


def resolve_range(bars: DataFrame | None, start=None, end=None, seed=None, today=None) -> DataFrame:
    """The load range as one row (``start_date``, ``end_date``); ``start_date`` is NULL if unknown.

    Start: as given (the table is not read then), else the day after the latest stored one, else the
    seed. End: as given, else the day before ``today``. A start past the end is pulled back to it.
    """
    now = _day(today) if today else F.current_date()
    last = F.coalesce(_day(end), F.date_sub(now, 1))
    if bars is None and not start:
        raise ValueError("without stored bars a start is needed")
    if start:
        one = SparkSession.active().range(1)
        first = _day(start)
        return one.select(F.least(first, last).alias("start_date"), last.alias("end_date"))
    first = F.coalesce(F.date_add(F.to_date("_latest"), 1), _day(seed))
    # least() skips NULLs, so an unknown start needs its own branch.
    begin = F.when(first.isNotNull(), F.least(first, last))
    latest = bars.agg(F.max(TIME).alias("_latest"))
    return latest.select(begin.alias("start_date"), last.alias("end_date"))


def range_bounds(bars: DataFrame, start=None, end=None, seed=None, today=None):
    """``resolve_range`` as a pair of dates; an unknown start is an error."""
    row = resolve_range(bars, start, end, seed, today).first()
    if row.start_date is None:
        raise ValueError("cannot determine the start date: none given, no stored rows and no seed")
    return row.start_date, row.end_date


def resolve_range_per_symbol(
    universe: DataFrame, bars: DataFrame, end=None, seed=None, today=None
) -> DataFrame:
    """The load range of each symbol from its own latest bar, so that nobody's missed days are skipped."""
    return resolve_range_from(universe, bars.groupBy(SYMBOL).agg(F.max(TIME).alias("latest")), end, seed, today)


def resolve_range_from(universe: DataFrame, latest: DataFrame, end=None, seed=None, today=None) -> DataFrame:
    """The same from each symbol's ``latest`` time, which a stored table has in its marks (``latest_per_symbol``)."""
    now = _day(today) if today else F.current_date()
    last = F.coalesce(_day(end), F.date_sub(now, 1))
    first = F.coalesce(F.date_add(F.to_date("latest"), 1), _day(seed))
    begin = F.when(first.isNotNull(), F.least(first, last))
    return (
        universe.select(SYMBOL).distinct().join(latest, SYMBOL, "left")
        .select(SYMBOL, begin.alias("start_date"), last.alias("end_date"))
    )
