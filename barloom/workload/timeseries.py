"""Rolls, gaps, calendars, chunks, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import adjust, calendars, combine, dedupe
from barloom.workload.registry import query, rounded

_BY_SERIES = "PARTITION BY series ORDER BY time, _ord"
_ROLLS = f"""marked AS (
    SELECT *, lag(symbol) OVER ({_BY_SERIES}) AS ps, lag(close) OVER ({_BY_SERIES}) AS pc, lag(volume) OVER ({_BY_SERIES}) AS pv
    FROM rolls),
  factors AS (
    SELECT *, coalesce(ps <> symbol AND volume > pv, false) AS is_roll,
           CASE WHEN ps <> symbol AND volume > pv THEN pc - open END AS roll_factor FROM marked)"""
_ADJUSTED = f"""WITH {_ROLLS}, shifted AS (
    SELECT *, coalesce(sum(roll_factor) OVER ({_BY_SERIES} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS shift FROM factors)
  SELECT series, _ord, time, symbol, round(open + shift, 6) AS open, round(high + shift, 6) AS high,
         round(low + shift, 6) AS low, round(close + shift, 6) AS close, volume FROM shifted"""
_ROLL_ROWS = f"""WITH {_ROLLS} SELECT series, _ord, time, symbol, open, high, low, close, volume, is_roll,
    round(roll_factor, 6) AS roll_factor FROM factors"""


@query(_ROLL_ROWS)
def roll_points(t):
    return rounded(adjust.roll_points(t.rolls(), "series"), "roll_factor")


@query(_ROLL_ROWS)
def roll_points_split(t):
    return rounded(adjust.roll_points(t.rolls(), "series", max_rows=5), "roll_factor")


@query(_ADJUSTED)
def back_adjust(t):
    return rounded(adjust.back_adjust(t.rolls(), "series"), "open", "high", "low", "close")


@query(_ADJUSTED)
def back_adjust_split(t):
    return rounded(adjust.back_adjust(t.rolls(), "series", max_rows=5), "open", "high", "low", "close")


# --- gaps --------------------------------------------------------------------------------------

_NEXT = "SELECT ts, lead(ts) OVER (ORDER BY ts) AS next_ts FROM events"


@query(f"SELECT count(*) FILTER (WHERE next_ts - ts > INTERVAL 60 SECOND) AS gap_count FROM ({_NEXT})")
def count_gaps(t):
    return calendars.count_gaps(t.read("events"), 60, time_col="ts")


@query(
    "SELECT symbol, count(*) FILTER (WHERE next_time - time > INTERVAL 3600 SECOND) AS gap_count FROM"
    " (SELECT symbol, time, lead(time) OVER (PARTITION BY symbol ORDER BY time) AS next_time FROM hours) GROUP BY symbol"
)
def count_gaps_per_symbol(t):
    return calendars.count_gaps(t.hours(), 3600, partition=["symbol"])


@query(
    "SELECT prev_time, cur_time FROM (SELECT lag(ts) OVER (ORDER BY ts) AS prev_time, ts AS cur_time FROM events)"
    " WHERE cur_time - prev_time > INTERVAL 20 MINUTE"
)
def list_gaps(t):
    return calendars.list_gaps(t.read("events"), 20 * 60, time_col="ts")


@query(
    "SELECT symbol, prev_time, cur_time FROM (SELECT symbol, lag(time) OVER (PARTITION BY symbol ORDER BY time) AS prev_time,"
    " time AS cur_time FROM user_days) WHERE cur_time - prev_time > INTERVAL 1 DAY"
)
def list_gaps_per_symbol(t):
    return calendars.list_gaps(t.user_days(), partition=["symbol"])


def _grid(view: str, step: str, where: str = "true") -> str:
    return (
        f"SELECT symbol, time FROM (SELECT symbol, unnest(generate_series(min(time), max(time), INTERVAL {step})) AS time"
        f" FROM {view} GROUP BY symbol) WHERE {where} EXCEPT SELECT symbol, time FROM {view}"
    )


@query(_grid("hours", "1 HOUR"))
def missing_hours(t):
    return calendars.missing_timestamps(t.hours(), "H")


@query(_grid("user_days", "1 DAY"))
def missing_days(t):
    return calendars.missing_timestamps(t.user_days(), "D")


@query(_grid("user_days", "1 DAY", "isodow(time) <= 5"))
def missing_business_days(t):
    return calendars.missing_timestamps(t.user_days(), "B")


@query(
    "SELECT symbol, count(*) AS missing FROM (" + _grid("hours", "1 MINUTE") + ") GROUP BY symbol"
)
def missing_minutes_per_symbol(t):
    return calendars.missing_timestamps(t.hours(), "min").groupBy("symbol").agg(F.count(F.lit(1)).alias("missing"))


@query("SELECT symbol, unnest(generate_series(min(time), max(time), INTERVAL 1 DAY)) AS time FROM user_days GROUP BY symbol")
def calendar_days(t):
    return calendars.calendar(t.user_days(), "D")


@query(
    "SELECT symbol, time FROM (SELECT symbol, unnest(generate_series(min(time), max(time), INTERVAL 1 DAY)) AS time"
    " FROM user_days GROUP BY symbol) WHERE isodow(time) <= 5"
)
def calendar_business_days(t):
    return calendars.calendar(t.user_days(), "B")


# --- chunks and ranges -------------------------------------------------------------------------

_CHUNKS = """WITH spans AS (SELECT symbol, min(time) AS s, max(time) AS e FROM {view} GROUP BY symbol),
  cut AS (SELECT symbol, e, unnest(generate_series(s, e - INTERVAL 1 MICROSECOND, INTERVAL {step})) AS chunk_start FROM spans WHERE s < e)
  SELECT symbol, chunk_start, least(chunk_start + INTERVAL {step}, e) AS chunk_end,
         strftime(chunk_start, '{fmt}') AS start_text, strftime(least(chunk_start + INTERVAL {step}, e), '{fmt}') AS end_text
  FROM cut"""


def _spans(df):
    return df.groupBy("symbol").agg(F.min("time").alias("start"), F.max("time").alias("end"))


@query(_CHUNKS.format(view="user_days", step="7 DAY", fmt="%Y-%m-%d"))
def chunk_ranges_daily(t):
    return calendars.chunk_ranges(_spans(t.user_days()), "Daily", 7).drop("start", "end")


@query(_CHUNKS.format(view="hours", step="36 HOUR", fmt="%Y-%m-%d %H:%M:%S"))
def chunk_ranges_hourly(t):
    return calendars.chunk_ranges(_spans(t.hours()), "hourly", 36).drop("start", "end")


@query(
    "SELECT CAST(CAST(max(time) AS DATE) + 1 AS VARCHAR) AS start_date, '2024-03-09' AS end_date FROM bars"
)
def resolve_range(t):
    return _as_text(calendars.resolve_range(t.bars(), seed="2020-01-01", today="2024-03-10"))


@query("SELECT CAST(least(CAST(max(time) AS DATE) + 1, DATE '2024-01-15') AS VARCHAR) AS start_date, '2024-01-15' AS end_date FROM bars")
def resolve_range_clamped(t):
    return _as_text(calendars.resolve_range(t.bars(), end="2024-01-15", today="2024-03-10"))


@query(
    "SELECT s.symbol, CAST(least(coalesce(CAST(max(d.time) AS DATE) + 1, DATE '2020-01-01'), DATE '2024-01-29') AS VARCHAR) AS start_date,"
    " '2024-01-29' AS end_date FROM (SELECT DISTINCT concat('U', c_custkey) AS symbol FROM customer) s"
    " LEFT JOIN user_days d ON s.symbol = d.symbol GROUP BY s.symbol"
)
def resolve_range_per_symbol(t):
    universe = t.read("customer").select(F.concat(F.lit("U"), F.col("c_custkey")).alias("symbol"))
    return _as_text(
        calendars.resolve_range_per_symbol(universe, t.user_days(), seed="2020-01-01", today="2024-01-30")
    )


def _as_text(df):
    return df.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


# --- joins and sets ----------------------------------------------------------------------------

@query(
    "SELECT symbol, time FROM user_days u WHERE NOT EXISTS"
    " (SELECT 1 FROM bars b WHERE b.time = u.time AND b.symbol = u.symbol)"
)
def anti_times(t):
    return combine.anti_times(t.user_days(), t.bars())


@query(
    "SELECT h.symbol, h.time, h.close FROM hour_bars h WHERE NOT EXISTS"
    " (SELECT 1 FROM bars b WHERE b.symbol = h.symbol AND b.time = h.time)"
)
def new_keys(t):
    return dedupe.new_keys(t.bars("hour").select("symbol", "time", "close"), t.bars())


@query(
    """WITH span AS (SELECT min(time) AS s, max(time) AS e FROM bars),
    chunks AS (SELECT unnest(generate_series(s, e - INTERVAL 1 MICROSECOND, INTERVAL 10 DAY)) AS chunk_start, e FROM span)
    SELECT u.symbol, chunk_start, least(chunk_start + INTERVAL 10 DAY, e) AS chunk_end
    FROM (SELECT DISTINCT symbol FROM user_days) u, chunks"""
)
def fan_out(t):
    span = combine.time_span(t.bars()).first()
    return calendars.fan_out(t.user_days().select("symbol").distinct(), span.start, span.end, "daily", 10)


@query("SELECT * FROM user_days WHERE symbol IN (SELECT concat('U', s_suppkey) FROM supplier)")
def only_universe(t):
    universe = t.read("supplier").select(F.concat(F.lit("U"), F.col("s_suppkey")).alias("symbol"))
    return combine.only_universe(t.user_days(), universe)


@query(
    "SELECT u.symbol, u.time, c_mktsegment AS instrumentType FROM user_days u"
    " LEFT JOIN (SELECT concat('U', c_custkey) AS symbol, c_mktsegment FROM customer) c ON u.symbol = c.symbol"
)
def attach_type(t):
    universe = t.read("customer").select(
        F.concat(F.lit("U"), F.col("c_custkey")).alias("symbol"), F.col("c_mktsegment").alias("instrumentType")
    )
    return combine.attach_type(t.user_days(), universe)


@query(
    "SELECT _ord, symbol, time, close, volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol, time ORDER BY _ord) AS rn"
    " FROM dirty) WHERE rn = 1"
)
def dedupe_first(t):
    return dedupe.dedupe_first(t.dirty())


@query(
    """WITH lists AS (
      SELECT replace(n_name, '_', '.') AS name, 0 AS priority, CAST(n_nationkey AS BIGINT) AS pos FROM nation
      UNION ALL SELECT s_name, 1, s_suppkey FROM supplier
      UNION ALL SELECT CASE WHEN c_custkey % 10 = 0 THEN ' ' WHEN c_custkey % 3 = 0 THEN concat(' nation.', c_custkey, ' ')
                       ELSE c_name END, 2, c_custkey FROM customer),
    ranked AS (SELECT replace(upper(trim(name)), '.', '-') AS ticker, priority, pos FROM lists)
    SELECT ticker, priority, pos FROM (
      SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY priority, pos) AS rn FROM ranked WHERE ticker <> '') WHERE rn = 1"""
)
def priority_union(t):
    return combine.priority_union(ticker_lists(t))


def ticker_lists(t):
    """Three ranked lists that overlap once spelled alike."""
    return [
        t.read("nation").selectExpr("replace(n_name, '_', '.') AS ticker", "n_nationkey AS pos"),
        t.read("supplier").selectExpr("s_name AS ticker", "s_suppkey AS pos"),
        t.read("customer").selectExpr(
            "CASE WHEN c_custkey % 10 = 0 THEN ' ' WHEN c_custkey % 3 = 0 THEN concat(' nation.', c_custkey, ' ')"
            " ELSE c_name END AS ticker", "c_custkey AS pos",
        ),
    ]


@query(
    "SELECT symbol, time, arg_min(close, o) AS close FROM ("
    "SELECT symbol, time, close, 0 AS o FROM bars WHERE time <= TIMESTAMP '2024-01-15'"
    " UNION ALL SELECT symbol, time, close, 1 AS o FROM bars WHERE time >= TIMESTAMP '2024-01-15') GROUP BY symbol, time"
)
def union_chunks(t):
    bars = t.bars().select("symbol", "time", "close")
    first = bars.filter("time <= '2024-01-15'").withColumn("o", F.lit(0))
    second = bars.filter("time >= '2024-01-15'").withColumn("o", F.lit(1)).select("o", "close", "time", "symbol")
    return combine.union_chunks([first, second], order=("o",)).select("symbol", "time", "close")


@query("SELECT symbol, time FROM hours EXCEPT SELECT symbol, time FROM bars")
def difference(t):
    return combine.difference(t.hours(), t.bars())


@query(
    "SELECT DISTINCT c_name AS \"dataSymbol\" FROM customer WHERE replace(c_name, 'Customer', 'Supplier') NOT IN"
    " (SELECT s_name FROM supplier)"
)
def missing_baseline(t):
    universe = t.read("supplier").selectExpr("replace(s_name, 'Supplier', 'Customer') AS dataSymbol")
    baseline = t.read("customer").selectExpr("c_name AS dataSymbol")
    return combine.missing_baseline(universe, baseline)
