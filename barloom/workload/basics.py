"""Filters, ordering, projections, coercion and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import aggregates, ordering, predicates, project
from barloom.plans import equity_rejections, get_bars, screen_equities
from barloom.schemas import EQUITY_FIELDS, FUTURES_FIELDS
from barloom.workload.registry import query, rounded

BAR = "time, symbol, open, high, low, close, volume"


# --- filters -----------------------------------------------------------------------------------

@query(f"SELECT {BAR} FROM bars WHERE time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'")
def filter_in_range(t):
    return t.bars().filter(predicates.in_range("2024-01-05", "2024-01-20")).select(*FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM bars WHERE symbol IN ('click', 'view')")
def filter_symbol_in(t):
    return predicates.with_symbols(t.bars(), ["click", "view"]).select(*FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM bars")
def filter_symbol_in_empty(t):
    return predicates.with_symbols(t.bars(), []).select(*FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM bars WHERE symbol = 'purchase'")
def filter_for_symbol(t):
    return predicates.for_symbol(t.bars(), "purchase").select(*FUTURES_FIELDS)


@query("SELECT * FROM dirty WHERE NOT (coalesce(close <= 0, false) OR coalesce(volume < 0, false))")
def filter_drop_corrupt(t):
    return predicates.drop_corrupt(t.dirty(), prices=["close"])


_PRICES = ["open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adjusted_close"]


@query(
    "SELECT _ord FROM equities WHERE NOT (" + " OR ".join(f"coalesce(TRY_CAST({p} AS DOUBLE) <= 0, false)" for p in _PRICES)
    + " OR coalesce(TRY_CAST(volume AS DOUBLE) < 0, false))"
)
def filter_drop_corrupt_all_prices(t):
    return predicates.drop_corrupt(t.equities()).select("_ord")


@query("SELECT * FROM dirty WHERE time IS NOT NULL AND symbol IS NOT NULL")
def filter_drop_unkeyed(t):
    return predicates.drop_unkeyed(t.dirty())


@query(
    "SELECT * FROM dirty WHERE time >= TIMESTAMP '2024-01-05'"
    " AND time < CAST(DATE '2024-01-10' + INTERVAL 1 DAY AS TIMESTAMP)"
)
def filter_in_day_range(t):
    return t.dirty().filter(predicates.in_day_range("2024-01-05", "2024-01-10"))


@query("SELECT * FROM dirty WHERE close IS NULL")
def filter_missing_close(t):
    return predicates.missing_close(t.dirty())


# --- ordering ----------------------------------------------------------------------------------

@query(f"SELECT {BAR} FROM bars ORDER BY symbol, time")
def sort_symbol_time(t):
    return ordering.sort_bars(t.bars()).select(*FUTURES_FIELDS)


@query("SELECT * FROM dirty ORDER BY time, _ord")
def sort_time(t):
    return ordering.sort_time(t.dirty())


@query(f"SELECT {BAR} FROM bars ORDER BY time DESC, symbol LIMIT 10")
def latest_rows(t):
    return ordering.latest_rows(t.bars(), 10).select(*FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM bars WHERE symbol = 'view' ORDER BY time DESC LIMIT 1")
def latest_bar(t):
    return ordering.latest_bar(t.bars(), "view").select(*FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM bars WHERE symbol = 'view' ORDER BY time LIMIT 1")
def earliest_bar(t):
    return ordering.earliest_bar(t.bars(), "view").select(*FUTURES_FIELDS)


_END_BAR = """SELECT _ord, symbol, time, close, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time {0}, _ord {0}) AS rn
    FROM dirty WHERE time IS NOT NULL) WHERE rn = 1"""


@query(_END_BAR.format("DESC"))
def latest_bar_per_symbol(t):
    return ordering.latest_bar_per_symbol(t.dirty())


@query(_END_BAR.format("ASC"))
def earliest_bar_per_symbol(t):
    return ordering.earliest_bar_per_symbol(t.dirty())


@query("SELECT least(10, count(*)) AS rows, least(10, count(*)) AS stored FROM bars")
def head_rows(t):
    """Which rows come is open: that there are so many, and that all are rows of the table."""
    head = ordering.head_rows(t.bars(), 10)
    counted = lambda df, inside: df.select(F.lit(1 - inside).alias("r"), F.lit(inside).alias("s"))
    both = counted(head, 0).unionByName(counted(head.intersectAll(t.bars()), 1))
    return both.agg(F.sum("r").alias("rows"), F.sum("s").alias("stored"))


@query("SELECT ts FROM events ORDER BY ts")
def scan_times(t):
    return ordering.scan_times(t.read("events"), "ts")


@query(
    f"SELECT {BAR} FROM bars WHERE time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'"
    " AND symbol IN ('click', 'error') ORDER BY symbol, time"
)
def bars_between(t):
    return get_bars(t.bars(), "2024-01-03", "2024-01-25", ["click", "error"]).select(*FUTURES_FIELDS)


# --- projections and coercion ------------------------------------------------------------------

@query("SELECT series, symbol, ts_event AS time, high, low, open, close, volume, 1 AS publisher, _ord FROM landed_futures")
def normalize_time_column(t):
    return project.normalize_time_column(t.landed_futures())


@query("SELECT time, symbol, close AS adjusted_close, volume AS adj_volume, open AS adj_open FROM bars")
def rename_fields(t):
    landed = t.bars().selectExpr("time AS date", "symbol", "close AS adjClose", "volume AS adjVolume", "open AS adjOpen")
    return project.rename_fields(landed)


@query("SELECT series, symbol, ts_event AS time, high, low, open, close, volume, 1 AS publisher, _ord FROM landed_futures")
def require_fields(t):
    return project.require_fields(project.normalize_time_column(t.landed_futures()))


@query(f"SELECT {', '.join(EQUITY_FIELDS)} FROM equities")
def require_and_slice(t):
    return project.require_and_slice(t.equities())


@query("SELECT symbol, high, low, open, close, volume FROM landed_futures")
def keep_columns(t):
    return project.keep_columns(t.landed_futures())


@query(
    "SELECT symbol, time, CAST(CAST(open AS VARCHAR) AS DOUBLE) AS open, high, low, close,"
    " CAST(CAST(volume AS VARCHAR) AS BIGINT) AS volume FROM bars"
)
def coerce_strict(t):
    as_text = t.bars().withColumns({c: F.col(c).cast("string") for c in ("open", "volume")})
    return project.coerce_strict(as_text)


@query(
    "SELECT * FROM (SELECT _ord, symbol, time, TRY_CAST(close AS DOUBLE) AS close,"
    " CAST(trunc(TRY_CAST(volume AS DOUBLE)) AS BIGINT) AS volume FROM texts) WHERE volume IS NOT NULL"
)
def coerce_lenient(t):
    return project.coerce_lenient(t.texts(), floats=["close"])


@query("SELECT event_id, strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS time FROM events")
def to_utc(t):
    naive = t.read("events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"))
    return project.to_utc(naive)


@query("SELECT event_id, date_trunc('second', ts) + INTERVAL 5 HOUR AS time FROM events")
def to_utc_from_zone(t):
    # January has no daylight saving in New York, so the zone is five hours behind throughout.
    local = t.read("events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"))
    return project.to_utc(local, tz="America/New_York")


@query(
    "SELECT _ord, symbol, strptime(time, '%Y-%m-%dT%H:%M:%S.000Z') AS time, close, volume"
    " FROM texts WHERE time <> 'not a time'"
)
def parse_time_lenient(t):
    return project.parse_time_lenient(t.texts())


@query(
    "SELECT base, upper(instrumentType) AS kind, CASE WHEN upper(instrumentType) = 'FUTURE' THEN"
    " concat(CASE base WHEN 'ES' THEN 'MES' WHEN 'NQ' THEN 'MNQ' WHEN 'RTY' THEN 'M2K' WHEN 'YM' THEN 'MYM' ELSE base END, '.v.0')"
    " WHEN upper(instrumentType) = 'EQUITY' THEN base END AS symbol FROM contracts"
)
def canonical_symbol(t):
    listed = t.contracts().select("base", F.upper("instrumentType").alias("kind"))
    return project.canonical_symbol(listed, "v", 0, symbol="base", kind="kind")


_TYPED = "(SELECT _ord, upper(instrumentType) AS kind FROM contracts)"


@query(f"SELECT _ord, kind FROM {_TYPED} WHERE kind = 'FUTURE'")
def asset_type_accepted(t):
    listed = t.contracts().select("_ord", F.upper("instrumentType").alias("kind"))
    return project.check_asset_type(listed, "FUTURE", "kind")[0]


@query(
    f"SELECT _ord, kind, concat('listed as ', kind, ', loading FUTURE') AS reason FROM {_TYPED} WHERE kind <> 'FUTURE'"
)
def asset_type_refused(t):
    listed = t.contracts().select("_ord", F.upper("instrumentType").alias("kind"))
    return project.check_asset_type(listed, "FUTURE", "kind")[1]


@query("SELECT _ord, upper(trim(symbol)) AS symbol, time, close, volume FROM dirty")
def normalize_symbol(t):
    return project.normalize_symbol(t.dirty())


@query(
    "SELECT dataSymbol, instrumentType FROM (SELECT trim(dataSymbol) AS dataSymbol, upper(instrumentType) AS instrumentType,"
    " row_number() OVER (PARTITION BY trim(dataSymbol) ORDER BY _ord DESC) AS rn FROM contracts) WHERE rn = 1"
)
def normalize_contracts(t):
    return project.normalize_contracts(t.contracts())


@query("SELECT c_custkey, replace(upper(trim(replace(concat(' ', c_name, ' '), '#', '.'))), '.', '-') AS ticker FROM customer")
def normalize_ticker(t):
    dotted = t.read("customer").selectExpr("c_custkey", "replace(concat(' ', c_name, ' '), '#', '.') AS ticker")
    return project.normalize_ticker(dotted)


# --- aggregations ------------------------------------------------------------------------------

@query("SELECT strftime(max(time), '%Y-%m-%d') AS latest_date FROM bars")
def latest_date(t):
    return aggregates.latest_date(t.bars())


@query("SELECT strftime(min(time), '%Y-%m-%d') AS earliest_date FROM bars")
def earliest_date(t):
    return aggregates.earliest_date(t.bars())


@query("SELECT count(*) AS rows FROM bars")
def row_count(t):
    return aggregates.row_count(t.bars())


@query(
    "SELECT count(DISTINCT symbol) AS symbols, count(*) AS rows, strftime(min(time), '%Y-%m-%d') AS first_day,"
    " strftime(max(time), '%Y-%m-%d') AS last_day FROM dirty"
)
def coverage(t):
    return aggregates.coverage(t.dirty())


@query("SELECT date_trunc('month', time) AS month, round(avg(close), 6) AS avg_close FROM bars GROUP BY 1 ORDER BY 1")
def monthly_avg_close(t):
    return rounded(aggregates.monthly_avg_close(t.bars()), "avg_close")


@query(
    "SELECT date_trunc('month', o_orderdate) AS month, round(avg(o_totalprice), 4) AS avg_close FROM orders GROUP BY 1 ORDER BY 1"
)
def monthly_avg_close_orders(t):
    bars = t.read("orders").selectExpr("o_orderdate AS time", "o_totalprice AS close")
    return rounded(aggregates.monthly_avg_close(bars), "avg_close", places=4)


@query("SELECT DISTINCT symbol FROM dirty")
def distinct_symbols(t):
    return aggregates.distinct_symbols(t.dirty())


@query("SELECT count(*) FILTER (WHERE time IS NULL OR volume IS NULL) AS null_count FROM dirty")
def null_count(t):
    return aggregates.null_count(t.dirty(), ["time", "volume"])


@query("SELECT count(*) FILTER (WHERE volume = 0) AS zero_count FROM dirty")
def zero_count(t):
    return aggregates.zero_count(t.dirty(), "volume")


@query(
    "SELECT symbol, round(avg(close), 6) AS close_mean, round(avg(volume), 6) AS volume_mean,"
    " round(median(close), 6) AS close_median, round(median(volume), 6) AS volume_median FROM dirty GROUP BY symbol"
)
def column_stats(t):
    stats = aggregates.column_stats(t.dirty(), ["close", "volume"], ["symbol"])
    return rounded(stats, "close_mean", "volume_mean", "close_median", "volume_median")


@query(
    "SELECT symbol, round(median(close), 6) AS close_median, round(median(volume), 6) AS volume_median"
    " FROM dirty GROUP BY symbol"
)
def column_medians_split(t):
    """The medians alone."""
    stats = aggregates.column_stats(t.dirty(), ["close", "volume"], ["symbol"], ("median",))
    return rounded(stats, "close_median", "volume_median")


@query("SELECT symbol, time, count(*) AS copies FROM dirty GROUP BY symbol, time HAVING count(*) > 1")
def duplicate_times(t):
    return aggregates.duplicate_times(t.dirty(), ["symbol"])


_SCREENED = """screened AS (
    SELECT upper(trim(symbol)) AS key, TRY_CAST(time AS TIMESTAMP) AS stamp, _ord,
           CASE WHEN time IS NULL OR symbol IS NULL THEN 'unkeyed'
                WHEN coalesce(close <= 0, false) OR open <= 0 OR high <= 0 OR low <= 0 OR adj_open <= 0 OR adj_high <= 0
                     OR adj_low <= 0 OR adjusted_close <= 0 OR coalesce(TRY_CAST(volume AS DOUBLE) < 0, false) THEN 'corrupt'
                WHEN time = 'not a time' THEN 'bad time'
                WHEN TRY_CAST(volume AS DOUBLE) IS NULL THEN 'bad volume' END AS reason
    FROM equities)"""


@query(
    f"WITH {_SCREENED} SELECT coalesce(reason, CASE WHEN rn > 1 THEN 'duplicate' ELSE 'retained' END) AS reason, count(*) AS rows"
    " FROM (SELECT *, row_number() OVER (PARTITION BY key, stamp, reason IS NULL ORDER BY _ord) AS rn FROM screened) GROUP BY 1"
)
def rejection_summary(t):
    return equity_rejections(screen_equities(t.equities(), policies=()))


@query(f"WITH {_SCREENED} SELECT coalesce(reason, 'retained') AS reason, count(*) AS rows FROM screened GROUP BY 1")
def rejection_summary_tagged(t):
    return aggregates.rejection_summary(screen_equities(t.equities(), policies=()))
