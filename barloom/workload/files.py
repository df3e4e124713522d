"""Sources and sinks: each query writes data derived from the tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom import sources
from barloom.functions.symbols import ticker
from barloom.operators import dedupe
from barloom.operators.calendars import missing_timestamps, resolve_range_from
from barloom.schemas import EQUITY_FIELDS, FUTURES_FIELDS
from barloom.session import scratch_path
from barloom.sinks import tables as sink
from barloom.sources.stored import latest_per_symbol
from barloom.plans import build_universe
from barloom.workload.registry import query
from barloom.workload.timeseries import ticker_lists

BAR = "time, symbol, open, high, low, close, volume"


@query("SELECT dataSymbol, instrumentType, round(multiplier, 6) AS multiplier, assetDesc FROM contracts")
def read_contracts(t):
    path = scratch_path(t.spark, "contracts")
    # Quoted because the symbols' own spaces belong to the data.
    t.contracts().drop("_ord", "base").write.option("header", True).option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return sources.read_contracts(t.spark, path).select(
        "dataSymbol", "instrumentType", F.round("multiplier", 6).alias("multiplier"), "assetDesc"
    )


_JSON = """SELECT strftime(time, '%Y-%m-%dT%H:%M:%S.000Z') AS time, symbol, open, high, low, close, volume,
    open / 2 AS adj_open, high / 2 AS adj_high, low / 2 AS adj_low, close / 2 AS adjusted_close,
    volume * CAST(1.5 AS DOUBLE) AS adj_volume, CAST(0 AS DOUBLE) AS div_cash, CAST(1 AS DOUBLE) AS split_factor FROM hour_bars"""


def equity_records(t):
    """Hourly bars in the equity provider's record shape."""
    return t.bars("hour").selectExpr(
        "symbol", "date_format(time, \"yyyy-MM-dd'T'HH:mm:ss'.000Z'\") AS date", "open", "high", "low", "close", "volume",
        "open / 2 AS adjOpen", "high / 2 AS adjHigh", "low / 2 AS adjLow", "close / 2 AS adjClose",
        "volume * 1.5D AS adjVolume", "0.0D AS divCash", "1.0D AS splitFactor",
    )


@query(_JSON)
def read_equity_json(t):
    path = scratch_path(t.spark, "equity-json")
    equity_records(t).write.partitionBy("symbol").json(path)
    return sources.read_equity_json(t.spark, path).select(*EQUITY_FIELDS)


@query(f"SELECT series, {BAR} FROM rolls")
def read_futures_bars(t):
    path = scratch_path(t.spark, "futures")
    t.rolls().withColumnRenamed("time", "ts_event").write.parquet(path)
    return sources.read_futures_bars(t.spark, path).select("series", *FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM hour_bars WHERE time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'")
def read_stored_bars(t):
    path = scratch_path(t.spark, "stored")
    sink.append_bars(t.bars("hour"), path, grain="day")
    return sources.read_bars(t.spark, path, "2024-01-05", "2024-01-20").select(*FUTURES_FIELDS)


@query("SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS ticker FROM customer WHERE c_custkey % 7 <> 0")
def read_constituents(t):
    path = scratch_path(t.spark, "constituents")
    listed = t.read("customer").selectExpr("CASE WHEN c_custkey % 7 = 0 THEN '  ' ELSE c_name END AS Symbol", "c_mktsegment AS Sector")
    listed.write.option("header", True).option("quoteAll", True).csv(path)
    return sources.read_constituents(t.spark, path).select("ticker")


@query(f"SELECT {BAR}, CAST(NULL AS BIGINT) AS extra FROM bars UNION ALL SELECT {BAR}, volume AS extra FROM bars")
def write_raw(t):
    """Two raw batches, the second one with a column more."""
    path = scratch_path(t.spark, "raw")
    bars = t.bars()
    sink.write_raw(bars, path)
    sink.write_raw(bars.withColumn("extra", F.col("volume")), path)
    return sources.read_bars(t.spark, path, merge_schema=True).select(*FUTURES_FIELDS, "extra")


_NEW = """(SELECT _ord, symbol, time, close, volume FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol, time, CASE WHEN time IS NULL THEN _ord END ORDER BY _ord) AS rn FROM dirty) d
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM bars b WHERE b.symbol = d.symbol AND b.time = d.time))"""


@query(f"SELECT * FROM {_NEW}")
def insert_ignore(t):
    """Hourly rows against stored daily bars: midnight hours are known, rows without a time never conflict."""
    return dedupe.insert_ignore(t.dirty(), t.bars())


@query(
    "SELECT symbol, time, close, volume FROM bars UNION ALL SELECT symbol, time, close, volume FROM hour_bars h"
    " WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.symbol = h.symbol AND b.time = h.time)"
)
def insert_ignore_stored(t):
    """The same into a stored table, twice: the repetition adds nothing."""
    path = scratch_path(t.spark, "insert")
    cols = ["symbol", "time", "close", "volume"]
    sink.append_bars(t.bars().select(*cols), path)
    batch = t.bars("hour").select(*cols, F.col("volume").alias("_ord"))
    sink.insert_new(batch, path)
    sink.insert_new(batch, path)
    return sources.read_bars(t.spark, path).select(*cols)


@query(
    """SELECT d.symbol, d.time, d.n AS in_batch, coalesce(b.n, 0) AS stored FROM
      (SELECT symbol, time, count(*) AS n FROM dirty WHERE time IS NOT NULL GROUP BY symbol, time) d
      LEFT JOIN (SELECT symbol, time, count(*) AS n FROM bars GROUP BY symbol, time) b ON b.symbol = d.symbol AND b.time = d.time
    WHERE d.n > 1 OR b.n > 0"""
)
def insert_strict_conflicts(t):
    return dedupe.conflicts(t.dirty(), t.bars())


_GONE = "time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-12' AND symbol IN ('click', 'view')"


@query(f"SELECT * FROM dirty WHERE NOT coalesce({_GONE}, false)")
def delete_range(t):
    return sink.delete_range(t.dirty(), "2024-01-08", "2024-01-12", ["click", "view"])[0]


@query(f"SELECT count(*) FILTER (WHERE coalesce({_GONE}, false)) AS rows FROM dirty")
def delete_range_count(t):
    return sink.delete_range(t.dirty(), "2024-01-08", "2024-01-12", ["click", "view"])[1]


@query(
    f"SELECT {BAR} FROM hour_bars WHERE NOT (time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-12 12:00:00')"
)
def delete_stored(t):
    """Days in the range disappear whole, the last one in part."""
    path = scratch_path(t.spark, "delete")
    sink.append_bars(t.bars("hour"), path, grain="day")
    sink.delete_stored(t.spark, path, "2024-01-08", "2024-01-12 12:00:00", grain="day")
    return sources.read_bars(t.spark, path).select(*FUTURES_FIELDS)


_SHORT = ["symbol", "time", "close", "volume"]


@query(
    "SELECT symbol, time, close, volume FROM bars UNION ALL SELECT symbol, time, close, volume FROM hour_bars h"
    " WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.symbol = h.symbol AND b.time = h.time)"
)
def insert_ignore_stored_day(t):
    """Into a table with a folder per day, with the month as the grain of the insert."""
    path = scratch_path(t.spark, "insert-day")
    sink.append_bars(t.bars().select(*_SHORT), path, grain="day")
    batch = t.bars("hour").select(*_SHORT, F.col("volume").alias("_ord"))
    for _ in range(2):
        sink.insert_new(batch, path)
    return sources.read_bars(t.spark, path).select(*_SHORT)


@query(f"SELECT {BAR} FROM hour_bars WHERE NOT (time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-12 12:00:00')")
def delete_stored_year(t):
    """From a table with a folder per year, with the default grain."""
    path = scratch_path(t.spark, "delete-year")
    sink.append_bars(t.bars("hour"), path, grain="year")
    sink.delete_stored(t.spark, path, "2024-01-08", "2024-01-12 12:00:00")
    return sources.read_bars(t.spark, path).select(*FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM hour_bars UNION ALL SELECT {BAR} FROM bars b WHERE hour(time) <> 0")
def insert_strict_stored(t):
    """A first insert goes in; a second one with the same keys fails and adds nothing."""
    path = scratch_path(t.spark, "strict")
    sink.insert_all(t.bars("hour"), path)
    try:
        sink.insert_all(t.bars(), path)
    except Exception as error:  # whatever Spark wraps it in
        if "duplicate" not in str(error).lower():
            raise
    return sources.read_bars(t.spark, path).select(*FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM bars")
def delete_all_then_insert(t):
    """A table that was emptied takes rows again."""
    path = scratch_path(t.spark, "emptied")
    sink.append_bars(t.bars("hour"), path)
    sink.delete_stored(t.spark, path, "1900-01-01", "2100-01-01")
    sink.insert_new(t.bars().withColumn("_ord", F.col("volume")), path)
    return sources.read_bars(t.spark, path).select(*FUTURES_FIELDS)


@query(f"SELECT {BAR} FROM hour_bars UNION ALL SELECT {BAR} FROM bars")
def compact_stored(t):
    """Two generations of every day, rewritten as one."""
    path = scratch_path(t.spark, "compact")
    for rows in (t.bars("hour"), t.bars()):
        sink.append_bars(rows, path, grain="day")
    sink.compact_stored(t.spark, path)
    return sources.read_bars(t.spark, path).select(*FUTURES_FIELDS)


@query(
    """SELECT symbol, CAST(least(CAST(max(time) AS DATE) + 1, DATE '2024-02-29') AS VARCHAR) AS start_date, '2024-02-29' AS end_date FROM hour_bars
      WHERE NOT (symbol IN ('click', 'view') AND time >= TIMESTAMP '2024-01-20') GROUP BY symbol"""
)
def resolve_range_from_marks(t):
    """Ranges from the marks of a stored table, after a delete that lowers two symbols' latest times."""
    path = scratch_path(t.spark, "marks")
    sink.append_bars(t.bars("hour"), path, grain="day")
    sink.delete_stored(t.spark, path, "2024-01-20", "2100-01-01", ["click", "view"])
    wanted = t.bars("hour").select("symbol").distinct()
    spans = resolve_range_from(wanted, latest_per_symbol(t.spark, path), seed="2020-01-01", today="2024-03-01")
    return spans.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


@query("SELECT DISTINCT replace(upper(trim(p_brand)), '.', '-') AS value FROM part")
def export_tickers(t):
    path = scratch_path(t.spark, "tickers")
    sink.export_tickers(t.read("part").select(ticker(F.col("p_brand")).alias("ticker")), path)
    return t.spark.read.text(path)


@query(
    """WITH lists AS (SELECT replace(n_name, '_', '.') AS name FROM nation UNION ALL SELECT s_name FROM supplier
      UNION ALL SELECT CASE WHEN c_custkey % 10 = 0 THEN ' ' WHEN c_custkey % 3 = 0 THEN concat(' nation.', c_custkey, ' ')
                       ELSE c_name END FROM customer)
    SELECT DISTINCT replace(upper(trim(name)), '.', '-') AS "dataSymbol", 'EQUITY' AS "instrumentType" FROM lists WHERE trim(name) <> ''"""
)
def write_universe(t):
    path = scratch_path(t.spark, "universe")
    sink.write_universe(build_universe(ticker_lists(t)), path)
    return t.spark.read.option("header", True).csv(path)


@query("SELECT count(*) AS expected, count(*) AS actual, true AS passed FROM bars")
def validate_row_count(t):
    path = scratch_path(t.spark, "counted")
    written = sink.append_bars(t.bars(), path)
    return sink.validate_row_count(sources.read_bars(t.spark, path), written)


@query(
    """SELECT 'missing_timestamp' AS kind, symbol, time AS ts, concat('no bar at ', strftime(time, '%Y-%m-%d %H:%M:%S')) AS detail FROM (
      SELECT symbol, time FROM (SELECT symbol, unnest(generate_series(min(time), max(time), INTERVAL 1 DAY)) AS time FROM user_days GROUP BY symbol)
      WHERE isodow(time) <= 5 EXCEPT SELECT symbol, time FROM user_days)"""
)
def write_findings(t):
    path = scratch_path(t.spark, "findings")
    sink.write_findings(sink.missing_findings(missing_timestamps(t.user_days(), "B")), path)
    return t.spark.read.parquet(path)
