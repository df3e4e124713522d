"""Composed work: cleaning, ingestion, backfill, universe."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.plans import backfill, backfill_resumable as by_chunks, backfill_stored as into_storage, build_universe, clean_equities, clean_futures, ingest
from barloom.schemas import EQUITY_FIELD_NAMES, EQUITY_FIELDS, OHLC
from barloom.session import cut_lineage, scratch_path
from barloom import sources
from barloom.workload.missing import SMALL
from barloom.workload.registry import query, rounded
from barloom.workload.timeseries import ticker_lists

_BY = "PARTITION BY series ORDER BY time, _ord"


def _adjusted(source: str) -> str:
    return f"""base AS ({source}),
  marked AS (SELECT *, lag(symbol) OVER ({_BY}) AS ps, lag(close) OVER ({_BY}) AS pc, lag(volume) OVER ({_BY}) AS pv FROM base),
  factors AS (SELECT *, CASE WHEN ps <> symbol AND volume > pv THEN pc - open END AS f FROM marked),
  shifted AS (SELECT *, coalesce(sum(f) OVER ({_BY} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS shift FROM factors)"""


_OUT = """series, time, symbol, round(open + shift, 6) AS open, round(high + shift, 6) AS high,
    round(low + shift, 6) AS low, round(close + shift, 6) AS close, volume"""
_ZERO = "SELECT series, symbol, ts_event AS time, high, low, coalesce(open, 0) AS open, coalesce(close, 0) AS close, volume, _ord FROM landed_futures"
_FORWARD = f"""SELECT series, symbol, ts_event AS time, high, low, volume, _ord,
    coalesce(last_value(open IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts_event, _ord
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS open,
    coalesce(last_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts_event, _ord
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS close FROM landed_futures"""


@query(f"WITH {_adjusted(_ZERO)} SELECT {_OUT} FROM shifted")
def clean_futures_bars(t):
    return rounded(clean_futures(t.landed_futures(), series="series"), *OHLC)


@query(f"WITH {_adjusted(_FORWARD)} SELECT {_OUT} FROM shifted")
def clean_futures_forward(t):
    return rounded(clean_futures(t.landed_futures(), ["forward_fill", "zero_fill"], series="series"), *OHLC)


@query(f"WITH {_adjusted(_FORWARD)} SELECT {_OUT} FROM shifted")
def clean_futures_forward_split(t):
    clean = clean_futures(t.landed_futures(), ["forward_fill", "zero_fill"], series="series", max_rows=5)
    return rounded(clean, *OHLC)


_DATA = [c for c in EQUITY_FIELDS if c not in ("time", "symbol")]


def _equities(source: str) -> str:
    prices = ["open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adjusted_close"]
    corrupt = " OR ".join(f"coalesce({p} <= 0, false)" for p in prices)
    return f"""WITH src AS ({source}),
  ok AS (SELECT * REPLACE (upper(trim(symbol)) AS symbol, TRY_CAST(time AS TIMESTAMP) AS time,
                           CAST(trunc(TRY_CAST(volume AS DOUBLE)) AS BIGINT) AS volume) FROM src
         WHERE time IS NOT NULL AND symbol IS NOT NULL AND NOT ({corrupt}) AND time <> 'not a time'
           AND TRY_CAST(volume AS DOUBLE) IS NOT NULL AND NOT TRY_CAST(volume AS DOUBLE) < 0),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol, time ORDER BY _ord) AS rn FROM ok)
  SELECT {', '.join(EQUITY_FIELDS)} FROM ranked WHERE rn = 1"""


_COMPLETE = "SELECT * FROM equities WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in EQUITY_FIELDS)
_CARRIED = "SELECT _ord, time, symbol, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY upper(trim(symbol)) ORDER BY TRY_CAST(time AS TIMESTAMP) NULLS FIRST, _ord"
    f" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in _DATA
) + " FROM equities"


@query(_equities(_COMPLETE))
def clean_equity_bars(t):
    return clean_equities(t.equities())


@query(_equities(_CARRIED))
def clean_equity_bars_forward(t):
    return clean_equities(t.equities(), ["forward_fill"])


@query(_equities(_CARRIED))
def clean_equity_bars_forward_split(t):
    return clean_equities(t.equities(), ["forward_fill"], max_rows=SMALL)


@query(
    """WITH lists AS (
      SELECT replace(n_name, '_', '.') AS name, 0 AS priority, CAST(n_nationkey AS BIGINT) AS pos FROM nation
      UNION ALL SELECT s_name, 1, s_suppkey FROM supplier
      UNION ALL SELECT CASE WHEN c_custkey % 10 = 0 THEN ' ' WHEN c_custkey % 3 = 0 THEN concat(' nation.', c_custkey, ' ')
                       ELSE c_name END, 2, c_custkey FROM customer),
    ranked AS (SELECT replace(upper(trim(name)), '.', '-') AS ticker, priority, pos FROM lists)
    SELECT ticker AS "dataSymbol", 'EQUITY' AS "instrumentType", priority, pos FROM (
      SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY priority, pos) AS rn FROM ranked WHERE ticker <> '') WHERE rn = 1"""
)
def universe(t):
    return build_universe(ticker_lists(t))


def _contract_file(t, symbols, kind):
    path = scratch_path(t.spark, "contracts")
    listed = symbols.select(F.col("symbol").alias("dataSymbol"), F.lit(kind).alias("instrumentType"))
    listed.write.option("header", True).csv(path)
    return path


def _landed_json(t):
    """Equity rows as provider files with times as text, and their contract list."""
    landing = scratch_path(t.spark, "landing")
    rows = t.equities().withColumn("symbol", F.trim("symbol"))
    contracts = _contract_file(t, rows.select("symbol").dropna().distinct(), "EQUITY")
    provider = {stored: given for given, stored in EQUITY_FIELD_NAMES.items()}
    # Part files are named in the order of their rows, which is the order the reader gives them.
    ordered = rows.withColumnsRenamed(provider).repartitionByRange("_ord").sortWithinPartitions("_ord").drop("_ord")
    ordered.write.option("ignoreNullFields", False).json(landing)
    return sources.read_equity_json(t.spark, landing), contracts


def _run(t, times=1, **options):
    landed, contracts = _landed_json(t)
    raw, table = scratch_path(t.spark, "raw"), scratch_path(t.spark, "bars")
    for _ in range(times):
        result = ingest(t.spark, contracts, landed, raw, table, "EQUITY", **{"start": "2024-01-01", "end": "2024-01-31", **options})
    return result, raw, table


@query(_equities(_COMPLETE))
def ingest_equities(t):
    """Two runs over the same landed files; the table holds each bar once."""
    return sources.read_bars(t.spark, _run(t, 2)[2]).select(*EQUITY_FIELDS)


@query("SELECT count(*) AS rows, count(*) FILTER (TRY_CAST(time AS TIMESTAMP) IS NULL) AS unreadable FROM equities WHERE symbol IS NOT NULL")
def ingest_raw_rows(t):
    """Rows without a readable time are kept as they came."""
    raw = t.spark.read.parquet(_run(t)[1])
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("time").try_cast("timestamp").isNull()).alias("unreadable"))


_STATUS = f"""WITH kept AS ({_equities(_COMPLETE)}),
  n AS (SELECT upper(trim(symbol)) AS symbol, count(*) AS landed FROM equities WHERE symbol IS NOT NULL GROUP BY 1),
  k AS (SELECT symbol, count(*) AS inserted FROM kept GROUP BY symbol)
  SELECT n.symbol, landed, """


@query(_STATUS + "coalesce(inserted, 0) AS inserted, 'ok' AS status FROM n LEFT JOIN k USING (symbol)")
def ingest_status(t):
    return _run(t)[0].status.select("symbol", "landed", "inserted", "status")


@query(_STATUS + "0 AS inserted, 'ok' AS status FROM n LEFT JOIN k USING (symbol)")
def ingest_status_repeated(t):
    """The second run adds nothing and says so."""
    return _run(t, 2)[0].status.select("symbol", "landed", F.col("inserted").cast("int").alias("inserted"), "status")


@query(f"SELECT count(*) AS expected, count(*) AS actual, true AS passed FROM ({_equities(_COMPLETE)})")
def ingest_validation(t):
    return _run(t)[0].validation


@query(
    """SELECT 'duplicate_timestamp' AS kind, count(*) AS findings, CAST(sum(n) AS BIGINT) AS rows FROM
         (SELECT count(*) AS n FROM equities WHERE symbol IS NOT NULL GROUP BY trim(symbol), time HAVING count(*) > 1)
       UNION ALL SELECT 'insert_status', count(DISTINCT upper(trim(symbol))), CAST(NULL AS BIGINT) FROM equities WHERE symbol IS NOT NULL"""
)
def ingest_findings(t):
    """Status per symbol and times that landed more than once, as stored findings."""
    path = scratch_path(t.spark, "findings")
    _run(t, findings=path)
    rows = F.when(F.col("kind") == "duplicate_timestamp", F.split_part("detail", F.lit(" "), F.lit(1)).cast("bigint"))
    return t.spark.read.parquet(path).groupBy("kind").agg(F.count(F.lit(1)).alias("findings"), F.sum(rows).alias("rows"))


@query(_equities(_COMPLETE))
def ingest_late_symbol(t):
    """A symbol that comes in a later run is loaded from its own beginning."""
    landed, contracts = _landed_json(t)
    raw, table = scratch_path(t.spark, "raw"), scratch_path(t.spark, "bars")
    late = F.upper(F.trim("symbol")) == "CLICK"
    for part in (landed.filter(~late), landed):
        ingest(t.spark, contracts, part, raw, table, "EQUITY", seed="2024-01-01", today="2024-02-01")
    return sources.read_bars(t.spark, table).select(*EQUITY_FIELDS)


@query(_equities(_COMPLETE))
def ingest_after_empty_run(t):
    """A first run whose rows are all refused does not spoil the table."""
    landed, contracts = _landed_json(t)
    raw, table = scratch_path(t.spark, "raw"), scratch_path(t.spark, "bars")
    for part in (landed.withColumn("volume", F.lit(None).cast("bigint")), landed):
        ingest(t.spark, contracts, part, raw, table, "EQUITY", start="2024-01-01", end="2024-01-31")
    return sources.read_bars(t.spark, table).select(*EQUITY_FIELDS)


@query(
    """WITH chosen AS (SELECT * FROM user_bars WHERE symbol NOT IN
             (SELECT symbol FROM user_bars WHERE open = 'bad')),
    zero AS (SELECT symbol, time, _ord, CAST(open AS DOUBLE) AS open, high, low, coalesce(close, 0) AS close,
                    coalesce(volume, 0) AS volume FROM chosen)
    SELECT time, concat(symbol, '.v.0') AS symbol, open, high, low, close, volume FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol, time ORDER BY _ord) AS rn FROM zero) WHERE rn = 1"""
)
def ingest_futures(t):
    """Symbols that cannot be typed are left out, the others go in, first row per key."""
    landed = t.user_bars()
    contracts = _contract_file(t, landed.select("symbol").distinct(), "FUTURE")
    stamped = cut_lineage(
        landed.withColumn("symbol", F.concat("symbol", F.lit(".v.0"))), scratch_path(t.spark, "landing")
    )
    raw, table = scratch_path(t.spark, "raw"), scratch_path(t.spark, "bars")
    ingest(t.spark, contracts, stamped, raw, table, "FUTURE", seed="2024-01-01", today="2024-02-01")
    return sources.read_bars(t.spark, table).select("time", "symbol", "open", "high", "low", "close", "volume")


@query(
    "SELECT symbol, time, close, volume FROM hour_bars WHERE time >= TIMESTAMP '2024-01-03' AND time < TIMESTAMP '2024-01-26'"
)
def backfill_rows(t):
    return _backfill(t)[0].select("symbol", "time", "close", "volume")


_CHUNKS = """WITH names AS (SELECT DISTINCT symbol FROM hour_bars),
    chunks AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', {last}, INTERVAL {step})) AS chunk_start),
    spans AS (SELECT symbol, chunk_start, least(chunk_start + INTERVAL {step}, {end}) AS chunk_end FROM chunks, names)
    SELECT s.symbol, chunk_start, chunk_end, count(h.time) AS rows FROM spans s LEFT JOIN hour_bars h ON h.symbol = s.symbol
      AND h.time >= chunk_start AND h.time {upto} GROUP BY s.symbol, chunk_start, chunk_end"""


@query(_CHUNKS.format(last="TIMESTAMP '2024-01-24 23:00:00'", step="7 DAY", end="TIMESTAMP '2024-01-25'", upto="< chunk_end + INTERVAL 1 DAY"))
def backfill_work(t):
    return _backfill(t)[1]


@query(_CHUNKS.format(last="TIMESTAMP '2024-02-19 23:59:59'", step="5 HOUR", end="TIMESTAMP '2024-02-20'", upto="<= chunk_end"))
def backfill_work_hourly(t):
    """Chunks of five hours, some of them empty; a bar on a border counts on both sides."""
    return _backfill(t, "2024-02-20", "hourly", 5)[1]


@query(
    "SELECT symbol, time, close, volume FROM hour_bars WHERE time >= TIMESTAMP '2024-01-03' AND time < TIMESTAMP '2024-01-26'"
)
def backfill_stored(t):
    """Into storage, twice."""
    raw, table = scratch_path(t.spark, "raw"), scratch_path(t.spark, "bars")
    bars, wanted = _bars(t)
    for _ in range(2):
        into_storage(t.spark, bars, wanted, "2024-01-03", "2024-01-25", raw, table, lambda df: df, "daily", 7)
    return sources.read_bars(t.spark, table).select("symbol", "time", "close", "volume")


@query(
    """WITH chunks AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-24', INTERVAL 7 DAY)) AS chunk_start)
    SELECT chunk_start, least(chunk_start + INTERVAL 7 DAY, TIMESTAMP '2024-01-25') AS chunk_end, count(h.time) AS inserted
    FROM chunks LEFT JOIN hour_bars h ON h.time < least(chunk_start + INTERVAL 7 DAY, TIMESTAMP '2024-01-25') + INTERVAL 1 DAY
      AND h.time >= CASE WHEN chunk_start = TIMESTAMP '2024-01-03' THEN chunk_start ELSE chunk_start + INTERVAL 1 DAY END GROUP BY chunk_start"""
)
def backfill_resumable(t):
    """Broken in the second chunk, then run again: every chunk is entered once."""
    raw, table, ledger = (scratch_path(t.spark, n) for n in ("raw", "bars", "ledger"))
    bars, wanted = _bars(t)
    calls = []

    def clean(rows):
        calls.append(1)
        if len(calls) == 2:
            raise ConnectionError
        return rows

    for _ in range(2):
        try:
            done = by_chunks(t.spark, bars, wanted, "2024-01-03", "2024-01-25", raw, table, clean, ledger, "daily", 7)
        except ConnectionError:
            continue
    return done


def _bars(t):
    bars = t.bars("hour").withColumn("_ord", F.col("volume"))
    return bars, bars.select("symbol").distinct()


def _backfill(t, end="2024-01-25", unit="daily", n=7):
    return backfill(*_bars(t), "2024-01-03", end, unit, n)


_READ = """CASE WHEN _ord % 31 = 0 THEN '12f' WHEN _ord % 37 = 0 THEN '0x1p3' ELSE CAST(close AS VARCHAR) END"""


@query(
    f"""WITH src AS (SELECT *, {_READ} AS c, CASE WHEN symbol = 'view' AND _ord % 50 = 0 THEN 'not a time' ELSE 'fine' END AS t FROM dirty
        WHERE time IS NOT NULL),
    failed AS (SELECT DISTINCT trim(symbol) AS s FROM src WHERE t = 'not a time' OR c IN ('12f', '0x1p3'))
    SELECT trim(symbol) AS symbol, count(*) AS rows, CASE WHEN trim(symbol) IN (SELECT s FROM failed) THEN 'failed' ELSE 'ok' END AS status
    FROM src GROUP BY trim(symbol)"""
)
def clean_futures_isolated(t):
    """Times and prices that cannot be read fail their own symbol."""
    rows = t.dirty().filter("time IS NOT NULL").withColumns({
        "symbol": F.trim("symbol"), "volume": F.coalesce("volume", F.lit(0)), "open": F.lit(1.0), "high": F.lit(1.0), "low": F.lit(1.0),
        "close": F.when(F.col("_ord") % 31 == 0, "12f").when(F.col("_ord") % 37 == 0, "0x1p3").otherwise(F.col("close").cast("string")),
        "time": F.when((F.col("symbol") == "view") & (F.col("_ord") % 50 == 0), "not a time").otherwise(F.col("time").cast("string")),
    })
    _, status = clean_futures(rows, [], isolate=True)
    return status.select("symbol", "rows", "status")
