"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import quality
from barloom.operators.calendars import with_gap_report
from barloom.sinks.tables import missing_findings, status_findings
from barloom.workload.registry import query, rounded

NOW = "2024-02-01 12:00:00"


@query(
    f"SELECT max(ts) AS latest, round((epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 1000000.0, 3) AS age_seconds,"
    f" TIMESTAMP '{NOW}' - max(ts) > INTERVAL 1 DAY AS is_stale FROM events"
)
def staleness(t):
    return rounded(quality.staleness(t.read("events"), NOW, time_col="ts"), "age_seconds", places=3)


@query(
    f"""SELECT CASE WHEN TIMESTAMP '{NOW}' - max(ts) > INTERVAL 1 DAY THEN 'stale' ELSE 'fresh' END AS kind,
        max(ts) AS from_time, TIMESTAMP '{NOW}' AS to_time FROM events
    UNION ALL SELECT 'gap', p, ts FROM (SELECT lag(ts) OVER (ORDER BY ts) AS p, ts FROM events) WHERE ts - p > INTERVAL 15 MINUTE"""
)
def staleness_and_gaps(t):
    return quality.staleness_and_gaps(t.read("events"), NOW, gap=15 * 60, time_col="ts")


_GATE = """WITH s AS ({source}),
  n AS (SELECT count(*) FILTER (WHERE symbol IS NULL OR asset_type IS NULL) AS null_count,
               count(*) FILTER (WHERE value_column = 0) AS zero_count FROM s),
  g AS (SELECT count(*) FILTER (WHERE nt - time > INTERVAL 60 SECOND) AS gap_count
        FROM (SELECT time, lead(time) OVER (ORDER BY time) AS nt FROM s WHERE time IS NOT NULL))
  SELECT null_count = 0 AND zero_count = 0 AND gap_count = 0 AS passed,
         CASE WHEN null_count > 0 THEN 'nulls' WHEN zero_count > 0 THEN 'zeros' WHEN gap_count > 0 THEN 'gaps' END AS first_failed,
         CAST(null_count AS BIGINT) AS null_count, CAST(zero_count AS BIGINT) AS zero_count, CAST(gap_count AS BIGINT) AS gap_count FROM n, g"""


@query(_GATE.format(source="SELECT event_type AS symbol, 'EQUITY' AS asset_type, value AS value_column, ts AS time FROM events"))
def quality_gate(t):
    table = t.read("events").selectExpr("event_type AS symbol", "'EQUITY' AS asset_type", "value AS value_column", "ts AS time")
    return quality.quality_gate(table)


@query(_GATE.format(source="SELECT symbol, 'EQUITY' AS asset_type, volume AS value_column, time FROM dirty"))
def quality_gate_dirty(t):
    table = t.dirty().selectExpr("symbol", "'EQUITY' AS asset_type", "volume AS value_column", "time")
    return quality.quality_gate(table)


@query(
    """WITH n AS (SELECT dataSymbol, count(*) AS n FROM contracts GROUP BY dataSymbol),
    c AS (SELECT count(*) FILTER (WHERE n > 1) AS d, coalesce(sum(n) FILTER (WHERE dataSymbol IS NULL), 0) AS z FROM n)
    SELECT d = 0 AND z = 0 AS passed, CASE WHEN d > 0 THEN 'duplicate symbols' WHEN z > 0 THEN 'null symbols' END AS first_failed,
           d AS duplicate_symbols, CAST(z AS BIGINT) AS null_symbols FROM c"""
)
def validate_contracts(t):
    return quality.validate_contracts(t.contracts())


@query(
    """WITH u AS (SELECT replace(c_name, '#', CASE WHEN c_custkey % 9 = 0 THEN '.' ELSE '-' END) AS s,
                         CASE WHEN c_custkey % 11 = 0 THEN 'FUTURE' ELSE 'EQUITY' END AS k FROM customer
                  UNION ALL SELECT s_name, 'EQUITY' FROM supplier UNION ALL SELECT s_name, 'EQUITY' FROM supplier),
    c AS (SELECT count(*) AS size, count(*) FILTER (WHERE k <> 'EQUITY') AS not_equity,
           count(s) - count(DISTINCT s) AS duplicates, count(*) FILTER (WHERE contains(s, '.')) AS dotted,
           count(*) FILTER (WHERE s IS NULL OR trim(s) = '') AS blank,
           (SELECT count(*) FROM (SELECT DISTINCT n_name FROM nation EXCEPT SELECT s FROM u)) AS missing_baseline FROM u)
    SELECT *, not_equity + duplicates + dotted + blank + missing_baseline = 0 AND size BETWEEN 540 AND 600 AS passed FROM c"""
)
def validate_universe(t):
    customers = t.read("customer").selectExpr(
        "replace(c_name, '#', CASE WHEN c_custkey % 9 = 0 THEN '.' ELSE '-' END) AS dataSymbol",
        "CASE WHEN c_custkey % 11 = 0 THEN 'FUTURE' ELSE 'EQUITY' END AS instrumentType",
    )
    suppliers = t.read("supplier").selectExpr("s_name AS dataSymbol", "'EQUITY' AS instrumentType")
    baseline = t.read("nation").selectExpr("n_name AS dataSymbol")
    return quality.validate_universe(customers.unionByName(suppliers).unionByName(suppliers), baseline)


def _bucket(symbol: str, n: int) -> str:
    """The digest modulo n, word by word, in DuckDB."""
    digest = f"sha1({symbol})"
    value = "CAST(0 AS HUGEINT)"
    for word in range(5):
        part = f"CAST(concat('0x', substr({digest}, {1 + 8 * word}, 8)) AS HUGEINT)"
        value = f"(({value} * 4294967296 + {part}) % {n})"
    return f"CAST({value} AS BIGINT)"


@query(f"SELECT c_name AS symbol, {_bucket('c_name', 12)} AS bucket FROM customer")
def stable_bucket(t):
    return quality.with_bucket(t.read("customer").selectExpr("c_name AS symbol"), 12)


@query(
    f"""WITH b AS (SELECT {_bucket('symbol', 12)} AS bucket, count(*) AS symbols
                   FROM (SELECT DISTINCT c_name AS symbol FROM customer) GROUP BY 1)
    SELECT bucket, symbols, symbols > 48 AS over_cap,
           CAST(ceil((SELECT sum(symbols) FROM b) / 48.0) AS BIGINT) AS buckets_needed FROM b"""
)
def bucket_capacity(t):
    return quality.bucket_capacity(t.read("customer").selectExpr("c_name AS symbol"), 12, cap=48)


@query("SELECT symbol, time, close FROM hour_bars")
def gap_report_bars(t):
    return with_gap_report(t.bars("hour"), "H")[0].select("symbol", "time", "close")


@query(
    "SELECT 'missing_timestamp' AS kind, symbol, time AS ts, concat('no bar at ', strftime(time, '%Y-%m-%d %H:%M:%S')) AS detail"
    " FROM (SELECT symbol, unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS time FROM hours GROUP BY symbol"
    " EXCEPT SELECT symbol, time FROM hours)"
)
def gap_report_findings(t):
    return missing_findings(with_gap_report(t.bars("hour"), "H")[1])


_REASON = """CASE WHEN open = 'bad' THEN 'bad open' WHEN volume IS NULL THEN 'missing volume' END"""
_STATUS = f"""SELECT symbol, count(*) AS rows, count(r) AS failed_rows,
    arg_min(r, (epoch_us(time) * 1000000 + _ord)) FILTER (WHERE r IS NOT NULL) AS first_reason,
    CASE WHEN count(r) > 0 THEN 'failed' ELSE 'ok' END AS status
    FROM (SELECT *, {_REASON} AS r FROM user_bars) GROUP BY symbol"""


@query(f"SELECT * FROM user_bars WHERE symbol NOT IN (SELECT symbol FROM user_bars WHERE {_REASON} IS NOT NULL)")
def isolate_failures_good(t):
    return quality.isolate_failures(t.user_bars())[0]


@query(_STATUS.replace("epoch_us(time) * 1000000 + _ord", "CAST(epoch_us(time) AS HUGEINT) * 10000000000 + _ord"))
def isolate_failures_status(t):
    return quality.isolate_failures(t.user_bars())[1]


@query(
    "SELECT 'insert_status' AS kind, symbol, CAST(NULL AS TIMESTAMP) AS ts, CASE WHEN status = 'ok' THEN"
    " concat('inserted ', rows, ' rows') ELSE concat('failed: ', first_reason) END AS detail FROM ("
    + _STATUS.replace("epoch_us(time) * 1000000 + _ord", "CAST(epoch_us(time) AS HUGEINT) * 10000000000 + _ord") + ")"
)
def status_report(t):
    """Findings of a first insert, whose rows are all new; `ingest_status_repeated` has the other case."""
    status = quality.isolate_failures(t.user_bars())[1]
    return status_findings(status.withColumn("inserted", F.col("rows")))
