"""Sources, sinks and whole ingestion runs on small files."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom import sources
from barloom.operators import combine, dedupe, quality
from barloom.operators.project import MissingFields
from barloom.plans import backfill, build_universe, ingest
from barloom.schemas import EQUITY_FIELDS
from barloom.sinks import tables as sink

WIDE = "assetDesc,underlying,dataSymbol,ibSymbol,exchange,multiplier,currency,dataSet,instrumentType\n"


def csv(tmp_path, text, name="contracts.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_text(text, encoding=encoding)
    return str(path)


def test_contract_lists_are_read_by_name(spark, tmp_path):
    wide = csv(tmp_path, "﻿﻿" + WIDE + "Micro,FX,6A,6A,CME,0.1,USD,GLOBEX,FUTURE\nEuro,FX,6E,6E,CME,125000,USD,GLOBEX,future\n")
    rows = sources.read_contracts(spark, wide).orderBy("_ord").collect()
    assert [(r.dataSymbol, r.multiplier, r.assetDesc) for r in rows] == [("6A", 0.1, "Micro"), ("6E", 125000.0, "Euro")]
    assert sorted(tuple(r) for r in sources.load_contracts(spark, wide).collect()) == [("6A", "FUTURE"), ("6E", "FUTURE")]
    narrow = csv(tmp_path, "dataSymbol,instrumentType\nSPY,EQUITY\n", "narrow.csv")
    assert [tuple(r) for r in sources.load_contracts(spark, narrow).collect()] == [("SPY", "EQUITY")]


@pytest.mark.parametrize(
    "text, error",
    [
        ("dataSymbol,kind\nES,FUTURE\n", "instrumentType"),
        ("dataSymbol,instrumentType\nES,FUTURE\nES,FUTURE\n", "duplicate"),
        ("dataSymbol,instrumentType\nES,FUTURE\n,FUTURE\n", "null"),
        ("dataSymbol,instrumentType\nNA,FUTURE\nES,FUTURE\n", "null"),
        ("dataSymbol,instrumentType\n,FUTURE\n,FUTURE\n", "duplicate"),
        ("", "no content"),
    ],
)
def test_bad_contract_lists(spark, tmp_path, text, error):
    with pytest.raises(ValueError, match=error):
        sources.load_contracts(spark, csv(tmp_path, text))


def test_missing_contract_list(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.load_contracts(spark, str(tmp_path / "none.csv"))


def test_duplicates_are_looked_for_before_stripping(spark, tmp_path):
    path = csv(tmp_path, 'dataSymbol,instrumentType\nES,FUTURE\n"ES ",equity\n')
    assert [tuple(r) for r in sources.load_contracts(spark, path).collect()] == [("ES", "EQUITY")]


def record(day, **more):
    base = dict(
        date=f"2024-01-{day:02}T00:00:00.000Z", open=1.0, high=2.0, low=0.5, close=1.5, volume=100, adjOpen=1.0, adjHigh=2.0,
        adjLow=0.5, adjClose=1.5, adjVolume=100.5, divCash=0.0, splitFactor=1.0,
    )
    return {**base, **more}


def test_equity_json_takes_the_symbol_from_the_file_name(spark, tmp_path):
    (tmp_path / "AAPL.json").write_text(json.dumps([record(2), record(3, extra="x")]))
    (tmp_path / "BRK-B.json").write_text(json.dumps([record(2, close=None)]))
    df = sources.read_equity_json(spark, str(tmp_path), symbol_pattern=r"^(.+)\.json$", multi_line=True)
    assert df.columns == [*EQUITY_FIELDS, "_ord"]
    rows = df.orderBy("_ord").collect()
    assert [(r.symbol, r.time[:10], r.close, r.adj_volume) for r in rows] == [
        ("AAPL", "2024-01-02", 1.5, 100.5), ("AAPL", "2024-01-03", 1.5, 100.5), ("BRK-B", "2024-01-02", None, 100.5),
    ]


def test_equity_json_needs_its_fields(spark, tmp_path):
    bad = record(2)
    del bad["adjVolume"]
    (tmp_path / "A.json").write_text(json.dumps({**bad, "symbol": "A"}))
    with pytest.raises(MissingFields, match="adjVolume"):
        sources.read_equity_json(spark, str(tmp_path))


def test_no_equity_json_is_an_empty_frame(spark, tmp_path):
    (tmp_path / "A.json").write_text("")
    df = sources.read_equity_json(spark, str(tmp_path))
    assert df.count() == 0 and df.columns == [*EQUITY_FIELDS, "_ord"]


def test_futures_bars_from_csv_and_from_nothing(spark, tmp_path):
    path = csv(tmp_path, "ts_event,open,high,low,close,volume\n2024-01-02,1,2,0.5,1.5,7\n", "bars.csv")
    row = sources.read_futures_bars(spark, path, "csv", F.lit("MES.v.0")).first()
    assert (row.time, row.symbol, row.volume) == ("2024-01-02", "MES.v.0", "7")
    (tmp_path / "empty").mkdir()
    assert sources.read_futures_bars(spark, str(tmp_path / "empty")).count() == 0


def test_constituents_keep_order_and_skip_blanks(spark, tmp_path):
    path = csv(tmp_path, "Symbol,Name\nMMM,a\n,b\n  ,c\nBRK.B,d\n")
    assert [r.ticker for r in sources.read_constituents(spark, path).orderBy("pos").collect()] == ["MMM", "BRK.B"]


def bars(spark, *rows):
    data = [(i, s, None if t is None else datetime(2024, 1, 1) + timedelta(days=t), float(v)) for i, (s, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "_ord long, symbol string, time timestamp, close double")


def stored(spark, path):
    rows = sources.read_bars(spark, path).collect()
    return sorted((r.symbol, (r.time - datetime(2024, 1, 1)).days if r.time else None, r.close) for r in rows)


def test_insert_ignore_first_wins_and_repeats_add_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sink.insert_new(bars(spark, ("B", 1, 9)), path) == 1
    batch = bars(spark, ("A", 1, 1), ("A", 1, 2), ("B", 1, 3))
    assert sink.insert_new(batch, path) == 1
    assert sink.insert_new(batch, path) == 0
    assert stored(spark, path) == [("A", 1, 1.0), ("B", 1, 9.0)]


def test_rows_without_a_key_never_conflict(spark):
    batch = bars(spark, ("A", None, 1), ("A", None, 2), (None, 1, 3), ("A", 1, 4))
    existing = bars(spark, ("A", None, 1), ("A", 1, 1))
    assert sorted(r.close for r in dedupe.insert_ignore(batch, existing).collect()) == [1.0, 2.0, 3.0]


def test_strict_insert_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sink.insert_all(bars(spark, ("A", 1, 1), ("B", 1, 2)), path) == 2
    for batch in (bars(spark, ("C", 1, 1), ("A", 1, 5)), bars(spark, ("C", 1, 1), ("C", 1, 2))):
        with pytest.raises(dedupe.DuplicateKeys):
            sink.insert_all(batch, path)
    assert stored(spark, path) == [("A", 1, 1.0), ("B", 1, 2.0)]


def test_delete_is_inclusive_and_spares_unknown_times(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.append_bars(bars(spark, ("A", 0, 1), ("A", 1, 2), ("B", 2, 3), ("A", 40, 4), ("A", None, 5)), path)
    assert sink.delete_stored(spark, path, "2024-01-02", "2024-01-03", ["A"]) == 1
    assert sink.delete_stored(spark, path, "2024-01-02", "2024-01-03") == 1
    assert stored_without_time(spark, path) == [1.0, 4.0, 5.0]
    assert sink.delete_stored(spark, path, "2024-02-01", "2024-03-01", []) == 1  # a whole partition
    assert sink.delete_stored(spark, path, "2024-02-01", "2024-03-01") == 0
    assert stored_without_time(spark, path) == [1.0, 5.0]


def stored_without_time(spark, path):
    return sorted(r.close for r in sources.read_bars(spark, path).collect())


def test_reading_a_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.append_bars(bars(spark, *[("A", d, d) for d in range(0, 365, 10)]), path)
    df = sources.read_bars(spark, path, "2024-03-01", "2024-03-31")
    assert df.count() == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_findings_and_exports(spark, tmp_path):
    df = spark.createDataFrame([(" b.x ",), ("A",), ("A",)], "ticker string")
    sink.export_tickers(df, str(tmp_path / "tickers"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "tickers")).collect()) == [" b.x ", "A"]
    check = sink.validate_row_count(df, 3).first()
    assert (check.expected, check.actual, check.passed) == (3, 3, True)
    assert not sink.validate_row_count(df, 3, "ticker = 'A'").first().passed


def test_universe_keeps_the_first_of_each_ticker(spark, tmp_path):
    lists = [[("SPY", 0), ("QQQ", 1)], [("brk.b", 0), ("SPY", 1), (" ", 2)], [("BRK-B ", 0), ("NIO", 1)]]
    frames = [spark.createDataFrame(rows, "ticker string, pos long") for rows in lists]
    universe = build_universe(frames)
    assert [r.dataSymbol for r in universe.orderBy("priority", "pos").collect()] == ["SPY", "QQQ", "BRK-B", "NIO"]
    path = str(tmp_path / "universe")
    sink.write_universe(universe, path)
    assert [tuple(r) for r in sources.load_contracts(spark, path).orderBy("dataSymbol").collect()][0] == ("BRK-B", "EQUITY")
    baseline = spark.createDataFrame([("SPY",), ("GLD",)], "dataSymbol string")
    report = quality.validate_universe(universe, baseline, 1, 10).first()
    assert (report.size, report.missing_baseline, report.passed) == (4, 1, False)
    assert quality.validate_universe(universe, baseline.filter("dataSymbol = 'SPY'"), 1, 10).first().passed


def landed_equities(spark, days, close=1.5, start=0):
    cols = ", ".join(f"{close} AS {c}" if c != "volume" else "100L AS volume" for c in EQUITY_FIELDS[2:])
    return spark.range(start, start + days).selectExpr(
        "id AS _ord", "timestamp_seconds(1704067200 + id * 86400) AS time", "element_at(array('SPY', 'QQQ'), CAST(id % 2 AS INT) + 1) AS symbol", *cols.split(", ")
    )


def test_ingestion_continues_where_the_table_ends(spark, tmp_path):
    contracts = csv(tmp_path, "dataSymbol,instrumentType\nSPY,equity\nQQQ,EQUITY\nES,FUTURE\n")
    raw, table = str(tmp_path / "raw"), str(tmp_path / "bars")
    landed = landed_equities(spark, 20)
    first = ingest(spark, contracts, landed, raw, table, "EQUITY", seed="2024-01-01", end="2024-01-10")
    assert (str(first.start), str(first.end), first.landed, first.inserted) == ("2024-01-01", "2024-01-10", 10, 10)
    assert [r.dataSymbol for r in first.refused.collect()] == ["ES"]
    second = ingest(spark, contracts, landed, raw, table, "EQUITY", today="2024-01-16")
    assert (str(second.start), str(second.end), second.inserted) == ("2024-01-10", "2024-01-15", 5)
    again = ingest(spark, contracts, landed, raw, table, "EQUITY", today="2024-01-16")
    assert (str(again.start), again.inserted) == ("2024-01-15", 0)
    assert sources.read_bars(spark, table).count() == 15
    assert spark.read.parquet(raw).count() == 16  # raw rows are appended every time
    nothing = ingest(spark, contracts, landed, raw, table, "EQUITY", start="2030-01-01", end="2030-01-02")
    assert (nothing.landed, nothing.inserted) == (0, 0)


def test_raw_rows_survive_a_series_that_cannot_be_cleaned(spark, tmp_path):
    contracts = csv(tmp_path, "dataSymbol,instrumentType\nES,FUTURE\nCL,FUTURE\n")
    rows = [(1, datetime(2024, 1, 2), "MES.v.0", "bad", 5), (2, datetime(2024, 1, 3), "MES.v.0", "1", 5), (3, datetime(2024, 1, 2), "CL.v.0", "2", 5)]
    landed = spark.createDataFrame(rows, "_ord long, ts_event timestamp, symbol string, open string, volume long").selectExpr(
        "*", "1.0D AS high", "1.0D AS low", "1.0D AS close"
    ).withColumnRenamed("ts_event", "time")
    raw, table = str(tmp_path / "raw"), str(tmp_path / "bars")
    result = ingest(spark, contracts, landed, raw, table, "FUTURE", start="2024-01-01", end="2024-01-31")
    assert result.inserted == 1 and spark.read.parquet(raw).count() == 3
    assert {r.symbol: r.status for r in result.status.collect()} == {"MES.v.0": "failed", "CL.v.0": "ok"}
    sink.write_findings(sink.status_findings(result.status), str(tmp_path / "findings"))
    details = [r.detail for r in spark.read.parquet(str(tmp_path / "findings")).orderBy("symbol").collect()]
    assert details == ["inserted 1 rows", "failed: bad open"]


def test_backfill_counts_boundary_days_in_both_chunks(spark):
    df = landed_equities(spark, 9).select("_ord", "time", "symbol", "close")
    universe = spark.createDataFrame([("SPY",), ("QQQ",), ("NEW",)], "symbol string")
    rows, work = backfill(df.union(df), universe, "2024-01-01", "2024-01-09", "daily", 4)
    assert rows.count() == 9
    got = {(r.symbol, r.chunk_start.day, r.chunk_end.day): r.rows for r in work.collect()}
    assert got == {("SPY", 1, 5): 3, ("SPY", 5, 9): 3, ("QQQ", 1, 5): 2, ("QQQ", 5, 9): 2, ("NEW", 1, 5): 0, ("NEW", 5, 9): 0}


def test_chunk_union_goes_by_name(spark):
    a = bars(spark, ("A", 1, 1))
    b = bars(spark, ("A", 1, 2), ("B", 2, 3)).withColumn("_ord", F.col("_ord") + 10).select("close", "time", "symbol", "_ord")
    assert sorted(r.close for r in combine.union_chunks([a, b]).collect()) == [1.0, 3.0]
