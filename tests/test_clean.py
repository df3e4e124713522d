"""Coercion and the two cleaning plans on hand-made rows."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barloom.functions.numbers import lenient_double, lenient_long
from barloom.functions.symbols import stable_bucket
from barloom.operators import predicates, project, quality
from barloom.plans import clean_equities, clean_futures, equity_rejections, screen_equities
from barloom.schemas import EQUITY_FIELDS, FUTURES_FIELDS


def equity(ord_, time, close=185.0, symbol="aapl", volume=1000, **more):
    row = dict(
        _ord=ord_, time=time, symbol=symbol, open=184.0, high=186.0, low=183.0, close=close, volume=volume,
        adj_open=184.0, adj_high=186.0, adj_low=183.0, adjusted_close=185.0, adj_volume=1000.5, div_cash=0.0,
        split_factor=1.0, junk_extra=1,
    )
    return {**row, **more}


SCHEMA = (
    "_ord long, time string, symbol string, open double, high double, low double, close double, volume string,"
    " adj_open double, adj_high double, adj_low double, adjusted_close double, adj_volume double, div_cash double,"
    " split_factor double, junk_extra long"
)


def equities(spark, *rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    data = [tuple(str(r[n]) if n == "volume" and r[n] is not None else r[n] for n in names) for r in rows]
    return spark.createDataFrame(data, SCHEMA)


JAN2, JAN3 = "2024-01-02T00:00:00.000Z", "2024-01-03T00:00:00.000Z"


def test_equity_rows_are_cleaned(spark):
    df = equities(spark, equity(3, JAN3, -5.0), equity(1, JAN3), equity(2, JAN3, 999.0), equity(4, JAN2))
    rows = clean_equities(df).collect()
    assert [(r.symbol, r.time) for r in rows] == [("AAPL", datetime(2024, 1, 2)), ("AAPL", datetime(2024, 1, 3))]
    assert rows[1].close == 185.0  # the first copy
    assert list(rows[0].asDict()) == EQUITY_FIELDS
    assert clean_equities(df).schema["volume"].dataType.typeName() == "long"


def test_equity_cleaning_of_nothing_is_nothing(spark):
    assert clean_equities(equities(spark)).count() == 0


def test_equity_columns_are_required(spark):
    with pytest.raises(project.MissingFields, match="adj_volume"):
        clean_equities(equities(spark, equity(1, JAN2)).drop("adj_volume"))


def test_equity_rejections_are_counted(spark):
    df = equities(
        spark, equity(1, JAN2), equity(2, JAN2), equity(3, JAN2, symbol=" AAPL "), equity(4, None), equity(5, JAN3, symbol=None),
        equity(6, "soon"), equity(7, JAN3, volume="many"), equity(8, JAN3, volume=-1), equity(9, JAN3, close=0.0),
        equity(10, JAN3, close=None), equity(11, JAN3, volume="-0.5"),
    )
    counts = {r.reason: r.rows for r in equity_rejections(screen_equities(df, policies=())).collect()}
    assert counts == {"retained": 2, "duplicate": 2, "unkeyed": 2, "bad time": 1, "bad volume": 1, "corrupt": 3}
    assert clean_equities(df, policies=()).count() == counts["retained"]


def test_symbols_that_differ_in_spelling_share_a_fill(spark):
    df = equities(spark, equity(1, JAN2, symbol=" aapl"), equity(2, JAN3, None, symbol="AAPL\t"))
    assert [r.close for r in clean_equities(df, ["forward_fill"]).collect()] == [185.0, 185.0]


def futures(spark, rows, volume="long", close="double"):
    return spark.createDataFrame(
        rows, f"_ord long, ts_event string, symbol string, open double, high double, low double, close {close}, volume {volume}, extra int"
    )


def test_futures_rows_are_cleaned(spark):
    df = futures(spark, [(2, "2024-01-03", "ES", 1.0, 2.0, 0.5, None, 7, 1), (1, "2024-01-02", "ES", 1.0, 2.0, 0.5, 1.5, 5, None)])
    clean = clean_futures(df)
    assert sorted(clean.columns) == sorted(FUTURES_FIELDS)
    assert [(r.time, r.close, r.volume) for r in clean.collect()] == [(datetime(2024, 1, 2), 1.5, 5), (datetime(2024, 1, 3), 0.0, 7)]


def test_futures_need_rows_and_columns(spark):
    one = futures(spark, [(1, "2024-01-02", "ES", 1.0, 2.0, 0.5, 1.5, 5, 1)])
    with pytest.raises(ValueError, match="no rows"):
        clean_futures(one.limit(0))
    with pytest.raises(project.MissingFields, match="close"):
        clean_futures(one.drop("close"))


def test_dropping_counts_extra_columns_in_the_futures_line(spark):
    df = futures(spark, [(1, "2024-01-02", "ES", 1.0, 2.0, 0.5, 1.5, 5, None), (2, "2024-01-03", "ES", 1.0, 2.0, 0.5, 1.5, 5, 1)])
    assert clean_futures(df, ["drop_nan"]).count() == 1


def test_strict_typing_fails_or_isolates(spark):
    rows = [(1, "2024-01-02", "ES", 1.0, 2.0, 0.5, "x", 5, 1), (2, "2024-01-02", "NQ", 1.0, 2.0, 0.5, "1.5", 5, 1)]
    df = futures(spark, rows, close="string")
    with pytest.raises(PySparkException, match="bad close"):
        clean_futures(df, ()).collect()
    clean, status = clean_futures(df, (), isolate=True)
    assert [r.symbol for r in clean.collect()] == ["NQ"]
    assert {r.symbol: (r.status, r.rows, r.failed_rows, r.first_reason) for r in status.collect()} == {
        "ES": ("failed", 1, 1, "bad close"), "NQ": ("ok", 1, 0, None),
    }


def test_a_missing_volume_fails_its_symbol_but_a_missing_price_does_not(spark):
    df = futures(spark, [(1, "2024-01-02", "ES", 1.0, 2.0, 0.5, 1.0, None, 1), (2, "2024-01-02", "NQ", None, 2.0, 0.5, 1.5, 5, 1)])
    _, status = quality.isolate_failures(project.normalize_time_column(df))
    assert {r.symbol: r.first_reason for r in status.collect()} == {"ES": "missing volume", "NQ": None}


def test_asset_types(spark):
    df = spark.createDataFrame([("ES", "FUTURE"), ("SPY", "EQUITY"), ("X", "OPTION"), ("Y", None)], "dataSymbol string, instrumentType string")
    ok, refused = project.check_asset_type(df, "FUTURE")
    assert [r.dataSymbol for r in ok.collect()] == ["ES"]
    assert refused.count() == 3
    ok, refused = project.check_asset_type(df, "OPTION")
    assert ok.count() == 0
    assert {r.dataSymbol: r.reason for r in refused.collect()}["X"] == "no such asset type here: OPTION"


def test_canonical_symbols(spark):
    df = spark.createDataFrame([("ES", "FUTURE"), ("6A", "FUTURE"), ("ES", "EQUITY")], "dataSymbol string, instrumentType string")
    assert [r.symbol for r in project.canonical_symbol(df, "v", "0").collect()] == ["MES.v.0", "6A.v.0", "ES"]
    with pytest.raises(ValueError):
        project.canonical_symbol(df, "x", "0")


def test_contracts_collapse_last_wins(spark):
    df = spark.createDataFrame([(1, "ES ", "future"), (2, " ES", "equity"), (3, "nq", "Future")], "_ord long, dataSymbol string, instrumentType string")
    assert sorted(tuple(r) for r in project.normalize_contracts(df).collect()) == [("ES", "EQUITY"), ("nq", "FUTURE")]


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("10.7",), ("-0.9",), ("x",), ("",), (None,), ("NaN",), ("9007199254740993",), ("1e3",)], "t string")
    got = df.select(lenient_double(F.col("t")).alias("d"), lenient_long(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [1, 2, 10, 0, None, None, None, None, 9007199254740993, 1000]
    assert [r.d for r in got][:8] == [1.5, 2.0, 10.7, -0.9, None, None, None, None]


def test_stable_buckets(spark):
    df = spark.createDataFrame([("SPY",), ("BRK-B",)], "s string")
    assert [r[0] for r in df.select(stable_bucket(F.col("s"), 12)).collect()][0] == 9
    assert [r[0] for r in df.select(stable_bucket(F.col("s"), 7)).collect()][1] == 2
    many = spark.range(50).select(F.col("id").cast("string").alias("s"))
    assert many.select(stable_bucket(F.col("s"), 3).alias("b")).distinct().count() == 3


def test_ranges_are_inclusive_and_empty_lists_do_not_filter(spark):
    df = spark.createDataFrame([("A", datetime(2024, 1, 1)), ("A", datetime(2024, 1, 2, 12)), ("B", datetime(2024, 1, 2))], "symbol string, time timestamp")
    assert df.filter(predicates.in_range("2024-01-01", "2024-01-02")).count() == 2
    assert df.filter(predicates.in_day_range("2024-01-01", "2024-01-02")).count() == 3
    assert predicates.with_symbols(df, None).count() == predicates.with_symbols(df, []).count() == 3
    assert predicates.with_symbols(df, ["B"] + [f"X{i}" for i in range(500)]).count() == 1
