"""Volume rolls and back-adjustment on hand-made series."""

import pytest

from barloom.operators.adjust import back_adjust, roll_points

SCHEMA = "series string, _ord long, time long, symbol string, open double, high double, low double, close double, volume long"


def bars(spark, rows):
    data = [("S", i, i, s, o + 0.0, o + 1.0, o - 1.0, c + 0.0, v) for i, (s, o, c, v) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def shifts(spark, rows, **options):
    df = bars(spark, rows)
    before = {r._ord: r for r in df.collect()}
    after = back_adjust(df, "series", **options).orderBy("_ord").collect()
    assert [r.volume for r in after] == [v for *_, v in rows]
    for r in after:
        for c in ("high", "low", "close"):
            assert getattr(r, c) - getattr(before[r._ord], c) == pytest.approx(r.open - before[r._ord].open)
    return [r.open - before[r._ord].open for r in after]


@pytest.mark.parametrize("max_rows", [1, 2, 100])
def test_earlier_rows_take_the_difference(spark, max_rows):
    rows = [("A", 9, 10, 5), ("A", 10, 11, 5), ("B", 15, 16, 9)]
    assert shifts(spark, rows, max_rows=max_rows) == [-4, -4, 0]


def test_a_change_without_more_volume_is_no_roll(spark):
    assert shifts(spark, [("A", 9, 10, 5), ("B", 15, 16, 5), ("A", 3, 4, 2)]) == [0, 0, 0]


@pytest.mark.parametrize("max_rows", [1, 100])
def test_factors_of_several_rolls_add_up(spark, max_rows):
    rows = [("A", 10, 11, 5), ("B", 15, 16, 9), ("C", 15, 15, 12)]
    assert shifts(spark, rows, max_rows=max_rows) == [-3, 1, 0]


def test_roll_points(spark):
    got = roll_points(bars(spark, [("A", 10, 11, 5), ("B", 15, 16, 9), ("B", 1, 2, 99)]), "series").orderBy("_ord").collect()
    assert [r.is_roll for r in got] == [False, True, False]
    assert [r.roll_factor for r in got] == [None, -4.0, None]


def test_series_are_adjusted_apart(spark):
    df = bars(spark, [("A", 10, 11, 5), ("B", 15, 16, 9)])
    other = df.selectExpr("'T' AS series", *df.columns[1:]).filter("symbol = 'A'")
    got = {(r.series, r._ord): r.close for r in back_adjust(df.union(other), "series").collect()}
    assert got == {("S", 0): 7.0, ("S", 1): 16.0, ("T", 0): 11.0}


def test_a_roll_without_a_price_makes_earlier_prices_unknown(spark):
    df = bars(spark, [("A", 10, 11, 5), ("B", 15, 16, 9), ("C", 20, 21, 12)])
    df = df.selectExpr("series", "_ord", "time", "symbol", "IF(symbol = 'B', NULL, open) AS open", "high", "low", "close", "volume")
    got = back_adjust(df, "series").orderBy("_ord").collect()
    assert [r.close for r in got] == [None, 16.0 - 4.0, 21.0]
