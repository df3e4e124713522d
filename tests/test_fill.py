"""Missing-data policies on hand-made frames."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from barloom.operators import fill
from barloom.operators.aggregates import column_stats

SCHEMA = "_ord long, symbol string, time timestamp, open double, high double, low double, close double, volume double"


@pytest.fixture
def two_rows(spark):
    """Second row lacks open, close and volume."""
    return spark.createDataFrame(
        [(1, "A", None, 100.0, 110.0, 90.0, 105.0, 1000.0), (2, "A", None, None, 115.0, 95.0, None, None)], SCHEMA
    )


def column(spark, values, symbol="A"):
    return spark.createDataFrame([(i, symbol, i, v) for i, v in enumerate(values)], "_ord long, symbol string, time long, v double")


def values_of(df, col="v"):
    return [r[col] for r in df.orderBy("_ord").collect()]


@pytest.mark.parametrize(
    "policy, second",
    [
        ("forward_fill", (100.0, 105.0, 1000.0)),
        ("backward_fill", (None, None, None)),
        ("interpolate", (100.0, 105.0, 1000.0)),
        ("zero_fill", (0.0, 0.0, 0.0)),
        ("mean_fill", (100.0, 105.0, 1000.0)),
        ("median_fill", (100.0, 105.0, 1000.0)),
        ("custom_fill", (7.0, 7.0, 7.0)),
    ],
)
def test_each_policy(two_rows, policy, second):
    rows = fill.handle_missing(two_rows, [policy], "7").orderBy("_ord").collect()
    assert len(rows) == 2
    assert (rows[1].open, rows[1].close, rows[1].volume) == second
    assert (rows[1].high, rows[1].low) == (115.0, 95.0)
    assert rows[0].open == 100.0 and rows[0].symbol == "A" and rows[0].time is None


def test_drop_counts_every_column(two_rows, spark):
    assert fill.drop_missing(two_rows).count() == 0  # no row has a time
    assert fill.drop_missing(two_rows, ["open", "close"]).count() == 1


def test_nan_is_missing(spark):
    df = column(spark, [1.0, float("nan"), 3.0])
    assert values_of(fill.forward_fill(df, ["v"])) == [1.0, 1.0, 3.0]
    assert values_of(fill.interpolate(df, ["v"])) == [1.0, 2.0, 3.0]
    assert values_of(fill.zero_fill(df, ["v"])) == [1.0, 0.0, 3.0]
    assert values_of(fill.mean_fill(df, ["v"])) == [1.0, 2.0, 3.0]
    assert values_of(fill.custom_fill(df, ["v"], 9)) == [1.0, 9.0, 3.0]
    assert values_of(fill.drop_missing(df)) == [1.0, 3.0]


def test_interpolation_keeps_leading_and_repeats_trailing_gaps(spark):
    assert values_of(fill.interpolate(column(spark, [None, 1.0, None, 3.0, None]), ["v"])) == [None, 1.0, 2.0, 3.0, 3.0]


def test_interpolation_goes_by_position_not_by_time(spark):
    rows = [(1, "A", 0, 0.0), (2, "A", 1, None), (3, "A", 100, 10.0)]
    df = spark.createDataFrame(rows, "_ord long, symbol string, time long, v double")
    assert values_of(fill.interpolate(df, ["v"])) == [0.0, 5.0, 10.0]


def test_backward_fill_leaves_trailing_gap(spark):
    assert values_of(fill.backward_fill(column(spark, [None, 1.0, None]), ["v"])) == [1.0, 1.0, None]


def test_median_is_the_mean_of_the_middle_two(spark):
    df = column(spark, [1.0, 2.0, 10.0, 20.0, None])
    assert values_of(fill.median_fill(df, ["v"])) == [1.0, 2.0, 10.0, 20.0, 6.0]


def test_policies_run_in_fixed_order(spark):
    df = column(spark, [None, 1.0, None])
    config = {"zero_fill": "True", "forward_fill": "True"}
    assert values_of(fill.handle_missing(df, config)) == [0.0, 1.0, 1.0]


def test_only_the_text_true_enables_a_policy(spark):
    df = column(spark, [None, 1.0])
    config = {"zero_fill": True, "mean_fill": "true", "custom_value": "0", "forward_fill": "False"}
    assert values_of(fill.handle_missing(df, config)) == [None, 1.0]
    with pytest.raises(ValueError):
        fill.handle_missing(df, ["zerofill"])


def test_symbols_do_not_leak_into_each_other(spark):
    df = column(spark, [5.0, None]).union(column(spark, [None, 8.0], "B"))
    got = {(r.symbol, r._ord): r.v for r in fill.forward_fill(df, ["v"]).collect()}
    assert got == {("A", 0): 5.0, ("A", 1): 5.0, ("B", 0): None, ("B", 1): 8.0}


def test_whole_number_columns_take_fractional_statistics(spark):
    df = spark.createDataFrame([(0, "A", 0, 1), (1, "A", 1, 2), (2, "A", 2, None)], "_ord long, symbol string, time long, v long")
    assert values_of(fill.mean_fill(df, ["v"])) == [1.0, 2.0, 1.5]


def test_a_group_without_values_stays_missing(spark):
    df = column(spark, [None, None]).union(column(spark, [4.0, None], "B"))
    got = sorted(((r.symbol, r._ord), r.v) for r in fill.median_fill(df, ["v"]).collect())
    assert [v for _, v in got] == [None, None, 4.0, 4.0]


def test_medians_of_all_kinds_of_doubles(spark):
    rng = random.Random(7)
    near = [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 0.9999999999999999, 1023.9999999999999, 1024.0]
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, *near, *[-x for x in near]]
    groups = {f"g{i}": [rng.choice(odd) for _ in range(rng.randint(1, 9))] for i in range(60)}
    groups |= {f"s{i}": [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(rng.randint(1, 40))] for i in range(20)}
    groups["bulk"] = [rng.gauss(100, 1e-13) for _ in range(3000)]
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values] + [("none", None)], "symbol string, v double")
    got = {r.symbol: r.v_median for r in column_stats(df, ["v"], ["symbol"], ("median",)).collect()}
    half = lambda a, b: a if a == b else (a + b) / 2
    want = {g: half(*(sorted(values)[i] for i in ((len(values) - 1) // 2, len(values) // 2))) for g, values in groups.items()}
    same = lambda a, b: a == b or (math.isnan(a) and math.isnan(b))
    assert got.pop("none") is None and got.keys() == want.keys()
    assert [g for g in want if not same(got[g], want[g])] == []


def test_interpolation_takes_time_in_proportion(spark):
    def seconds(n):
        df = spark.range(n).select(F.col("id").alias("_ord"), F.lit("A").alias("symbol"), F.col("id").alias("time"), F.when(F.col("id") % 5000 == 0, F.col("id").cast("double")).alias("v"))
        started = time.perf_counter()
        assert fill.interpolate(df, ["v"]).where(f"abs(v - least(_ord, {(n - 1) // 5000 * 5000})) > 1e-6").count() == 0
        return time.perf_counter() - started

    seconds(1000)
    once = seconds(100_000)
    assert seconds(400_000) < 8 * once + 2
