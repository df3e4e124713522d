"""Split series must give exactly what one window per key gives."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import adjust, aggregates, fill, series
from barloom.operators.series import SEGMENT, arrange, last_known, neighbour, running_sum


def skewed(spark, rows=3000, seed=7):
    """One key with half of all rows, many of them at a single time; NULL keys and times too."""
    rnd = random.Random(seed)
    data = []
    for i in range(rows):
        key = "hot" if i % 2 else rnd.choice(["a", "b", None])
        time = 500 if rnd.random() < 0.3 else rnd.choice([None, *range(1000)])
        value = None if rnd.random() < 0.6 else float(rnd.randrange(50))
        data.append((i, key, time, value))
    rnd.shuffle(data)
    return spark.createDataFrame(data, "_ord long, symbol string, time long, v double").repartition(8)


def rows_of(df, *cols):
    return sorted(df.select("_ord", *cols).collect())


@pytest.fixture(scope="module")
def data(spark):
    return skewed(spark).cache()


def window(reverse=False):
    order = [
        F.col(c).desc_nulls_last() if reverse else F.col(c).asc_nulls_first() for c in ("time", "_ord")
    ]
    return Window.partitionBy("symbol").orderBy(*order)


def test_cuts_rows_into_segments_of_constant_size(data):
    s = arrange(data, ["symbol"], ["time", "_ord"], max_rows=200)
    assert s.split
    sizes = {r[SEGMENT]: r["count"] for r in s.df.groupBy(SEGMENT).count().collect()}
    assert sum(sizes.values()) == 3000
    assert len(sizes) >= 12 and max(sizes.values()) <= 400
    assert not arrange(data, ["symbol"], ["time", "_ord"], max_rows=10_000).split


def test_small_segments_share_tasks_and_files(spark):
    rows = spark.range(0, 3000, 1, 4).select(
        F.col("id").alias("_ord"), F.lit("hot").alias("symbol"), (F.col("id") % 7).alias("time"),
        F.when(F.col("id") % 900 == 0, F.col("id").cast("double")).alias("v"),
    )
    s = arrange(rows, ["symbol"], ["time", "_ord"], max_rows=5)
    sizes = [r["count"] for r in s.df.groupBy(SEGMENT).count().collect()]
    assert len(s.df.inputFiles()) == 1 and sizes == [5] * 600
    cut, whole = (fill.forward_fill(rows, ["v"], max_rows=n) for n in (5, 3000))
    assert rows_of(cut, "v") == rows_of(whole, "v")


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(series, "TASK_ROWS", 500)
    rows = skewed(spark)
    s = arrange(rows, ["symbol"], ["time", "_ord"], max_rows=90)
    assert len(s.df.inputFiles()) == 6
    assert max(r["count"] for r in s.df.groupBy(SEGMENT).count().collect()) <= 90
    plain = rows.select("_ord", F.last("v", ignorenulls=True).over(window().rowsBetween(Window.unboundedPreceding, 0)).alias("known"))
    key = lambda found: [tuple(str(x) for x in r) for r in found]
    assert key(rows_of(last_known(s, {"known": F.col("v")}).rows(), "known")) == key(rows_of(plain, "known"))


def test_segments_follow_the_order(data):
    s = arrange(data, ["symbol"], ["time", "_ord"], max_rows=200)
    ranges = (
        s.df.groupBy("symbol", SEGMENT)
        .agg(F.min(F.struct("time", "_ord")).alias("lo"), F.max(F.struct("time", "_ord")).alias("hi"))
        .filter(F.col("symbol") == "hot")
        .orderBy(SEGMENT)
        .withColumn("before", F.lag("hi").over(Window.partitionBy("symbol").orderBy(SEGMENT)))
    )
    assert ranges.filter("before >= lo").count() == 0


@pytest.mark.parametrize("max_rows", [60, 700])
@pytest.mark.parametrize("reverse", [False, True])
def test_scans_match_plain_windows(data, max_rows, reverse):
    w = window(reverse)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    plain = data.select(
        "_ord",
        F.last("v", ignorenulls=True).over(upto).alias("known"),
        F.lag("v").over(w).alias("next_to"),
        F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("total"),
        F.coalesce(F.sum("v").over(before), F.lit(0)).alias("total_before"),
    )
    s = arrange(data, ["symbol"], ["time", "_ord"], max_rows)
    assert s.split
    s = last_known(s, {"known": F.col("v")}, reverse)
    s = neighbour(s, {"next_to": F.col("v")}, reverse)
    s = running_sum(s, {"total": F.col("v")}, reverse)
    s = running_sum(s, {"total_before": F.col("v")}, reverse, inclusive=False)
    cols = ["known", "next_to", "total", "total_before"]
    key = lambda rows: [tuple(str(x) for x in r) for r in rows]
    got = sorted(key(s.rows().select("_ord", *cols).collect()))
    assert got == sorted(key(plain.select("_ord", *cols).collect()))


@pytest.mark.parametrize("policy", [fill.forward_fill, fill.backward_fill, fill.interpolate])
def test_fills_do_not_depend_on_splitting(data, policy):
    whole = policy(data, ["v"])
    cut = policy(data, ["v"], max_rows=100)
    assert cut.columns == data.columns
    one = {r._ord: r.v for r in whole.collect()}
    two = {r._ord: r.v for r in cut.collect()}
    assert len(one) == 3000 and one.keys() == two.keys()
    assert one == two


def test_medians_against_sparks_own(data):
    many = data.withColumn("w", F.pmod(F.hash("_ord"), F.lit(100000)) / 7)
    whole = many.groupBy("symbol").agg(F.median("v").alias("v"), F.median("w").alias("w"), F.avg("w").alias("m"))
    cut = aggregates.column_stats(many, ["v", "w"], ["symbol"])
    a = {r.symbol: (r.v, r.w, round(r.m, 6)) for r in whole.collect()}
    b = {r.symbol: (r.v_median, r.w_median, round(r.w_mean, 6)) for r in cut.collect()}
    assert a == b and len(a) == 4


def test_back_adjustment_does_not_depend_on_splitting(data):
    bars = data.select(
        "_ord", "time", F.lit("s").alias("series"), F.col("symbol"),
        *[(F.pmod(F.hash("_ord", F.lit(i)), F.lit(1000)) / 4).alias(c) for i, c in enumerate(["open", "high", "low", "close"])],
        F.pmod(F.hash("_ord", F.lit(9)), F.lit(50)).cast("bigint").alias("volume"),
    )
    whole = {r._ord: r for r in adjust.back_adjust(bars, "series").collect()}
    cut = {r._ord: r for r in adjust.back_adjust(bars, "series", max_rows=150).collect()}
    assert whole == cut and len(whole) == 3000
    assert len({r.close for r in whole.values()}) > 100


def test_more_than_4096_segments(spark):
    rows = spark.range(0, 4200, 1, 4).select(
        F.col("id").alias("_ord"), F.lit("hot").alias("symbol"), (F.col("id") % 7).alias("time"),
        F.when(F.col("id") % 900 == 0, F.col("id").cast("double")).alias("v"),
    )
    s = arrange(rows, ["symbol"], ["time", "_ord"], max_rows=1)
    assert s.df.select(SEGMENT).distinct().count() > 4000
    w = Window.partitionBy("symbol").orderBy("time", "_ord").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.select("_ord", F.last("v", ignorenulls=True).over(w).alias("known"))
    assert rows_of(last_known(s, {"known": F.col("v")}).rows(), "known") == rows_of(plain, "known")
