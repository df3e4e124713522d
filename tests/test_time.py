"""Calendars, gaps, chunks, ranges and staleness."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators import calendars, quality


def times(spark, *stamps, symbol="A"):
    return spark.createDataFrame([(symbol, t) for t in stamps], "symbol string, time timestamp")


FRI, TUE = datetime(2024, 1, 5), datetime(2024, 1, 9)


@pytest.mark.parametrize("freq, days", [("D", [6, 7, 8]), ("B", [8])])
def test_missing_days(spark, freq, days):
    got = calendars.missing_timestamps(times(spark, FRI, TUE), freq).orderBy("time").collect()
    assert [r.time.day for r in got] == days


def test_missing_times_within_a_day_are_anchored_at_the_first(spark):
    start = datetime(2024, 1, 5, 23, 30)
    got = calendars.missing_timestamps(times(spark, start, start + timedelta(hours=3)), "H").orderBy("time").collect()
    assert [r.time for r in got] == [start + timedelta(hours=h) for h in (1, 2)]
    minutes = calendars.missing_timestamps(times(spark, start, start + timedelta(hours=25)), "min")
    assert minutes.count() == minutes.distinct().count() == 25 * 60 - 1


def test_calendar_needs_a_known_frequency_and_time_column(spark):
    with pytest.raises(ValueError):
        calendars.missing_timestamps(times(spark, FRI), "7min")
    with pytest.raises(ValueError):
        calendars.missing_timestamps(times(spark, FRI).drop("time"), "D")


@pytest.mark.parametrize("freq, longest", [("D", 9), ("B", 9), ("H", 1.5), ("min", 0.02)])
def test_missing_times_against_the_whole_calendar(spark, freq, longest):
    rnd = random.Random(5)
    rows = []
    for symbol in ("A", "B", None, "one"):
        at = datetime(2024, 1, 30, 10, 0, 0, 1)
        for _ in range(1 if symbol == "one" else 25):
            rows += [(symbol, at)] * rnd.choice([1, 1, 3])
            at += rnd.choice([timedelta(minutes=1), timedelta(hours=1), timedelta(days=1), timedelta(seconds=rnd.random() * longest * 86_400)])
    rows += [("A", None), ("none", None)]
    df = spark.createDataFrame(rows, "symbol string, time timestamp")
    whole = {tuple(r) for r in calendars.calendar(df, freq).select("symbol", "time").collect()}
    for max_rows in (7, 1_000_000):
        got = [tuple(r) for r in calendars.missing_timestamps(df, freq, max_rows=max_rows).select("symbol", "time").collect()]
        assert len(got) == len(set(got)) > 0 and set(got) == whole - set(rows)


def test_missing_times_follow_the_gaps(spark):
    """No calendar in the plan, and a gap longer than an array of times."""
    df = times(spark, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1), datetime(2024, 3, 1))
    missing = calendars.missing_timestamps(df, "min")
    assert missing.count() == 60 * 24 * 60 - 2
    assert "LeftAnti" not in missing._jdf.queryExecution().optimizedPlan().toString()


def test_gaps_between_days(spark):
    df = times(spark, datetime(2024, 3, 4), datetime(2024, 3, 1), datetime(2024, 3, 3), datetime(2024, 3, 3))
    assert [tuple(r) for r in calendars.list_gaps(df).collect()] == [(datetime(2024, 3, 1), datetime(2024, 3, 3))]
    assert calendars.list_gaps(df.limit(0)).count() == 0
    assert calendars.count_gaps(df.limit(0)).first().gap_count == 0


def test_a_gap_is_strictly_longer_than_the_threshold(spark):
    t = datetime(2024, 3, 1, 10, 0, 0, 1)
    df = times(spark, t, t + timedelta(seconds=60), t + timedelta(seconds=120, microseconds=1), None)
    assert calendars.count_gaps(df, 60).first().gap_count == 1


def test_gap_count_matches_a_plain_loop_across_blocks(spark):
    rnd = random.Random(3)
    at, stamps = datetime(1969, 12, 1), []
    for _ in range(3000):
        at += timedelta(seconds=rnd.choice([1, 30, 59, 60, 61, 500, 5_000_000]) if rnd.random() < 0.9 else 0)
        stamps.append(at)
    expected = [(a, b) for a, b in zip(stamps, stamps[1:]) if (b - a).total_seconds() > 60]
    rnd.shuffle(stamps)
    df = times(spark, *stamps)
    assert calendars.count_gaps(df, 60).first().gap_count == len(expected)
    assert sorted(tuple(r) for r in calendars.list_gaps(df, 60).collect()) == expected


def chunks(spark, *args):
    return [(r.start_text, r.end_text) for r in calendars.time_chunks(spark, *args).orderBy("chunk_start").collect()]


def test_chunks(spark):
    assert chunks(spark, "2023-01-01", "2023-01-02", "daily", 1) == [("2023-01-01", "2023-01-02")]
    assert chunks(spark, "2024-01-01", "2024-01-08", "Daily", 3) == [
        ("2024-01-01", "2024-01-04"), ("2024-01-04", "2024-01-07"), ("2024-01-07", "2024-01-08"),
    ]
    assert chunks(spark, "2024-01-01", "2024-01-01", "daily", 3) == []
    assert chunks(spark, "2024-01-02", "2024-01-01", "daily", 3) == []
    assert chunks(spark, "2024-01-01", "2024-01-01 01:00", "min", 45)[-1] == ("2024-01-01 00:45:00", "2024-01-01 01:00:00")


@pytest.mark.parametrize("unit, n, error", [("weekly", 1, ValueError), ("daily", 1.5, TypeError), ("daily", True, TypeError), ("daily", 0, ValueError)])
def test_bad_chunks(spark, unit, n, error):
    with pytest.raises(error):
        calendars.time_chunks(spark, "2024-01-01", "2024-01-02", unit, n)


def test_range_resolution(spark):
    stored = times(spark, datetime(2026, 6, 1), datetime(2026, 5, 1))
    empty = stored.limit(0)
    bounds = calendars.range_bounds
    assert bounds(empty, "2026-02-03", "2026-02-28") == (date(2026, 2, 3), date(2026, 2, 28))
    assert bounds(stored, today="2026-06-20") == (date(2026, 6, 2), date(2026, 6, 19))
    assert bounds(empty, seed="2026-01-01", today="2026-06-20") == (date(2026, 1, 1), date(2026, 6, 19))
    assert bounds(times(spark, datetime(2026, 6, 30)), end="2026-06-15") == (date(2026, 6, 15), date(2026, 6, 15))
    assert bounds(empty, "", "", seed="2026-01-01", today="2026-01-05") == (date(2026, 1, 1), date(2026, 1, 4))
    with pytest.raises(ValueError):
        bounds(empty, today="2026-06-20")


def test_an_explicit_start_does_not_read_the_table(spark):
    broken = times(spark, FRI).withColumn("time", F.raise_error(F.lit("table was read")).cast("timestamp"))
    assert calendars.range_bounds(broken, "2026-02-03", "2026-02-04") == (date(2026, 2, 3), date(2026, 2, 4))


def test_range_per_symbol_keeps_missed_days(spark):
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    stored = times(spark, datetime(2026, 1, 5)).union(times(spark, datetime(2026, 1, 2), symbol="B"))
    got = calendars.resolve_range_per_symbol(universe, stored, end="2026-01-06", seed="2025-12-01").collect()
    assert {r.symbol: str(r.start_date) for r in got} == {"A": "2026-01-06", "B": "2026-01-03", "C": "2025-12-01"}


def test_staleness(spark):
    now = datetime(2024, 3, 10, 12)
    for age, stale in ((timedelta(days=2), True), (timedelta(hours=12), False), (timedelta(days=1), False)):
        row = quality.staleness(times(spark, now - age), now).first()
        assert (row.age_seconds, row.is_stale) == (age.total_seconds(), stale)
    assert tuple(quality.staleness(times(spark, now).limit(0), now).first()) == (None, None, None)


def gate(spark, *rows):
    df = spark.createDataFrame(rows, "symbol string, asset_type string, value_column double, time timestamp")
    row = quality.quality_gate(df).first()
    return row.passed, row.first_failed


def test_quality_gate_stops_at_the_first_failure(spark):
    t = datetime(2024, 1, 1)
    good = ("A", "EQUITY", 1.0, t)
    assert gate(spark, good, ("A", "EQUITY", 2.0, t + timedelta(seconds=60))) == (True, None)
    assert gate(spark, good, ("A", "EQUITY", 2.0, t + timedelta(seconds=61))) == (False, "gaps")
    assert gate(spark, good, ("A", "EQUITY", 0.0, t + timedelta(days=1))) == (False, "zeros")
    assert gate(spark, good, (None, "EQUITY", 0.0, t + timedelta(days=1))) == (False, "nulls")
