"""Commits of stored tables: two writers, broken runs, marks, compaction, and backfills that go on."""

from datetime import datetime, timedelta

import pytest

from barloom import sources
from barloom.operators import dedupe
from barloom.operators.calendars import resolve_range_from
from barloom.plans import backfill_resumable
from barloom.sinks import commits
from barloom.sinks import tables as sink
from barloom.sources.stored import latest_per_symbol, read_marks, snapshot


def bars(spark, *rows):
    data = [(i, s, None if t is None else datetime(2024, 1, 1) + timedelta(days=t), float(v)) for i, (s, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "_ord long, symbol string, time timestamp, close double")


def stored(spark, path):
    rows = sources.read_bars(spark, path).collect()
    return sorted(((r.symbol, (r.time - datetime(2024, 1, 1)).days if r.time else None, r.close) for r in rows), key=str)


def between(monkeypatch, times, action):
    """Let another writer commit just before this one does, for the first ``times`` commits."""
    real, left = commits.publish, [times]

    def publish(spark, path, base, *args):
        if left[0]:
            left[0] -= 1
            action()
        return real(spark, path, base, *args)

    monkeypatch.setattr(sink, "publish", publish)


def test_of_two_inserts_of_one_key_one_row_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sink.insert_new(bars(spark, ("A", 0, 0)), path)
    between(monkeypatch, 1, lambda: sink.insert_new(bars(spark, ("A", 1, 1), ("B", 1, 1)), path))
    assert sink.insert_new(bars(spark, ("A", 1, 2), ("C", 1, 2)), path) == 1
    assert stored(spark, path) == [("A", 0, 0.0), ("A", 1, 1.0), ("B", 1, 1.0), ("C", 1, 2.0)]


def test_of_two_strict_inserts_of_one_key_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    between(monkeypatch, 1, lambda: sink.insert_all(bars(spark, ("A", 1, 1)), path))
    with pytest.raises(dedupe.DuplicateKeys):
        sink.insert_all(bars(spark, ("A", 1, 2), ("C", 1, 2)), path)
    assert stored(spark, path) == [("A", 1, 1.0)]


def test_a_delete_does_not_lose_what_is_inserted_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sink.append_bars(bars(spark, ("A", 0, 0), ("A", 1, 1), ("A", 2, 2)), path)
    between(monkeypatch, 1, lambda: sink.append_bars(bars(spark, ("B", 1, 5), ("B", 2, 6)), path))
    assert sink.delete_stored(spark, path, "2024-01-02", "2024-01-02") == 2
    assert stored(spark, path) == [("A", 0, 0.0), ("A", 2, 2.0), ("B", 2, 6.0)]


def test_writers_that_never_come_first_give_up(spark, tmp_path, monkeypatch):
    path, left = str(tmp_path / "t"), []
    sink.append_bars(bars(spark, ("A", 0, 0)), path)
    monkeypatch.setattr(sink, "publish", lambda *args: left.append(1))
    with pytest.raises(commits.CommitConflict):
        sink.insert_new(bars(spark, ("B", 1, 5)), path)
    assert len(left) == sink.ATTEMPTS and stored(spark, path) == [("A", 0, 0.0)]


@pytest.mark.parametrize("work", ["insert", "delete", "compact"])
def test_a_killed_run_leaves_the_old_state(spark, tmp_path, monkeypatch, work):
    path = str(tmp_path / "t")
    for value in (0, 1):
        sink.append_bars(bars(spark, ("A", value, value), ("A", value + 10, value)), path)
    before = stored(spark, path)

    def killed(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(sink, "publish", killed)
    run = {
        "insert": lambda: sink.insert_new(bars(spark, ("B", 1, 5)), path),
        "delete": lambda: sink.delete_stored(spark, path, "2024-01-01", "2024-01-02"),
        "compact": lambda: sink.compact_stored(spark, path),
    }[work]
    with pytest.raises(KeyboardInterrupt):
        run()
    assert stored(spark, path) == before
    monkeypatch.undo()
    assert commits.purge(spark, path) == 1 and stored(spark, path) == before and commits.purge(spark, path) == 0
    run()
    assert (stored(spark, path) == before) == (work == "compact")


def test_a_run_killed_after_its_commit_leaves_the_new_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sink.append_bars(bars(spark, ("A", 0, 0), ("A", 1, 1), ("A", 40, 4)), path)

    def killed(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(sink, "remove_path", killed)
    with pytest.raises(KeyboardInterrupt):
        sink.delete_stored(spark, path, "2024-01-02", "2024-03-01")
    assert stored(spark, path) == [("A", 0, 0.0)]
    assert commits.purge(spark, path) == 2 and stored(spark, path) == [("A", 0, 0.0)]


def test_thinned_folders_are_written_once_and_others_left_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.append_bars(bars(spark, ("A", 0, 0), ("A", 1, 1), ("A", 40, 4), ("A", None, 5)), path)
    before = snapshot(spark, path)
    old = sources.read_bars(spark, path)
    assert sink.delete_stored(spark, path, "2024-01-02", "2024-01-03", keep_old=True) == 1
    after = snapshot(spark, path)
    assert after.version == before.version + 1 and len(set(after.folders) - set(before.folders)) == 1 and len(set(before.folders) - set(after.folders)) == 1
    assert old.count() == 4 and stored(spark, path) == [("A", 0, 0.0), ("A", 40, 4.0), ("A", None, 5.0)]  # readers of the old state go on


def test_marks_follow_inserts_and_deletes(spark, tmp_path):
    path = str(tmp_path / "t")
    latest = lambda: {r.symbol: r.latest and (r.latest - datetime(2024, 1, 1)).days for r in latest_per_symbol(spark, path).collect()}
    assert latest() == {}
    sink.insert_new(bars(spark, ("A", 0, 0), ("A", 40, 4), ("B", 3, 1), ("C", None, 1)), path)
    sink.insert_new(bars(spark, ("A", 35, 0), ("B", 50, 1), ("B", 3, 2)), path)
    assert latest() == {"A": 40, "B": 50, "C": None}
    sink.delete_stored(spark, path, "2024-02-09", "2024-12-31")
    assert latest() == {"A": 35, "B": 3, "C": None}
    assert sum(r.rows for r in read_marks(spark, path).collect()) == len(stored(spark, path))
    plan = latest_per_symbol(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "close" not in plan and "_marks" in plan
    wanted = spark.createDataFrame([("A",), ("B",), ("NEW",)], "symbol string")
    spans = {r.symbol: str(r.start_date) for r in resolve_range_from(wanted, latest_per_symbol(spark, path), seed="2020-01-01", today="2024-06-01").collect()}
    assert spans == {"A": "2024-02-06", "B": "2024-01-05", "NEW": "2020-01-01"}


def test_tables_from_before_the_first_commit_are_read_and_written_on(spark, tmp_path):
    path = str(tmp_path / "t")
    bars(spark, ("A", 0, 0), ("A", 1, 1), ("A", 40, 4)).drop("_ord").selectExpr("*", "to_date(date_trunc('month', time)) AS period").write.partitionBy("period").parquet(path)
    assert sink.insert_new(bars(spark, ("A", 1, 9), ("B", 1, 2)), path) == 1
    assert {r.symbol: r.latest.day for r in latest_per_symbol(spark, path).collect()} == {"A": 10, "B": 2}
    assert sink.delete_stored(spark, path, "2024-01-02", "2024-01-02") == 2
    assert stored(spark, path) == [("A", 0, 0.0), ("A", 40, 4.0)]


def test_compaction_joins_the_folders_of_a_period(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        sink.append_bars(bars(spark, ("A", i, i), ("A", 40 + i, i)), path)
    before = stored(spark, path)
    assert sink.compact_stored(spark, path) == 6 and len(snapshot(spark, path).folders) == 2
    assert stored(spark, path) == before and sink.compact_stored(spark, path) == 0


def test_a_broken_backfill_goes_on_with_the_chunk_that_broke(spark, tmp_path):
    raw, table, ledger = (str(tmp_path / n) for n in ("raw", "bars", "ledger"))
    rows, wanted = bars(spark, *[("A", d, d) for d in range(9)]), spark.createDataFrame([("A",)], "symbol string")
    seen = []

    def clean(df):
        seen.append(df.count())
        if len(seen) == 2:
            raise RuntimeError("broken")
        return df

    run = lambda: backfill_resumable(spark, rows, wanted, "2024-01-01", "2024-01-09", raw, table, clean, ledger, "daily", 4)
    with pytest.raises(RuntimeError):
        run()
    assert [r.inserted for r in spark.read.parquet(ledger).collect()] == [5]
    done = run().orderBy("chunk_start").collect()
    assert [r.inserted for r in done] == [5, 4] and seen == [5, 5, 5] and len(stored(spark, table)) == 9
    assert spark.read.parquet(raw).count() == 10  # the day between two chunks belongs to both
    run()
    assert len(seen) == 3


def test_columns_that_came_later_are_read_on_demand(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.append_bars(bars(spark, ("A", 0, 0)), path)
    sink.append_bars(bars(spark, ("A", 1, 1)).selectExpr("*", "'x' AS venue"), path)
    assert sorted(str(r.venue) for r in sources.read_bars(spark, path, merge_schema=True).collect()) == ["None", "x"]
    assert sources.read_bars(spark, path).count() == 2
