"""Writing bar tables: raw append, insert-ignore, strict insert, delete, findings and exports.

Tables are Parquet folders by ``period``, the first day of the year, month or day. Every write is one commit (``commits``) on the
state it was worked out for; if another writer commits first, it is worked out again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barloom.functions.times import period_start
from barloom.operators import dedupe
from barloom.operators.aggregates import row_count
from barloom.operators.predicates import in_range, symbol_in
from barloom.schemas import ORD, SYMBOL, TIME
from barloom.session import remove_path
from barloom.sinks.commits import CommitConflict, discard, publish, write_generation
from barloom.sources.stored import GENERATION, PERIOD, Snapshot, folder_name, prune, read_folders, read_marks, read_stored, snapshot

#: Times a write is worked out again when other writers commit first.
ATTEMPTS = 10


def write_raw(df: DataFrame, path: str, mode: str = "append") -> int:
    """Append a batch as it came, before any cleaning; only the landing order is left out.

    Returns the number of rows, counted by the write itself.
    """
    counted = Observation()
    rows = df.drop(ORD).observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode(mode).parquet(path)
    return counted.get["rows"]


def _laid_out(df: DataFrame, grain: str) -> DataFrame:
    """Rows grouped by partition folder, in files of even size, sorted for row-group skipping.

    The rebalance hint lets AQE split a period that holds most rows and merge small ones.
    """
    if PERIOD not in df.columns:
        df = df.withColumn(PERIOD, period_start(F.col(TIME), grain))
    return df.hint("rebalance", PERIOD).sortWithinPartitions(PERIOD, SYMBOL, TIME)


def append_bars(df: DataFrame, path: str, grain: str = "month") -> int:
    """Append rows as they are, in one commit; returns how many. The count comes from the write itself."""
    spark = df.sparkSession
    folders, rows = write_generation(_laid_out(df.drop(ORD), grain), path)
    return _published(lambda: publish(spark, path, snapshot(spark, path), folders), rows) if folders else rows


def _published(attempt: Callable, result):
    """Commit until no other commit comes first; what is committed must not depend on what is stored."""
    for _ in range(ATTEMPTS):
        if attempt():
            return result
    raise CommitConflict("other writers came first each time")


def _stored_for(batch: DataFrame, path: str, state: Snapshot | None = None, within: DataFrame | None = None) -> DataFrame:
    """The part of a stored table that can hold keys of the batch: the periods its times (or those of ``within``, which has them all) span."""
    stored = read_stored(batch.sparkSession, path, batch.schema, state)
    span = (batch if within is None else within).agg(F.min(TIME).alias("lo"), F.max(TIME).alias("hi")).first()
    if span.lo is None:
        return stored.limit(0)
    return prune(stored, span.lo, span.hi)


def new_rows(
    batch: DataFrame, path: str, keys=dedupe.KEYS, order=(ORD,), state: Snapshot | None = None, within: DataFrame | None = None
) -> DataFrame:
    """What an insert-ignore would add to a stored table. The batch is read twice, unless ``within`` is a cheaper table that has all its times."""
    return dedupe.insert_ignore(batch, _stored_for(batch, path, state, within), keys, order)


def _insert(batch: DataFrame, path: str, grain: str, allowed: Callable[[Snapshot], DataFrame]) -> tuple[int, list[str]]:
    """Insert the rows ``allowed`` on a state of the table, in one commit on that very state.

    If another commit comes first, the written rows are discarded and what is allowed is asked again.
    """
    spark = batch.sparkSession
    for _ in range(ATTEMPTS):
        state = snapshot(spark, path)
        folders, rows = write_generation(_laid_out(allowed(state).drop(ORD), grain), path)
        if not folders or publish(spark, path, state, folders):
            return rows, folders
        discard(spark, path, folders)
    raise CommitConflict("other writers came first each time")


def insert_new(batch: DataFrame, path: str, keys=dedupe.KEYS, order=(ORD,), grain: str = "month") -> int:
    """Insert-ignore into a stored table of any grain; returns the number of rows added. ``grain`` is that of
    the folders the new rows go to. Repeating a batch adds nothing, and of two writers that bring one key at once one adds it.
    """
    return _insert(batch, path, grain, lambda state: new_rows(batch, path, keys, order, state))[0]


def insert_counted(
    batch: DataFrame, path: str, keys=dedupe.KEYS, order=(ORD,), grain: str = "month", within: DataFrame | None = None
) -> tuple[int, DataFrame]:
    """``insert_new``, and the rows it added per symbol (``inserted``), taken from the marks of what was written."""
    rows, folders = _insert(batch, path, grain, lambda state: new_rows(batch, path, keys, order, state, within))
    marks = read_marks(batch.sparkSession, path, Snapshot(0, tuple(folders)))
    return rows, marks.groupBy(SYMBOL).agg(F.sum("rows").alias("inserted"))


def insert_all(batch: DataFrame, path: str, keys=dedupe.KEYS, grain: str = "month") -> int:
    """Strict insert into a stored table: any duplicate key fails it before anything can be seen, one that another writer brings meanwhile too."""
    return _insert(batch, path, grain, lambda state: dedupe.insert_strict(batch, _stored_for(batch, path, state), keys))[0]


def doomed(start, end, symbols=None) -> Column:
    """Rows a delete removes; a row without a time is never in the range."""
    return F.coalesce(in_range(start, end) & symbol_in(symbols), F.lit(False))


def delete_range(df: DataFrame, start, end, symbols=None) -> tuple[DataFrame, DataFrame]:
    """The rows that stay, and a one-row count of those that go."""
    gone = doomed(start, end, symbols)
    return df.filter(~gone), row_count(df, gone)


def delete_stored(spark: SparkSession, path: str, start, end, symbols=None, grain: str = "month", keep_old: bool = False) -> int:
    """Delete from a stored table and return the number of rows removed.

    Only folders that lose rows are rewritten, once, to a new generation; one commit takes them out of the table and puts the new ones in.
    Readers, and a run that is killed, find the state before or the state after. ``grain`` counts for folders without a period only. The
    replaced files are removed after the commit unless ``keep_old`` (for readers of the state before; see ``purge``).
    """
    gone = doomed(start, end, symbols)
    for _ in range(ATTEMPTS):
        state = snapshot(spark, path)
        if not state.folders:
            return 0
        touched = (
            prune(read_folders(spark, path, state.folders), start, end)
            .groupBy(GENERATION, PERIOD)
            .agg(F.count_if(gone).alias("gone"), F.count(F.lit(1)).alias("rows"))
            .filter(F.col("gone") > 0)
            .collect()
        )
        if not touched:
            return 0
        thinned = [folder_name(r[GENERATION], r[PERIOD]) for r in touched if r.gone < r.rows]
        added = []
        if thinned:
            kept = read_folders(spark, path, thinned).filter(~gone).drop(GENERATION)
            added, _ = write_generation(_laid_out(kept, grain), path)
        replaced = [folder_name(r[GENERATION], r[PERIOD]) for r in touched]
        if publish(spark, path, state, added, replaced):
            if not keep_old:
                for folder in replaced:
                    remove_path(spark, f"{path.rstrip('/')}/{folder}")
            return sum(r.gone for r in touched)
        discard(spark, path, added)
    raise CommitConflict("other writers came first each time")


def compact_stored(spark: SparkSession, path: str, least: int = 2, keep_old: bool = False) -> int:
    """Rewrite periods that lie in at least ``least`` generations as one folder each, in one commit; returns how many folders went."""
    for _ in range(ATTEMPTS):
        state = snapshot(spark, path)
        by_period: dict[str, list[str]] = {}
        for folder in state.folders:
            by_period.setdefault(folder.rsplit("=", 1)[1], []).append(folder)
        replaced = [f for folders in by_period.values() if len(folders) >= least for f in folders]
        if not replaced:
            return 0
        added, _ = write_generation(_laid_out(read_folders(spark, path, replaced).drop(GENERATION), "month"), path)
        if publish(spark, path, state, added, replaced):
            if not keep_old:
                for folder in replaced:
                    remove_path(spark, f"{path.rstrip('/')}/{folder}")
            return len(replaced)
        discard(spark, path, added)
    raise CommitConflict("other writers came first each time")


def validate_row_count(df: DataFrame, expected: int, where: Column | str | None = None) -> DataFrame:
    """Whether a table (or the part ``where`` selects) has the expected number of rows."""
    return row_count(df, where).select(
        F.lit(expected).cast("bigint").alias("expected"),
        F.col("rows").alias("actual"),
        (F.col("rows") == expected).alias("passed"),
    )


def missing_findings(missing: DataFrame) -> DataFrame:
    """Missing timestamps as findings: ``kind``, ``symbol``, ``ts``, ``detail``."""
    return missing.select(
        F.lit("missing_timestamp").alias("kind"), SYMBOL, F.col(TIME).alias("ts"),
        F.concat(F.lit("no bar at "), F.date_format(TIME, "yyyy-MM-dd HH:mm:ss")).alias("detail"),
    )


def duplicate_findings(copies: DataFrame) -> DataFrame:
    """Times that occur more than once in a series (``copies``) as findings of the same shape."""
    return copies.select(
        F.lit("duplicate_timestamp").alias("kind"), SYMBOL, F.col(TIME).try_cast("timestamp").alias("ts"),
        F.concat(F.col("copies").cast("string"), F.lit(" rows")).alias("detail"),
    )


def status_findings(status: DataFrame) -> DataFrame:
    """Per-symbol insert status (``status``, ``inserted``, ``first_reason``) as findings of the same shape."""
    text = F.when(
        F.col("status") == "ok", F.concat(F.lit("inserted "), F.col("inserted").cast("string"), F.lit(" rows"))
    ).otherwise(F.concat(F.lit("failed: "), F.col("first_reason")))
    return status.select(
        F.lit("insert_status").alias("kind"), SYMBOL, F.lit(None).cast("timestamp").alias("ts"), text.alias("detail")
    )


def write_findings(findings: DataFrame, path: str) -> None:
    findings.select("kind", SYMBOL, "ts", "detail").write.mode("append").parquet(path)


def export_tickers(df: DataFrame, path: str, col: str = "ticker") -> None:
    """Sorted distinct tickers, one per line; several part files keep the order of their names."""
    df.select(F.col(col).cast("string").alias("value")).dropna().distinct().orderBy("value").write.text(path)


def write_universe(universe: DataFrame, path: str, pos: tuple[str, ...] = ("priority", "pos")) -> None:
    """Universe as CSV with a header, in list order; small lists come out as one file."""
    universe.orderBy(*pos).select("dataSymbol", "instrumentType").write.option("header", True).csv(path)
