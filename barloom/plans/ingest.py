"""End-to-end ingestion and chunked backfill."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.symbols import upper_symbol
from barloom.functions.times import iso_utc, micros
from barloom.operators.aggregates import duplicate_times
from barloom.operators.calendars import fan_out, range_bounds, resolve_range_from, time_chunks
from barloom.operators.combine import only_universe
from barloom.operators.dedupe import dedupe_first
from barloom.operators.predicates import in_day_range, in_range
from barloom.operators.project import canonical_symbol, check_asset_type
from barloom.operators.series import SEGMENT_ROWS
from barloom.plans.clean import EQUITY_POLICIES, FUTURES_POLICIES, accepted_equities, clean_futures, screen_equities
from barloom.schemas import EQUITY_SCHEMA, FUTURES_SCHEMA, ORD, SYMBOL, TIME
from barloom.session import cut_lineage, path_exists, scratch_path, temporary_copies
from barloom.sinks.tables import duplicate_findings, insert_counted, insert_new, status_findings, validate_row_count, write_findings, write_raw
from barloom.sources.landing import load_contracts
from barloom.sources.stored import latest_per_symbol, read_bars, read_marks


@dataclass(frozen=True)
class IngestResult:
    """What one run did. ``status`` has a row per symbol: rows landed, refused, inserted and already known,
    ``status`` and ``first_reason``; ``refused`` a row per contract of another asset type.
    """

    start: date
    end: date
    landed: int
    inserted: int
    refused: DataFrame
    status: DataFrame
    validation: DataFrame


def universe_of(contracts: DataFrame, asset: str, roll: str = "v", rank: str | int = 0):
    """Symbols to load under their stored names, and the contracts of other asset types."""
    accepted, refused = check_asset_type(contracts, asset)
    return canonical_symbol(accepted, roll, rank).select(SYMBOL, "instrumentType").distinct(), refused


def ingest(
    spark: SparkSession,
    contracts: str,
    landed: DataFrame,
    raw: str,
    table: str,
    asset: str,
    policies=None,
    start=None,
    end=None,
    seed=None,
    today=None,
    roll: str = "v",
    rank: str | int = 0,
    series: str = SYMBOL,
    grain: str = "month",
    max_rows: int = SEGMENT_ROWS,
    findings: str | None = None,
) -> IngestResult:
    """One ingestion run: contracts, range, raw append, cleaning, insert-ignore, validation, findings.

    ``landed`` holds the landed bars of the asset class with an ordinal ``_ord``; times may be text. Each
    symbol is loaded from the day after its own latest bar, unless ``start`` is given. Rows of the range, and rows
    whose time cannot be read, are stored as they came before cleaning. What was stored is what is cleaned, in one pass that
    tags each row with the reason it is refused for. Latest bars, rows stored before and rows inserted come from the marks of the table.
    Running again over the same range adds nothing to ``table``. ``findings`` names a folder for
    the status of each symbol and the times that landed more than once.
    """
    with temporary_copies(spark) as keep:
        kept_status = scratch_path(spark, "status")
        keep.add(kept_status)
        spark_schema = FUTURES_SCHEMA if asset == "FUTURE" else EQUITY_SCHEMA
        universe, refused = universe_of(load_contracts(spark, contracts), asset, roll, rank)
        if start:
            first, last = range_bounds(None, start, end, seed, today)
            spans = universe.select(SYMBOL, F.lit(first).alias("start_date"), F.lit(last).alias("end_date"))
        else:
            spans = cut_lineage(resolve_range_from(universe, latest_per_symbol(spark, table), end, seed, today))
            bounds = spans.agg(F.min("start_date"), F.max("end_date"), F.count_if(F.col("start_date").isNull())).first()
            if bounds[2] or bounds[1] is None:
                raise ValueError("cannot determine the start date: none given, no stored rows and no seed")
            first, last = bounds[0], bounds[1]
        day = F.to_date(iso_utc(F.col(TIME)))
        spans = spans.select(F.col(SYMBOL).alias("_symbol"), "start_date", "end_date")
        wanted = (F.col(SYMBOL) == F.col("_symbol")) & F.coalesce(day.between(F.col("start_date"), F.col("end_date")), F.lit(True))
        batch = cut_lineage(landed.join(spans, wanted, "left_semi"))
        landed_rows = write_raw(batch, raw)
        if asset == "FUTURE":
            clean, screened = clean_futures(
                batch, policies or FUTURES_POLICIES, series, isolate=True, max_rows=max_rows, for_storage=True
            )
            # A failed series takes all rows of its symbols out.
            outcome = screened.select(F.col(series).alias("_series"), "first_reason", "status")
            counts = batch.groupBy(SYMBOL, F.col(series).alias("_series")).agg(F.count(F.lit(1)).alias("_rows"))
            screened = counts.join(outcome, "_series").groupBy(SYMBOL).agg(
                F.sum(F.when(F.col("status") == "failed", F.col("_rows")).otherwise(F.lit(0))).alias("refused"),
                F.min("first_reason").alias("first_reason"), F.min("status").alias("status"),
            )
        else:
            rows = cut_lineage(screen_equities(batch, policies or EQUITY_POLICIES, max_rows=max_rows))
            worst = F.min(F.when(F.col("reason").isNotNull(), F.struct(ORD, "reason"))).getField("reason")
            screened = rows.groupBy(SYMBOL).agg(F.count("reason").alias("refused"), worst.alias("first_reason"), F.lit("ok").alias("status"))
            clean = accepted_equities(rows)
        before = read_marks(spark, table).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if asset == "FUTURE":
            clean = rows = cut_lineage(clean)
        inserted, new = insert_counted(clean, table, grain=grain, within=rows)
        key = F.col(SYMBOL) if asset == "FUTURE" else upper_symbol(F.col(SYMBOL))
        status = (
            batch.groupBy(key.alias(SYMBOL)).agg(F.count(F.lit(1)).alias("landed"))
            .join(screened, SYMBOL, "left")
            .join(new, SYMBOL, "left")
            .fillna(0, ["refused", "inserted"])
            .withColumn("known", F.col("landed") - F.col("refused") - F.col("inserted"))
            .select(SYMBOL, "landed", "refused", "inserted", "known", F.coalesce("status", F.lit("ok")).alias("status"), "first_reason")
        )
        status = cut_lineage(status, kept_status)
        if findings:
            write_findings(status_findings(status), findings)
            write_findings(duplicate_findings(duplicate_times(batch, [SYMBOL])), findings)
    validation = validate_row_count(read_bars(spark, table, schema=spark_schema), before + inserted)
    return IngestResult(first, last, landed_rows, inserted, refused, status, validation)


def backfill(
    bars: DataFrame, universe: DataFrame, start, end, unit: str = "daily", n: int = 100, keys=(SYMBOL, TIME), order=(ORD,)
) -> tuple[DataFrame, DataFrame]:
    """Bars of a long range, and the work list (symbol, chunk) with the rows each chunk holds.

    Chunks touch: the day on which one ends and the next begins belongs to both, and its second copy
    is dropped. Contiguous chunks cover the range, so the rows are one filtered read, not a union.
    """
    daily = unit.lower() == "daily"
    within = in_day_range(start, end) if daily else in_range(start, end)
    rows = dedupe_first(only_universe(bars.filter(within), universe), keys, order)
    work = fan_out(universe.select(SYMBOL).distinct(), start, end, unit, n)
    width = n * {"daily": 86_400, "hourly": 3_600, "min": 60}[unit.lower()] * 1_000_000
    origin = micros(F.lit(start).cast("timestamp"))
    # A row's place in the range: its day for daily chunks, its time otherwise.
    place = micros(F.date_trunc("day", TIME) if daily else F.col(TIME)) - origin
    chunk = F.floor(place / F.lit(width)).cast("bigint")
    on_border = (F.pmod(place, F.lit(width)) == 0) & (chunk > 0)
    counted = (
        rows.select(SYMBOL, F.explode(F.when(on_border, F.array(chunk, chunk - 1)).otherwise(F.array(chunk))).alias("_chunk"))
        .groupBy(SYMBOL, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    numbered = work.withColumn("_chunk", F.floor((micros(F.col("chunk_start")) - origin) / F.lit(width)).cast("bigint"))
    work = numbered.join(counted, [SYMBOL, "_chunk"], "left").select(
        SYMBOL, "chunk_start", "chunk_end", F.coalesce("_n", F.lit(0).cast("bigint")).alias("rows")
    )
    return rows, work


def backfill_stored(
    spark: SparkSession, bars: DataFrame, universe: DataFrame, start, end, raw: str, table: str, clean, unit: str = "daily",
    n: int = 100, grain: str = "month",
) -> tuple[int, DataFrame]:
    """A backfill into storage: rows to ``raw`` as they came, cleaned by ``clean``, insert-ignored into ``table``.

    Returns the number of rows inserted and the work list.
    """
    rows, work = backfill(bars, universe, start, end, unit, n)
    write_raw(rows, raw)
    with temporary_copies(spark):
        inserted = insert_new(cut_lineage(clean(rows)), table, grain=grain)
    return inserted, work


LEDGER = "chunk_start timestamp, chunk_end timestamp, inserted long"


def backfill_resumable(
    spark: SparkSession, bars: DataFrame, universe: DataFrame, start, end, raw: str, table: str, clean, ledger: str, unit: str = "daily",
    n: int = 100, grain: str = "month",
) -> DataFrame:
    """A backfill chunk by chunk, each for all symbols; returns the ledger: every finished chunk with the rows it inserted.

    A chunk is entered when its rows are in the table, so a run that broke goes on with the first chunk that is not there. A chunk
    that broke is done again: it replaces its own raw rows, and its inserts ignore what is stored. ``clean`` sees one chunk at a time, so fills and adjustments
    must not reach across chunks.
    """
    daily = unit.lower() == "daily"
    done = {(r.chunk_start, r.chunk_end) for r in spark.read.schema(LEDGER).parquet(ledger).collect()} if path_exists(spark, ledger) else set()
    # As many rows as the calendar has chunks.
    for chunk in time_chunks(spark, start, end, unit, n).orderBy("chunk_start").collect():
        if (chunk.chunk_start, chunk.chunk_end) in done:
            continue
        within = in_day_range(chunk.start_text, chunk.end_text) if daily else in_range(chunk.start_text, chunk.end_text)
        rows = only_universe(bars.filter(within), universe)
        write_raw(rows, f"{raw.rstrip('/')}/chunk={chunk.chunk_start:%Y%m%dT%H%M%S}", mode="overwrite")
        with temporary_copies(spark):
            inserted = insert_new(cut_lineage(clean(rows)), table, grain=grain)
        entry = spark.createDataFrame([(chunk.chunk_start, chunk.chunk_end, inserted)], LEDGER)
        entry.coalesce(1).write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)
