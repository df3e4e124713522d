"""Data-quality reports and per-symbol failure isolation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.symbols import stable_bucket, strip
from barloom.functions.times import micros
from barloom.operators.aggregates import any_of
from barloom.operators.calendars import count_gaps, list_gaps
from barloom.operators.combine import missing_baseline
from barloom.operators.project import asset_mismatch, strict_failure
from barloom.schemas import CONTRACT_REQUIRED, ORD, SYMBOL, TIME

_DAY_SECONDS = 86_400


def staleness(df: DataFrame, now, max_age: float = _DAY_SECONDS, time_col: str = TIME) -> DataFrame:
    """Latest time, its age in seconds and whether it is older than ``max_age``; NULL when empty."""
    latest = F.max(F.col(time_col).cast("timestamp"))
    return df.agg(latest.alias("latest")).select(
        "latest",
        ((micros(F.lit(now)) - micros(F.col("latest"))) / 1e6).alias("age_seconds"),
        (micros(F.lit(now)) - micros(F.col("latest")) > F.lit(int(max_age * 1_000_000))).alias("is_stale"),
    )


def staleness_and_gaps(
    df: DataFrame, now, max_age: float = _DAY_SECONDS, gap: float = _DAY_SECONDS, time_col: str = TIME
) -> DataFrame:
    """One row on staleness (``kind`` stale, fresh or empty) and one per gap (``kind`` gap)."""
    state = staleness(df, now, max_age, time_col).select(
        F.when(F.col("is_stale"), "stale").when(~F.col("is_stale"), "fresh").otherwise("empty").alias("kind"),
        F.col("latest").alias("from_time"),
        F.lit(now).cast("timestamp").alias("to_time"),
    )
    gaps = list_gaps(df, gap, time_col=time_col).select(
        F.lit("gap").alias("kind"), F.col("prev_time").alias("from_time"), F.col("cur_time").alias("to_time")
    )
    return state.unionByName(gaps)


def quality_gate(
    df: DataFrame, key_cols: list[str] = ("symbol", "asset_type"), value_col: str = "value_column",
    seconds: float = 60, time_col: str = TIME,
) -> DataFrame:
    """Three checks in order: NULL keys, zero values, time gaps. One row with counts and verdict."""
    values = df.agg(
        F.count_if(any_of([F.col(c).isNull() for c in key_cols])).alias("nulls"),
        F.count_if(F.col(value_col) == 0).alias("zeros"),
    ).select(F.expr("stack(2, 1, 'nulls', nulls, 2, 'zeros', zeros) AS (step, check, n)"))
    gaps = count_gaps(df, seconds, time_col=time_col).select(
        F.lit(3).alias("step"), F.lit("gaps").alias("check"), F.col("gap_count").alias("n")
    )
    found = values.unionByName(gaps)
    failing = F.when(F.col("n") > 0, F.col("step"))
    count_of = lambda name: F.sum(F.when(F.col("check") == name, F.col("n")))
    return found.agg(
        (F.count(failing) == 0).alias("passed"),
        F.min_by("check", failing).alias("first_failed"),
        count_of("nulls").alias("null_count"),
        count_of("zeros").alias("zero_count"),
        count_of("gaps").alias("gap_count"),
    )


def validate_contracts(df: DataFrame) -> DataFrame:
    """Contract-list checks in order: required columns, duplicate symbols, missing symbols.

    Symbols are compared as written, before any stripping, and two missing ones are duplicates too.
    """
    absent = [c for c in CONTRACT_REQUIRED if c not in df.columns]
    if absent:
        nothing = F.lit(None).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("_n")).select(
            F.lit(False).alias("passed"), F.lit(f"missing columns: {', '.join(absent)}").alias("first_failed"),
            nothing.alias("duplicate_symbols"), nothing.alias("null_symbols"),
        )
    sizes = df.groupBy("dataSymbol").agg(F.count(F.lit(1)).alias("n"))
    report = sizes.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_symbols"),
        F.coalesce(F.sum(F.when(F.col("dataSymbol").isNull(), F.col("n"))), F.lit(0).cast("bigint")).alias("null_symbols"),
    )
    failed = F.when(F.col("duplicate_symbols") > 0, "duplicate symbols").when(F.col("null_symbols") > 0, "null symbols")
    return report.select(failed.isNull().alias("passed"), failed.alias("first_failed"), "duplicate_symbols", "null_symbols")


def validate_universe(universe: DataFrame, baseline: DataFrame, low: int = 540, high: int = 600) -> DataFrame:
    """Universe rules as one row of counts plus ``passed``."""
    symbol = F.col("dataSymbol")
    blank = symbol.isNull() | (strip(symbol) == "")
    rules = universe.agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if(~F.col("instrumentType").eqNullSafe(F.lit("EQUITY"))).alias("not_equity"),
        (F.count(symbol) - F.count_distinct(symbol)).alias("duplicates"),
        F.count_if(F.contains(symbol, F.lit("."))).alias("dotted"),
        F.count_if(blank).alias("blank"),
        F.lit(None).cast("bigint").alias("missing_baseline"),
    )
    lost = missing_baseline(universe, baseline).agg(F.count(F.lit(1)).alias("missing_baseline"))
    counts = ["size", "not_equity", "duplicates", "dotted", "blank", "missing_baseline"]
    merged = rules.unionByName(lost, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in counts])
    clean = (F.col("not_equity") + F.col("duplicates") + F.col("dotted") + F.col("blank") + F.col("missing_baseline")) == 0
    return merged.select(*counts, (clean & F.col("size").between(low, high)).alias("passed"))


def with_bucket(df: DataFrame, buckets: int, col: str = SYMBOL) -> DataFrame:
    return df.withColumn("bucket", stable_bucket(F.col(col), buckets))


def bucket_capacity(df: DataFrame, buckets: int, cap: int, col: str = SYMBOL) -> DataFrame:
    """Distinct symbols per bucket against a cap, and how many buckets all of them would need."""
    per_bucket = (
        with_bucket(df.select(col).distinct(), buckets, col).groupBy("bucket").agg(F.count(F.lit(1)).alias("symbols"))
    )
    # The only window without keys: its input has at most ``buckets`` rows.
    everything = F.sum("symbols").over(Window.partitionBy())
    return per_bucket.select(
        "bucket", "symbols", (F.col("symbols") > cap).alias("over_cap"),
        F.ceil(everything / F.lit(cap)).cast("bigint").alias("buckets_needed"),
    )


def isolate_failures(
    df: DataFrame, asset: str | None = None, kind: str = "instrumentType", key: str = SYMBOL, order=(TIME, ORD)
) -> tuple[DataFrame, DataFrame]:
    """Rows of the symbols that can be cleaned, and a status row for every symbol.

    One row that fails strict typing (or has the wrong asset type) takes its whole symbol out;
    other symbols are not affected.
    """
    reasons = [strict_failure(df)]
    if asset:
        reasons.insert(0, asset_mismatch(F.col(kind), asset))
    tagged = df.withColumn("_reason", F.coalesce(*reasons))
    at = F.struct(*order, "_reason")
    status = tagged.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("_reason").alias("failed_rows"),
        F.min(F.when(F.col("_reason").isNotNull(), at)).getField("_reason").alias("first_reason"),
    ).withColumn("status", F.when(F.col("failed_rows") > 0, "failed").otherwise("ok"))
    failed = tagged.filter(F.col("_reason").isNotNull()).select(F.col(key).alias("_failed")).distinct()
    good = df.join(failed, F.col(key).eqNullSafe(F.col("_failed")), "left_anti")
    return good, status
