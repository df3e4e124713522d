"""Missing-data policies, applied per series in time order.

Order-based policies (forward, backward, interpolate) are scans over a ``Series``; mean and median
are statistics joined back, so no series is ever gathered in one task for them.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.numbers import nan_to_null
from barloom.operators.aggregates import all_of, column_stats
from barloom.operators.series import (
    SEGMENT, SEGMENT_ROWS, Series, arrange, known_around, last_known, match_keys,
)
from barloom.schemas import ORD, SYMBOL, TIME

# Policy names in the order in which enabled policies run.
POLICIES = (
    "drop_nan", "forward_fill", "backward_fill", "interpolate",
    "zero_fill", "mean_fill", "median_fill", "custom_fill",
)
BY = (SYMBOL,)
IN_ORDER = (TIME, ORD)


def value_columns(df: DataFrame, reserved: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c not in {*reserved, ORD, SEGMENT}]


def numeric_columns(df: DataFrame, reserved: tuple[str, ...]) -> list[str]:
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    return [c for c in value_columns(df, reserved) if c in numeric]


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in ``cols`` (default: every column)."""
    cols = list(cols or [c for c in df.columns if c not in (ORD, SEGMENT)])
    # One condition per column: each can reach the scan, and Catalyst's constraint inference stays
    # linear (dropna's single condition over all columns makes it exponential in their number).
    present = [F.col(c).isNotNull() for c in cols]
    return nan_to_null(df, cols).filter(all_of(present))


def forward_fill(df, cols, partition=BY, order=IN_ORDER, max_rows=SEGMENT_ROWS) -> DataFrame:
    return _fill(arrange(nan_to_null(df, cols), partition, order, max_rows), cols, False).rows()


def backward_fill(df, cols, partition=BY, order=IN_ORDER, max_rows=SEGMENT_ROWS) -> DataFrame:
    return _fill(arrange(nan_to_null(df, cols), partition, order, max_rows), cols, True).rows()


def interpolate(df, cols, partition=BY, order=IN_ORDER, max_rows=SEGMENT_ROWS) -> DataFrame:
    """Linear by row position. Leading gaps stay missing, trailing ones take the last value."""
    return _interpolate(arrange(nan_to_null(df, cols), partition, order, max_rows), cols).rows()


def zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    # fillna replaces NaN too.
    return df.fillna(0, subset=list(cols))


def custom_fill(df: DataFrame, cols: list[str], value) -> DataFrame:
    """Fill with a configured value, which may arrive as text and takes each column's type."""
    kinds = {f.name: f.dataType for f in df.schema}
    filled = {c: F.coalesce(F.col(c), F.lit(value).cast(kinds[c])) for c in cols}
    return nan_to_null(df, cols).withColumns(filled)


def mean_fill(df: DataFrame, cols: list[str], partition=BY) -> DataFrame:
    return _statistic_fill(df, cols, partition, "mean")


def median_fill(df: DataFrame, cols: list[str], partition=BY) -> DataFrame:
    return _statistic_fill(df, cols, partition, "median")


def enabled_policies(policies) -> list[str]:
    """Names of the enabled policies, in running order.

    ``policies`` is a list of names or a configuration mapping, where only the text ``"True"``
    enables a policy.
    """
    if isinstance(policies, dict):
        wanted = {name for name, flag in policies.items() if flag == "True"}
    else:
        wanted = set(policies or ())
    unknown = wanted - set(POLICIES)
    if unknown and not isinstance(policies, dict):
        raise ValueError(f"unknown missing-data policies: {sorted(unknown)}")
    return [p for p in POLICIES if p in wanted]


def handle_missing(
    df: DataFrame,
    policies,
    value=0,
    partition=BY,
    order=IN_ORDER,
    max_rows=SEGMENT_ROWS,
    drop_cols: list[str] | None = None,
    untouched: tuple[str, ...] = (),
) -> DataFrame:
    """Run the enabled policies in their fixed order; each sees what the earlier ones left.

    Keys, order columns and ``untouched`` ones are never filled. ``drop_cols`` are the columns that
    ``drop_nan`` looks at (default: every column).
    """
    steps = enabled_policies(policies)
    reserved = (*partition, *order, *untouched)
    df = nan_to_null(df)
    if "drop_nan" in steps:
        df = drop_missing(df, drop_cols)
    scans = [p for p in steps if p in ("forward_fill", "backward_fill", "interpolate")]
    if scans:
        series = arrange(df, partition, order, max_rows)
        for number, step in enumerate(scans):
            series = series.settled() if number else series
            if step == "interpolate":
                series = _interpolate(series, numeric_columns(series.df, reserved))
            else:
                cols = value_columns(series.df, reserved)
                series = _fill(series, cols, reverse=step == "backward_fill")
        df = series.rows()
    cols = numeric_columns(df, reserved)
    if "zero_fill" in steps:
        df = zero_fill(df, cols)
    if "mean_fill" in steps:
        df = mean_fill(df, cols, partition)
    if "median_fill" in steps:
        df = median_fill(df, cols, partition)
    if "custom_fill" in steps:
        df = custom_fill(df, cols, value)
    return df


def _fill(s: Series, cols, reverse: bool) -> Series:
    filled = last_known(s, {f"_f_{c}": F.col(c) for c in cols}, reverse)
    return _replace(filled, cols, "_f_")


def _interpolate(s: Series, cols) -> Series:
    both = known_around(s, list(cols), "_i", "_b_", "_a_")
    return _replace(both.with_columns({f"_n_{c}": _between(c) for c in cols}), cols, "_n_").without(
        "_i", *[f"_b_{c}" for c in cols], *[f"_a_{c}" for c in cols]
    )


def _between(c: str) -> Column:
    before, after = F.col(f"_b_{c}"), F.col(f"_a_{c}")
    share = (F.col("_i") - before["i"]) / F.nullif(after["i"] - before["i"], F.lit(0))
    line = before["v"] + (after["v"] - before["v"]) * share
    return F.coalesce(F.col(c).cast("double"), F.when(after.isNull(), before["v"]).otherwise(line))


def _replace(s: Series, cols, prefix: str) -> Series:
    """Put the helper columns in the place of the originals, keeping the column order."""
    named = {c: f"{prefix}{c}" for c in cols}
    helpers = set(named.values())
    kept = [F.col(named[c]).alias(c) if c in named else F.col(c) for c in s.df.columns if c not in helpers]
    return replace(s, df=s.df.select(*kept))


def _statistic_fill(df, cols, partition, kind) -> DataFrame:
    df = nan_to_null(df, cols)
    names = {k: f"_k{i}" for i, k in enumerate(partition)}
    stats = column_stats(df, cols, list(partition), kinds=(kind,))
    stats = stats.select(
        *[F.col(k).alias(v) for k, v in names.items()], *[F.col(f"{c}_{kind}").alias(f"_s_{c}") for c in cols]
    )
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_s_{c}")) for c in cols}
    # No broadcast hint: the statistics have one row per series and AQE knows their real size.
    return df.join(stats, match_keys(names), "left").withColumns(filled).select(*df.columns)
