"""Ordered computations per key that survive a key holding a large share of all rows.

A Spark window sends each ``partitionBy`` group to one task. Here the rows, whatever their keys, are
range-partitioned by key and order, tie-break column included, and cut into segments of at most
``max_rows`` rows: many rows of one key and one time are divided like any others. Every scan then runs
in two steps:

1. a window over (key, segment), so the segments of one key are processed in parallel;
2. one summary row per key and segment, scanned per key, whose result is joined to the segments.

The segment size is constant, so the number of segments grows with the table. Small segments share
a task and its file: their number is no number of tasks, which hold about ``TASK_ROWS`` rows, or a
segment if that is larger. A table of one segment needs no carry; that is the same computation with one
summary less, and results do not depend on ``max_rows``. The segmented rows are written once and
read back, so a recomputed task always sees the same segments.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import cut_lineage

SEGMENT = "_segment"
#: Rows of a segment: what one task of an ordered scan gets.
SEGMENT_ROWS = 1_000_000
#: Rows that a task cuts into segments, where those are smaller.
TASK_ROWS = 250_000
#: The part of ``monotonically_increasing_id`` that counts rows within a task.
_IN_TASK = (1 << 33) - 1


@dataclass(frozen=True)
class Series:
    """Rows with the keys that separate series and the columns that order each of them."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool = False

    def with_columns(self, columns: dict[str, Column]) -> "Series":
        return replace(self, df=self.df.withColumns(columns))

    def without(self, *columns: str) -> "Series":
        return replace(self, df=self.df.drop(*columns))

    def settled(self) -> "Series":
        """Cut lineage between chained scans of split series.

        A split scan reads its input twice (rows and summaries); without the cut a chain of them
        would double the work at each step.
        """
        return replace(self, df=cut_lineage(self.df)) if self.split else self

    def rows(self) -> DataFrame:
        return self.df.drop(SEGMENT)


def match_keys(keys: dict[str, str]) -> Column:
    """Join condition that, like grouping, treats NULL keys as equal. ``keys``: left -> right."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(v)) for k, v in keys.items()])


def arrange(
    df: DataFrame,
    keys: list[str] | tuple[str, ...],
    order: list[str] | tuple[str, ...],
    max_rows: int = SEGMENT_ROWS,
) -> Series:
    """Cut the rows into segments of at most ``max_rows``, in key and order.

    The number of tasks comes from one count over no columns.
    """
    keys, order = tuple(keys), tuple(order)
    if not keys or not order:
        raise ValueError("a series needs key and order columns")
    missing = [c for c in (*keys, *order) if c not in df.columns]
    if missing:
        raise ValueError(f"missing series columns: {missing}")
    rows = df.count()
    if rows <= max_rows:
        return Series(df, keys, order)
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    ranged = df.repartitionByRange(math.ceil(rows / max(max_rows, TASK_ROWS)), *by).sortWithinPartitions(*by)
    # A segment is named by the number of its first row, so names ascend with the order.
    numbered = ranged.withColumn(SEGMENT, F.monotonically_increasing_id())
    cut = F.col(SEGMENT) - F.col(SEGMENT).bitwiseAND(F.lit(_IN_TASK)) % F.lit(max_rows)
    return Series(cut_lineage(numbered.withColumn(SEGMENT, cut)), keys, order, True)


def _window(s: Series, reverse: bool):
    order = [F.col(c).desc_nulls_last() if reverse else F.col(c).asc_nulls_first() for c in s.order]
    by = [*s.keys, SEGMENT] if s.split else s.keys
    return Window.partitionBy(*by).orderBy(*order)


def _carry(s: Series, summaries: dict[str, Column], scan, reverse: bool) -> DataFrame:
    """Join to each row ``scan(summary)`` over the segments of its key that come before its own.

    A summary is the value its column has in the segment's last row (in scan direction), so it comes
    out of the windows that computed the column. Adds ``_carry_<name>``.
    """
    names = {**{k: f"_k{i}" for i, k in enumerate(s.keys)}, SEGMENT: "_ks"}
    order = F.col("_ks").desc() if reverse else F.col("_ks").asc()
    w = Window.partitionBy(*[v for k, v in names.items() if k != SEGMENT]).orderBy(order)
    last = s.df.withColumn("_more", F.lead(F.lit(True)).over(_window(s, reverse))).filter(F.col("_more").isNull())
    carried = last.select(
        *[F.col(k).alias(v) for k, v in names.items()], *[c.alias(f"_at_{n}") for n, c in summaries.items()]
    ).select(*names.values(), *[scan(F.col(f"_at_{n}"), w).alias(f"_carry_{n}") for n in summaries])
    return s.df.join(carried, match_keys(names), "left").drop(*names.values())


def last_known(s: Series, values: dict[str, Column], reverse: bool = False) -> Series:
    """Latest non-NULL value at or before each row; at or after it with ``reverse``."""
    frame = _window(s, reverse).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.with_columns({n: F.last(v, ignorenulls=True).over(frame) for n, v in values.items()})
    if not s.split:
        return s
    before = lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = _carry(s, {n: F.col(n) for n in values}, before, reverse)
    filled = {n: F.coalesce(F.col(n), F.col(f"_carry_{n}")) for n in values}
    return replace(s, df=df.withColumns(filled).drop(*[f"_carry_{n}" for n in values]))


def neighbour(s: Series, values: dict[str, Column], reverse: bool = False) -> Series:
    """Value of the row just before each row (just after it with ``reverse``), NULLs included."""
    w = _window(s, reverse)
    if not s.split:
        return s.with_columns({n: F.lag(v).over(w) for n, v in values.items()})
    own = {f"_own_{n}": v for n, v in values.items()}
    lagged = {n: F.lag(v).over(w) for n, v in values.items()}
    s = s.with_columns({**own, **lagged, "_row": F.row_number().over(w)})
    df = _carry(s, {n: F.col(f"_own_{n}") for n in values}, lambda c, w: F.lag(c).over(w), reverse)
    joined = {n: F.when(F.col("_row") == 1, F.col(f"_carry_{n}")).otherwise(F.col(n)) for n in values}
    return replace(s, df=df.withColumns(joined).drop("_row", *own, *[f"_carry_{n}" for n in values]))


def running_sum(
    s: Series, values: dict[str, Column], reverse: bool = False, inclusive: bool = True
) -> Series:
    """Sum over the rows up to each row (from it on with ``reverse``); 0 where there are none.

    Give decimals or integers where the result must not depend on how rows are grouped.
    """
    w = _window(s, reverse)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frame = upto if inclusive else w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    local = {n: F.coalesce(F.sum(v).over(frame), zero) for n, v in values.items()}
    if not s.split:
        return s.with_columns(local)
    whole = {f"_whole_{n}": F.sum(v).over(upto) for n, v in values.items()}
    s = s.with_columns({**local, **whole})
    before = lambda c, w: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = _carry(s, {n: F.col(f"_whole_{n}") for n in values}, before, reverse)
    total = {n: F.col(n) + F.coalesce(F.col(f"_carry_{n}"), zero) for n in values}
    return replace(s, df=df.withColumns(total).drop(*whole, *[f"_carry_{n}" for n in values]))


def known_around(s: Series, cols: list[str], index: str, before: str, after: str) -> Series:
    """Row number (``index``) and, per column, the known value before and after each row with its row
    number, as structs ``<before><col>`` and ``<after><col>``. One carry brings all of it.
    """
    w = _window(s, False)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.with_columns({index: F.row_number().over(w).cast("bigint")})
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"), F.col(index).alias("i"))) for c in cols}
    back = {f"{before}{c}": F.last(v, ignorenulls=True).over(upto) for c, v in known.items()}
    # What comes next is the latest known value in the opposite order: a running frame, where one that ends with the
    # partition would be evaluated anew for each row.
    by = [*s.keys, SEGMENT] if s.split else s.keys
    backwards = Window.partitionBy(*by).orderBy(F.col(index).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = {f"{after}{c}": F.last(v, ignorenulls=True).over(backwards) for c, v in known.items()}
    if not s.split:
        return s.with_columns({**back, **ahead})
    first = {f"_first_{c}": F.first(v, ignorenulls=True).over(upto) for c, v in known.items()}
    s = s.with_columns({**back, **ahead, **first})
    names = {**{k: f"_k{i}" for i, k in enumerate(s.keys)}, SEGMENT: "_ks"}
    series = Window.partitionBy(*[v for k, v in names.items() if k != SEGMENT])
    earlier, later = (series.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_ks").asc(), F.col("_ks").desc()))
    last = s.df.withColumn("_more", F.lead(F.lit(True)).over(w)).filter(F.col("_more").isNull())
    ends = last.select(
        *[F.col(k).alias(v) for k, v in names.items()], F.col(index).alias("_n"),
        *[F.col(f"{before}{c}").alias(f"_l_{c}") for c in cols], *[F.col(f"_first_{c}").alias(f"_f_{c}") for c in cols],
    ).withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("bigint")))
    moved = lambda c: F.when(c.isNotNull(), F.struct(c["v"].alias("v"), (c["i"] + F.col("_offset")).alias("i")))
    ends = ends.withColumns({f"{p}{c}": moved(F.col(f"{p}{c}")) for p in ("_l_", "_f_") for c in cols})
    carried = ends.select(
        *names.values(), "_offset",
        *[F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_cb_{c}") for c in cols],
        *[F.last(f"_f_{c}", ignorenulls=True).over(later).alias(f"_ca_{c}") for c in cols],
    )
    df = s.df.join(carried, match_keys(names), "left")
    df = df.withColumns({
        index: F.col(index) + F.col("_offset"),
        **{f"{before}{c}": F.coalesce(moved(F.col(f"{before}{c}")), F.col(f"_cb_{c}")) for c in cols},
        **{f"{after}{c}": F.coalesce(moved(F.col(f"{after}{c}")), F.col(f"_ca_{c}")) for c in cols},
    })
    helpers = [*names.values(), "_offset", *first, *[f"_cb_{c}" for c in cols], *[f"_ca_{c}" for c in cols]]
    return replace(s, df=df.drop(*helpers))
