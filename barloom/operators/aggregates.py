"""Aggregations over stored bars. Each returns a DataFrame, never a collected value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import match_keys

_DAY = "yyyy-MM-dd"


def latest_date(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Latest day as ``yyyy-MM-dd`` text; NULL for an empty table."""
    return df.agg(F.date_format(F.max(time_col), _DAY).alias("latest_date"))


def earliest_date(df: DataFrame, time_col: str = "time") -> DataFrame:
    return df.agg(F.date_format(F.min(time_col), _DAY).alias("earliest_date"))


def row_count(df: DataFrame, where: Column | str | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.agg(F.count(F.lit(1)).alias("rows"))


def coverage(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of symbols and rows, first and last day (NULL times are not days)."""
    symbols = F.approx_count_distinct("symbol") if approximate else F.count_distinct("symbol")
    return df.agg(
        symbols.alias("symbols"),
        F.count(F.lit(1)).alias("rows"),
        F.date_format(F.min("time"), _DAY).alias("first_day"),
        F.date_format(F.max("time"), _DAY).alias("last_day"),
    )


def monthly_avg_close(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.date_trunc("month", "time").alias("month"))
        .agg(F.avg("close").alias("avg_close"))
        .orderBy("month")
    )


def distinct_symbols(df: DataFrame, col: str = "symbol") -> DataFrame:
    return df.select(col).distinct()


def null_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows in which at least one of ``cols`` is NULL."""
    return df.agg(F.count_if(any_of([F.col(c).isNull() for c in cols])).alias("null_count"))


def zero_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_if(F.col(col) == 0).alias("zero_count"))


def duplicate_times(df: DataFrame, by: list[str] | None = None, time_col: str = "time") -> DataFrame:
    """Times that occur more than once in a series, with how often they do."""
    return (
        df.groupBy(*(by or []), time_col)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def rejection_summary(tagged: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows per outcome of a tagged frame; rows without a reason were retained."""
    return tagged.groupBy(F.coalesce(F.col(reason), F.lit("retained")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def column_stats(df: DataFrame, cols: list[str], by: list[str], kinds: tuple[str, ...] = ("mean", "median")) -> DataFrame:
    """Mean and exact median of each column per group, as ``<col>_mean`` and ``<col>_median``.

    Spark's exact median keeps the distinct values of a group in one task's memory. The median is therefore
    selected by counts, see ``_selected_medians``.
    """
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"{c}_mean") for c in cols]) if "mean" in kinds else None
    if "median" not in kinds:
        return means
    medians = _selected_medians(df, cols, by)
    names = {k: f"_k{i}" for i, k in enumerate(by)}
    groups = means if means is not None else df.select(*by).distinct()
    return groups.join(medians.withColumnsRenamed(names), match_keys(names), "left").drop(*names.values())


#: Steps a factor of two is cut into, and linear steps inside such a bucket: 12 + 21 + 22 bits, two more than a double has.
_FIRST, _NEXT = 1 << 12, (1 << 21, 1 << 22)
_CODES = (1100 + 1100) * 2 * _FIRST


def _coarse(x: Column) -> Column:
    """Bucket of a double, rising with it: its power of two, cut into ``_FIRST`` steps.

    A logarithm that rounds up to the next power only gives a step below that power's first, so buckets keep their order.
    """
    size = F.abs(x)
    power = F.floor(F.log2(size)).cast("double")
    step = F.floor((size / F.pow(F.lit(2.0), power) - 1) * _FIRST)
    code = ((power + 1100) * (2 * _FIRST) + step + 1).cast("bigint")
    code = F.when(F.isnan(x), F.lit(_CODES + 1)).when(size == F.lit(float("inf")), F.lit(_CODES)).when(size == 0, F.lit(0)).otherwise(code)
    return F.when(x < 0, -code).otherwise(code).cast("bigint")


def _selected_medians(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """Exact medians by narrowing the range of values that holds them, without an order over the rows.

    Per group and column the values are counted by bucket, partially before the shuffle; the bucket with the middle rank is cut into finer
    ones in the next pass. Three passes reach single values, whatever the number of rows. A group's counts are what one task orders: at
    most a bucket per step, not a row per value. An even number of values has two middle ones: if the second is not the first again, it is the
    least value above it, which each pass brings along.
    """
    keys = [f"_g{i}" for i in range(len(by))] + ["_column"]
    pairs = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    named = [F.col(k).alias(f"_g{i}") for i, k in enumerate(by)]
    values = df.select(*named, F.expr(f"stack({len(cols)}, {pairs}) AS (_column, _x)")).filter(F.col("_x").isNotNull())
    ordered = Window.partitionBy(*keys).orderBy("_bucket")

    def narrowed(buckets: DataFrame, *carried: str) -> DataFrame:
        """The bucket that holds the lower middle rank of each group and column."""
        upto = F.sum("_n").over(ordered)
        state = buckets.withColumns({"_upto": upto, "_above": F.lead("_lo").over(ordered)})
        if not carried:
            state = state.withColumns({"_total": F.sum("_n").over(Window.partitionBy(*keys)), "_below": F.lit(0).cast("bigint"), "_then": F.lit(None).cast("double")})
        rank = F.expr("(_total + 1) div 2 - _below")
        held = state.filter((F.col("_upto") - F.col("_n") < rank) & (F.col("_upto") >= rank))
        return held.select(
            *keys, "_lo", "_hi", "_n", "_total", (F.col("_below") + F.col("_upto") - F.col("_n")).alias("_below"), F.coalesce("_above", "_then").alias("_then")
        )

    counted = [F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]
    state = narrowed(values.withColumn("_bucket", _coarse(F.col("_x"))).groupBy(*keys, "_bucket").agg(*counted))
    for steps in _NEXT:
        range_ = state.select(*[F.col(k).alias(f"_s{k}") for k in keys], F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), "_total", "_below", "_then")
        inside = values.join(range_, match_keys({k: f"_s{k}" for k in keys})).filter(F.col("_x").between(F.col("_from"), F.col("_to")))
        place = F.floor((F.col("_x") - F.col("_from")) / (F.col("_to") - F.col("_from")) * steps)
        bucket = F.when(F.col("_from") == F.col("_to"), F.lit(0)).otherwise(place).cast("bigint")
        known = [F.first(c).alias(c) for c in ("_total", "_below", "_then")]
        state = narrowed(inside.withColumn("_bucket", bucket).groupBy(*keys, "_bucket").agg(*counted, *known), "carried")
    again = F.expr("_total div 2 + 1") <= F.col("_below") + F.col("_n")
    median = F.when(again, F.col("_lo")).otherwise((F.col("_lo") + F.col("_then")) / 2)
    return state.groupBy(*[F.col(f"_g{i}").alias(k) for i, k in enumerate(by)]).agg(
        *[F.max(F.when(F.col("_column") == i, median)).alias(f"{c}_median") for i, c in enumerate(cols)]
    )
