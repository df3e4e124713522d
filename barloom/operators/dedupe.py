"""First-wins deduplication and insert conflict rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.aggregates import any_of
from barloom.schemas import ORD, SYMBOL, TIME

KEYS = (SYMBOL, TIME)


class DuplicateKeys(ValueError):
    """Raised when a strict insert meets keys that exist already or repeat in the batch."""


def dedupe_first(df: DataFrame, keys=KEYS, order=(ORD,)) -> DataFrame:
    """First row per key in ``order``.

    Spark limits each group before the shuffle (``WindowGroupLimit``), so a key with very many
    copies sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def new_keys(batch: DataFrame, existing: DataFrame, keys=KEYS) -> DataFrame:
    """Batch rows whose key is not stored; rows with a NULL key never conflict.

    Stored keys are made distinct first: copies collapse before the shuffle that the join needs.
    """
    return batch.join(existing.select(*keys).distinct(), list(keys), "left_anti").select(*batch.columns)


def insert_ignore(batch: DataFrame, existing: DataFrame, keys=KEYS, order=(ORD,)) -> DataFrame:
    """Rows an insert that ignores conflicts would add: the first per key, if the key is not stored.

    As in SQL, NULL keys are distinct from each other, so such rows are all kept; ``order`` is unique
    per row and gives each of them a group of its own.
    """
    unkeyed = any_of([F.col(k).isNull() for k in keys])
    own = [F.when(unkeyed, F.col(c)).alias(f"_own{i}") for i, c in enumerate(order)]
    tagged = batch.select("*", *own)
    first = dedupe_first(tagged, (*keys, *[f"_own{i}" for i in range(len(order))]), order)
    return new_keys(first.select(*batch.columns), existing, keys)


def conflicts(batch: DataFrame, existing: DataFrame, keys=KEYS) -> DataFrame:
    """Keys that make a strict insert fail, with the rows they have in the batch and in store."""
    known = [F.col(k).isNotNull() for k in keys]
    counted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("in_batch"))
    for condition in known:
        counted = counted.filter(condition)
    stored = existing.groupBy(*keys).agg(F.count(F.lit(1)).alias("stored"))
    return (
        counted.join(stored, list(keys), "left")
        .withColumn("stored", F.coalesce("stored", F.lit(0).cast("bigint")))
        .filter((F.col("in_batch") > 1) | (F.col("stored") > 0))
    )


def insert_strict(batch: DataFrame, existing: DataFrame, keys=KEYS) -> DataFrame:
    """The batch itself, or an error that names some of the conflicting keys."""
    found = conflicts(batch, existing, keys).limit(5).collect()
    if found:
        shown = [tuple(str(r[k]) for k in keys) for r in found]
        raise DuplicateKeys(f"duplicate keys, nothing inserted; for example {shown}")
    return batch
