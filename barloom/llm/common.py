"""Small helpers the operators share: reading tables, Arrow mapping, cutting lineage, running totals over sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import cut_lineage, scratch_path

__all__ = ["ascii_lower", "cut_lineage", "map_batches", "scratch_path", "strings", "table"]

#: Rows whose Python values are in memory at once.
SLICE = 1000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays. Text of one byte a character takes the quick way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def strings(column: pa.Array) -> list[str]:
    """Values of a text column; null counts as empty."""
    return ["" if value is None else value for value in column.to_pylist()]


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply a function of one Arrow batch to every batch, ``SLICE`` rows at a time; they never meet in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, SLICE) for i in range(0, whole.num_rows, SLICE)):
                out = function(batch)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    return df.mapInArrow(run, schema)
