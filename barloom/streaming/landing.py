"""Incremental ingestion of newly landed files with Structured Streaming.

The batch form resumes from the latest stored day. This form resumes from the files not read yet:
each run takes what has landed since the last one and stops. Rows are inserted with the same
insert-ignore, so a micro-batch that is delivered again after a failure adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.session import cut_lineage, temporary_copies
from barloom.sinks.tables import insert_new, write_raw


def ingest_landed(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    clean: Callable[[DataFrame], DataFrame],
    raw: str,
    table: str,
    checkpoint: str,
    fmt: str = "parquet",
    grain: str = "month",
    max_files: int | None = None,
) -> StreamingQuery:
    """Ingest the files landed since the last run in one batch, or ``max_files`` at a time.

    Smaller batches give the same table only if ``clean`` looks at single rows: fills and adjustments see a
    batch, not the series.
    ``clean`` turns a batch of landed rows into storable ones, e.g.
    ``lambda df: clean_equities(df, for_storage=True)``. Duplicates are resolved per micro-batch by
    the landing order and across micro-batches by what is stored first.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        # A batch that is delivered again replaces its own raw rows.
        if write_raw(batch, f"{raw.rstrip('/')}/batch={batch_id}", mode="overwrite"):
            with temporary_copies(spark):
                insert_new(cut_lineage(clean(batch)), table, grain=grain)

    reader = spark.readStream.schema(schema).format(fmt)
    landed = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(landing)
    return (
        landed.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
