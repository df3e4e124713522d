"""Exact deduplication as a stream with disk-backed state.

Texts arrive as a stream of files. For every digest the state keeps the largest stable identifier, the locator (file, row) of
the content that has it, and the number of rows; RocksDB holds the state on disk and nothing in it expires, so copies may be any
time apart. Partial aggregation in front of the shuffle sends one row per digest and task, however hot a text is. Only a digest that
was hit is looked at again: its rows fetch the content at the locator and are compared byte by byte. Rows that differ from it
(a digest collision) are grouped by the text itself.

Everything is DataFrame and SQL functions.

Defined results. Texts are equal if they agree after lower-casing A-Z; a null text counts as empty. Of equal texts the row with
the largest identifier stays; a null identifier is smaller than all others, and of rows with one identifier the one with the largest
(file, row) stays. Rows are repeated in the result as often as in the table; an empty table gives an empty one. Extra columns are not
read. Files that come later are added by another call with the same ``state`` folder: the state goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import ascii_lower, cut_lineage, scratch_path

#: State on disk, without room set aside in advance: there is a store per partition, and most are small.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: str = "text") -> Column:
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def _located(df: DataFrame, doc_id: str) -> DataFrame:
    """Add ``at``: identifier, file and row. Ordered by these three, greatest last."""
    return df.select(
        F.struct(
            F.col(doc_id).alias("doc_id"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ).alias("at"),
        normalised(df.columns[1]).alias("norm"),
    )


def update_state(spark: SparkSession, path: str, state: str, doc_id: str = "doc_id", text: str = "text", files_per_trigger: int | None = None) -> None:
    """Take all files of ``path`` that the state has not seen yet into the state under ``state``."""
    schema = spark.read.parquet(path).select(doc_id, text).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"  # the source takes a single file only by a pattern
    keyed = _located(reader.parquet(pattern), doc_id).select("at", F.xxhash64("norm").alias("digest"))
    counted = keyed.groupBy("digest").agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("n"))
    before = {name: spark.conf.get(name, None) for name in STATE_CONF}
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    try:
        query = (
            counted.writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """Digest, identifier and locator of the row that stays, number of rows."""
    stored = spark.read.format("statestore").load(state)
    return stored.select(F.col("key.digest").alias("digest"), F.col("value.max").alias("at"), F.col("value.count").alias("n"))


def exact_groups(
    spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text", state: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, keep_id, group_size, kept, text_sha256."""
    state = state or scratch_path(spark, "exact-state")
    update_state(spark, path, state, doc_id, text, files_per_trigger)
    held = read_state(spark, state).withColumnRenamed("at", "keep")
    rows = _located(spark.read.parquet(path).select(doc_id, text), doc_id).withColumn("digest", F.xxhash64("norm"))

    # Hits: every row of a digest that came more than once, against the content at the locator.
    content = rows.join(held.where("n > 1"), F.col("at") == F.col("keep")).select("keep", held["digest"], F.col("norm").alias("content"))
    content = cut_lineage(content)
    # No step behind this join needs a digest's rows together, so Spark may split a hot one.
    collided = cut_lineage(rows.join(content, "digest").where(F.col("norm") != F.col("content")).select("digest"))

    plain = rows.select("at", "digest", F.sha2("norm", 256).alias("text_sha256"))
    grouped = plain.join(held, "digest")
    if not collided.isEmpty():
        grouped = grouped.join(collided, "digest", "left_anti").unionByName(_by_text(rows.join(collided, "digest", "left_semi")))
    return grouped.select(
        F.col("at.doc_id").alias("doc_id"),
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("at") == F.col("keep")).alias("kept"),
        "text_sha256",
    )


def _by_text(rows: DataFrame) -> DataFrame:
    """Groups of rows whose digest stands for several texts."""
    groups = rows.groupBy("digest", "norm").agg(F.max("at").alias("keep"), F.count(F.lit(1)).alias("n"))
    joined = rows.join(groups, ["digest", "norm"])
    return joined.select("digest", "at", F.sha2("norm", 256).alias("text_sha256"), "keep", "n")
