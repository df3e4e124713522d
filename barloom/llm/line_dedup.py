"""Line deduplication across documents.

Every document gives one row per distinct long line: a 128-bit hash of the line's key and the places where it stands. The rows are
range-partitioned by hash, then document (greatest first), and sorted in that order within each partition; one pass streams over
them. The first row of a hash is the document that keeps the line; all others lose it once enough documents have
been seen, so a run of any length needs a handful of rows in memory. The document is part of the range key, so a line that a
third of all documents share spreads over many partitions. Only the first and the last hash of a partition can go on in a
neighbour: their rows leave the pass undecided, with one summary row per partition and hash, and are decided by joining the
summaries (two per partition at most). What comes out is one compressed bitmap of kept lines per document, not text.

Defined results. Lines are what stands between \\n; a null or empty text is one empty line. The key is the line without
space, tab and ``\\n\\v\\f\\r`` at both ends, with A-Z lower-cased. Rows with one identifier are one document; a null identifier is a document
of its own, smaller than all others. Lines of the document with the largest identifier all stay, repetitions included. Repeated rows
lose the same lines. An empty table gives an empty table. Extra columns do not matter to the bitmaps and are carried along by
`apply_bitmaps`, except that names starting with ``_line`` are refused.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import cut_lineage, map_batches, strings

STRIPPED = " \t\n\x0b\x0c\r"
DROP, OPEN, SUMMARY = 0, 1, 2


def long_lines(lines: list[str], min_chars: int) -> dict[bytes, list[int]]:
    """Hash of each key that is long enough, with its places."""
    places: dict[bytes, list[int]] = {}
    for place, line in enumerate(lines):
        key = line.strip(STRIPPED)
        if len(key) >= min_chars:
            places.setdefault(xxhash.xxh3_128_digest(key.encode().lower()), []).append(place)
    return places


def _line_rows(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            T.StructField("high", T.LongType()),
            T.StructField("low", T.LongType()),
            T.StructField("doc", rows.schema["doc"].dataType),
            T.StructField("row", T.LongType()),
            T.StructField("n_lines", T.IntegerType()),
            T.StructField("places", T.BinaryType()),
        ]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        source, n_lines, places, hashes = [], [], [], bytearray()
        for i, value in enumerate(strings(batch.column(2))):
            if len(value) < min_chars:
                continue
            lines = value.split("\n")
            for digest, found in long_lines(lines, min_chars).items():
                source.append(i)
                n_lines.append(len(lines))
                places.append(np.array(found, np.int32).tobytes())
                hashes += digest
        pairs = np.frombuffer(bytes(hashes), np.int64).reshape(-1, 2)
        taken = pa.array(source, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), batch.column(0).take(taken), batch.column(1).take(taken),
                pa.array(n_lines, pa.int32()), pa.array(places, pa.binary()),
            ],
            names=schema.names,
        )

    return map_batches(rows, run, schema)


def _stream(min_docs: int):
    """Pass over a sorted partition: rows that are dropped, rows left open, and summaries of the hashes at both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first_doc = last_doc = None
        seen, runs = 0, 0
        waiting: list[pa.RecordBatch] = []  # rows of the run that are dropped if enough documents follow

        def out(rows: pa.RecordBatch, state: int) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([state] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, rows.column(2).type)],
                names=[*rows.schema.names, "state", "n_docs", "last"],
            )

        def summary(schema: pa.Schema) -> pa.RecordBatch:
            kind = schema.field("doc").type
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([first_doc], kind),
                    pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
                    pa.array([SUMMARY], pa.int32()), pa.array([seen], pa.int64()), pa.array([last_doc], kind),
                ],
                names=[*schema.names, "state", "n_docs", "last"],
            )

        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            dropped: list[int] = []
            opened: list[int] = []
            held: list[int] = []  # as ``waiting``, but in this batch
            for i, (high, low, doc) in enumerate(
                zip(batch.column(0).to_numpy().tolist(), batch.column(1).to_numpy().tolist(), batch.column(2).to_pylist())
            ):
                if key != (high, low):
                    if runs == 1:
                        yield summary(schema)
                    key, first_doc, last_doc, seen, runs = (high, low), doc, doc, 1, runs + 1
                    waiting, held = [], []
                elif doc != last_doc:
                    last_doc, seen = doc, seen + 1
                if runs == 1:
                    opened.append(i)
                elif doc != first_doc:
                    held.append(i)
                    if seen >= min_docs:
                        for rows in waiting:
                            yield out(rows, DROP)
                        dropped += held
                        waiting, held = [], []
            if dropped:
                yield out(batch.take(pa.array(dropped)), DROP)
            if opened:
                yield out(batch.take(pa.array(opened)), OPEN)
            if held:
                waiting.append(batch.take(pa.array(held)))
        if schema is not None:
            for rows in waiting:
                yield out(rows, OPEN)
            yield summary(schema)

    return run


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per document that loses lines: doc, row (hash of its text), n_lines, n_dropped, keep (compressed bitmap)."""
    rows = cut_lineage(_line_rows(docs, doc_id, text, min_chars))
    order = [F.asc("high"), F.asc("low"), F.desc_nulls_last("doc"), F.asc("row")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("state", T.IntegerType()), T.StructField("n_docs", T.LongType()), T.StructField("last", rows.schema["doc"].dataType)]
    )
    streamed = cut_lineage(sorted_rows.mapInArrow(_stream(min_docs), schema))

    # A document whose rows end one partition and begin the next is counted in both.
    by_hash = W.partitionBy("high", "low").orderBy(F.desc_nulls_last("doc"), F.desc_nulls_last("last"))
    ends = streamed.where(F.col("state") == SUMMARY).withColumn(
        "again", (F.lag("last").over(by_hash).eqNullSafe(F.col("doc")) & (F.row_number().over(by_hash) > 1)).cast("long")
    )
    decided = ends.groupBy("high", "low").agg((F.sum("n_docs") - F.sum("again")).alias("total"), F.max("doc").alias("keeper"))
    decided = decided.where(F.col("total") >= min_docs).select("high", "low", "keeper")
    late = streamed.where(F.col("state") == OPEN).join(decided, ["high", "low"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    columns = ["doc", "row", "n_lines", "places"]
    drops = streamed.where(F.col("state") == DROP).select(columns).unionByName(late.select(columns))
    grouped = drops.groupBy("doc", "row").agg(F.max("n_lines").alias("n_lines"), F.collect_set("places").alias("places"))
    out = T.StructType(
        [*grouped.schema.fields[:3], T.StructField("n_dropped", T.LongType()), T.StructField("keep", T.BinaryType())]
    )

    names = out.names

    def bitmaps(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_dropped, keep = [], []
        for n, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            mask = np.ones(n, np.uint8)
            mask[np.frombuffer(b"".join(places), np.int32)] = 0
            n_dropped.append(int(n - mask.sum()))
            keep.append(zlib.compress(np.packbits(mask).tobytes()))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(n_dropped, pa.int64()), pa.array(keep, pa.binary())], names=names
        )

    return map_batches(grouped, bitmaps, out)


def read_bitmap(keep: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: bool = False) -> DataFrame:
    """The documents without their dropped lines; ``counts`` adds n_lines (before dropping) and n_dropped."""
    if any(c.startswith("_line") for c in docs.columns):
        raise ValueError("column names that start with _line are used here")
    marks = bitmaps.select(
        F.col("doc").alias("_line_doc"), F.col("row").alias("_line_row"), F.col("n_lines").alias("_line_n"), F.col("keep").alias("_line_keep")
    )
    same = F.col(doc_id).eqNullSafe(F.col("_line_doc")) & (F.xxhash64(text) == F.col("_line_row"))
    joined = docs.join(marks, same, "left").select(*docs.columns, "_line_n", "_line_keep")
    extra = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())] if counts else []
    schema = T.StructType([*docs.schema.fields, *extra])
    place, width, names = docs.columns.index(text), len(docs.columns), schema.names

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_lines, n_dropped = [], [], []
        for value, n, keep in zip(*(batch.column(i).to_pylist() for i in (place, width, width + 1))):
            if keep is None:
                texts.append(value)
                n_lines.append((value or "").count("\n") + 1 if counts else 0)
                n_dropped.append(0)
                continue
            mask = read_bitmap(keep, n)
            texts.append("\n".join(compress(value.split("\n"), mask)))
            n_lines.append(n)
            n_dropped.append(int(n - mask.sum()))
        columns = list(batch.columns[:width])
        columns[place] = pa.array(texts, pa.string())
        if counts:
            columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(joined, run, schema)
