"""Near-duplicates by SimHash, compared bit-sliced.

A fingerprint has a bit per majority of the bits of its shingle hashes. Fingerprints within the radius agree in at least
``blocks - radius`` of ``blocks`` blocks of bits, so each choice of so many blocks is a bucket key, and every linked pair
shares a bucket: no pair is lost and none outside a bucket is looked at. Equal fingerprints are one row from the start. A bucket with more rows than
``chunk`` is dealt into chunks by hash, and every two chunks meet in one task.

Inside a task the fingerprints are turned on their side: one vector per bit, a position per row. Row i and row i + d are compared
for all rows at once by shifting the vectors by d; distances are carry-save counters, also one vector per digit, which overflow
just above the radius. Words of 64 comparisons that have all overflowed are left out of the remaining bits. Links inside a bucket
become a spanning forest before they leave the task, so a group of copies gives a row per copy, not per pair.

Defined results. A null text counts as empty. Words are runs of anything but space and \\t\\n\\v\\f\\r, with A-Z lower-cased. Fewer words than a shingle
needs are one shingle; no words give fingerprint zero, which is linked like any other. Repeated rows have one fingerprint and one
component. Null identifiers never name a component unless it has no other. An empty table gives an empty table. Extra columns are
not read.

`similar_texts` links by the Jaccard similarity of the texts' sets of shingles instead. Its candidates are fingerprints (of the sets) within
a wide radius that share a band of minimal hashes, compared by the same bit-sliced tasks; the texts of connected candidates then meet in
one task, where every pair that could reach the similarity is compared shingle by shingle, so no link is below it. Texts without
words have one, empty, shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import cut_lineage, map_batches, strings
from barloom.llm.components import connected_components

FULL = np.uint64(2**64 - 1)


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Bits of one text, as an unsigned number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(stops)
    for at in range(0, n, 65_536):  # bounds memory for very long texts
        part = range(at, min(n, at + 65_536))
        hashes = np.array([hashed(joined[starts[i] : stops[i]], seed) for i in part], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for low in range(0, len(bits), 255):
            counts += np.add.reduce(bits[low : low + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("fp", T.LongType(), False)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(value, shingle, seed) for value in strings(batch.column(1))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=schema.names)

    return map_batches(rows, run, schema)


def block_masks(radius: int, blocks: int) -> list[int]:
    """One mask per choice of the blocks that a linked pair must share."""
    edges = np.linspace(0, 64, blocks + 1).round().astype(int).tolist()
    parts = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Row k holds bit k of all values, 64 values a word, with two spare words for shifting."""
    n = len(values)
    bits = np.zeros((64 * (n // 64 + 3), 64), np.uint8)
    bits[:n] = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def near_pairs(planes: np.ndarray, valid: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Places i with ``valid[i]`` whose values differ from those at i + shift in at most ``radius`` bits."""
    padded = np.zeros(64 * -(-len(valid) // 64), np.uint8)
    padded[: len(valid)] = valid
    wanted = np.packbits(padded, bitorder="little").view(np.uint64)
    live = np.flatnonzero(wanted)
    over = ~wanted[live]
    digits = radius.bit_length()
    offset = (1 << digits) - 1 - radius  # the counter overflows at radius + 1
    counter = [np.full(len(live), FULL if offset >> d & 1 else 0, np.uint64) for d in range(digits)]
    words, low = divmod(shift, 64)
    for k, plane in enumerate(planes):
        at = live + words
        there = plane[at] if not low else (plane[at] >> np.uint64(low)) | (plane[at + 1] << np.uint64(64 - low))
        carry = plane[live] ^ there
        for d in range(digits):
            counter[d], carry = counter[d] ^ carry, counter[d] & carry
        over |= carry
        if k % 8 == 7:
            keep = np.flatnonzero(over != FULL)
            if len(keep) < len(live):
                live, over, counter = live[keep], over[keep], [c[keep] for c in counter]
                if not len(live):
                    break
    hits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(hits)
    return live[word] * 64 + bit


class Forest:
    """Union of rows; the smallest place is the root."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))
        self.labels = np.arange(n)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        new = self.labels[left] != self.labels[right]
        if new.any():
            for a, b in zip(left[new].tolist(), right[new].tolist()):
                a, b = self.find(a), self.find(b)
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
            self.labels = np.array(self.parent)
            while (flat := self.labels[self.labels]).tolist() != self.labels.tolist():
                self.labels = flat
            self.parent = self.labels.tolist()


def link_runs(values: np.ndarray, run: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between values of the same run (runs are contiguous)."""
    starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    lengths = np.diff(np.append(starts, len(values)))
    longest_first = np.argsort(-lengths, kind="stable")
    sizes = lengths[longest_first]
    size = np.repeat(sizes, sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = values[np.repeat(starts[longest_first], sizes) + place]
    planes, forest = bit_planes(values), Forest(len(values))
    for shift in range(1, int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-size, -shift, side="left"))  # rows of runs longer than the shift come first
        left = near_pairs(planes, place[:n] + shift < size[:n], shift, radius)
        forest.link(left, left + shift)
    rows = np.flatnonzero(forest.labels != np.arange(len(values)))
    return values[rows], values[forest.labels[rows]]


def near_links(distinct: DataFrame, radius: int = 3, blocks: int = 5, chunk: int = 2048) -> DataFrame:
    """Links (a, b) that connect exactly the values of column ``fp`` that a chain of near values connects."""
    masks = block_masks(radius, blocks)
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    keys = [F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)]
    return bucket_links(distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.*"), radius, chunk)


def bucket_links(rows: DataFrame, radius: int, chunk: int = 2048) -> DataFrame:
    """Links (a, b) that connect the values ``fp`` that a chain of near values, each two of one bucket (mask, key), connects."""
    shared = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = rows.join(shared, ["mask", "key"]).withColumn("chunks", F.ceil(F.col("n") / chunk))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    bucket = ["mask", "key", "low", "high"]
    dealt = dealt.select("fp", "mask", "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
    dealt = dealt.repartition(*bucket).sortWithinPartitions(*bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            changes = (rows[1:, 1:] != rows[:-1, 1:]).any(axis=1)
            a, b = link_runs(np.ascontiguousarray(rows[:, 0]).view(np.uint64), np.concatenate(([0], np.cumsum(changes))), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([column.to_numpy().astype(np.int64) for column in batch.columns], axis=1)
            last = int(np.flatnonzero((rows[:, 1:] != rows[-1, 1:]).any(axis=1))[-1]) + 1 if (rows[:, 1:] != rows[-1, 1:]).any() else 0
            if last or (kept and (kept[-1][-1, 1:] != rows[0, 1:]).any()):
                done = np.concatenate([*kept, rows[:last]])
                kept = []
                if len(done) > 1:
                    yield links(done)
            kept.append(rows[last:])
        if kept:
            yield links(np.concatenate(kept))

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, blocks: int = 5, chunk: int = 2048
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (smallest identifier reachable over links)."""
    marked = cut_lineage(fingerprints(docs, doc_id, text, shingle))
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    roots = connected_components(near_links(distinct.select("fp"), radius, blocks, chunk))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


_RANDOM = np.random.default_rng(42)
BANDS, IN_BAND = 25, 4  # a pair of similarity 0.8 shares no band once in 500,000 times
FLIPS = _RANDOM.integers(0, 2**64, BANDS * IN_BAND, np.uint64)[:, None]
FACTORS = _RANDOM.integers(0, 2**64, BANDS * IN_BAND, np.uint64)[:, None] | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)
SLACK = 1e-9  # a similarity of exactly the least one counts


def shingle_set(text: str, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Hashes of the different shingles of a text, in order."""
    words = text.encode().lower().split()
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words], dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist() if words else [0]
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.array([hashed(joined[low:high], seed) for low, high in zip(starts, stops)], np.uint64))


def sketch(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """Fingerprint of a set of shingles, and a key per band of minimal hashes."""
    counts, least = np.zeros(64, np.int64), np.full(len(FLIPS), FULL)
    for low in range(0, len(hashes), 2048):
        part = hashes[low : low + 2048]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        least = np.minimum(least, ((part ^ FLIPS) * FACTORS).min(axis=1))
    keys = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, IN_BAND).T:
        keys = (keys ^ column) * MIX
        keys ^= keys >> np.uint64(29)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]), keys


def similar_pairs(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Spanning links between the sets that a chain of pairs of at least this Jaccard similarity connects.

    Two such sets share one of the rarest ``n - similarity * n + 1`` shingles of each, so only sets that do are compared.
    """
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    sizes = [len(s) for s in sets]
    ranked = [np.sort(part) for part in np.split(rank[inverse], np.cumsum(sizes)[:-1])]
    forest, holders = Forest(len(sets)), {}
    for i in np.argsort(sizes, kind="stable").tolist():
        n, tried = sizes[i], set()
        for token in ranked[i][: n - ceil(similarity * n - SLACK) + 1].tolist():
            held = holders.setdefault(token, [])
            for j in held:
                if j in tried or sizes[j] < similarity * n - SLACK:
                    continue
                tried.add(j)
                a, b = forest.find(i), forest.find(j)
                if a == b:
                    continue
                both = len(np.intersect1d(ranked[i], ranked[j], assume_unique=True))
                if both >= similarity * (n + sizes[j] - both) - SLACK:
                    forest.parent[max(a, b)] = min(a, b)
                    yield i, j
            held.append(i)


def text_key(text: str) -> Column:
    """128 bits that name a text, as hex; null counts as empty."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def maybe_among(rows: DataFrame, few: DataFrame, key: str, bits: int = 1 << 24) -> DataFrame:
    """Rows whose ``key`` may be one of those in ``few``: all that are, and some others, by a bitmap of hashes of a fixed size."""
    slot = f"pmod(xxhash64({key}), {bits}L)"
    marks = few.selectExpr(f"{slot} AS slot").groupBy(F.expr("slot div 64").alias("word"))
    marks = F.broadcast(marks.agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 AS int)))").alias("marks")))
    found = rows.join(marks, F.expr(f"{slot} div 64") == marks["word"])
    return found.where(F.expr(f"getbit(marks, cast({slot} % 64 AS int)) = 1")).select(rows.columns)


def similar_texts(
    docs: DataFrame, text: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 22, chunk: int = 2048, chunk_chars: int = 1 << 24
) -> DataFrame:
    """Links between different texts by `text_key`: ``root`` (the smallest key reachable) of every ``node`` that is not its own.

    ``radius`` only thins the candidates: similarity 0.8 differs in about 10 bits of 64, unrelated texts in about 32.
    """
    rows = docs.select(text_key(text).alias("node"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sketch(shingle_set(value, shingle)) for value in strings(batch.column(1))]
        prints = np.array([fp for fp, _ in found], np.uint64).view(np.int64)
        keys = [k.view(np.int64) for _, k in found]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), pa.array(keys, pa.list_(pa.int64()))], names=["node", "fp", "keys"])

    marked = cut_lineage(map_batches(rows, run, "node string, fp long, keys array<long>"))
    bands = marked.select("fp", F.posexplode("keys").alias("mask", "key")).distinct()
    near = connected_components(bucket_links(bands, radius, chunk))
    nodes = marked.select("node", "fp").distinct()
    grouped = nodes.join(near, nodes["fp"] == near["node"], "left").select(nodes["node"], F.coalesce("root", "fp").alias("group"))
    several = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    grouped = cut_lineage(grouped.join(several, "group"))
    # Only texts that may be candidates are shuffled.
    texts = cut_lineage(maybe_among(rows, grouped, "node").join(grouped, "node").dropDuplicates(["node"]))
    return connected_components(_compare(texts, shingle, similarity, chunk_chars))


def _compare(texts: DataFrame, shingle: int, similarity: float, chunk_chars: int) -> DataFrame:
    """Links (a, b) between the nodes of a group whose texts are similar. Groups of more than ``chunk_chars`` meet in pairs of chunks."""
    chunks = texts.groupBy("group").agg(F.ceil(F.sum(F.length("text")) / chunk_chars + 1e-9).alias("chunks"))
    dealt = texts.join(chunks, "group").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    pair = ["group", "low", "high"]
    dealt = dealt.select("group", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "node", "text")
    dealt = dealt.repartition(*pair).sortWithinPartitions(*pair)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, nodes, sets = None, [], []

        def links() -> pa.RecordBatch:
            found = list(similar_pairs(sets, similarity)) if len(sets) > 1 else []
            ends = [pa.array([nodes[pair[side]] for pair in found], pa.string()) for side in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        for whole in batches:
            for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                *key, node, text = batch.columns
                for run_of, number, value in zip(zip(*(k.to_pylist() for k in key)), node.to_pylist(), strings(text)):
                    if run_of != current:
                        if sets:
                            yield links()
                        current, nodes, sets = run_of, [], []
                    nodes.append(number)
                    sets.append(shingle_set(value, shingle))
        if sets:
            yield links()

    return dealt.mapInArrow(run, "a string, b string")
