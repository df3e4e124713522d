"""Removal of repeated byte strings with suffix sorting, a block at a time.

Every window of ``length`` bytes has an anchor: the smallest hash among its ``gram``-byte strings, leftmost of ties. Equal windows
have equal anchors at the same place, so only windows whose anchor occurs again can be repeated, and an anchor is one suffix bucket.

1. Neighbouring windows with one anchor are a *stretch*. Equal stretches are counted by a 128-bit hash, added up before the shuffle;
   all windows of a stretch that occurs twice are repeated. Hot passages and whole copies end here, without their bytes being sent.
2. Stretches of one anchor that differ may still share windows. Their bytes (one copy of each) are brought together by anchor, and
   the suffixes at their windows are sorted block by block: first by ``V`` bytes; ties by the ranks of difference-cover
   samples. For any two suffixes some shift below V brings both onto the sample, whose ranks were worked out for the block
   by doubling, so a tie of any length costs one comparison and no more memory. Windows are repeated if neighbours
   in that order agree in ``length`` bytes, which is checked on the bytes.
3. An anchor with more than ``bucket`` different stretches would not fit in a block; its windows are counted by their 128-bit hash instead, added
   up before the shuffle.

The repeated windows of a document are joined to it as intervals; what they cover is cut out.

Defined results. Texts are UTF-8 bytes; a null text is empty. Windows do not cross documents; overlapping windows of one document
count as different places. Removal looks at the input, not at what is left. Texts shorter than ``length`` stay whole. Repeated rows
are repeated text, so all of them lose what they share. What is left may end within a character: it is binary. An empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import cut_lineage, map_batches

#: A difference cover. Every number is the difference of two of COVER modulo V.
V = 31
COVER = (1, 5, 11, 24, 25, 27)

MULTIPLIER = 0x9E3779B97F4A7C15
SEGMENT = 1 << 20


def _shift_table() -> np.ndarray:
    """For residues a and b the smallest shift that brings both into the cover."""
    table = np.full((V, V), -1, np.int64)
    for a in range(V):
        for b in range(V):
            table[a, b] = next(d for d in range(V) if (a + d) % V in COVER and (b + d) % V in COVER)
    return table


SHIFT = _shift_table()


class _Powers:
    """Powers of the multiplier and of its inverse, modulo 2**64, grown when needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = np.cumprod(np.append(np.uint64(1), np.full(size, MULTIPLIER, np.uint64)), dtype=np.uint64)
            self.down = np.cumprod(np.append(np.uint64(1), np.full(size, pow(MULTIPLIER, -1, 1 << 64), np.uint64)), dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed hash of the ``gram`` bytes at each place."""
    up, down = _POWERS.get(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    found = (sums[gram:] - sums[:-gram]) * down[: len(sums) - gram]
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(32)
    return found


def stretches(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each stretch."""
    hashes = gram_hashes(data, gram)
    width = length - gram + 1
    windows = len(hashes) - width + 1
    padded = np.append(hashes, np.full(-len(hashes) % width, 2**64 - 1, np.uint64)).reshape(-1, width)
    upto = np.minimum.accumulate(padded, axis=1).ravel()
    onward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(onward[:windows], upto[width - 1 : width - 1 + windows])
    # A stretch ends where a smaller hash comes in, and behind the window that begins at the anchor.
    new = np.append(True, (least[1:] != least[:-1]) | (hashes[: windows - 1] == least[:-1]))
    first = np.flatnonzero(new)
    return least[first], first, np.diff(np.append(first, windows))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a big-endian number; zeros behind the end."""
    padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out |= padded[j : j + len(data)] << np.uint64(56 - 8 * j)
    return out


def sample_ranks(words: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the cover-sample suffixes by at least ``depth`` bytes, at their places; 0 elsewhere."""
    n = len(words) - 2 * depth - 4 * V  # what follows is padding
    places = np.flatnonzero(np.isin(np.arange(n) % V, COVER))
    keys = [words[places + 24] >> np.uint64(8), words[places + 16], words[places + 8], words[places]]
    order = np.lexsort(keys)
    new = np.zeros(len(places), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    ranks = np.zeros(len(words), np.int64)
    ranks[places[order]] = np.cumsum(new) + 1
    covered = V
    while covered < depth and len(places):
        pair = ranks[places] * (len(places) + 2) + ranks[places + covered]
        ranks[places] = np.unique(pair, return_inverse=True)[1] + 1
        covered *= 2
    return ranks


def repeated_suffixes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes agree in ``length`` bytes with another one; all of them lie in ``data`` so far."""
    marked = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return marked
    words = words_at(np.append(data, np.zeros(2 * length + 5 * V, np.uint8)))
    keys = [words[starts + 24] >> np.uint64(8), words[starts + 16], words[starts + 8], words[starts]]
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    tie = np.cumsum(new) - 1
    tied = np.bincount(tie)[tie] > 1
    order, tie = order[tied], tie[tied]
    if not len(order):
        return marked
    ranks = sample_ranks(words, length)
    # Ternary quicksort of all tie groups at once; `place` is where an item stands in the final order.
    final, place, group = order.copy(), np.arange(len(order)), tie
    while len(place):
        items = final[place]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(first, len(group)))
        pivot = np.repeat(starts[items[first + sizes // 2]], sizes)
        here = starts[items]
        shift = SHIFT[here % V, pivot % V]
        side = np.sign(ranks[here + shift] - ranks[pivot + shift])
        key = np.repeat(np.arange(len(first)), sizes) * 3 + side + 1
        by_key = np.argsort(key, kind="stable")
        final[place] = items[by_key]
        key = key[by_key]
        open_ = (key % 3 != 1) & (np.bincount(key)[key] > 1)
        place, group = place[open_], key[open_]
    left, right = starts[final[:-1]], starts[final[1:]]
    alike = np.flatnonzero(tie[1:] == tie[:-1])
    for offset in [length - 8, *range(24, length - 8, 8)]:
        alike = alike[words[left[alike] + offset] == words[right[alike] + offset]]
    marked[final[alike]] = marked[final[alike + 1]] = True
    return marked


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("row")).alias("key"), body.alias("text"))


def _stretch_rows(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("key", keyed.schema["key"].dataType),
            *(T.StructField(name, T.LongType()) for name in ("anchor", "high", "low", "first", "windows")),
        ]
    )
    names = schema.names

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        source: list[np.ndarray] = []
        parts: list[list[np.ndarray]] = [[], [], []]
        hashes = bytearray()
        for i, value in enumerate(batch.column(1).to_pylist()):
            data = value.encode()
            for at in range(0, max(0, len(data) - length + 1), SEGMENT):
                piece = data[at : at + SEGMENT + length - 1]
                anchor, first, windows = stretches(np.frombuffer(piece, np.uint8), length, gram)
                for a, b in zip(first.tolist(), (first + windows + length - 1).tolist()):
                    hashes += xxhash.xxh3_128_digest(piece[a:b])
                for to, values in zip(parts, (anchor.view(np.int64), first + at, windows)):
                    to.append(values)
                source.append(np.full(len(first), i))
        if not source:
            return
        pairs = np.frombuffer(bytes(hashes), np.int64).reshape(-1, 2)
        anchor, first, windows = (np.concatenate(p) for p in parts)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.concatenate(source))), *(pa.array(x) for x in (anchor, pairs[:, 0].copy(), pairs[:, 1].copy(), first, windows))],
            names=names,
        )

    return map_batches(keyed, run, schema)


def _bytes_of(listed: DataFrame, length: int) -> DataFrame:
    """One row per listed stretch with its bytes."""
    item = listed.schema["items"].dataType.elementType
    schema = T.StructType([T.StructField("key", listed.schema["key"].dataType), *item.fields, T.StructField("bytes", T.BinaryType())])
    names = schema.names

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, items, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("key", "items", "text"))
        for i in range(batch.num_rows):  # a document at a time bounds memory
            found, data = items[i].as_py(), texts[i].as_py().encode()
            columns = [pa.array([x[name] for x in found], pa.int64()) for name in names[1:-1]]
            cut = [data[x["first"] : x["first"] + x["windows"] + length - 1] for x in found]
            yield pa.RecordBatch.from_arrays([keys.take(pa.array([i] * len(found))), *columns, pa.array(cut, pa.binary())], names=names)

    return map_batches(listed, run, schema)


def _sort_blocks(length: int, block: int):
    """Pass over rows sorted by anchor: intervals of the stretches that occur once."""

    def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(rows).combine_chunks()
        pieces = table["bytes"].to_pylist()
        first, windows, n = (table[c].to_numpy() for c in ("first", "windows", "n"))
        sizes = np.array([len(piece) for piece in pieces])
        row = np.repeat(np.arange(len(pieces)), windows)
        within = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = (np.cumsum(sizes) - sizes)[row] + within
        marked = repeated_suffixes(np.frombuffer(b"".join(pieces), np.uint8), starts, length) & (n[row] == 1)
        if not marked.any():
            return None
        row, at = row[marked], (first[row] + within)[marked]
        new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)))
        last = np.append(new[1:], len(at)) - 1
        keys = table["key"].combine_chunks().take(pa.array(row[new]))
        return pa.RecordBatch.from_arrays([keys, pa.array(at[new]), pa.array(at[last] + length)], names=["key", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            anchors = batch.column(batch.schema.get_field_index("anchor")).to_numpy()
            sizes = np.cumsum(pc.binary_length(batch.column(batch.schema.get_field_index("bytes"))).to_numpy())
            if kept and kept[-1].column(batch.schema.get_field_index("anchor"))[-1].as_py() != anchors[0] and size >= block:
                if (out := done(kept)) is not None:
                    yield out
                kept, size = [], 0
            begin = 0
            for end in (np.flatnonzero(anchors[1:] != anchors[:-1]) + 1).tolist():
                if size + int(sizes[end - 1] - (sizes[begin - 1] if begin else 0)) >= block:
                    kept.append(batch.slice(begin, end - begin))
                    if (out := done(kept)) is not None:
                        yield out
                    kept, size, begin = [], 0, end
            kept.append(batch.slice(begin))
            size += int(sizes[-1] - (sizes[begin - 1] if begin else 0))
        if kept and (out := done(kept)) is not None:
            yield out

    return run


def _window_rows(large: DataFrame, length: int) -> DataFrame:
    """Every window of the stretches of very frequent anchors, with the hash of its bytes."""
    schema = T.StructType(
        [
            T.StructField("key", large.schema["key"].dataType),
            *(T.StructField(name, T.LongType()) for name in ("start", "n", "high", "low")),
        ]
    )
    names = schema.names

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, row in enumerate(batch.select(["first", "windows", "n", "bytes"]).to_pylist()):
            data, windows = row["bytes"], row["windows"]
            hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[j : j + length]) for j in range(windows)), np.int64).reshape(-1, 2)
            start = pa.array(np.arange(windows) + row["first"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([i] * windows)), start, pa.array([row["n"]] * windows, pa.int64()), pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy())],
                names=names,
            )

    return map_batches(large, run, schema)


def removed_bytes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, gram: int = 128, bucket: int = 4096, block: int = 1 << 20
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (array of begin, end: maximal removed runs), kept (bytes left)."""
    if not 32 <= gram <= length or length < 40:
        raise ValueError("gram must lie between 32 and length, and length be 40 at least")
    keyed = _keyed(docs, doc_id, text)
    rows = cut_lineage(_stretch_rows(keyed, length, gram))
    same = ["anchor", "high", "low"]
    distinct = rows.groupBy(same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first", "windows")).alias("one"))
    distinct = cut_lineage(distinct)
    covered = rows.join(distinct.where("n > 1").select(same), same)
    covered = covered.select("key", F.col("first").alias("begin"), (F.col("first") + F.col("windows") + F.lit(length - 1)).alias("end"))

    shared = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"), F.min("n").alias("least")).where("different > 1 AND least = 1")
    wanted = distinct.join(shared.select("anchor", "different"), "anchor")
    listed = wanted.groupBy("one.key").agg(F.collect_list(F.struct("anchor", "different", "n", "one.first", "one.windows")).alias("items"))
    pieces = _bytes_of(listed.join(keyed, "key"), length)
    found = pieces.where(F.col("different") <= bucket).repartition("anchor").sortWithinPartitions("anchor")
    span = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    found = found.mapInArrow(_sort_blocks(length, block), span)
    found = covered.unionByName(found)
    if not shared.where(F.col("different") > bucket).isEmpty():
        windows = _window_rows(pieces.where(F.col("different") > bucket), length)
        often = windows.groupBy("high", "low").agg(F.count(F.lit(1)).alias("places")).where("places > 1")
        frequent = windows.where("n = 1").join(often, ["high", "low"])
        found = found.unionByName(frequent.select("key", F.col("start").alias("begin"), (F.col("start") + length).alias("end")))

    spans = found.groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    joined = keyed.join(spans, "key", "left").select("key.doc_id", "text", "spans")
    schema = T.StructType(
        [
            joined.schema["doc_id"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    names = schema.names

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_bytes, merged, kept = [], [], []
        for value, given in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            body, runs = value.encode(), []
            for begin, end in sorted((s["begin"], s["end"]) for s in given or ()):
                if runs and begin <= runs[-1][1]:
                    runs[-1][1] = max(end, runs[-1][1])
                else:
                    runs.append([begin, end])
            n_bytes.append(len(body))
            merged.append(runs)
            kept.append(b"".join(body[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), len(body)])))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(merged, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())], names=names
        )

    return map_batches(joined, cut, schema)
