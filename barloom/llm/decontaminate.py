"""Benchmark passages in documents, found by counting shared q-grams and verified by alignment.

Every stretch of ``window`` characters of a benchmark item is a window (they begin every ``step`` characters). A stretch of a document within
``k`` edits of a window of ``m`` characters shares at least m + 1 - q (k + 1) character q-grams with it, all within a band of diagonals k wide on
either side. Documents are read once. A bitmap of the benchmark's q-grams, of one fixed size, tells which places can share one; regions where such
places are as dense as the bound asks go on with their q-grams, which are joined with those of the items by hash and counted per region and item. Pairs
that reach the bound are verified in tasks: hits are sorted per band of diagonals (bands overlap, every stretch lies in
one of them whole), windows with fewer hits than the bound are dropped, and the rest is verified by an alignment restricted to the band. The counts never lose a stretch within the budget;
the alignment never keeps one beyond it.

The benchmark is a table like any other: equal texts are one, long ones are cut into overlapping parts, and nothing of them goes through the driver
but the bitmap (2 MB). With a very large benchmark the bitmap fills up and thins less; results stay the same.

Defined results. Both sides are compared in lower case, with ASCII punctuation and white space as single spaces. Items of fewer than
``least_chars`` characters (then) and null items are no evidence and are left out; if an item is too short for its budget, the budget is lowered until the
bound is positive. A null text counts as empty. Offsets refer to the text as it is compared. Repeated rows give
repeated results, a stretch once each; equal items under several identifiers are all reported. An empty benchmark finds nothing; an empty table gives an empty
table. Extra columns do not matter and are carried along by `clean`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import SLICE, cut_lineage, map_batches, strings
from barloom.llm.suffix_dedup import gram_hashes

GAP = np.uint32(0x7FFFFFFF)  # no character


@dataclass(frozen=True)
class Budget:
    """Windows of ``window`` characters every ``step``, up to ``rate`` edits a character, q-grams of ``q``, bands of ``band`` diagonals. A passage of ``least_chars`` holds a whole window."""

    window: int = 40
    step: int = 1
    rate: float = 0.07
    q: int = 10
    band: int = 16
    least_chars: int = 40

    def edits(self, m: int) -> int:
        return max(0, min(int(self.rate * m), m // self.q - 1, -(-(m + 1) // self.q) - 2))

    def bound(self, m: int) -> int:
        return m + 1 - self.q * (self.edits(m) + 1)

    @property
    def sizes(self) -> range:
        """Lengths that windows can have."""
        return range(min(self.window, max(self.least_chars, self.q)), self.window + 1)

    @property
    def reach(self) -> int:
        """Characters within which all hits of a stretch lie."""
        return self.window + 2 * max(self.edits(m) for m in self.sizes) + self.band


_TABLE = bytearray(range(256))
for _i in range(128):
    if not chr(_i).isalnum():
        _TABLE[_i] = 32
_TABLE = bytes(_TABLE)


def normalise(text: str) -> str:
    return b" ".join(text.lower().encode().translate(_TABLE).split()).decode()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Index:
    """q-grams of a block of items, by their places in the items' joined text."""

    def __init__(self, items: Iterable[tuple[object, str]], budget: Budget) -> None:
        self.budget = budget
        self.items: list[object] = []
        values, hashes, places, total = [], [], [], 0
        for item, text in items:
            value = codes(normalise(text))
            if len(value) < max(budget.least_chars, budget.q):
                continue
            grams = gram_hashes(value, budget.q)
            hashes.append(grams)
            places.append(total + np.arange(len(grams)))
            values.append(value)
            total += len(value)
            self.items.append(item)
        self.text = np.concatenate(values) if values else np.zeros(0, np.uint32)
        self.lengths = np.array([len(v) for v in values], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.sizes = np.minimum(self.lengths, budget.window)
        self.edits = np.array([budget.edits(m) for m in self.sizes.tolist()], np.int64)
        self.bounds = np.array([budget.bound(m) for m in self.sizes.tolist()], np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.place = np.concatenate(places)[order] if places else np.zeros(0, np.int64)
        self.grams, self.begin, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.shift = np.uint64(64 - max(10, int(len(self.grams) * 16).bit_length()))
        self.seen = np.zeros(1 << int(64 - int(self.shift)), bool)
        self.seen[self.grams >> self.shift] = True

    def search(self, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Item, end in ``text`` and edits of every verified stretch (the best end of each window and band)."""
        if not len(self.grams) or len(text) < self.budget.q:
            return
        hashes = gram_hashes(text, self.budget.q)
        at = np.flatnonzero(self.seen[hashes >> self.shift])
        gram = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        exact = self.grams[gram] == hashes[at]
        at, gram = at[exact], gram[exact]
        reach = int(self.sizes.max()) + 2 * int(self.edits.max()) + self.budget.band
        crowd = np.searchsorted(at, at + reach, side="right") - np.searchsorted(at, at - reach)
        dense = crowd >= self.bounds.min()  # a stretch needs that many hits around each of its own
        at, gram = at[dense], gram[dense]
        bands = (len(text) + int(self.lengths.max()) + 2 * reach) // self.budget.band + 3
        total = len(self.text)
        # One number orders hits by item, band and place: it stays below 2^63 for items and texts of this size.
        sums = np.cumsum(self.count[gram])
        cuts = np.searchsorted(sums, np.arange(1 << 22, int(sums[-1]), 1 << 22)) if len(sums) else []
        for low, high in self._apart(at, [0, *cuts, len(at)], reach):
            yield from self._windows(text, at[low:high], gram[low:high], bands, total)

    @staticmethod
    def _apart(at: np.ndarray, cuts: list[int], reach: int) -> Iterator[tuple[int, int]]:
        """Ranges of hits between the cuts, each with what lies within reach behind it."""
        for low, high in zip(cuts, cuts[1:]):
            if low < high:
                yield int(low), int(np.searchsorted(at, at[high - 1] + 2 * reach, side="right"))

    def _windows(self, text: np.ndarray, at: np.ndarray, gram: np.ndarray, bands: int, total: int) -> Iterator[tuple[int, int, int]]:
        """Windows with as many hits as their bound, aligned."""
        wide = self.budget.band
        times = self.count[gram]
        place = self.place[np.repeat(self.begin[gram], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        item = np.searchsorted(self.starts, place, side="right") - 1
        shift = int(self.lengths.max()) + wide
        diagonal = np.repeat(at, times) - (place - self.starts[item]) + shift
        band = diagonal // wide
        also = diagonal % wide < 2 * self.edits[item]
        key = np.concatenate([(item * bands + band) * total + place, ((item * bands + band - 1) * total + place)[also]])
        key.sort()
        group, place = np.divmod(key, total)
        item = group // bands
        last = np.arange(len(key)) + self.bounds[item] - 1
        first = np.flatnonzero(last < len(key))
        last = last[first]
        span = self.sizes[item[first]] - self.budget.q
        enough = (group[first] == group[last]) & (place[last] - place[first] <= span)
        first, last, span = first[enough], last[enough], span[enough]
        if not len(first):
            return
        item, begin = item[first], self.starts[item[first]]
        end = begin + self.lengths[item] - self.sizes[item]  # where the last window begins
        low, high = np.maximum(place[last] - span, begin), np.minimum(place[first], end)
        for part in range(0, len(first), 65_536):
            some = slice(part, part + 65_536)
            many = high[some] - low[some] + 1
            start = np.repeat(low[some], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            key = np.unique(np.repeat(group[first[some]], many) * total + start)
            of, start = np.divmod(key, total)
            number, band = np.divmod(of, bands)
            local = start - self.starts[number]
            wanted = (local % self.budget.step == 0) | (local == self.lengths[number] - self.sizes[number])
            number, band, start, local = number[wanted], band[wanted], start[wanted], local[wanted]
            for m in np.unique(self.sizes[number]).tolist():
                chosen = np.flatnonzero(self.sizes[number] == m)
                for at_ in range(0, len(chosen), 4096):
                    c = chosen[at_ : at_ + 4096]
                    yield from self._align(text, number[c], start[c], band[c] * wide - shift + local[c], m)

    def _align(self, text: np.ndarray, item: np.ndarray, start: np.ndarray, first: np.ndarray, m: int) -> Iterator[tuple[int, int, int]]:
        """Fewest edits between each window and a stretch of the text on the band's diagonals."""
        k = int(self.edits[item[0]])
        low, width = first - k, self.budget.band + 4 * k + 1
        pattern = self.text[start[:, None] + np.arange(m)[None]]
        there = low[:, None] + np.arange(width + m)[None]
        inside = (there >= 0) & (there < len(text))
        around = np.where(inside, text[np.clip(there, 0, len(text) - 1)], GAP)
        slope = np.arange(width)
        cost = np.zeros((len(item), width), np.int64)
        for r in range(m):
            step = cost + (around[:, r : r + width] != pattern[:, r : r + 1])
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(step - slope, axis=1) + slope
        best = cost.argmin(axis=1)
        edits = cost[np.arange(len(item)), best]
        for i in np.flatnonzero(edits <= k).tolist():
            yield int(item[i]), int(low[i] + m + best[i]), int(edits[i])


def find_in_texts(texts: list[str], index: Index, most: int = 1 << 18) -> Iterator[tuple[int, int, int, int, int]]:
    """Text, item, begin, end and edits of every stretch found; texts are read ``most`` characters at a time."""
    gap = np.full(2 * int(index.edits.max(initial=0)) + 2, GAP, np.uint32)
    overlap = 2 * (int(index.sizes.max(initial=0)) + 4 * len(gap) + index.budget.band)
    parts: list[np.ndarray] = []
    places: list[tuple[int, int, int]] = []  # where a piece begins, its text, its offset in the text
    size = 0

    def flush() -> Iterator[tuple[int, int, int, int, int]]:
        begins = np.array([p[0] for p in places])
        for item, end, edits in index.search(np.concatenate(parts)):
            begin, number, offset = places[int(np.searchsorted(begins, max(0, end - 1), side="right")) - 1]
            stop = end - begin + offset
            yield number, item, max(0, stop - int(index.sizes[item])), stop, edits

    for number, text in enumerate(texts):
        value = codes(normalise(text))
        for start in range(0, max(1, len(value) - overlap), most):
            piece = value[start : start + most + overlap]
            places.append((size, number, start))
            parts += [piece, gap]
            size += len(piece) + len(gap)
            if size >= most:
                yield from flush()
                parts, places, size = [], [], 0
    if places:
        yield from flush()


#: Bits of a q-gram's hash that the bitmap tells apart, characters of a part of an item and of a region of a document, and of a text read at once.
BITS, PART, REGION, READ = 24, 1 << 16, 1 << 16, 1 << 20


def _item_parts(benchmark: DataFrame, budget: Budget, text: str) -> DataFrame:
    """Different benchmark texts as compared, in parts: part, name (of the text), value, bound."""
    texts = benchmark.where(F.col(text).isNotNull()).select(F.md5(F.col(text).cast("binary")).alias("name"), F.col(text).alias("text"))
    stride = max(budget.step, (PART - budget.window) // budget.step * budget.step)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for name, value in zip(batch.column(0).to_pylist(), map(normalise, strings(batch.column(1)))):
            if len(value) >= max(budget.least_chars, budget.q):
                starts = range(0, max(1, len(value) - budget.window + 1), stride)
                rows += [(name, part, budget.bound(min(len(part), budget.window))) for part in (value[at : at + stride + budget.window] for at in starts)]
        columns = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["name", "value", "bound"])

    one = texts.groupBy("name").agg(F.first("text").alias("text"))
    return cut_lineage(map_batches(one, run, "name string, value string, bound long").withColumn("part", F.monotonically_increasing_id()))


def _item_grams(parts: DataFrame, budget: Budget) -> DataFrame:
    """gram, part and how often the part has it."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, value in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
            grams, times = np.unique(gram_hashes(codes(value), budget.q), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array([part] * len(grams), pa.int64()), pa.array(times)], names=["gram", "part", "times"])

    return cut_lineage(map_batches(parts.select("part", "value"), run, "gram long, part long, times long"))


def _bitmap(grams: DataFrame) -> np.ndarray:
    """Which upper ``BITS`` bits the q-grams have. At most 2 ** (BITS - 6) words come to the driver, whatever the benchmark's size."""
    place = F.shiftrightunsigned("gram", 64 - BITS)
    words = grams.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(gram, {64 - BITS}) & 63 AS INT))")).alias("bits"))
    out = np.zeros(1 << (BITS - 6), np.int64)
    for word, bits in words.collect():
        out[word] = bits
    return out


def dense_regions(value: np.ndarray, seen: np.ndarray, budget: Budget) -> Iterator[tuple[int, int, np.ndarray]]:
    """Begin, end and q-grams of the stretches of a text where hits of the bitmap are dense enough for a window."""
    if len(value) < budget.q:
        return
    hashes = gram_hashes(value, budget.q)
    at = np.flatnonzero(seen[hashes >> np.uint64(64 - BITS)])
    crowd = np.searchsorted(at, at + budget.reach, side="right") - np.searchsorted(at, at - budget.reach)
    at = at[crowd >= min(budget.bound(m) for m in budget.sizes)]
    if not len(at):
        return
    breaks = np.flatnonzero(np.diff(at) > 4 * budget.reach)
    for first, last in zip(at[np.concatenate(([0], breaks + 1))].tolist(), at[np.append(breaks, len(at) - 1)].tolist()):
        begin, end = max(0, first - 2 * budget.reach), min(len(value), last + budget.q + 2 * budget.reach)
        for low in range(begin, max(begin + 1, end - 4 * budget.reach), REGION):
            high = min(end, low + REGION + 4 * budget.reach)
            yield low, high, hashes[at[(at >= low) & (at + budget.q <= high)]]


def _regions(rows: DataFrame, seen: np.ndarray, budget: Budget) -> DataFrame:
    """Regions of documents (key, carried, text) with their q-grams: region, key, carried, offset, value, grams, times."""
    schema = T.StructType(
        [T.StructField("key", rows.schema["key"].dataType), T.StructField("carried", rows.schema["carried"].dataType), T.StructField("offset", T.LongType()),
         T.StructField("value", T.StringType()), T.StructField("grams", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))]
    )
    sent = rows.sparkSession.sparkContext.broadcast(seen.tobytes())
    overlap = 8 * budget.reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(sent.value, np.uint8), bitorder="little").astype(bool)
        for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            places, rest = [], []
            for i, text in enumerate(strings(batch.column(2))):
                value = codes(normalise(text))
                for start in range(0, max(1, len(value) - overlap), READ):
                    for low, high, grams in dense_regions(value[start : start + READ + overlap], bits, budget):
                        grams, times = np.unique(grams, return_counts=True)
                        places.append(i)
                        rest.append((start + low, value[start + low : start + high].tobytes().decode("utf-32-le"), grams.view(np.int64), times))
            if places:
                offsets, values, grams, times = zip(*rest)
                kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                columns = [batch.column(c).take(pa.array(places)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, k) for c, k in zip((offsets, values, grams, times), kinds))], names=schema.names)

    return cut_lineage(rows.mapInArrow(run, schema).withColumn("region", F.monotonically_increasing_id()))


@lru_cache(maxsize=256)
def _index_of(value: str, budget: Budget) -> Index:
    return Index([(0, value)], budget)


def _verified(rows: DataFrame, benchmark: DataFrame, budget: Budget, text: str) -> DataFrame:
    """key, carried, name (of the benchmark text), begin, end and edits of every stretch found in rows (key, carried, text)."""
    parts = _item_parts(benchmark, budget, text)
    grams = _item_grams(parts, budget)
    regions = _regions(rows, _bitmap(grams), budget)
    hits = regions.select("region", F.explode(F.arrays_zip("grams", "times")).alias("g")).select("region", F.col("g.grams").alias("gram"), F.col("g.times").alias("here"))
    counted = hits.join(grams, "gram").groupBy("region", "part").agg(F.sum(F.col("here") * F.col("times")).alias("hits"))
    pairs = counted.join(parts.select("part", "name", "bound", F.col("value").alias("item")), "part").where("hits >= bound")
    met = regions.select("region", "key", "carried", "offset", "value").join(pairs.select("region", "name", "item"), "region").drop("region")
    schema = T.StructType([*regions.select("key", "carried").schema, T.StructField("name", T.StringType()), *(T.StructField(n, T.LongType()) for n in ("begin", "end", "edits"))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, found = [], []
        for i, (offset, value, item) in enumerate(zip(batch.column(2).to_pylist(), strings(batch.column(3)), strings(batch.column(5)))):
            index = _index_of(item, budget)
            for _, end, edits in index.search(codes(value)):
                places.append(i)
                found.append((max(0, offset + end - int(index.sizes[0])), offset + end, edits))
        columns = [batch.column(c).take(pa.array(places, pa.int64())) for c in (0, 1, 4)]
        numbers = [pa.array(c, pa.int64()) for c in (list(zip(*found)) or [()] * 3)]
        return pa.RecordBatch.from_arrays([*columns, *numbers], names=schema.names)

    return map_batches(met, run, schema).dropDuplicates(["key", "name", "begin", "end", "edits"])


def find_passages(
    docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """doc_id, item_id, begin, end and edits of every stretch of a document within the budget of a benchmark window."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(doc_id).alias("carried"), F.col(text).alias("text"))
    found = cut_lineage(_verified(rows, benchmark, budget, text))
    named = benchmark.where(F.col(text).isNotNull()).select(F.md5(F.col(text).cast("binary")).alias("name"), F.col(item_id).alias("item_id")).distinct()
    return found.join(named, "name").select(F.col("carried").alias("doc_id"), "item_id", "begin", "end", "edits")


def clean(docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), text: str = "text") -> DataFrame:
    """The documents without those that hold a benchmark passage; rows are judged by their texts alone."""
    rows = docs.select(F.md5(docs[text].cast("binary")).alias("key"), F.lit(0).alias("carried"), docs[text].alias("text"))
    held = cut_lineage(_verified(rows, benchmark, budget, "text").select(F.col("key").alias("held")).distinct())
    return docs.join(held, F.md5(docs[text].cast("binary")) == held["held"], "left_anti")
