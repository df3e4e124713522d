"""Trie of conversation prefixes, from sorted sequences and range minima over their common prefixes.

A conversation is a sequence of turn digests (128 bits of role and text). All sequences are range-partitioned in order, conversation number as the
last tie-break, into segments; in one, the common prefix of each two neighbours is an array, and a sparse table answers range minima over it.
Every prefix of every sequence that can begin a node, or receive a child, searches its extent to the left and to the right on its own, by
halving steps over the table: no stack, no order among the candidates, whole arrays at a time. An extent is a node's members, and everything the
node is asked for is a sum or a minimum over it: what a conversation saves is the part of it its predecessor in order has too, so the
savings of a whole subtree are one difference of running sums.

Segments know the sequence before and after them. Only nodes on the path of such a border can lie in several segments; their parts are added up by
key, everything else is finished where it is. So a first turn that most conversations share, or a conversation with very many copies, is
spread over segments. The digest of a list of very many members is fed in order from pieces of bounded size.

Defined results. A null role or text counts as empty, null turns come first, equal turns are ordered by the digest of role and text. Rows without a
conversation number belong to no conversation. Repeated rows are repeated turns. A conversation without turns is a member of the root only. An empty table
has no nodes. Very long texts are hashed in the JVM and not moved; the digests of one conversation (24 bytes a turn) must fit in a task. Extra
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import SLICE, cut_lineage

WIDTH = 16  # bytes of a turn's digest
#: Candidate prefixes searched at once, and member numbers in a piece of a list.
SEARCHED, PIECE = 1 << 18, 1000

COLUMNS = (
    "node binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
    "parent binary, parent_conv_id long, piece long, members string"
)
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
_KINDS = [{"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in COLUMNS.split(", ")]


def sequences(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and its turns in order, each with ``digest`` (hex) and ``size`` (bytes of its text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t")
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def rebuilt(convs: DataFrame, base: Column, taken: Column, most: int) -> DataFrame:
    """Every conversation with its first ``taken`` (at most ``most``) turns replaced by those of the conversation ``base``."""
    convs = cut_lineage(convs.withColumn("_base", base).withColumn("_taken", taken))
    heads = convs.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    own = F.slice("turns", F.col("_taken") + 1, F.greatest(F.size("turns") - F.col("_taken"), F.lit(0)))
    head = F.slice(F.coalesce("_head", F.slice("turns", 1, 0)), F.lit(1), F.col("_taken"))
    return convs.join(heads, "_base", "left").select("conv_id", F.concat(head, own).alias("turns"))


class RangeMinima:
    """Minima over ranges of an array, from minima over all ranges of a power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def over(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of places first to last, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << k) + 1])
        return out

    def right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Furthest place whose values after ``start`` are all at least ``least``."""
        end, last = start.copy(), len(self.levels[0]) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            fits = end + step <= last
            go = fits & (table[np.where(fits, end + 1, 0)] >= least)
            end[go] += step
        return end

    def left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Furthest place before ``start`` such that all values after it up to ``start`` are at least ``least``."""
        end = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            fits = end - step >= 0
            go = fits & (table[np.where(fits, end - step + 1, 0)] >= least)
            end[go] -= step
        return end


def common_prefixes(keys: list[bytes]) -> np.ndarray:
    """Turns that each sequence but the first shares with the one before it."""
    lengths = np.array([len(k) // WIDTH for k in keys])
    starts = np.cumsum(lengths) - lengths
    words = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, WIDTH // 8)
    shared = np.minimum(lengths[1:], lengths[:-1])
    out = np.zeros(len(shared), np.int64)
    some = np.flatnonzero(shared)
    if not len(some):
        return out
    n = shared[some]
    first = np.cumsum(n) - n
    depth = np.arange(n.sum()) - np.repeat(first, n)
    here, before = (np.repeat(starts[some + k], n) + depth for k in (1, 0))
    equal = (words[here] == words[before]).all(axis=1)
    out[some] = np.minimum.reduceat(np.where(equal, np.repeat(n, n), depth), first)
    return out


def segment_nodes(keys: list[bytes], ids: np.ndarray, sizes: list[list[int]], before: bytes | None, after: bytes | None, number: int) -> Iterator[pa.RecordBatch]:
    """Nodes, or parts of nodes, that the sorted sequences of one segment make."""
    n = len(keys)
    lengths = np.array([len(k) // WIDTH for k in keys], np.int64)
    lcp = np.full(n + 1, -1, np.int64)
    around = [*([before] if before is not None else []), *keys, *([after] if after is not None else [])]
    lcp[int(before is None) : int(before is None) + len(around) - 1] = common_prefixes(around)
    minima, smallest = RangeMinima(np.concatenate(([0], lcp[1:n]))), RangeMinima(ids)

    flat = np.concatenate(([0], np.cumsum([size for row in sizes for size in row], dtype=np.int64))) if lengths.any() else np.zeros(1, np.int64)
    row_at = np.cumsum(lengths) - lengths
    upto = lambda row, turns: flat[row_at[row] + turns] - flat[row_at[row]]  # bytes of the first turns of a row
    rows = np.arange(n)
    kept = np.concatenate(([0], np.cumsum(upto(rows, np.maximum(lcp[:n], 0)))))
    leaves = np.concatenate(([0], np.cumsum(lcp[1:] < lengths)))

    new_from = np.where(rows > 0, lcp[:n] + 1, 0)  # depth of the first node that begins at a row
    nodes_before = np.concatenate(([0], np.cumsum(lengths - new_from + 1)))
    total = int(nodes_before[-1])
    left, depth, right, children = (np.zeros(total, np.int64) for _ in range(4))
    above = np.full(total, -1, np.int64)
    place = lambda row, deep: nodes_before[row] + deep - new_from[row]

    lowest = np.where(rows > 0, np.maximum(lcp[:n], 0), 0)
    candidates_before = np.concatenate(([0], np.cumsum(lengths - lowest + 1)))
    for at in range(0, int(candidates_before[-1]), SEARCHED):
        which = np.arange(at, min(at + SEARCHED, int(candidates_before[-1])))
        row = np.searchsorted(candidates_before, which, side="right") - 1
        deep = which - candidates_before[row] + lowest[row]
        begin, end = minima.left(row, deep), minima.right(row, deep)
        node = place(begin, deep)
        own = begin == row
        left[node[own]], depth[node[own]], right[node[own]] = row[own], deep[own], end[own]
        grows = (lcp[row] <= deep) & (deep < lengths[row])
        np.add.at(children, node[grows], 1)
        # A node's parent is one turn up in its own row, or where the row left the one before it.
        up = own & (deep > new_from[row])
        above[node[up]] = node[up] - 1
        forks = ~own & (deep < lengths[row])
        above[place(row[forks], deep[forks] + 1)] = node[forks]

    members = right - left + 1
    least = smallest.over(left, right)
    goes_on_left, goes_on_right = (left == 0) & (lcp[0] >= depth), (right == n - 1) & (lcp[n] >= depth)
    spans = goes_on_left | goes_on_right
    first_saves = goes_on_left
    own_bytes = upto(left, np.maximum(depth - 1, 0))
    saved = kept[right + 1] - kept[left] - (members - 1 + first_saves) * own_bytes
    saved -= np.where(first_saves, 0, kept[left + 1] - kept[left])

    equal = (lcp[:n] == lengths) & np.concatenate(([before is not None and len(before) // WIDTH == lengths[0]], lengths[1:] == lengths[:-1]))
    starts = np.flatnonzero(~equal | (rows == 0))
    stops = np.append(starts[1:], n)
    ends: dict[int, str] = {}
    lists: list[tuple[int, int, str]] = []
    for a, b in zip(starts.tolist(), stops.tolist()):
        node = int(place(a, lengths[a]))
        crosses = (a == 0 and equal[0]) or (b == n and after is not None and lcp[n] == lengths[n - 1] and len(after) // WIDTH == lengths[n - 1])
        if crosses:
            lists += [(node, a + i, ",".join(map(str, ids[a + i : min(b, a + i + PIECE)].tolist()))) for i in range(0, b - a, PIECE)]
        else:
            ends[node] = sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest()

    name = lambda node: md5(keys[left[node]][: WIDTH * int(depth[node])]).digest()
    named = {node: name(node) for node in np.flatnonzero(spans).tolist()}
    for low in range(0, total, 10_000):
        part = slice(low, min(total, low + 10_000))
        span = range(part.start, part.stop)
        up = above[part].tolist()
        columns = [
            [named.get(i) for i in span], depth[part], least[part], members[part], children[part], leaves[right[part] + 1] - leaves[left[part]], saved[part],
            [ends.get(i) for i in span], [named.get(i) for i in up], [None if i < 0 or i in named else int(least[i]) for i in up], [None] * len(span), [None] * len(span),
        ]
        yield _batch(columns)
    if lists:
        empty = [None] * len(lists)
        yield _batch([[named[node] for node, _, _ in lists], *[empty] * 9, [(number << 32) + i for _, i, _ in lists], [text for _, _, text in lists]])


def _batch(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _KINDS)], names=NAMES)


def prefix_nodes(convs: DataFrame, segment_rows: int = 100_000) -> DataFrame:
    """One row per node of the trie over all conversations (conv_id, turns of `sequences`)."""
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = cut_lineage(convs.select("conv_id", joined.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes")))
    segments = max(1, ceil(rows.count() / segment_rows))
    ranged = cut_lineage(rows.repartitionByRange(segments, "key", "conv_id").withColumn("segment", F.spark_partition_id().cast("long")))

    edges = ranged.groupBy("segment").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    order = Window.orderBy("segment")  # a row per segment
    edges = edges.select("segment", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    beside = edges.select("segment", F.explode(F.array(F.struct(F.lit(-1).alias("side"), F.col("before").alias("key")), F.struct(F.lit(1).alias("side"), F.col("after").alias("key")))).alias("e"))
    both = ranged.withColumn("side", F.lit(0)).unionByName(beside.select("segment", "e.*").where("key IS NOT NULL"), allowMissingColumns=True)
    both = both.select("segment", "side", "key", "conv_id", "sizes").repartition("segment").sortWithinPartitions("segment", "side", "key", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, ids, sizes, beside = None, [], [], [], {}

        def finished() -> Iterator[pa.RecordBatch]:
            if keys:
                yield from segment_nodes(keys, np.array(ids, np.int64), sizes, beside.get(-1), beside.get(1), current)

        for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            for segment, side, key, conv, size in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != current:
                    yield from finished()
                    current, keys, ids, sizes, beside = segment, [], [], [], {}
                if side:
                    beside[side] = key
                else:
                    keys.append(key)
                    ids.append(conv)
                    sizes.append(size)
        yield from finished()

    return _together(cut_lineage(both.mapInArrow(run, COLUMNS)))


def _together(parts: DataFrame) -> DataFrame:
    """Whole nodes: parts of a node that several segments hold are added up, and children learn their parent's name."""
    nodes = parts.where("piece IS NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = nodes.where("node IS NOT NULL").groupBy("node", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends").alias("ends"), F.max("parent").alias("parent"))
    merged = cut_lineage(merged.join(_long_lists(parts.where("piece IS NOT NULL")), "node", "left"))
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("_name"))
    whole = merged.withColumn("ends", F.coalesce("list", "ends")).withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "parent"]
    every = whole.select(columns).unionByName(nodes.where("node IS NULL").select(columns))
    known, asked = every.where("parent IS NULL"), every.where("parent IS NOT NULL")
    asked = asked.join(names, "parent").withColumn("parent_conv_id", F.col("_name")).select(columns)
    out = known.unionByName(asked)
    return out.select(*columns[:-2], F.coalesce("ends", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))


def _long_lists(pieces: DataFrame) -> DataFrame:
    """Digest of each list of members that several segments hold, from its pieces in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["node", "list"])
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if node != current:
                    if state:
                        yield done()
                    current, state = node, sha256()
                    state.update(text.encode())
                else:
                    state.update(b"," + text.encode())
        if state:
            yield done()

    ordered = pieces.select("node", "piece", "members").repartition("node").sortWithinPartitions("node", "piece")
    return ordered.mapInArrow(run, "node binary, list string")
