"""Merkle manifest of a dataset, its trees stored in van Emde Boas order.

Every row is a leaf: the SHA-256 of its columns, each with its length before it. The leaves of one run (a language, say) are numbered in
order and cut into aligned subtrees of ``2 ** height`` leaves. A task builds one subtree at a time and keeps its nodes in one byte string, in van
Emde Boas order: the upper half of the levels first, then each lower subtree, both laid out in the same way. Where a node lies follows from its
depth and number alone (`address`), so building a level and fetching siblings read close bytes at every size of memory block. The roots of the
subtrees are the leaves of the next ones, until a run has one root; the roots of the runs, in order, go the same way to the root of all.
Proofs go down again: a path from the root is handed to the subtree below each block root, and only the last step is taken per row.

A run that holds most rows is many blocks: ranks are taken by range-partitioned segments (`series`), and no task sees more than a segment or a
block. The blocks are written to the shared folder; a task that is run again reads the same ones.

Defined results. A null column is ``-``, and differs from an empty one. A null run is a run, the first; null keys come first in their run.
Equal keys are ordered by their digests, so repeated rows are neighbours and each has its proof. A run of one leaf has that leaf as its root, one
run alone is the root. An empty table gives no rows. Extra columns are not read, whatever their names. Of a node without a sibling only the node itself is
hashed. A very long text is hashed inside the JVM and not moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import SLICE, cut_lineage
from barloom.operators.series import SEGMENT_ROWS, arrange, running_sum

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SIZE = 32  # bytes of a digest
#: Steps of a path, from a node to its parent.
ALONE, LEFT, RIGHT = 0, 1, 2


def address(depth: int, number: np.ndarray, levels: int) -> np.ndarray:
    """Place of the nodes ``number`` of a depth in a complete tree of so many levels, in van Emde Boas order."""
    if levels == 1:
        return np.zeros_like(number)
    upper = levels // 2
    if depth < upper:
        return address(depth, number, upper)
    below = depth - upper
    subtree, inside = number >> below, number & ((1 << below) - 1)
    return (1 << upper) - 1 + subtree * ((1 << (levels - upper)) - 1) + address(below, inside, levels - upper)


@lru_cache(maxsize=64)
def places(levels: int) -> list[list[int]]:
    """Byte offset of each node, by depth and number."""
    return [(address(depth, np.arange(1 << depth), levels) * SIZE).tolist() for depth in range(levels)]


def widths(leaves: int, height: int) -> list[int]:
    """Nodes of each depth of a subtree that holds so many leaves."""
    counts = [leaves]
    for _ in range(height):
        counts.append((counts[-1] + 1) // 2)
    return counts[::-1]


def joined(*digests: bytes) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def subtree(leaves: list[bytes], height: int) -> bytes:
    """All nodes above (and with) the leaves, in van Emde Boas order; places of nodes that are not there are zero."""
    place, count = places(height + 1), widths(len(leaves), height)
    nodes = bytearray(SIZE * ((2 << height) - 1))
    for at, leaf in zip(place[height], leaves):
        nodes[at : at + SIZE] = leaf
    for depth in range(height - 1, -1, -1):
        here, below = place[depth], place[depth + 1]
        for i in range(count[depth]):
            children = below[2 * i : min(2 * i + 2, count[depth + 1])]
            nodes[here[i] : here[i] + SIZE] = joined(*(bytes(nodes[at : at + SIZE]) for at in children))
    return bytes(nodes)


def siblings(nodes: bytes, leaf: int, leaves: int, height: int) -> tuple[bytes, bytes]:
    """Steps and sibling digests on the way from a leaf to the root of its subtree."""
    place, count = places(height + 1), widths(leaves, height)
    steps, found = bytearray(), []
    for depth in range(height, 0, -1):
        other = leaf ^ 1
        if other < count[depth]:
            steps.append(LEFT if leaf & 1 else RIGHT)
            found.append(nodes[place[depth][other] : place[depth][other] + SIZE])
        else:
            steps.append(ALONE)
        leaf >>= 1
    return bytes(steps), b"".join(found)


def folded(leaf: bytes, steps: bytes, found: bytes) -> bytes:
    """The root that a leaf and the siblings on its path give."""
    at = 0
    for step in steps:
        if step == ALONE:
            leaf = joined(leaf)
            continue
        other, at = found[at : at + SIZE], at + SIZE
        leaf = joined(other, leaf) if step == LEFT else joined(leaf, other)
    return leaf


def record_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 of the columns as text, each after its length in bytes and a colon; null is ``-``."""
    parts = [c.cast("string") for c in columns.values()]
    coded = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in parts]
    return F.unhex(F.sha2(F.concat(*coded), 256))


@dataclass(frozen=True)
class Tree:
    """Leaves with their number in their run, and the blocks of each level of blocks, lowest first."""

    leaves: DataFrame  # run, pos, n, digest and what else the leaves carry
    blocks: list[DataFrame]  # run, block, n, leaves, height, nodes, root

    def roots(self) -> DataFrame:
        """The root of each run."""
        return _union([b.where("n <= capacity").select("run", F.col("root").alias("digest")) for b in self.blocks])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _numbered(rows: DataFrame, order: list[str], segment_rows: int) -> DataFrame:
    """Adds the number of each row in its run and the length of the run."""
    placed = running_sum(arrange(rows, ["run"], order, segment_rows), {"pos": F.lit(1)}, inclusive=False).rows()
    sizes = rows.groupBy(F.col("run").alias("_run")).agg(F.count(F.lit(1)).alias("n"))
    return placed.join(sizes, F.col("run").eqNullSafe(F.col("_run"))).drop("_run").withColumn("pos", F.col("pos").cast("long"))


def build_tree(rows: DataFrame, order: list[str], height: int = 10, segment_rows: int = SEGMENT_ROWS) -> Tree:
    """Tree over each ``run`` of the rows, which have a ``digest``; leaves in the given order."""
    capacity = 1 << height
    leaves = cut_lineage(_numbered(rows, order, segment_rows))
    nodes, blocks = leaves.select("run", "pos", "n", "digest"), []
    longest = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        blocks.append(cut_lineage(_blocks(nodes, height)))
        if longest <= capacity:
            return Tree(leaves, blocks)
        longest = -(-longest // capacity)
        above = blocks[-1].where(f"n > {capacity}")
        nodes = above.select("run", F.col("block").alias("pos"), F.ceil(F.col("n") / capacity).cast("long").alias("n"), F.col("root").alias("digest"))


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    run = nodes.schema["run"].dataType
    rows = nodes.select("run", F.shiftright("pos", height).alias("block"), "pos", "n", "digest")
    rows = rows.repartition("run", "block").sortWithinPartitions("run", "block", "pos")
    schema = T.StructType(
        [T.StructField("run", run), *(T.StructField(n, T.LongType()) for n in ("block", "n", "leaves", "height", "capacity")),
         T.StructField("nodes", T.BinaryType()), T.StructField("root", T.BinaryType())]
    )
    run_type = rows_type(run)

    def finished(key: tuple, leaves: list[bytes]) -> pa.RecordBatch:
        name, block, n = key
        tall = min(height, (n - 1).bit_length())
        tree = subtree(leaves, tall)
        columns = [pa.array([name], run_type), *(pa.array([v], pa.int64()) for v in (block, n, len(leaves), tall, 1 << height))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([tree], pa.binary()), pa.array([tree[:SIZE]], pa.binary())], names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaves = None, []
        for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            runs, numbers, _, sizes, digests = (c.to_pylist() for c in batch.columns)
            for this, digest in zip(zip(runs, numbers, sizes), digests):
                if this != key:
                    if leaves:
                        yield finished(key, leaves)
                    key, leaves = this, []
                leaves.append(digest)
        if leaves:
            yield finished(key, leaves)

    return rows.mapInArrow(work, schema)


def rows_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


PATH = "steps binary, found binary"


def _paths_below(blocks: DataFrame) -> DataFrame:
    """run, pos and path of every leaf of the blocks, which carry the path of their root."""
    kind = blocks.schema["run"].dataType
    schema = T.StructType([T.StructField("run", kind), T.StructField("pos", T.LongType()), T.StructField("steps", T.BinaryType()), T.StructField("found", T.BinaryType())])
    run_type = rows_type(kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, block, leaves, height, capacity, nodes, steps, found in zip(*(c.to_pylist() for c in batch.columns)):
                paths = [siblings(nodes, i, leaves, height) for i in range(leaves)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([run] * leaves, run_type), pa.array([block * capacity + i for i in range(leaves)], pa.int64()),
                     pa.array([s + steps for s, _ in paths], pa.binary()), pa.array([f + found for _, f in paths], pa.binary())],
                    names=schema.names,
                )

    return blocks.select("run", "block", "leaves", "height", "capacity", "nodes", "steps", "found").mapInArrow(work, schema)


def _with_paths(tree: Tree, above: DataFrame) -> DataFrame:
    """The lowest blocks with the path of each block root, given the path of each run's root (run, steps, found)."""
    top = above.withColumnRenamed("run", "_run")
    below = None
    for blocks in (b.drop("root") for b in reversed(tree.blocks)):
        whole = blocks.where("n <= capacity").join(top, F.col("run").eqNullSafe(F.col("_run"))).drop("_run")
        if below is not None:
            deeper = below.select(F.col("run").alias("_run"), F.col("pos").alias("_block"), "steps", "found")
            parts = blocks.where("n > capacity").join(deeper, F.col("run").eqNullSafe(F.col("_run")) & (F.col("block") == F.col("_block")))
            whole = whole.unionByName(parts.drop("_run", "_block"))
        below = _paths_below(whole)
    return whole


def manifest(
    docs: DataFrame, key: str = "doc_id", run: str = "lang", columns: tuple[str, ...] = COLUMNS,
    changed: dict[str, Column] | None = None, height: int = 10, segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Per row: key, leaf, subroot (of its run), root (of all), proof (siblings, bottom up), steps, folded_root; digests as binary.

    ``changed`` gives columns as they are found later: the folded root is that of the changed row with the siblings of the manifest.
    """
    cells = {c: F.col(c) for c in columns}
    later = record_digest({**cells, **changed}) if changed else F.lit(None).cast("binary")
    rows = docs.select(F.col(run).alias("run"), F.col(key).alias("key"), record_digest(cells).alias("digest"), later.alias("later"))
    tree = build_tree(cut_lineage(rows), ["key", "digest"], height, segment_rows)
    tops = tree.roots().select(F.lit(0).alias("run"), F.col("run").alias("name"), "digest")
    over = build_tree(tops, ["name"], height, segment_rows)
    root = over.roots().select(F.col("digest").alias("root"), F.lit(0).alias("_all"))
    none = F.lit(b"")
    paths = _paths_below(_with_paths(over, over.roots().select("run", none.alias("steps"), none.alias("found"))))
    named = over.leaves.select("name", F.col("pos").alias("_pos"), F.col("digest").alias("subroot"))
    named = named.join(paths, F.col("pos") == F.col("_pos")).select(F.col("name").alias("run"), "subroot", "steps", "found")
    named = cut_lineage(named.withColumn("_all", F.lit(0)).join(root, "_all").drop("_all"))
    held = _with_paths(tree, named.select("run", "steps", "found"))
    roots = named.select(F.col("run").alias("_run"), "subroot", "root")
    return _proofs(tree, held.join(roots, F.col("run").eqNullSafe(F.col("_run"))).drop("_run"), key, height)


def _proofs(tree: Tree, blocks: DataFrame, key: str, height: int) -> DataFrame:
    """Blocks and their leaves meet in one task; a block comes before its leaves."""
    nothing = F.lit(None)
    held = blocks.select(
        "run", "block", F.lit(-1).cast("long").alias("pos"), nothing.cast(tree.leaves.schema["key"].dataType).alias("key"), nothing.cast("binary").alias("digest"),
        nothing.cast("binary").alias("later"), "leaves", "height", "nodes", "steps", "found", "subroot", "root",
    )
    rows = tree.leaves.select("run", F.shiftright("pos", height).alias("block"), "pos", "key", "digest", "later")
    both = held.unionByName(rows, allowMissingColumns=True).repartition("run", "block").sortWithinPartitions("run", "block", "pos")
    binary = ("leaf", "subroot", "root", "proof", "steps", "folded_root")
    schema = T.StructType([T.StructField(key, tree.leaves.schema["key"].dataType), *(T.StructField(n, T.BinaryType()) for n in binary)])
    key_type = rows_type(schema[0].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            keys, out = [], []
            for pos, name, leaf, later, leaves, tall, nodes, steps, found, subroot, root in zip(*(c.to_pylist() for c in batch.columns[2:])):
                if pos < 0:
                    block = leaves, tall, nodes, steps, found, subroot, root
                    continue
                leaves, tall, nodes, steps, found, subroot, root = block
                own_steps, own = siblings(nodes, pos & ((1 << height) - 1), leaves, tall)
                way, proof = own_steps + steps, own + found
                keys.append(name)
                out.append((leaf, subroot, root, proof, way, folded(leaf if later is None else later, way, proof)))
            columns = list(zip(*out)) or [()] * len(binary)
            yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), *(pa.array(c, pa.binary()) for c in columns)], names=schema.names)

    return both.mapInArrow(work, schema)
