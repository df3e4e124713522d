"""The manifest against a plain tree, and the address arithmetic against a recursive layout."""

from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
H = lambda *parts: sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    coded = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return H("".join(coded))


def climb(nodes):
    """Per node its siblings with sides up to the root, and the root."""
    ways, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for i, group in enumerate(groups):
            other = i ^ 1
            for member in group:
                ways[member].append((i & 1, nodes[other] if other < len(nodes) else None))
        nodes = [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        groups = [sum(groups[i : i + 2], []) for i in range(0, len(groups), 2)]
    return ways, nodes[0] if nodes else None


def plain(rows, change):
    runs = {}
    for row in rows:
        runs.setdefault(row[2], []).append(row)
    names = sorted(runs, key=lambda lang: (lang is not None, (lang or "").encode()))
    for name in names:
        runs[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    parts = {name: climb([leaf(r) for r in runs[name]]) for name in names}
    tops, root = climb([parts[name][1] for name in names])
    out = []
    for name, top in zip(names, tops):
        for row, way in zip(runs[name], parts[name][0]):
            way, node = way + top, leaf(change(row))
            for right, other in way:
                node = H(node) if other is None else H(other, node) if right else H(node, other)
            out.append((str(row[0]), leaf(row), parts[name][1], root, H(*(o for _, o in way if o)), node))
    return sorted(out)


def layout(levels, root=1):
    """Heap numbers (root 1) in van Emde Boas order, by recursion on node lists."""
    if levels == 1:
        return [root]
    upper = levels // 2
    bottoms = [(root << upper) + i for i in range(1 << upper)]
    return layout(upper, root) + [x for b in bottoms for x in layout(levels - upper, b)]


@pytest.mark.parametrize("levels", range(1, 9))
def test_addresses(levels):
    at = {node: i for i, node in enumerate(layout(levels))}
    for depth in range(levels):
        assert merkle.address(depth, np.arange(1 << depth), levels).tolist() == [at[(1 << depth) + i] for i in range(1 << depth)]


@pytest.mark.parametrize("height, segment_rows", [(2, 7), (10, 1_000_000)])
def test_manifest_against_a_plain_tree(spark, rng, height, segment_rows):
    langs = ["de"] + ["en"] * 5 + [None, "é", ""]
    rows = [(i, rng.choice(["a", None, "ü"]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", "x", "text é " * 9])) for i in range(130)]
    rows += [(None, None, None, None, None), rows[5], rows[5], (rows[5][0], "other", "en", 1, "x"), (None, "s", "en", 2, "y"), (500, "s", "only", 3, "z")]
    change = lambda r: (*r[:3], r[3] + 1 if r[3] is not None and r[0] is not None and r[0] % 3 == 0 else r[3], r[4])
    df = spark.createDataFrame([(*r, 1, "x", b"n") for r in rows], f"{SCHEMA}, pos int, run string, nodes binary")
    bump = F.col("n_chars") + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)
    got = merkle.manifest(df, changed={"n_chars": bump}, height=height, segment_rows=segment_rows).collect()
    text = sorted((str(r.doc_id), *(bytes(v).hex() for v in (r.leaf, r.subroot, r.root)), H(bytes(r.proof).hex()), bytes(r.folded_root).hex()) for r in got)
    assert text == plain(rows, change)
    assert all((r.folded_root == r.root) == (change(row) == row) for r, row in zip(got, got) for row in [next(x for x in rows if leaf(x) == bytes(r.leaf).hex())])


@pytest.mark.parametrize("n", [0, 1, 3, 9])
def test_small_tables(spark, n):
    rows = [(i, "s", "en", i, "t") for i in range(n)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), height=2).collect()
    assert sorted((str(r.doc_id), bytes(r.leaf).hex(), bytes(r.subroot).hex(), bytes(r.root).hex(), H(bytes(r.proof).hex()), bytes(r.folded_root).hex()) for r in got) == (
        plain(rows, lambda r: r)
    )
    assert all(r.folded_root == r.root for r in got)
