"""The trie against a plain one made of nested prefixes."""

from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(convs):
    """Rows of the nodes over conversations given as {number: [(role, text), ...]}."""
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def under(path):
        yield path
        for child in children.get(path, ()):
            yield from under(child)

    out = []
    for path, held in members.items():
        below = list(under(path))
        ends = ",".join(str(c) for c in sorted(held) if len(convs[c]) == len(path))
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        out.append((min(held), len(path), min(members[path[:-1]]) if path else None, len(held), len(children.get(path, ())),
                    sum(p not in children for p in below), saved, sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(rows):
    """Turns of each conversation, null turns first."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in convs.items()}


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations(rng, n):
    rows = []
    for c in range(n):
        turns = [("user", rng.choice(["hello", "hello", "hello", "é"]))] + [(rng.choice(["user", None]), rng.choice(["a", "b", None, "long é " * 5])) for _ in range(rng.randint(0, 5))]
        if rng.random() < 0.4:
            turns = [("user", "hello"), ("bot", "the very same")]
        rows += [(c, t, role, text) for t, (role, text) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("segment_rows", [1, 3, 40, 100_000])
def test_nodes_against_a_plain_trie(spark, rng, segment_rows):
    rows = conversations(rng, 120)
    rows += [(500, None, "user", "hello"), (500, 0, None, None), (None, 1, "user", "no number"), (501, 1, None, ""), (502, 7, "user", "x" * 5000)]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], f"{SCHEMA}, key string, segment int")
    out = prefix_trie.prefix_nodes(prefix_trie.sequences(df), segment_rows)
    assert got(out) == plain(ordered(rows))


def test_members_of_a_hot_conversation_in_pieces(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t}") for c in range(3000) for t in range(2)] + [(5000, 0, "user", "turn 0"), (5001, 0, "user", "turn 0")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie.prefix_nodes(prefix_trie.sequences(df), 1200)) == plain(ordered(rows))


def test_rebuilt_conversations(spark, rng):
    rows = [r for r in conversations(rng, 83) if r[0] % 5 or r[0] % 3]
    convs = ordered(rows)
    want = {}
    for c, turns in convs.items():
        h = crc32(str(c).encode()) % 9
        want[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    assert any(not turns for turns in want.values())
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(9)).cast("int")
    built = prefix_trie.rebuilt(prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA)), F.col("conv_id") - F.col("conv_id") % 5, taken, 8)
    assert got(prefix_trie.prefix_nodes(built, 20)) == plain(want)


def test_empty_and_turnless(spark):
    assert got(prefix_trie.prefix_nodes(prefix_trie.sequences(spark.createDataFrame([], SCHEMA)))) == []
    none = spark.createDataFrame([(4, []), (2, [])], "conv_id long, turns array<struct<digest string, size long>>")
    assert got(prefix_trie.prefix_nodes(none, 1)) == plain({4: [], 2: []})


def test_range_minima(rng):
    values = np.array([rng.randint(0, 4) for _ in range(50)])
    minima = prefix_trie.RangeMinima(values)
    for i in range(50):
        for d in range(5):
            right = max(r for r in range(i, 50) if all(values[i + 1 : r + 1] >= d))
            left = min(x for x in range(i + 1) if all(values[x + 1 : i + 1] >= d))
            assert (minima.right(np.array([i]), np.array([d]))[0], minima.left(np.array([i]), np.array([d]))[0]) == (right, left)
        assert minima.over(np.array([0]), np.array([i]))[0] == values[: i + 1].min()
