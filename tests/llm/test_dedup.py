"""Exact, line and near-duplicate removal against plain versions."""

import numpy as np
import pytest
import xxhash

from barloom.llm import line_dedup, simhash
from barloom.llm.components import connected_components
from barloom.llm.exact_dedup import exact_groups

SCHEMA = "doc_id long, text string"
WHITE = " \t\n\x0b\x0c\r"
lower = lambda text: "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_exact_groups(spark, rng, tmp_path):
    rows = [(i, rng.choice(["Same", "sAME", "other É", "other é", None, "", f"own {i}"])) for i in range(200)]
    rows += [(None, "same"), (7, rows[7][1]), (None, "only null"), (None, "only null")]
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame([(*r, 1, "x") for r in rows], f"{SCHEMA}, digest int, n string").repartition(3).write.parquet(path)
    got = exact_groups(spark, path, files_per_trigger=1).collect()
    groups = {}
    for i, text in rows:
        groups.setdefault(lower(text or ""), []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted((str(i), str(keep[lower(t or "")]), len(groups[lower(t or "")])) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_groups_goes_on_with_its_state(spark, tmp_path):
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA).coalesce(1).write.parquet(path)
    exact_groups(spark, path, state=state).count()
    spark.createDataFrame([(3, "A")], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_groups(spark, path, state=state).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True)}


def test_exact_groups_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none"))
    assert exact_groups(spark, str(tmp_path / "none")).collect() == []


def test_digest_collisions_are_told_apart_by_the_text(spark):
    from barloom.llm.exact_dedup import _by_text
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], SCHEMA).select(
        F.struct("doc_id", F.lit("f").alias("file"), F.col("doc_id").alias("row")).alias("at"), F.lit(0).alias("digest"), F.col("text").alias("norm")
    )
    assert sorted((r["at"]["doc_id"], r["keep"]["doc_id"], r["n"]) for r in _by_text(rows).collect()) == [(1, 3, 2), (2, 2, 1), (3, 3, 2)]


def plain_lines(rows, min_chars, min_docs):
    docs = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(WHITE))
            if len(key) >= min_chars:
                docs.setdefault(key, set()).add(i)
    greatest = lambda ids: max(ids, key=lambda i: -1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        drop = [len(docs.get(k := lower(x.strip(WHITE)), ())) >= min_docs and greatest(docs[k]) != i for x in lines]
        out.append((str(i), len(lines), sum(drop), "\n".join(x for x, d in zip(lines, drop) if not d)))
    return sorted(out)


@pytest.mark.parametrize("partitions", [1, 13])
def test_line_dedup(spark, rng, partitions):
    pool = [f"{'line é'[: rng.randint(3, 6)]} {i} {'x' * 8}" for i in range(12)]
    make = lambda: "\n".join(rng.choice([lambda: rng.choice(pool), lambda: f"\t{rng.choice(pool).upper()} ", lambda: "short", lambda: pool[0]])() for _ in range(rng.randint(0, 9)))
    rows = [(i, make()) for i in range(150)] + [(None, pool[0]), (None, None), (3, pool[1]), (3, pool[1]), (400, "\n\n")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], f"{SCHEMA}, high int, keep string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df, min_chars=10, min_docs=5), counts=True).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text or "") for r in found) == plain_lines(rows, 10, 5)


def test_line_dedup_of_an_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df)).collect() == []
    with pytest.raises(ValueError):
        line_dedup.apply_bitmaps(spark.createDataFrame([(1, "a", 1)], f"{SCHEMA}, _line_n int"), df)


def plain_components(rows):
    def bits(text):
        words = lower(text or "").encode().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [bits(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            near = [label[j] for j, b in enumerate(prints) if (a ^ b).bit_count() <= 3]
            label[i] = min(near)
    least = {k: min((rows[i][0] for i in range(len(rows)) if label[i] == k and rows[i][0] is not None), default=None) for k in set(label)}
    return sorted((str(r[0]), p, str(least[k])) for r, p, k in zip(rows, prints, label))


@pytest.mark.parametrize("chunk", [2048, 3])
def test_near_duplicates(spark, rng, chunk):
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(4)]
    rows = []
    for i in range(120):
        text = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            text[rng.randrange(len(text))] = rng.choice(words).upper()
        rows.append((i, "\t".join(text)))
    rows += [(None, rows[0][1]), (500, None), (501, ""), (502, " \n "), (503, "one"), (504, "one two"), (5, rows[5][1]), (505, "x " * 70_000)]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], f"{SCHEMA}, fp int, root string")
    got = simhash.near_duplicates(df, chunk=chunk).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == plain_components(rows)


def test_bit_sliced_distances(rng):
    values = np.array([rng.getrandbits(64) & 0xFF0F for _ in range(500)], np.uint64)
    planes = simhash.bit_planes(values)
    for shift in (1, 63, 64, 65, 200):
        for radius in (0, 2, 3, 5):
            valid = np.arange(500 - shift) % 3 > 0
            near = np.bitwise_count(values[: 500 - shift] ^ values[shift:]) <= radius
            assert simhash.near_pairs(planes, valid, shift, radius).tolist() == np.flatnonzero(near & valid).tolist()


def test_empty_table_has_no_duplicates(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_long_chain_and_a_star(spark, rng):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(5, 5)]
    rng.shuffle(links)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(200, 300)}}
