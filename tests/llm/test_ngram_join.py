"""The Jaccard join against brute force over word sets."""

from itertools import combinations

import numpy as np
import pytest

from barloom.llm import ngram_join
from barloom.llm.ngram_join import similar_documents

SCHEMA = "doc_id long, text string"
lower = lambda text: "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, k=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower(text or "")) if w]
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain(rows, num=90, den=100, k=3):
    sets, group = [shingles(t, k) for _, t in rows], list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if group[i] != group[j] and sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
            group = [group[i] if g == group[j] else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return sorted((str(i), len(s), str(least[g])) for (i, _), s, g in zip(rows, sets, group))


def documents(rng, families=25, copies=6):
    """Families of near copies around the threshold, and a passage that many share."""
    words = [f"w{i}" for i in range(900)]
    shared = " ".join(rng.choices(words, k=25))
    texts = []
    for _ in range(families):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 4, 9, 12, 20, 60, 150, 400]))
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 50))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            text = " ".join(copy)
            texts.append(f"{text} {shared}" if rng.random() < 0.3 else rng.choice([text, f" {text.upper()}\n", text.replace(" ", "\t")]))
    return texts + [shared] * 3 + [shared + " more"] * 2


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


@pytest.mark.parametrize("counted", [1, 4])
def test_components_against_brute_force(spark, rng, counted):
    rows = list(enumerate(documents(rng)))
    rows += [(None, rows[3][1]), (None, None), (900, None), (901, ""), (902, " \n"), (None, "only here it stands"), (7, rows[8][1]), (7, rows[8][1]), (903, "É É é a"), (904, "é é é a")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], f"{SCHEMA}, name string, n int, set int")
    want = plain(rows)
    assert 30 < len({c for _, _, c in want}) < len(rows) - 60
    assert got(similar_documents(df, counted=counted)) == want


def test_other_similarity_and_width(spark, rng):
    rows = list(enumerate(documents(rng, 15)))
    assert got(similar_documents(spark.createDataFrame(rows, SCHEMA), shingle=2, similarity=(3, 5))) == plain(rows, 3, 5, 2)


def test_large_group_of_near_copies(spark, rng):
    words = [f"v{i}" for i in range(500)]
    rows = []
    for i in range(300):
        copy = words[:200]
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(200)] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    assert got(similar_documents(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_empty_table_and_long_text(spark, rng):
    assert similar_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    long = " ".join(str(rng.randrange(50_000)) for _ in range(120_000))
    rows = [(5, long), (4, long + " end"), (3, "one")]
    assert got(similar_documents(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_odd_ranges_never_overstate_a_difference(rng):
    draw = lambda n: {rng.getrandbits(64) for _ in range(n)}
    for _ in range(200):
        both, left, right = draw(rng.randint(0, 300)), draw(rng.randint(0, 40)), draw(rng.randint(0, 40))
        odd = [np.bitwise_xor.reduce(ngram_join.range_bits(np.array(sorted(s), np.uint64)), axis=0) for s in (both | left, both | right)]
        apart = sum(int(x).bit_count() for x in odd[0] ^ odd[1])
        assert apart <= len(left ^ right) and apart % 2 == len(left ^ right) % 2


def test_filters_pass_every_linked_pair(rng):
    """The bounds themselves, on sets at the threshold."""
    for _ in range(300):
        n, m = rng.randint(1, 60), rng.randint(1, 60)
        both = rng.randint(0, min(n, m))
        if 100 * both >= 90 * (n + m - both):
            assert both >= max(ngram_join.least_overlap(s, 90, 100) for s in (n, m))
            assert all(s - both < ngram_join.prefix_length(s, 90, 100) for s in (n, m))


def test_words_are_hashed_alike_in_blocks(rng, monkeypatch):
    text = " ".join("".join(rng.choice("abcÉ\0") for _ in range(rng.randint(1, 30))) for _ in range(300)) + "\t" + "z" * 500 + "\n\x0b A\x1cB"
    whole = ngram_join.word_hashes(text)
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    assert len(whole) == len(words) and len(set(whole.tolist())) == len(set(words))
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    assert ngram_join.word_hashes(text).tolist() == whole.tolist()
    assert [ngram_join.word_hashes(w)[0] for w in words[:20]] == whole[:20].tolist()
