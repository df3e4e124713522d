import pytest

from barloom.llm import decontaminate
from barloom.llm.decontaminate import Budget, Index, clean, find_in_texts, find_passages, normalise

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
BUDGET = Budget(window=60, step=20, rate=0.07, q=8)


def distance(pattern, text):
    """Fewest edits between the pattern and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefé") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        chars[at : at + rng.choice([0, 1])] = rng.choice(["x", "", "yz"[: rng.randint(1, 2)]])
    return "".join(chars)


def test_every_stretch_within_the_budget_is_found_and_no_other(rng):
    for n in range(250):
        item = normalise(words(rng, 30))[: rng.randint(40, 60)].strip()
        inside = edited(rng, item, rng.randint(0, 8))
        text = normalise(f"{words(rng, rng.randint(0, 20))} {inside} {words(rng, rng.randint(0, 20))}")
        k = BUDGET.edits(len(item))
        want = distance(item, text) <= k
        found = list(find_in_texts([text], Index([(1, item)], BUDGET), most=rng.choice([50, 1 << 20])))
        assert bool(found) == want, (item, text)
        assert all(f[4] <= k for f in found)


def test_tables(spark, rng, monkeypatch):
    items = [(i, words(rng, 20)) for i in range(12)] + [(50, None), (51, "too short"), (None, words(rng, 20))]
    docs = [(i, words(rng, 40)) for i in range(30)] + [(None, f"{words(rng, 9)}\n{items[0][1].upper()}!"), (None, None), (99, "")]
    docs += [(100 + i, f"{words(rng, 5)}, {text}; {words(rng, 5)}") for i, text in items[:12]]
    docs += [(200, docs[-1][1]), (200, docs[-1][1])]
    items += [(77, items[11][1]), (77, items[11][1])]
    d = spark.createDataFrame([(*r, 1, "x", "y") for r in docs], f"{DOCS}, item_id int, edits string, held string")
    b = spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(decontaminate, "SLICE", 7)
    for part, region, read in ((1 << 16, 1 << 16, 1 << 20), (100, 90, 120)):  # whole texts, several pieces
        for name, value in (("PART", part), ("REGION", region), ("READ", read)):
            monkeypatch.setattr(decontaminate, name, value)
        budget = Budget(window=60, step=20, q=8)
        rows = find_passages(d, b, budget).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == {(100 + i, i) for i in range(12)} | {(None, 0), (200, 11), (200, 77)} | {(111, 77)}
        assert len([r for r in rows if r.doc_id == 200]) % 2 == 0
        kept = clean(d, b, budget)
        assert kept.columns == d.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([str(i) for i in range(30)] + ["None", "99"])


def test_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "a b c")], DOCS), spark.createDataFrame([], ITEMS)
    assert find_passages(d, b).collect() == [] and clean(d, b).count() == 1
    items = spark.createDataFrame([(1, "word " * 30)], ITEMS)
    assert find_passages(d.limit(0), items).collect() == [] and clean(d.limit(0), items).collect() == []


@pytest.mark.parametrize("m", range(10, 101))
def test_bound_is_positive(m):
    assert Budget().bound(m) >= 1


def test_every_passage_of_least_chars_is_found(rng):
    """Passages cut from a longer item at any place, and items with a word replaced in every 80 characters."""
    items = [(i, normalise(words(rng, 120))) for i in range(10)]
    index = Index(items, Budget())
    for i, item in items:
        for n in (40, 43, 55, 79, 90):
            at = rng.randrange(len(item) - n)
            text = f"{words(rng, 30)} {item[at : at + n].strip().ljust(40, item[at + n])} {words(rng, 30)}"
            if normalise(item[at : at + n]) == item[at : at + n]:
                assert i in {f[1] for f in find_in_texts([text], index)}, (n, at)
        reworded = item
        for at in range(20, len(item) - 20, 80):
            reworded = reworded[:at] + "zzzzzzzz" + reworded[at + 8 :]
        assert i in {f[1] for f in find_in_texts([reworded], index)}
    assert not list(find_in_texts([words(rng, 3000)], index))


def test_rows_against_one_index_of_all_items(spark, rng):
    """The same stretches as a search of whole texts for all items at once finds."""
    items = [(i, words(rng, rng.choice([8, 40, 300]))) for i in range(15)]
    docs = []
    for i in range(60):
        item = rng.choice(items)[1]
        at = rng.randrange(max(1, len(item) - 60))
        docs.append((i, f"{words(rng, 20)} {edited(rng, item[at : at + rng.choice([50, 90, 400])], rng.randint(0, 6))} {words(rng, 20)}"))
    index = Index(items, Budget())
    want = {(i, index.items[item], begin, end, edits) for i, text in docs for _, item, begin, end, edits in find_in_texts([text], index)}
    got = {tuple(r) for r in find_passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == want and len({i for i, *_ in want}) > 30
