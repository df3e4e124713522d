"""The near-duplicate stage against brute-force Jaccard similarity of five-word shingles, and what it does with identifiers."""

from itertools import combinations

import corpus_pipeline
from barloom.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def families(rng, n, copies):
    """Texts and copies of them with words replaced, some of similarity just above and some just below 0.8."""
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    texts = []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.choice([8, 30, 100, 300]))
        texts.append(" ".join(words))
        for _ in range(copies):
            other = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            texts.append(" ".join(other))
    return texts


def plain(texts, similarity=0.8):
    """Groups of places connected by pairs of the similarity."""
    sets, group = [shingles(t) for t in texts], list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if group[i] != group[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
            group = [group[i] if g == group[j] else g for g in group]
    return group


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)
    out = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert out.columns == df.columns
    return out.collect()


def test_stage_agrees_with_brute_force(spark, rng):
    texts = families(rng, 60, 4)
    group = plain(texts)
    assert 60 < len(set(group)) < len(texts)
    got = sorted(r.doc_id for r in kept(spark, [(i, t, "s") for i, t in enumerate(texts)]))
    assert got == sorted({min(i for i, g in enumerate(group) if g == h) for h in set(group)})


def test_large_groups_meet_in_chunks(spark, rng):
    texts = families(rng, 2, 30)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    roots = {r.node: r.root for r in simhash.similar_texts(df, chunk=4, chunk_chars=4000).collect()}
    keys = [r[0] for r in df.select(simhash.text_key("text")).collect()]
    group = plain(texts)
    assert all((roots.get(a, a) == roots.get(b, b)) == (g == h) for (a, g), (b, h) in combinations(zip(keys, group), 2))


def test_rows_are_judged_by_text_not_by_identifier(spark, rng):
    texts = families(rng, 12, 0)
    rows = [(None, t, "s") for t in texts[:4]] + [(7, t, "s") for t in texts[4:8]] + [(i, t, "s") for i, t in zip((20, 21), texts[8:10])]
    rows += [(None, texts[0], "s"), (5, texts[1], "s"), (7, texts[8], "s"), (7, texts[4], "s"), (7, texts[4], "t"), (None, None, "s"), (None, "", "s")]
    got = kept(spark, rows)
    assert len(got) == 11 and {r.text or "" for r in got} == {*texts[:10], ""}
    ids = {r.text: r.doc_id for r in got}
    assert ids[texts[0]] is None and ids[texts[1]] == 5 and ids[texts[8]] == 7 and ids[texts[9]] == 21
    assert sorted(map(str, got)) == sorted(map(str, kept(spark, rows[::-1])))


def test_texts_are_shuffled_once_whatever_is_broadcast(spark, rng):
    texts = families(rng, 10, 3)
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    plans = {}
    for size in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        try:
            out = corpus_pipeline.drop_near_duplicates(spark, df, "")
            plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
            plans[size] = [step for step in plan.split("\n\n") if " Exchange\n" in step and "text#" in step.split("Arguments")[0]]
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in kept(spark, [(i, t, "s") for i, t in enumerate(texts)]))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [len(found) for found in plans.values()] == [1, 1]


def test_bitmap_keeps_all_that_may_match(spark):
    rows = spark.range(5000).selectExpr("md5(cast(id AS string)) AS node", "id")
    few = rows.where("id % 50 = 7").select("node")
    for bits, most in ((64, 5000), (1 << 16, 300)):
        found = simhash.maybe_among(rows, few, "node", bits)
        assert found.columns == rows.columns
        ids = [r.id for r in found.collect()]
        assert len(ids) == len(set(ids)) <= most and {i for i in range(5000) if i % 50 == 7} <= set(ids)
