import numpy as np
import pytest

from barloom.llm.line_quality import FEATURES, line_features, marginals, score, train

DOCS = "doc_id long, text string"


def test_marginals_against_all_labellings(rng):
    switch = np.array([[0.3, -0.7], [-0.2, 0.9]])
    good = np.array([[rng.uniform(-2, 2) for _ in range(5)] for _ in range(4)])
    lengths = np.array([5, 1, 3, 2])
    got, pairs, total = marginals(good, lengths, switch)
    for i, n in enumerate(lengths):
        weights, each, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            labels = [code >> t & 1 for t in range(n)]
            value = np.exp(sum(good[i, t] * y for t, y in enumerate(labels)) + sum(switch[a, b] for a, b in zip(labels, labels[1:])))
            weights += value
            each += value * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                both[a, b] += value
        assert np.allclose(got[i, :n], each / weights) and np.allclose(pairs[i], both / weights) and np.isclose(total[i], np.log(weights))


def test_features_of_odd_texts():
    for text in ("", "\n\n", "é", "a\tb  c.", "x" * 10_000, "A!\n" * 500):
        features, weights = line_features(text)
        assert features.shape == (text.count("\n") + 1, FEATURES) and len(weights) == len(features) and np.isfinite(features).all()


def test_learns_from_labels_alone(spark, rng):
    good = lambda: "\n".join(" ".join(rng.choice("the river runs past an old mill and turns north".split()) for _ in range(12)).capitalize() + "." for _ in range(rng.randint(1, 6)))
    bad = lambda: "\n".join(" | ".join(rng.choice(["$$$", "BUY!!", "x"]) for _ in range(8)) for _ in range(rng.randint(1, 6)))
    rows = [(i, good() if i % 3 else bad()) for i in range(300)]
    df = spark.createDataFrame([(*r, "q") for r in rows], f"{DOCS}, quality string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(150)] + [(None, 1), (7, None), (5, 1)], "doc_id long, quality int")
    model = train(df.drop("quality"), labels)
    got = score(df, model)
    assert got.columns == [*df.columns, "score"]
    assert all((r.score >= 0.3) == (r.doc_id % 3 > 0) for r in got.where("doc_id >= 150").collect())
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "a\n" * 20_000)], DOCS)
    assert all(0 <= r.score <= 1 for r in score(odd, model).collect()) and score(odd, model).count() == 4
    assert score(odd.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        score(got, model)


def test_without_labels_nothing_is_known(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b\nc")], DOCS)
    model = train(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in score(df, model).collect()} == {0.5}
