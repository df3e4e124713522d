"""The stages on a small fixture against plain versions, and the registered queries against SQL."""

import sys
from pathlib import Path

import pytest

import corpus_pipeline
from barloom.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_queries import compare, connect  # noqa: E402
from test_dedup import plain_lines  # noqa: E402
from test_near_dedup_stage import plain as plain_groups  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, connect(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER)
    assert ok, note


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_gives_a_row_per_row(spark, name):
    df = QUERIES[name](spark, FOLDER)
    source = {"op1": "conversations", "op10": "pages"}.get(name.split("_")[0], "documents")
    if name.startswith("op5"):
        assert df.count() > 0
    else:
        assert df.count() >= spark.read.parquet(f"{FOLDER}/{source}.parquet").count()


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.keep_good(spark, docs, FOLDER).cache()
    assert kept.columns == docs.columns and 0.5 * docs.count() < kept.count() < docs.count()

    lines = corpus_pipeline.drop_repeated_lines(spark, kept, FOLDER).cache()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted((str(r.doc_id), r.text) for r in lines.collect()) == [(i, text) for i, _, _, text in plain_lines(rows, 40, 5)]
    assert lines.columns == docs.columns and lines.where("n_chars <> length(text)").count() == 0

    apart = corpus_pipeline.drop_near_duplicates(spark, lines, FOLDER).cache()
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    groups = {}
    for (i, _), group in zip(rows, plain_groups([text or "" for _, text in rows])):
        groups.setdefault(group, []).append(i)
    assert len(groups) < len(rows) and sorted(r.doc_id for r in apart.collect()) == sorted(min(ids) for ids in groups.values())

    free = corpus_pipeline.drop_benchmark_passages(spark, apart, FOLDER).cache()
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    holds = lambda text: any(item in " ".join(text.lower().split()) for item in items)
    assert sorted(r.doc_id for r in free.collect()) == sorted(r.doc_id for r in apart.collect() if not holds(r.text))

    coded = {r.doc_id: r for r in corpus_pipeline.tokenize(spark, free, FOLDER).collect()}
    assert {i: r.text for i, r in coded.items()} == {r.doc_id: r.text for r in free.collect()}
    assert all(r.n_tokens == len(r.ids) for r in coded.values())


def test_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and an empty table go through all stages."""
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(1, "Plain words stand here.", "en", "s", 23), (1, "Plain words stand here.", "en", "s", 23), (None, None, None, None, None), (2, "", "en", "s", 0)]
    for name, data in (("rows", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(data, schema).write.parquet(str(folder / "documents.parquet"))
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(0 if name == "none" else 20).write.parquet(str(folder / f"{table}.parquet"))
        assert corpus_pipeline.run(spark, str(folder)).count() <= len(data)


def test_columns_of_any_name_come_through(spark, tmp_path):
    """Names that the stages use for their own columns are a table's names like others."""
    names = ["_text", "_root", "_place", "known", "known_id", "name_0", "ROOT_0", "place_0", "quality_0", "held", "key", "node", "row"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    wide = docs.selectExpr("*", *[f"concat('{n} of ', doc_id) AS `{n}`" for n in names])
    narrow = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        wide, narrow = (corpus_pipeline.cut_lineage(stage(spark, df, FOLDER)) for df in (wide, narrow))
        assert wide.columns == [*docs.columns, *names]
    rows = wide.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in narrow.collect())
    assert all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names)
    assert "text" in corpus_pipeline.STAGES[-1][1](spark, wide, FOLDER).columns
