"""Incremental ingestion of landed files."""

from barloom.plans import clean_equities
from barloom.streaming import ingest_landed
from test_clean import JAN2, JAN3, equities, equity


def test_each_run_takes_only_what_is_new(spark, tmp_path):
    landing, raw, table = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "bars")
    schema = equities(spark).schema

    def run():
        query = ingest_landed(
            spark, landing, schema, lambda df: clean_equities(df, for_storage=True), raw, table, str(tmp_path / "state")
        )
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted((r.time.day, r.close) for r in spark.read.parquet(table).collect())

    equities(spark, equity(1, JAN2), equity(2, JAN2, 999.0)).write.mode("append").parquet(landing)
    assert run() == [(2, 185.0)]
    equities(spark, equity(3, JAN2, 7.0), equity(4, JAN3)).write.mode("append").parquet(landing)
    assert run() == [(2, 185.0), (3, 185.0)]
    assert run() == [(2, 185.0), (3, 185.0)]
    assert spark.read.parquet(raw).count() == 4
