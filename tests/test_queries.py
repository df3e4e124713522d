"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_queries import compare, connect  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", entry_points.queries())
def test_query_matches_sql(spark, connection, name):
    sql = entry_points.oracle_sql().get(name)
    ok, note = compare(spark, connection, name, entry_points.queries()[name], sql, FOLDER)
    assert ok or note == "no rows on either side", note


def test_entry_gives_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
