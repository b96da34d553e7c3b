"""Every bound query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from compare import compare, connect
from plumbline.catalog import REGISTRY

FOLDER = os.environ.get("PLUMBLINE_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables here")
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    n, ok, why = compare(spark, con, REGISTRY[name], FOLDER)
    assert ok is not False, why
    if ok is None:
        assert n > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["rule", "column", "n"]
    assert set(entry.oracle_sql()) < set(entry.queries())
