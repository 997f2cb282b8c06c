"""Every registered query against its SQL on the smallest tables."""

import pytest

from tabularium.checks.all import CHECKS
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, con, name):
    status, _, _, note = compare(spark, con, FOLDER, name, CHECKS[name])
    assert status in ("ok", "rows-only"), note


def test_entry_contract():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(CHECKS) <= set(entry.queries())
    assert {n for n, c in CHECKS.items() if c.sql is None} <= {"k7_catalogue", "q7_stored_size"}  # stored bytes have no SQL
