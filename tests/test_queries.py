"""Every registered query against its SQL on the smallest folder."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks import catalogue  # noqa: E402,F401
from checks.compare import differences, open_tables, sql_rows  # noqa: E402
from checks.registry import QUERIES, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    if name not in SQL:
        assert rows
        return
    names, expected = sql_rows(tables, SQL[name])
    assert differences(df.columns, rows, names, expected) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
