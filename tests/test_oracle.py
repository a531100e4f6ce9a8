"""Every query with SQL gives the same rows as that SQL; the rest give rows."""

import pytest
from compare import connect, differences

from churnwright.plans import ORACLE, QUERIES
from churnwright.session import ROWS_PER_CHUNK_KEY

SLOW = ("t5", "t6", "t7", "t8")
ORDERED = [k for k in ORACLE if k.split("_")[0] in {"p12", "p16", "c1", "c3", "c7", "c10", "c11", "l3", "l7", "l8", "l9", "l10", "l11", "l12", "e1", "e5", "e7", "e13", "f5", "m6", "m8", "m11", "a11", "a18"}]


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("key", list(ORACLE))
def test_equals_sql(spark, folder, con, key):
    assert differences(QUERIES[key](spark, folder), con, ORACLE[key]) == []


@pytest.mark.parametrize("key", ORDERED)
def test_equals_sql_in_many_chunks(spark, folder, con, key):
    spark.conf.set(ROWS_PER_CHUNK_KEY, "100")
    try:
        assert differences(QUERIES[key](spark, folder), con, ORACLE[key]) == []
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_KEY)


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in ORACLE and not k.startswith(SLOW)])
def test_gives_rows(spark, folder, key):
    assert QUERIES[key](spark, folder).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 2
    assert set(entry.oracle_sql()) <= set(entry.queries())
