"""Every registered query against its check SQL on the smallest supplied tables."""

import pytest
from compare import compare, connect

from fleetlens.plans.catalog import oracle_sql, queries

SF = "/root/testdata/sf0.001"
CHECKS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    if name not in CHECKS:
        assert df.count() > 0
        return
    problems, _ = compare(df, con, CHECKS[name])
    assert not problems, problems


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
