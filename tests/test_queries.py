"""Every core query against its SQL on the smallest data, the others for a stable schema."""

import pytest

from folioweave.queries import core
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(core.ORACLE))
def test_oracle(spark, con, name):
    compare(core.QUERIES[name](spark, SF), con, core.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLE)))
def test_runs(spark, name):
    df = core.QUERIES[name](spark, SF)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()


def test_oracles_belong_to_queries():
    assert set(core.ORACLE) <= set(core.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
