import pytest
from oracle import connect, same

from workloom.plans import general, reports, search, state, storage, weekly

MODULES = (general, weekly, reports, state, search, storage)
WITH_SQL = [(m, k) for m in MODULES for k in m.QUERIES if k in m.SQL]
WITHOUT = [(m, k) for m in MODULES for k in m.QUERIES if k not in m.SQL]


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("module,name", WITH_SQL, ids=[k for _, k in WITH_SQL])
def test_against_sql(spark, data, con, module, name):
    same(spark, con, data, module.QUERIES[name], module.SQL[name])


@pytest.mark.parametrize("module,name", WITHOUT, ids=[k for _, k in WITHOUT])
def test_runs(spark, data, module, name):
    df = module.QUERIES[name](spark, data)
    assert df.columns and df.count() > 0


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) > 60
