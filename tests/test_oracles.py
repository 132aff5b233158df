import pytest
from paperloom.plans import all_registries
from tests.oracle_check import connect, same

QUERIES = {k: f for r in all_registries() for k, f in r.queries.items()}
SQL = {k: s for r in all_registries() for k, s in r.sql.items()}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, con, name):
    same(QUERIES[name](spark, small), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert len(set(df.columns)) == len(df.columns)
    df.count()


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
