"""Every registered query against its DuckDB oracle (rows-only when none)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_SMALL, QUERIES[name], ORACLE[name])
    assert r["ok"], r.get("why")
    assert r["spark_rows"] > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sirenname", "total_amount", "n_contract"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
