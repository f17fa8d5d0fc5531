"""Every registered query against its DuckDB oracle SQL (sf0.001, whole tables)."""

import pytest

from conftest import SF001
from tools.compare import digest, duck

import __spark_entry__ as E
from prefpairs.plans.queries import QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["entry_id", "strategy_ord", "prompt", "chosen", "rejected", "action_type", "rejection_strategy", "source"]


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) & set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]
