"""Every registered query with SQL gives the same schema and bag of rows."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import duck, mismatch

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, con, name):
    problem = mismatch(con, SQL[name], queries()[name](spark, sf_dir))
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_gives_rows(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(queries())


def test_flagship_scores_every_validation_user(spark):
    result = entry(spark)
    assert result.count() == 143
    row = result.agg({"precision_at_k": "min", "ndcg_at_k": "max"}).first()
    assert 0 <= row["min(precision_at_k)"] and row["max(ndcg_at_k)"] <= 1
