"""Every query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pytest

from scriptorium.plans import all as plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return connection


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(repr(round(r[k], 9)) if isinstance(r[k], float) else str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_against_sql(spark, data, duck, name):
    df = plans.QUERIES[name](spark, data)
    found = duck.execute(plans.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.collect(), df.columns) == ordered(found.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_others_run(spark, data, name):
    assert plans.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
