"""Every registered query with SQL equals DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as app

TABLES = "events documents embeddings pages benchmark labels conversations".split()
ORACLES = app.oracle_sql()


def comparable(arrow):
    names = sorted(arrow.column_names)

    def plain(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    columns = [[plain(v) for v in arrow.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns), key=repr)


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, db, name):
    mine = comparable(app.queries()[name](spark, sf_dir).toArrow())
    assert mine == comparable(db.sql(ORACLES[name]).to_arrow_table())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(app.queries())


def test_entry(spark):
    assert app.entry(spark).count() == 2
