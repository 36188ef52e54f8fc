"""Every operator query with SQL equals DuckDB on the two smallest table sets."""

import duckdb
import pytest

from quillspark.llm import queries
from test_registry import TABLES, comparable


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_equals_sql(spark, name, sf):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/{sf}/{table}.parquet'")
    mine = comparable(queries.queries()[name](spark, f"/root/testdata/{sf}").toArrow())
    assert mine == comparable(db.sql(queries.oracles()[name]).to_arrow_table())
