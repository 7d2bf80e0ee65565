"""The contract queries that SQL can express, against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from mesaquery.llm import registry

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in DATA.iterdir():
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    got, want = registry.queries()[name](spark, str(DATA)).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert got.equals(want.astype(got.dtypes.to_dict()))
