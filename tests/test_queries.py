"""Every query of the reference's operators against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from mesaquery.plans import registry

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = DATA / f"{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(frame: pd.DataFrame) -> list[tuple]:
    def one(v):
        if pd.api.types.is_scalar(v) and pd.isna(v):
            return "null"
        return f"{float(v):.7g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(one, r)) for r in frame.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", list(registry.SQL))
def test_query_equals_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, str(DATA)).toPandas(), duck.sql(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) and plain(got) == plain(want)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.SQL])
def test_other_queries_run(spark, name):
    assert registry.QUERIES[name](spark, str(DATA)).count() > 0


def test_hot_key_medians_keep_days_without_dates_or_prices(spark, tmp_path):
    rows = """SELECT CASE WHEN i % 5 > 0 THEN TIMESTAMP '1998-01-01' + to_days(CAST(i % 5 AS INTEGER)) END AS l_shipdate, CASE WHEN i % 5 <> 2 THEN CAST(i * 37 % 50 AS DOUBLE) END AS l_quantity,
        CASE WHEN i % 5 <> 3 THEN i * 7919 % 1000 / 8.0 END AS l_extendedprice FROM range(400) AS r(i)"""
    con = duckdb.connect()
    con.sql(f"COPY ({rows}) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    got, want = registry.QUERIES["hot_key_medians"](spark, str(tmp_path)).toPandas(), con.sql(registry.SQL["hot_key_medians"]).df()
    assert len(got) == 6 and plain(got) == plain(want)
