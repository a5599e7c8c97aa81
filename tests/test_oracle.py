"""Every registered query against its DuckDB oracle (the driver's gate, here at sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry
from airmart.plans import registry
from scripts.check_oracle import TABLES, rows_of
from tests.conftest import SF_SMALL

ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = set(registry.queries()) - set(ORACLE)
    assert missing == set()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.sql(ORACLE[name])
    o_cols, o_rows = res.columns, res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["country", "city", "pm25_avg", "pm10_avg", "so2_avg", "no2_avg", "co_avg", "o3_avg",
                          "prominent_pollutant", "aqi"]
    assert 0 < len(rows) <= 10
    assert [r.aqi for r in rows] == sorted([r.aqi for r in rows], reverse=True)
