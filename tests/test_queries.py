import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload import oracle
from workload.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = ("supplier", "lineitem")
SAMPLE = (
    "price_panel",
    "daily_returns_sparse",
    "consensus_prices",
    "contract_violations",
    "signals",
    "mart_scores_monthly",
    "mart_factor_summary",
    "checks_damaged_run",
    "parity",
    "pipeline_build",
    "export_factor_returns",
    "forward_returns_with_gaps",
    "cumulative_spread_spine",
)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.statements())
    assert set(QUERIES) <= set(entry_module.queries()) and set(oracle.statements()) <= set(entry_module.oracle_sql())


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(row[i]) for i in order] for row in rows), key=repr)


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_its_sql(spark, name):
    found = entry_module.queries()[name](spark, str(DATA))
    with duckdb.connect() as con:
        for table in TABLES:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
        expected = con.execute(entry_module.oracle_sql()[name])
        columns = [c[0] for c in expected.description]
        assert sorted(found.columns) == sorted(columns)
        assert _rows(found.columns, found.collect()) == _rows(columns, expected.fetchall())


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
def test_entry(spark):
    assert {r.factor for r in entry_module.entry(spark).collect()} == {"mom_12_1", "rev_21d", "vol_63d", "beta_252d"}
