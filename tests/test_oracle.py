"""Every registered query against its DuckDB oracle on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as E
from quarry.plans.queries import QUERIES
from tests.conftest import SMALL
from tools.check_oracle import TABLES, digest

ORACLES = E.oracle_sql()
# File-level oracles name the sf0.01 folder (the driver's check data), so they run there.
FILE_KEYS = {"file_scan", "file_inventory", "file_stream"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert missing == []


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k in ORACLES and k not in FILE_KEYS))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["max_torque_nm", "file_name", "manufacturer", "model_number", "rnk"]
