"""Every registered query against its SQL in DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from tallywharf.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield con
    con.close()


def _sorted(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = _sorted(QUERIES[name](spark, SF_DIR).toPandas())
    want = _sorted(duck.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert len(got) > 0
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns if got[c].dtype.kind != want[c].dtype.kind}
    assert not kinds
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)
