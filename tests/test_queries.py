"""Every registered query against its SQL statement in DuckDB, on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod

from .compare import compare, duck

SF = os.environ.get("AIRSHED_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/lineitem.parquet"), reason="driver tables not present")

ORACLE = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "aqi" in df.columns


@pytest.mark.parametrize("name", sorted(entry_mod.queries()))
def test_query_matches_sql(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, msg
