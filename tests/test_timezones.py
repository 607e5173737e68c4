"""Results do not depend on the session time zone (all times are UTC wall clock, NTZ)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod

from .compare import compare, duck

SF = os.environ.get("AIRSHED_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/lineitem.parquet"), reason="driver tables not present")


@pytest.mark.parametrize("name", ["daily_aqi", "silver_transform", "landing_roundtrip_counts", "dq_freshness_asof",
                                  "events_trailing_mean"])
def test_query_in_a_daylight_saving_zone(spark, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ok, msg = compare(entry_mod.queries()[name](spark, SF), duck(SF), entry_mod.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert ok, msg
