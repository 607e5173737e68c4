"""Quality checks and report helpers on small frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from airshed.operators import quality, serve


def _silver(spark, rows):
    return spark.createDataFrame(rows, "city_id string, ts_utc timestamp_ntz, pm2_5 double, pm10 double, "
                                       "no2 double, so2 double, o3 double, co_mg_m3 double")


def test_checks_and_gate_decision(spark):
    t = dt.datetime(2026, 9, 1)
    rows = [("A", t, 1.0, 1.0, 1.0, 1.0, 1.0, 0.1), ("A", t, 1.0, 1.0, 1.0, 1.0, 1.0, 0.1),
            ("B", t, -1.0, 1.0, 1.0, None, 1.0, 0.1), ("B", t + dt.timedelta(hours=1), 5000.0, 1.0, 1.0, 1.0, 1.0, 0.1)]
    expected = spark.createDataFrame([("A",), ("B",), ("C",)], "city_id string")
    res = quality.run_checks(_silver(spark, rows), expected, as_of=dt.datetime(2026, 9, 4))
    got = {r.check_name: (r.passed, r.observed) for r in res.collect()}
    assert got["unique_city_hour"] == (False, "1 duplicate keys")
    assert got["no_negative_concentrations"] == (False, "1 rows")
    assert got["plausible_concentrations"] == (False, "1 rows")
    assert got["all_cities_present"] == (False, "missing: 1 sites")
    assert got["fresh_within_48h"] == (False, "latest hour 2026-09-01 01:00 UTC")
    decision = quality.gate_decision(res).first()
    assert decision.may_publish is False
    assert decision.blocking_checks == ["no_negative_concentrations", "unique_city_hour"]


def test_label_passes_unknown_codes_through(spark):
    df = spark.createDataFrame([("pm2_5",), ("co",), ("xyz",), (None,)], "code string")
    got = [r.l for r in df.select(serve.label(F.col("code")).alias("l")).collect()]
    assert got == ["PM2.5", "CO", "xyz", None]


def test_global_rank_matches_a_plain_ordering(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), F.col("id").alias("k"))
    ranked = {r.k: r.rank for r in serve.global_rank(df.repartition(7), [-F.col("v")], [F.col("v").desc(), F.col("k")]).collect()}
    order = sorted(range(5000), key=lambda k: (-(k * 7919 % 5000), k))
    assert [ranked[k] for k in order] == list(range(1, 5001))
