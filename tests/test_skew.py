"""Hot keys: one key holding a large share of all rows gives whole, exact results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from airshed.functions.localtime import local_date
from airshed.operators.dedupe import latest_per_key
from airshed.operators.rolling import rolling_8h_mean
from airshed.operators.serve import latest_per_site


def test_dedupe_hot_key_keeps_the_newest(spark):
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), (F.col("id") % 1000).cast("string")))
        .alias("city_id"),
        F.lit(dt.datetime(2026, 9, 1)).cast("timestamp_ntz").alias("ts_utc"),
        F.col("id").alias("version"),
        (F.col("id") * 2).alias("payload"),
    ).repartition(8)
    out = {r.city_id: r for r in latest_per_key(df, ["city_id", "ts_utc"], ["version"]).collect()}
    assert len(out) == 1 + len({f"K{i % 1000}" for i in range(n) if i % 3})
    assert out["HOT"].version == max(i for i in range(n) if i % 3 == 0)
    assert out["HOT"].payload == 2 * out["HOT"].version


def test_rolling_hot_site_many_days(spark):
    # one site with 2,000 hours (83 days) next to small ones: parallel by site-day, still exact
    start = dt.datetime(2026, 1, 1)
    rows = [("HOT", start + dt.timedelta(hours=h), float(h % 17), float(h % 5)) for h in range(2000)]
    rows += [(f"S{i}", start + dt.timedelta(hours=h), 1.0, 1.0) for i in range(5) for h in range(30)]
    df = spark.createDataFrame(rows, "city_id string, ts_utc timestamp_ntz, o3 double, co_mg_m3 double")
    out = rolling_8h_mean(df.withColumn("obs_date_ist", local_date(F.col("ts_utc"))))
    got = {(r.city_id, r.ts_utc): r.o3_8h for r in out.collect()}
    assert len(got) == len(rows)
    for h in range(7, 2000, 97):
        want = sum(float(x % 17) for x in range(h - 7, h + 1)) / 8
        assert abs(got[("HOT", start + dt.timedelta(hours=h))] - want) < 1e-9


def test_latest_per_site_hot_site(spark):
    rows = [("HOT", dt.date(2020, 1, 1) + dt.timedelta(days=d), d % 500) for d in range(3000)]
    rows += [("A", dt.date(2020, 1, 1), 7)]
    gold = spark.createDataFrame(rows, "city_id string, obs_date_ist date, aqi int")
    got = {r.city_id: (r.obs_date_ist, r.aqi) for r in latest_per_site(gold).collect()}
    assert got == {"HOT": (dt.date(2020, 1, 1) + dt.timedelta(days=2999), 2999 % 500), "A": (dt.date(2020, 1, 1), 7)}
