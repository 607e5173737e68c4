"""Halo-partitioned trailing window = plain per-site window (brute force), incl. gaps and midnight."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from airshed.functions.localtime import local_date
from airshed.operators.rolling import rolling_8h_mean
from pyspark.sql import functions as F

from . import brute


def _hourly(spark, rows):
    df = spark.createDataFrame(rows, "city_id string, ts_utc timestamp_ntz, o3 double, co_mg_m3 double")
    return df.withColumn("obs_date_ist", local_date(F.col("ts_utc")))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force_with_gaps(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for site in ("A", "B", "HOT"):
        hours = 24 * 6 if site != "HOT" else 24 * 12
        for h in range(hours):
            if rnd.random() < 0.2:
                continue  # missing hour
            t = dt.datetime(2026, 9, 1) + dt.timedelta(hours=h)
            o3 = None if rnd.random() < 0.1 else round(rnd.uniform(0, 200), 2)
            rows.append((site, t, o3, round(rnd.uniform(0, 5), 3)))
    got = {(r.city_id, r.ts_utc): r for r in rolling_8h_mean(_hourly(spark, rows)).collect()}
    assert len(got) == len(rows)
    for site in ("A", "B", "HOT"):
        mine = [(t, o3) for s, t, o3, _ in rows if s == site]
        want = brute.rolling(mine)
        for t, w in want.items():
            g = got[(site, t)].o3_8h
            assert (g is None and w is None) or g == pytest.approx(w), (site, t, g, w)


def test_frame_crosses_local_midnight(spark):
    # 8 hours ending at 00:30 local on 2 Sep: the frame reaches back to 17:30 local on 1 Sep
    start = dt.datetime(2026, 9, 1, 12)  # 17:30 local
    rows = [("A", start + dt.timedelta(hours=h), float(h), None) for h in range(8)]
    got = {r.ts_utc: r for r in rolling_8h_mean(_hourly(spark, rows)).collect()}
    last = got[start + dt.timedelta(hours=7)]
    assert last.obs_date_ist == dt.date(2026, 9, 2)
    assert last.o3_8h == pytest.approx(sum(range(8)) / 8)
    assert got[start + dt.timedelta(hours=4)].o3_8h is None  # only 5 values in frame


@pytest.mark.parametrize("bucket", [1, 3, 6])
def test_short_buckets_match_brute_force(spark, bucket):
    rnd = random.Random(bucket)
    start = dt.datetime(2026, 9, 1)
    rows = []
    for h in range(24 * 3):
        for _ in range(rnd.randint(0, 3)):  # irregular, sub-hour timestamps
            t = start + dt.timedelta(hours=h, seconds=rnd.randint(0, 3599), microseconds=rnd.randint(0, 999999))
            rows.append(("U", t, round(rnd.uniform(0, 50), 2), 1.0))
    rows = list({r[1]: r for r in rows}.values())
    out = rolling_8h_mean(_hourly(spark, rows), min_count=1, bucket_hours=bucket)
    got = {r.ts_utc: r.o3_8h for r in out.collect()}
    want = brute.rolling([(t, v) for _, t, v, _ in rows], hours=8, min_count=1)
    assert len(got) == len(rows)
    for t, w in want.items():
        assert got[t] == pytest.approx(w), (t, got[t], w)
