"""Merge upsert semantics, idempotency, persisted partitions, range replace."""

from __future__ import annotations

import datetime as dt

from airshed.operators import upsert
from airshed.operators.publish import replace_range, write_days

COLS = ("city_id string, ts_utc timestamp_ntz, obs_date_ist date, pm2_5 double, pm10 double, no2 double, "
        "so2 double, o3 double, co_mg_m3 double, run_id string, ingested_at timestamp_ntz")
T0 = dt.datetime(2026, 9, 1)


def _row(city, h, pm, run, ing_day, pm10=1.0):
    ts = T0 + dt.timedelta(hours=h)
    return (city, ts, (ts + dt.timedelta(hours=5, minutes=30)).date(), pm, pm10, 1.0, 1.0, 1.0, 0.1, run,
            dt.datetime(2026, 9, ing_day))


def _df(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _actions(plan):
    return {r["_action"]: r["rows"] for r in upsert.merge_counts(plan).collect()}


def test_actions(spark):
    target = _df(spark, [_row("A", 0, 1.0, "r1", 2), _row("A", 1, 1.0, "r1", 2), _row("A", 2, 1.0, "r1", 2),
                         _row("A", 3, 1.0, "r1", 2)])
    batch = _df(spark, [
        _row("A", 0, 9.0, "r2", 3),          # newer and different -> update
        _row("A", 1, 1.0, "r2", 3),          # newer, same values -> unchanged (keeps old version)
        _row("A", 2, 9.0, "r0", 1),          # older -> unchanged
        _row("A", 4, 5.0, "r2", 3),          # new key -> insert
        _row("A", 3, None, "r2", 3),         # a newer null replaces a value
    ])
    plan = upsert.merge_plan(target, batch)
    assert _actions(plan) == {"update": 2, "unchanged": 2, "insert": 1}
    state = {r.ts_utc.hour: r for r in upsert.merged_state(plan).collect()}
    assert state[0].pm2_5 == 9.0 and state[0].run_id == "r2"
    assert state[1].run_id == "r1" and state[2].pm2_5 == 1.0 and state[3].pm2_5 is None
    rev = upsert.revisions(plan).collect()
    assert sorted((r.ts_utc.hour, r.pm2_5, r.superseded_by_run) for r in rev) == [(0, 1.0, "r2"), (3, 1.0, "r2")]


def test_persisted_merge_is_idempotent_and_rewrites_only_changed_days(spark, tmp_path):
    path = str(tmp_path / "silver")
    batch = _df(spark, [_row("A", h, float(h), "r1", 9) for h in range(48)])
    assert upsert.upsert(spark, batch, path).inserted == 48
    res = upsert.upsert(spark, batch, path)
    assert (res.inserted, res.updated, res.changed_dates) == (0, 0, [])
    assert spark.read.parquet(path).count() == 48
    late = _df(spark, [_row("A", 30, 99.0, "r2", 10)])  # one hour on 2 Sep (local)
    res = upsert.upsert(spark, late, path, revisions_path=str(tmp_path / "rev"))
    assert (res.inserted, res.updated, res.changed_dates) == (0, 1, [dt.date(2026, 9, 2)])
    back = spark.read.parquet(path)
    assert back.count() == 48
    assert back.where("pm2_5 = 99.0").count() == 1
    assert spark.read.parquet(str(tmp_path / "rev")).count() == 1


def test_replace_range_empties_days_without_new_rows(spark, tmp_path):
    old = spark.createDataFrame([(d, 1) for d in (dt.date(2026, 9, 1), dt.date(2026, 9, 2), dt.date(2026, 9, 3))],
                                "obs_date_ist date, v int")
    new = spark.createDataFrame([(dt.date(2026, 9, 2), 2)], "obs_date_ist date, v int")
    got = sorted((r.obs_date_ist.day, r.v) for r in
                 replace_range(old, new, dt.date(2026, 9, 2), dt.date(2026, 9, 3)).collect())
    assert got == [(1, 1), (2, 2)]
    path = str(tmp_path / "gold")
    old.write.partitionBy("obs_date_ist").parquet(path)
    assert write_days(spark, new, path, [dt.date(2026, 9, 2), dt.date(2026, 9, 3)]) == 1
    got = sorted((r.obs_date_ist.day, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 2)]
