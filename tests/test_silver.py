"""Bronze -> silver: explode, units, local time, forecast hours, bad input, dedupe order."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from airshed.operators.clean import silver_transform

from .conftest import bronze_rows, sample_responses


def _payload(times, **arrays):
    return json.dumps({"latitude": 1.0, "longitude": 2.0, "hourly": {"time": times, **arrays}})


def _bronze(spark, rows):
    return spark.createDataFrame(rows, "run_id string, ingested_at timestamp_ntz, source string, city_id string, "
                                       "payload string, source_file string")


def test_explodes_hours_and_converts_units(spark):
    out = silver_transform(bronze_rows(spark, sample_responses()), audit=False)
    assert out.count() == 2 * 72
    first = out.where("city_id = 'BLR' AND ts_utc = timestamp_ntz'2026-09-01 00:00:00'").first()
    assert first.obs_date_ist == dt.date(2026, 9, 1) and first.obs_hour_ist == 5  # 00:00Z = 05:30 local
    assert first.co_mg_m3 == pytest.approx(sample_responses()[0]["hourly"]["carbon_monoxide"][0] / 1000)
    late = out.where("city_id = 'BLR' AND ts_utc = timestamp_ntz'2026-09-01 19:00:00'").first()
    assert late.obs_date_ist == dt.date(2026, 9, 2) and late.obs_hour_ist == 0  # crosses local midnight
    assert {f.name: f.dataType.simpleString() for f in out.schema}["ts_utc"] == "timestamp_ntz"


def test_future_hours_dropped_even_with_missing_arrays(spark):
    p = _payload(["2026-09-01T00:00", "2099-01-01T00:00"], pm2_5=[10.0, 11.0])
    df = _bronze(spark, [("r", dt.datetime(2026, 9, 2), "t", "BLR", p, "f")])
    out = silver_transform(df, audit=False).collect()
    assert len(out) == 1 and out[0].pm2_5 == 10.0 and out[0].pm10 is None


def test_bad_input_is_dropped_not_fatal(spark):
    rows = [
        ("r", dt.datetime(2026, 9, 2), "t", "A", "{not json", "f1"),                       # corrupt payload
        ("r", dt.datetime(2026, 9, 2), "t", "B", _payload(["2026-09-01 00:00", "2026-13-01T00:00", "x"],
                                                          pm2_5=[1.0, 2.0, 3.0]), "f2"),  # bad times
        ("r", dt.datetime(2026, 9, 2), "t", "C", _payload(["2026-09-01T00:00", "2026-09-01T01:00"],
                                                          pm2_5=[5.0], pm10=[None, None]), "f3"),  # ragged
        ("r", dt.datetime(2026, 9, 2), "t", "D", _payload(["2026-09-01T00:00"], pm2_5=[None]), "f4"),  # all null
    ]
    out = {(r.city_id, r.ts_utc): r for r in silver_transform(_bronze(spark, rows), audit=False).collect()}
    assert list(out) == [("C", dt.datetime(2026, 9, 1, 0))]  # ragged tail hour has no value at all


def test_nan_becomes_null(spark):
    p = '{"hourly":{"time":["2026-09-01T00:00"],"pm2_5":[NaN],"pm10":[4.0]}}'
    out = silver_transform(_bronze(spark, [("r", dt.datetime(2026, 9, 2), "t", "A", p, "f")]), audit=False).first()
    assert out.pm2_5 is None and out.pm10 == 4.0


def test_latest_version_wins_whatever_the_arrival_order(spark):
    t = ["2026-09-01T00:00"]
    rows = [
        ("run-b", dt.datetime(2026, 9, 3), "t", "A", _payload(t, pm2_5=[2.0]), "f2"),
        ("run-c", dt.datetime(2026, 9, 4), "t", "A", _payload(t, pm2_5=[3.0]), "f3"),
        ("run-a", dt.datetime(2026, 9, 2), "t", "A", _payload(t, pm2_5=[1.0]), "f1"),
        ("run-a", dt.datetime(2026, 9, 4), "t", "A", _payload(t, pm2_5=[4.0]), "f0"),  # same time, lower run id
    ]
    for perm in (rows, rows[::-1], rows[1:] + rows[:1]):
        out = silver_transform(_bronze(spark, perm), audit=False).collect()
        assert [(r.pm2_5, r.run_id) for r in out] == [(3.0, "run-c")]
