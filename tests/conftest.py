from __future__ import annotations

import datetime as dt
import json
import math
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

START = dt.datetime(2026, 9, 1)
SITES = [("BLR", "Bengaluru", "Karnataka", 12.97, 77.59), ("DEL", "Delhi", "Delhi", 28.61, 77.21),
         ("BOM", "Mumbai", "Maharashtra", 19.08, 72.88)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from airshed.session import get_spark

    s = get_spark("airshed-tests", master="local[4]", shuffle_partitions=4,
                  extra={"spark.driver.memory": "4g",
                         "spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s
    s.stop()


def response(site: int, hours: int = 72, start: dt.datetime = START, null_so2=(), scale_pm25: float = 1.0) -> dict:
    """A source-shaped response with smooth made-up values (our own rule, not real data)."""
    base = [(38.0, 60.0, 30.0, 12.0, 70.0, 900.0), (150.0, 230.0, 70.0, 28.0, 52.0, 2400.0)][site]
    hourly = {"time": [], "pm2_5": [], "pm10": [], "nitrogen_dioxide": [], "sulphur_dioxide": [], "ozone": [],
              "carbon_monoxide": []}
    for i in range(hours):
        t = start + dt.timedelta(hours=i)
        h = int((t - START).total_seconds() // 3600)  # values depend on the absolute hour only
        wave = 1.0 + 0.25 * math.sin((h + 3 * site) / 4.0)
        hourly["time"].append(t.strftime("%Y-%m-%dT%H:%M"))
        hourly["pm2_5"].append(round(base[0] * wave * scale_pm25, 1))
        hourly["pm10"].append(round(base[1] * wave, 1))
        hourly["nitrogen_dioxide"].append(round(base[2] * (2 - wave), 1))
        hourly["sulphur_dioxide"].append(None if t in null_so2 else round(base[3] * wave, 1))
        hourly["ozone"].append(round(base[4] * (0.6 + 0.8 * (h % 24) / 23), 1))
        hourly["carbon_monoxide"].append(round(base[5] * wave, 1))
    lat, lon = [(12.97, 77.59), (28.61, 77.21)][site]
    return {"latitude": lat, "longitude": lon, "generationtime_ms": 0.5, "utc_offset_seconds": 0,
            "timezone": "GMT", "hourly_units": {"time": "iso8601"}, "hourly": hourly}


DEL_SO2_GAP = tuple(dt.datetime(2026, 9, 2, h) for h in range(10))


def sample_responses() -> list[dict]:
    return [response(0), response(1, null_so2=DEL_SO2_GAP)]


def revised_responses() -> list[dict]:
    day3 = START + dt.timedelta(days=2)
    return [response(0, 24, day3, scale_pm25=1.5), response(1, 24, day3)]


@pytest.fixture
def sample_file(tmp_path: Path) -> str:
    p = tmp_path / "sample_response.json"
    p.write_text(json.dumps(sample_responses()), encoding="utf-8")
    return str(p)


@pytest.fixture
def revised_file(tmp_path: Path) -> str:
    p = tmp_path / "revised_response.json"
    p.write_text(json.dumps(revised_responses()), encoding="utf-8")
    return str(p)


@pytest.fixture
def dim(spark):
    rows = [(i, *s) for i, s in enumerate(SITES)]
    return spark.createDataFrame(rows, "position int, city_id string, name string, state string, "
                                       "latitude double, longitude double")


def bronze_rows(spark, responses: list[dict], run_id: str = "run-1", ingested=dt.datetime(2026, 9, 5),
                sites=("BLR", "DEL")):
    rows = [(run_id, ingested, "test", sites[i], json.dumps(r), f"{run_id}.jsonl") for i, r in enumerate(responses)]
    return spark.createDataFrame(rows, "run_id string, ingested_at timestamp_ntz, source string, city_id string, "
                                       "payload string, source_file string")
