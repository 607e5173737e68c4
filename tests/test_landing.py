"""Landing files: envelope round trip, FAILFAST on corrupt lines, skip known files, saved responses."""

from __future__ import annotations

import json

import pytest

from airshed.plans.lakehouse import load_bronze
from airshed.sources import landing


def _lines(path, recs):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in recs) + "\n", encoding="utf-8")


def _rec(city, payload='{"hourly":{"time":[]}}'):
    return {"run_id": "r1", "ingested_at": "2026-09-05T10:00:00.000000+00:00", "source": "t", "city_id": city,
            "window_start": "2026-09-01", "window_end": "2026-09-03", "payload": payload}


def test_read_landing_types_and_file_names(spark, tmp_path):
    f = tmp_path / "landing" / "ingest_date=2026-09-05" / "r1_a.jsonl"
    _lines(f, [_rec("BLR"), _rec("DEL")])
    rows = landing.read_landing(spark, str(f)).collect()
    assert len(rows) == 2 and rows[0].source_file == "r1_a.jsonl"
    assert str(rows[0].ingested_at) == "2026-09-05 10:00:00"  # UTC wall clock, NTZ
    assert str(rows[0].window_start) == "2026-09-01"


def test_corrupt_line_fails(spark, tmp_path):
    f = tmp_path / "bad.jsonl"
    f.write_text(json.dumps(_rec("BLR")) + "\n{broken\n", encoding="utf-8")
    with pytest.raises(Exception):
        landing.read_landing(spark, str(f)).collect()


def test_missing_required_field_fails(spark, tmp_path):
    f = tmp_path / "nofield.jsonl"
    r = _rec("BLR")
    del r["payload"]
    _lines(f, [r])
    with pytest.raises(Exception):
        landing.read_landing(spark, str(f)).collect()


def test_bronze_skips_files_already_loaded(spark, tmp_path):
    f = tmp_path / "landing" / "a.jsonl"
    _lines(f, [_rec("BLR"), _rec("DEL")])
    path = str(tmp_path / "bronze")
    assert load_bronze(spark, [str(f)], path) == 2
    assert load_bronze(spark, [str(f)], path) == 0
    g = tmp_path / "landing" / "b.jsonl"
    _lines(g, [_rec("BLR")])
    assert load_bronze(spark, [str(f), str(g)], path) == 1


def test_saved_single_object_is_a_list_of_one(spark, tmp_path, dim):
    from .conftest import sample_responses

    f = tmp_path / "one.json"
    f.write_text(json.dumps(sample_responses()[1]), encoding="utf-8")
    env = landing.read_saved_responses(spark, str(f), dim.select("position", "city_id"), "r1", "fixture",
                                       "2026-09-05T00:00:00+00:00").collect()
    assert [(e.city_id, e.window_start, e.window_end) for e in env] == [("BLR", "2026-09-01", "2026-09-03")]
    assert json.loads(env[0].payload)["latitude"] == 28.61
