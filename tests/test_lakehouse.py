"""Properties of lakehouse runs: interrupted anywhere they converge; the gate sees the right rows; exact days are republished."""

from __future__ import annotations

import datetime as dt
import json
from unittest import mock

import pytest
from pyspark.sql import functions as F

from airshed.operators import quality
from airshed.operators.daily import GOLD_COLUMNS, daily_aqi
from airshed.plans import lakehouse as L
from airshed.sources import fs

from . import brute
from .conftest import START, response, revised_responses, sample_responses

SITES = ["BLR", "DEL", "BOM"]


def land(root: str, run_id: str, responses: dict, day: int) -> list[str]:
    """A landing file of {site: response}, ingested on 2027-09-<day>, after any fixture."""
    import os

    folder = f"{L.at(root, 'landing')}/{run_id}"
    os.makedirs(folder)
    with open(f"{folder}/{run_id}.jsonl", "w", encoding="utf-8") as out:
        for site, r in responses.items():
            out.write(json.dumps({"run_id": run_id, "ingested_at": f"2027-09-{day:02}T00:00:00+00:00", "source": "test", "city_id": site,
                                  "window_start": "2026-09-01", "window_end": "2026-09-03", "payload": json.dumps(r)}) + "\n")
    return [folder]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def gold_is_current(spark, root) -> bool:
    have, want = spark.read.parquet(L.at(root, "gold")), daily_aqi(spark.read.parquet(L.at(root, "silver")), audit=False)
    return rows(have, *GOLD_COLUMNS) == rows(want, *GOLD_COLUMNS)


def audit(spark, root) -> dict:
    out: dict = {}
    for r in spark.read.parquet(L.at(root, "audit")).orderBy("finished_at").collect():
        out.setdefault(r.run_id, []).append(r.status)
    return out


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


@pytest.fixture
def first(spark, root, dim, sample_file):
    return L.run(spark, root, dim, fixture=sample_file, run_id="first")


def test_index_of_every_day_follows_the_rule(spark, root, first):
    assert first["status"] == "success" and first["silver_inserted"] == 144 and first["gold_rows"] == 8
    hours = {}
    for site, r in zip(SITES, sample_responses()):
        h = r["hourly"]
        hours[site] = [{"ts": dt.datetime.fromisoformat(t), "pm2_5": h["pm2_5"][i], "pm10": h["pm10"][i], "no2": h["nitrogen_dioxide"][i],
                        "so2": h["sulphur_dioxide"][i], "o3": h["ozone"][i], "co": h["carbon_monoxide"][i] / 1000} for i, t in enumerate(h["time"])]
    for g in spark.read.parquet(L.at(root, "gold")).collect():
        want = brute.daily(hours[g.city_id], g.obs_date_ist)
        assert (g.aqi, g.prominent_pollutant) == (want["aqi"], want["main"])


def test_the_same_landing_again_changes_nothing(spark, root, dim, sample_file, first):
    again = L.run(spark, root, dim, landing_files=[f"{L.at(root, 'landing')}/run=first"], run_id="again")
    assert (again["bronze_rows"], again["silver_inserted"], again["silver_updated"], again["gold_rows"]) == (0, 0, 0, 0)
    checks = spark.read.parquet(L.at(root, "checks")).groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in checks} == {"first": 5, "again": 5}  # recorded although nothing changed


STEPS = ["load_bronze", "stage", "gate", "log_pending", "commit", "revisions", "publish", "published", "dimension"]


def broken(step: str):
    """A patch that lets one run fail at `step`."""
    lost = ConnectionError(step)
    if step == "load_bronze":
        return mock.patch.object(L, "load_bronze", side_effect=lost)
    if step == "stage":
        return mock.patch.object(L.upsert, "stage_merge", side_effect=lost)
    if step == "gate":
        return mock.patch.object(L.quality, "record_and_enforce", side_effect=lost)
    if step == "log_pending":
        return mock.patch.object(L, "log_pending", side_effect=lost)
    if step == "commit":
        return mock.patch.object(L.upsert.StagedMerge, "commit", side_effect=lost)
    if step == "revisions":
        return mock.patch.object(L.upsert, "revisions", side_effect=lost)
    if step == "publish":
        return mock.patch.object(L, "write_days", side_effect=lost)
    if step == "dimension":
        return mock.patch.object(L, "publish_dimension", side_effect=lost)
    append = L._append

    def fails_once(spark, root, table, rows, ddl, column):
        if table == "publish_log" and rows[0][2] == "published":
            raise lost
        return append(spark, root, table, rows, ddl, column)

    return mock.patch.object(L, "_append", side_effect=fails_once)


@pytest.mark.parametrize("step", STEPS)
def test_a_run_broken_anywhere_is_finished_by_the_next(spark, root, dim, first, step):
    files = land(root, "late", dict(zip(SITES, revised_responses())), 7)
    with broken(step), pytest.raises(ConnectionError):
        L.run(spark, root, dim, landing_files=files, run_id="late")
    assert audit(spark, root)["late"] == ["failed"]
    L.run(spark, root, dim, landing_files=files if step == "load_bronze" else [], run_id="next")
    assert gold_is_current(spark, root)
    revised = spark.read.parquet(L.at(root, "silver")).where("city_id = 'BLR' and obs_date_ist = '2026-09-03'")
    assert {r.run_id for r in revised.collect()} >= {"late"}
    assert audit(spark, root) == {"first": ["success"], "late": ["failed", "recovered"], "next": ["success"]}
    assert L.outstanding(spark, root) == ([], [])
    L.run(spark, root, dim, run_id="after")
    assert audit(spark, root)["late"] == ["failed", "recovered"]


def test_a_recovery_that_fails_is_not_called_one(spark, root, dim, first):
    files = land(root, "late", dict(zip(SITES, revised_responses())), 7)
    for run_id, given in (("late", files), ("next", [])):
        with broken("publish"), pytest.raises(ConnectionError):
            L.run(spark, root, dim, landing_files=given, run_id=run_id)
    assert "recovered" not in audit(spark, root)["late"] and not gold_is_current(spark, root)
    L.run(spark, root, dim, run_id="third")
    assert gold_is_current(spark, root) and audit(spark, root)["next"] == ["failed", "recovered"]


def checks_of(spark, root, run_id):
    return {r.check_name: (r.passed, r.observed) for r in spark.read.parquet(L.at(root, "checks")).where(F.col("run_id") == run_id).collect()}


def test_sites_and_freshness_are_those_of_silver_after_the_commit(spark, root, dim, first):
    late_hours = {"BLR": response(0, 24, START + dt.timedelta(days=9))}
    L.run(spark, root, dim, landing_files=land(root, "newer", late_hours, 12), run_id="newer", mode="backfill",
          start=dt.date(2026, 9, 10), end=dt.date(2026, 9, 10), as_of=dt.datetime(2026, 9, 11))
    assert checks_of(spark, root, "first")["all_cities_present"] == (False, "missing: 1 sites")
    assert checks_of(spark, root, "newer")["all_cities_present"] == (False, "missing: 1 sites")  # DEL isn't missing
    old_days = {"BLR": revised_responses()[0]}
    L.run(spark, root, dim, landing_files=land(root, "older", old_days, 13), run_id="older", mode="backfill",
          start=dt.date(2026, 9, 3), end=dt.date(2026, 9, 3), as_of=dt.datetime(2026, 9, 11))
    assert checks_of(spark, root, "older")["fresh_within_48h"] == (True, "latest hour 2026-09-10 23:00 UTC")


def test_live_runs_check_freshness_by_themselves(spark, root, dim, first):
    assert "fresh_within_48h" not in checks_of(spark, root, "first")
    L.run(spark, root, dim, run_id="live", mode="incremental")
    assert not checks_of(spark, root, "live")["fresh_within_48h"][0]


def test_a_blocked_gate_leaves_silver_and_gold_as_they_were(spark, root, dim, first):
    before = rows(spark.read.parquet(L.at(root, "silver")), "city_id", "ts_utc", "pm2_5"), rows(spark.read.parquet(L.at(root, "gold")), *GOLD_COLUMNS)
    bad = revised_responses()[0]
    bad["hourly"]["pm2_5"][3] = -5.0
    with pytest.raises(quality.GateBlocked) as blocked:
        L.run(spark, root, dim, landing_files=land(root, "bad", {"BLR": bad}, 7), run_id="bad")
    assert blocked.value.checks == ["no_negative_concentrations"]
    after = rows(spark.read.parquet(L.at(root, "silver")), "city_id", "ts_utc", "pm2_5"), rows(spark.read.parquet(L.at(root, "gold")), *GOLD_COLUMNS)
    assert after == before and checks_of(spark, root, "bad")["no_negative_concentrations"] == (False, "1 rows")


def test_only_changed_days_and_their_next_days_are_rewritten(spark, root, dim):
    span = {"BLR": response(0, 24 * 12)}
    L.run(spark, root, dim, landing_files=land(root, "all", span, 20), run_id="all")
    times = {r.obs_date_ist: r.computed_at for r in spark.read.parquet(L.at(root, "gold")).collect()}
    far = {"BLR": response(0, 2, dt.datetime(2026, 9, 2, 4), scale_pm25=2.0)}
    L.run(spark, root, dim, landing_files=land(root, "d2", far, 21), run_id="d2")
    near = {"BLR": response(0, 2, dt.datetime(2026, 9, 9, 4), scale_pm25=2.0)}
    both = land(root, "d9", near, 22)
    with broken("publish"), pytest.raises(ConnectionError):
        L.run(spark, root, dim, landing_files=both, run_id="d9")
    L.run(spark, root, dim, run_id="end")
    now = {r.obs_date_ist: r.computed_at for r in spark.read.parquet(L.at(root, "gold")).collect()}
    assert sorted(d.day for d in now if now[d] != times[d]) == [2, 3, 9, 10]
    assert gold_is_current(spark, root)  # the day before a changed day is read for its evening hours


def test_rebuild_replaces_silver_and_gold_whole(spark, root, dim, first, tmp_path):
    span = {"BLR": response(0, 24 * 6)}
    L.run(spark, root, dim, landing_files=land(root, "more", span, 12), run_id="more")
    bronze = spark.read.parquet(L.at(root, "bronze")).where("run_id = 'first'").collect()
    kept = spark.createDataFrame(bronze, spark.read.parquet(L.at(root, "bronze")).schema)
    kept.write.mode("overwrite").parquet(L.at(root, "bronze"))
    assert L.rebuild(spark, root, dim) == 8
    assert spark.read.parquet(L.at(root, "silver")).count() == 144 and gold_is_current(spark, root)
    assert spark.read.parquet(L.at(root, "gold")).count() == 8  # the other days are gone


@pytest.mark.parametrize("broken_rename", [1, 2, 3, 4])
def test_an_interrupted_rebuild_never_leaves_part_of_a_table(spark, root, dim, first, broken_rename):
    rename, calls = fs._rename, []

    def fails(spark, source, target):
        calls.append(source)
        if len(calls) == broken_rename:
            raise ConnectionError("rename lost")
        return rename(spark, source, target)

    with mock.patch.object(fs, "_rename", side_effect=fails), pytest.raises(ConnectionError):
        L.rebuild(spark, root, dim)
    L.run(spark, root, dim, run_id="next")
    assert spark.read.parquet(L.at(root, "silver")).count() == 144 and gold_is_current(spark, root)
    assert L.outstanding(spark, root) == ([], [])


def test_windows_and_modes(spark, root, dim, first):
    with pytest.raises(ValueError):
        L.run(spark, root, dim, mode="sometimes")
    with pytest.raises(ValueError):
        L.run(spark, root, dim, mode="backfill", start=dt.date(2026, 9, 1))
    with pytest.raises(ValueError):
        L.run(spark, root, dim, mode="backfill", start=dt.date(2026, 9, 2), end=dt.date(2026, 9, 1))
    done = L.run(spark, root, dim, mode="incremental", run_id="inc", today=dt.date(2026, 9, 9))
    assert (done["window_start"], done["window_end"]) == (dt.date(2026, 9, 2), dt.date(2026, 9, 9))
    assert spark.read.parquet(L.at(root, "audit")).where("run_id = 'inc'").first().window_start == dt.date(2026, 9, 2)


def test_a_renamed_site_is_published_without_new_hours(spark, root, dim, first):
    renamed = dim.withColumn("name", F.upper("name"))
    L.run(spark, root, renamed, run_id="renamed")
    assert {r.name for r in L.latest_aqi(spark, root).collect()} == {"BENGALURU", "DELHI"}


def test_repeated_sites_fail_and_empty_lakehouses_do_nothing(spark, root, dim):
    with pytest.raises(ValueError, match="1 city_id occur more than once"):
        L.run(spark, root, dim.union(dim.limit(1)), run_id="twice")
    assert L.run(spark, root, dim, run_id="nothing")["status"] == "success"
    assert L.rebuild(spark, root, dim) == 0


def test_the_hundred_thousandth_version_wins(spark):
    from airshed.operators.clean import silver_transform

    body = lambda v: json.dumps({"latitude": 1.0, "longitude": 2.0, "hourly": {"time": ["2026-09-01T00:00"], "pm2_5": [v]}})
    paths = [("/x/version=99999/a.json", 1.0), ("/x/version=100000/a.json", 2.0), ("/x/version=09/a.json", 3.0)]
    bronze = spark.createDataFrame([("r", dt.datetime(2026, 9, 2), "A", body(v), p) for p, v in paths],
                                   "run_id string, ingested_at timestamp_ntz, city_id string, payload string, source_path string")
    assert silver_transform(bronze, audit=False).first().pm2_5 == 2.0
