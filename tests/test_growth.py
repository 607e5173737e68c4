"""Work that would grow faster than the input: lines shuffled by their file, envelopes shuffled twice, silver shuffled twice, summaries taken twice."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from airshed.operators import quality, upsert
from airshed.operators.daily import daily_aqi
from airshed.plans import lakehouse as L
from airshed.sources import landing

from .conftest import response, sample_responses
from .test_envelopes import hourly  # noqa: F401
from .test_lakehouse import gold_is_current, land
from .test_maintenance import summary_is_current

WIDE = dict(zip(("BLR", "DEL"), sample_responses()))


@pytest.fixture
def no_small_tables(spark):
    """Joins as on large tables: nothing is broadcast for its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


def test_lines_are_not_shuffled_by_their_file(spark, root, dim, no_small_tables):
    first, more = land(root, "first", WIDE, 3), land(root, "more", {"BOM": response(1)}, 3)
    L.load_bronze(spark, first, root)
    fresh = L.fresh_lines(spark, [*first, *more], root)
    assert "SortMergeJoin" not in plan_of(fresh)
    names = {r[0] for r in landing.landing_lines(spark, more).select("source_path").collect()}
    assert {r.source_path for r in fresh.collect()} == names != set()


def test_envelopes_built_by_run_land_without_a_second_shuffle(spark, hourly, tmp_path):  # noqa: F811
    kept = hourly.where("city_id is not null and run_id is not null")
    for crowd in (1000, 15):
        by_run = landing.build_envelopes(hourly, "test", ["id"], crowd=crowd, by_run=True)
        assert rows(by_run, *by_run.columns) == rows(landing.build_envelopes(hourly, "test", ["id"]), *by_run.columns)
    env = landing.build_envelopes(kept, "test", ["id"], by_run=True)
    assert re.findall(r"Exchange (\w+)", plan_of(env))[0] == "rangepartitioning" and "hashpartitioning" not in plan_of(env)
    landing.write_landing(env, str(tmp_path / "landing"), F.col("run_id"), as_built=True)
    for run in ("r0", "r1"):
        back = landing.read_landing(spark, landing.batch_folder(str(tmp_path / "landing"), run))
        assert rows(back, "city_id", "payload", "version") == rows(env.where(F.col("run_id") == run), "city_id", "payload", "version")


def test_files_of_one_load_go_to_bronze_as_they_lie():
    mb = 1 << 20
    assert landing.are_few([("2026-09-01", 24, 24 * 2 * mb), ("2026-09-02", 4, 10)])
    assert not landing.are_few([("2026-09-01", 24, 24 * mb // 2)]) and not landing.are_few([("2026-09-01", 40, 40 * 2 * mb)])


def test_gold_of_some_site_days_shuffles_silver_once(spark, root, dim, no_small_tables):
    L.run(spark, root, dim, landing_files=land(root, "first", WIDE, 3), run_id="first")
    silver = L.stored(spark, root, "silver")
    keys = spark.createDataFrame([("BLR", dt.date(2026, 9, 2)), ("DEL", dt.date(2026, 9, 3)), (None, dt.date(2026, 9, 2))], "city_id string, obs_date_ist date")
    some = daily_aqi(silver, days=[dt.date(2026, 9, 2), dt.date(2026, 9, 3)], keys=keys, audit=False)
    want = daily_aqi(silver, audit=False).where("(city_id = 'BLR' and obs_date_ist = '2026-09-02') or (city_id = 'DEL' and obs_date_ist = '2026-09-03')")
    assert rows(some, *some.columns) == rows(want, *some.columns) and some.count() == 2
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(some))) == 2  # silver and the keys, once each


def test_pending_days_are_summarised_once(spark, root, dim, monkeypatch):
    L.load_bronze(spark, land(root, "first", WIDE, 3), root)
    L.merge_rows(spark, root, L.stored(spark, root, "bronze"), dim, "first", publish=False)
    assert L.outstanding(spark, root)[1] and not L.outstanding(spark, root, L.SUMMARIZED)[1]
    with monkeypatch.context() as m:  # the commit wrote the summary; nothing is left to do for it
        m.setattr(L, "write_summary", lambda *a: pytest.fail("summarised again"))
        L.current_summary(spark, root)
    assert summary_is_current(spark, root)
    day = dt.date(2026, 9, 2)  # a merge that was interrupted after its commit
    L.log_pending(spark, root, "broken/x", [day])
    stale = [r.asDict() | {"rows": 0} for r in L.stored(spark, root, "summary").where(F.col("obs_date_ist") == day).collect()]
    L.write_summary(spark, root, spark.createDataFrame(stale, L.stored(spark, root, "summary").schema))
    assert not summary_is_current(spark, root)
    for _ in range(2):
        L.current_summary(spark, root)
        assert summary_is_current(spark, root) and not L.outstanding(spark, root, L.SUMMARIZED)[0]
    L.run(spark, root, dim, run_id="next")
    assert L.outstanding(spark, root) == ([], []) and gold_is_current(spark, root)


def test_a_merge_reads_the_days_of_its_batch_alone(spark, root, dim, monkeypatch):
    L.run(spark, root, dim, landing_files=land(root, "first", WIDE, 3), run_id="first")
    read = []
    plain = upsert.merge_plan

    def seen(target, *a, **k):
        read.append(({r[0] for r in target.select("obs_date_ist").distinct().collect()}, plan_of(target)))
        return plain(target, *a, **k)

    monkeypatch.setattr(upsert, "merge_plan", seen)
    L.run(spark, root, dim, landing_files=land(root, "late", {"BLR": response(0, 1, dt.datetime(2026, 9, 2), scale_pm25=2.0)}, 7), run_id="late")
    (days, plan), = read
    assert days == {dt.date(2026, 9, 2)} and "PartitionFilters: [" in plan and "Join" not in plan


def test_metadata_rows_need_no_python_worker(spark, root, monkeypatch):
    frames = []
    plain = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda s, *a, **k: frames.append(plain(*a, **k)) or frames[-1])
    L.log_pending(spark, root, "m/x", [dt.date(2026, 9, 1), None])
    monkeypatch.undo()
    assert "LocalTableScan" in plan_of(frames[0]) and "RDD" not in plan_of(frames[0])
    assert rows(L.stored(spark, root, "publish_log"), "merge_id", "event") == [("m/x", "pending")] * 2


def test_row_checks_need_no_arrays(spark):
    values = ["pm2_5", "pm10", "no2", "so2", "o3", "co_mg_m3"]
    nan = float("nan")
    df = spark.createDataFrame([(1, *[None] * 6), (2, 1.0, -1.0, *[None] * 4), (3, nan, *[None] * 5), (4, 2000.0, *[1.0] * 5), (5, 2001.0, *[None] * 5),
                                (6, *[None] * 5, 200.5)], ", ".join(["i int", *(f"{c} double" for c in values)]))
    got = df.select("i", quality.any_negative().alias("n"), quality.any_implausible().alias("p"))
    assert "lambda" not in plan_of(got)
    assert {r.i: (r.n, r.p) for r in got.collect()} == {1: (False, False), 2: (True, False), 3: (False, True), 4: (False, False), 5: (False, True), 6: (False, True)}


def test_a_merge_into_new_days_joins_nothing(spark, root, dim, monkeypatch):
    L.run(spark, root, dim, landing_files=land(root, "first", WIDE, 3), run_id="first")
    with monkeypatch.context() as m:  # no stored row lies on the batch's days: there is nothing to join with
        m.setattr(upsert, "merge_plan", lambda *a, **k: pytest.fail("joined"))
        new = L.run(spark, root, dim, landing_files=land(root, "new", {"BLR": response(0, 30, dt.datetime(2026, 9, 11))}, 20), run_id="new")
    assert (new["silver_inserted"], new["silver_updated"]) == (30, 0) and L.stored(spark, root, "silver").count() == 174
    assert L.stored(spark, root, "revisions") is None and gold_is_current(spark, root) and summary_is_current(spark, root)


def test_staged_rows_are_counted_from_their_summary(spark, root, dim, monkeypatch):
    L.run(spark, root, dim, landing_files=land(root, "first", WIDE, 3), run_id="first")
    counts = []
    real = upsert.StagedMerge.commit

    def seen(self, *a):
        own = upsert.StagedMerge(spark, self.table_path, self.staged_path, self.cols, self.partition_col, self._staged)
        counts.append([(x.inserted, x.updated, x.changed_dates, sorted(x.dates)) for x in (self, own)])
        return real(self, *a)

    monkeypatch.setattr(upsert.StagedMerge, "commit", seen)
    monkeypatch.setattr(upsert.StagedMerge, "changed_keys", property(lambda self: pytest.fail("keys taken from the staged rows")), raising=False)
    late = {"BLR": response(0, 30, dt.datetime(2026, 9, 3), scale_pm25=1.5)}
    run = L.run(spark, root, dim, landing_files=land(root, "late", late, 7), run_id="late")
    days = [dt.date(2026, 9, 3), dt.date(2026, 9, 4)]
    assert counts == [[(6, 24, days, days)] * 2] and (run["silver_inserted"], run["silver_updated"]) == (6, 24)
    assert gold_is_current(spark, root) and summary_is_current(spark, root)


def test_hours_that_differ_need_no_count_by_key(spark, tmp_path, no_small_tables):
    from airshed.operators import summary

    one, day = (1.0,) * 6, dt.date(2026, 9, 1)
    ddl = "city_id string, ts_utc timestamp_ntz, obs_date_ist date, pm2_5 double, pm10 double, no2 double, so2 double, o3 double, co_mg_m3 double"
    hours = [(c, dt.datetime(2026, 9, 1, h), day, -1.0 if h == 3 else 1.0, *one[1:]) for c in "AB" for h in range(18)]
    odd = [("A", dt.datetime(2026, 9, 1, 3), day, *one), ("C", dt.datetime(2026, 9, 1, 3), day, *one), ("C", dt.datetime(2026, 9, 1, 3, 30), day, *one),
           ("D", None, day, *one), (None, dt.datetime(2026, 9, 1, 3), day, *one), (None, dt.datetime(2026, 9, 1, 3), day, *one)]
    also = {"low": F.col("pm2_5") < 0}
    for name, values in (("plain", hours), ("odd", [*hours, *odd])):
        table = spark.createDataFrame(values, ddl)
        quick, want = summary.by_hours(table, also), summary.day_summary(table, also)
        assert len(re.findall(r"Exchange hashpartitioning", plan_of(quick))) == 1
        sure = quick.where("duplicate_keys is not null")
        assert rows(sure, *want.columns) == rows(want.where(F.col("city_id").isin("B", *("A" * (name == "plain")))), *want.columns)
        summary.write_summary_of(table, str(tmp_path / name), also)
        assert rows(spark.read.parquet(str(tmp_path / name)), *want.columns) == rows(want, *want.columns)


def test_landing_files_are_read_by_several_tasks(spark, hourly, tmp_path, monkeypatch):  # noqa: F811
    env = landing.build_envelopes(hourly.where("city_id is not null and run_id is not null"), "test", ["id"], by_run=True)
    monkeypatch.setattr(landing, "LINES_A_FILE", 2)
    landing.write_landing(env.coalesce(1), str(tmp_path / "landing"), F.col("run_id"), as_built=True)
    back = landing.read_landing(spark, str(tmp_path / "landing"))
    per_file = [r["count"] for r in back.groupBy("source_path").count().collect()]
    assert max(per_file) <= 2 and len(per_file) > back.select("run_id", "ingest_date").distinct().count()
    assert rows(back, "city_id", "run_id", "payload", "version") == rows(env, "city_id", "run_id", "payload", "version")


def test_gold_of_some_site_days_is_sorted_once(spark, root, dim, no_small_tables):
    L.run(spark, root, dim, landing_files=land(root, "first", WIDE, 3), run_id="first")
    keys = spark.createDataFrame([("BLR", dt.date(2026, 9, 2))], "city_id string, obs_date_ist date")
    plan = plan_of(daily_aqi(L.stored(spark, root, "silver"), days=[dt.date(2026, 9, 2)], keys=keys, audit=False))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and len(re.findall(r"\bSort \[", plan)) == 1
