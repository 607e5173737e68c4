"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver tables.

The air-quality inputs come from the `readings` adapter view over `lineitem` (one hourly
observation per line item, one site per supplier) and the `dim_city` view over
`supplier` + `nation`; see `airshed.sources.testdata`. Every query reads whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aqi
from ..functions.breakpoints import DAILY_MEAN_POLLUTANTS, POLLUTANT_ORDER
from ..functions.numeric import TIE_TOLERANCE, round_half_up as plain_round
from ..operators import quality, serve, upsert, windows
from ..operators.clean import clean_hours, explode_hours, newest_first, parse_payload, silver_transform, to_silver
from ..operators.dedupe import latest_per_key
from ..operators.daily import GOLD_COLUMNS, SILVER_COLUMN, daily_aqi, daily_measures
from ..operators.publish import publish_dimension, replace_range
from ..operators.ranges import numbered, sliding_means
from ..functions.localtime import local_date, parse_utc_hour
from ..operators.rolling import rolling_8h_mean, with_trailing_means
from ..schemas import SILVER_COLUMNS
from ..session import checkpoint_dir
from ..sources import fs, landing, testdata
from . import oracle_sql as osql
from . import params as P

def round_half_up(c, digits: int = 0):
    """Rounding of the compared queries (see TIE_TOLERANCE)."""
    return plain_round(c, digits, TIE_TOLERANCE)


Query = Callable[[SparkSession, str], DataFrame]
SILVER_OUT = [c for c in SILVER_COLUMNS if c != "updated_at"]
VALUE_COLS = ["pm2_5", "pm10", "no2", "so2", "o3", "co_mg_m3"]


# ------------------------------------------------------------------------ shared inputs


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hourly_readings(spark: SparkSession, sf_dir: str, *, early_ingest: bool = False) -> DataFrame:
    """Readings view with silver-style grid column names and the tie-break columns."""
    return (testdata.readings(spark, sf_dir, early_ingest=early_ingest, keep_source=True)
            .withColumnRenamed("latitude", "grid_latitude")
            .withColumnRenamed("longitude", "grid_longitude"))


def silver_of(hourly: DataFrame) -> DataFrame:
    return to_silver(hourly, testdata.TIEBREAK_COLS, audit=False)


def silver_from_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_of(hourly_readings(spark, sf_dir))


def gold_of(silver: DataFrame) -> DataFrame:
    return daily_aqi(silver, audit=False, tolerance=TIE_TOLERANCE)


def envelopes(spark: SparkSession, sf_dir: str, by_run: bool = False) -> DataFrame:
    """K1 over the readings: one landing envelope per (site, run, UTC day)."""
    r = testdata.readings(spark, sf_dir, keep_source=True)
    return landing.build_envelopes(r, source="lineitem", order=testdata.TIEBREAK_COLS, by_run=by_run)


def bronze_of(env: DataFrame) -> DataFrame:
    """Envelopes typed as bronze rows (the envelope's file key stands in for the landing path)."""
    return landing.parse_envelopes(env.withColumnRenamed("_file", "source_file").withColumn("source_path", F.col("source_file")))


def merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(target, batch): silver of runs 1..4, and the deduped batch of runs 5..7."""
    h = hourly_readings(spark, sf_dir)
    target = silver_of(h.where(F.col("l_linenumber") <= P.TARGET_LAST_RUN))
    batch = silver_of(h.where(F.col("l_linenumber") > P.TARGET_LAST_RUN))
    return target, batch


def merge_plan_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = merge_inputs(spark, sf_dir)
    return upsert.merge_plan(target, batch, columns=SILVER_OUT)


def sequential_merge(spark: SparkSession, sf_dir: str, order: list[int]) -> DataFrame:
    """I5 batch by batch: merge each run's deduped rows into the state, in arrival `order`.

    All runs' batches come from one pass: a single dedupe keyed by (run, site, hour), written once,
    partitioned by run, so each batch reads its own files. Each merged state is checkpointed to
    the shared checkpoint folder, so lineage stays one merge deep and a lost executor
    recomputes one step, not the whole chain.
    """
    folder = scratch(spark, "per-run")
    clean = clean_hours(hourly_readings(spark, sf_dir))
    per_run = latest_per_key(clean, ["run_id", "city_id", "ts_utc"],
                             newest_first(testdata.TIEBREAK_COLS)).select(*SILVER_OUT)
    per_run.hint("rebalance", F.col("run_id")).withColumn("run", F.col("run_id")).write.partitionBy("run").parquet(folder)
    state = None
    for run in order:
        batch = spark.read.parquet(folder).where(F.col("run") == f"run-{run}").select(*SILVER_OUT)
        if state is None:
            state = batch.checkpoint()
            continue
        state = upsert.merged_state(upsert.merge_plan(state, batch, columns=SILVER_OUT)).checkpoint()
    return state


# ------------------------------------------------------------------------------ queries


def q_daily_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 (flagship): daily index per site and local day."""
    return gold_of(silver_from_readings(spark, sf_dir))


def q_dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 (+P5..P9): latest version per (site, UTC hour)."""
    return silver_from_readings(spark, sf_dir)


def q_silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X10 through JSON: envelopes -> parse -> explode -> clean -> dedupe."""
    return silver_transform(bronze_of(envelopes(spark, sf_dir)), audit=False)


def q_json_envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + P1..P4: every reading survives envelope -> JSON -> parse -> explode unchanged."""
    bronze = bronze_of(envelopes(spark, sf_dir))
    rows = explode_hours(parse_payload(bronze), ["city_id", "run_id", "ingested_at"])
    return rows.select("city_id", "run_id", "ingested_at", "ts_utc", "pm2_5", "pm10", "no2", "so2", "o3", "co",
                       "grid_latitude", "grid_longitude")


def q_local_day_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local (UTC+05:30) date and hour of every stored hour."""
    return silver_from_readings(spark, sf_dir).groupBy("obs_date_ist", "obs_hour_ist").agg(
        F.count("*").alias("hours"), F.min("ts_utc").alias("first_ts_utc"), F.max("ts_utc").alias("last_ts_utc"))


def q_drop_future_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ingestion inside the data span, hours after the ingestion time are dropped."""
    kept = clean_hours(hourly_readings(spark, sf_dir, early_ingest=True))
    return kept.groupBy("run_id").agg(F.count("*").alias("kept_rows"), F.max("ts_utc").alias("last_ts_utc"),
                                      F.min("ingested_at").alias("ingested_at"))


def q_rolling_8h_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing 8-hour means (>= 6 values) of O3 and CO on every hourly row."""
    rolled = rolling_8h_mean(silver_from_readings(spark, sf_dir))
    return rolled.select("city_id", "ts_utc", "obs_date_ist", round_half_up(F.col("o3_8h"), 4).alias("o3_8h"),
                         round_half_up(F.col("co_8h"), 6).alias("co_8h"))


def q_daily_hours_and_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + X3/X4 inputs: 24-h means, daily max of 8-h means, non-null hours per pollutant."""
    m = daily_measures(silver_from_readings(spark, sf_dir))
    return m.select("city_id", "obs_date_ist",
                    *[round_half_up(F.col(f"{p}_24h"), 4).alias(f"{p}_24h") for p in DAILY_MEAN_POLLUTANTS],
                    round_half_up(F.col("o3_8h_max"), 4).alias("o3_8h_max"),
                    round_half_up(F.col("co_8h_max"), 6).alias("co_8h_max"),
                    *[f"{p}_hours" for p in POLLUTANT_ORDER])


def q_sub_index_all_pollutants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 on every stored value of every pollutant."""
    silver = silver_from_readings(spark, sf_dir)
    long = silver.select(
        "city_id", "ts_utc",
        F.explode(F.array(*[F.struct(F.lit(p).alias("pollutant"), F.col(SILVER_COLUMN[p]).alias("conc"))
                            for p in POLLUTANT_ORDER])).alias("v"),
    ).select("city_id", "ts_utc", "v.pollutant", "v.conc").where(F.col("conc").isNotNull())
    si = None
    for p in POLLUTANT_ORDER:
        branch = aqi.sub_index(p, "conc", TIE_TOLERANCE)
        si = F.when(F.col("pollutant") == p, branch) if si is None else si.when(F.col("pollutant") == p, branch)
    return long.withColumn("si", si)


def q_aqi_category_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-days per category."""
    gold = gold_of(silver_from_readings(spark, sf_dir))
    return gold.groupBy("aqi_category").agg(F.count("*").alias("site_days"), F.min("aqi").alias("min_aqi"),
                                            F.max("aqi").alias("max_aqi"))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_of(silver_from_readings(spark, sf_dir))
    return serve.latest_aqi(gold, testdata.dim_city(spark, sf_dir))


def q_latest_aqi_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11: latest reported day per site with its name, worst first."""
    return _latest(spark, sf_dir)


def q_ranked_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X12 + W3 + P18: ranked report rows with pollutant labels and the table line."""
    return serve.report_rows(_latest(spark, sf_dir))


def q_dq_results_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1..Q5 + Q7: the long result table of the gate on silver."""
    return quality.run_checks(silver_from_readings(spark, sf_dir), testdata.dim_city(spark, sf_dir))


def q_dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 on cleaned rows before dedupe: every key with more than one version."""
    clean = clean_hours(hourly_readings(spark, sf_dir))
    return clean.groupBy("city_id", "ts_utc").agg(F.count("*").alias("versions")).where(F.col("versions") > 1)


def q_dq_freshness_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness against a fixed clock."""
    return quality.freshness(silver_from_readings(spark, sf_dir), P.FRESHNESS_AS_OF)


def faulty_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty readings with their hour text parsed; `co` in ug/m3."""
    return testdata.faulty_readings(spark, sf_dir).withColumn("ts_utc", parse_utc_hour(F.col("hour_text"))).drop("hour_text")


def _faulty_check(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = faulty_hours(spark, sf_dir).withColumn("co_mg_m3", F.col("co") / F.lit(1000.0))
    return quality.row_checks(rows).where(F.col("check_name") == name)


def q_dq_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: rows without site or hour among the faulty readings."""
    return _faulty_check(spark, sf_dir, "not_null_keys")


def q_dq_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 + P12 on the faulty readings."""
    return _faulty_check(spark, sf_dir, "no_negative_concentrations")


def q_dq_implausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 + P13 on the faulty readings."""
    return _faulty_check(spark, sf_dir, "plausible_concentrations")


def q_drop_all_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the faulty readings with an hour, those with a value, by run."""
    rows = faulty_hours(spark, sf_dir).where("ts_utc is not null").withColumn("row_no", F.lit(1))
    kept = clean_hours(rows).groupBy("run_id").agg(F.count("*").alias("kept"))
    return rows.groupBy("run_id").agg(F.count("*").alias("rows")).join(kept, "run_id", "left").select(
        "run_id", "rows", F.coalesce("kept", F.lit(0)).alias("kept"))


def q_drop_bad_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of the faulty readings whose text parses, by run."""
    return faulty_hours(spark, sf_dir).groupBy("run_id").agg(
        F.count("*").alias("rows"), F.count("ts_utc").alias("parsed"), F.max("ts_utc").alias("last_ts_utc"))


def q_select_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: the bronze rows of two runs, with their hours."""
    from .lakehouse import rows_of_runs

    parsed = parse_payload(rows_of_runs(bronze_of(envelopes(spark, sf_dir)), P.SELECTED_RUNS))
    return parsed.select("city_id", "run_id", F.date_format("window_start", "yyyy-MM-dd").alias("window_start"),
                         "ingested_at", F.size("p.hourly.time").cast("long").alias("hours"))


def q_dq_gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 as data: the gate over un-deduped rows is blocked by the duplicate-key check."""
    clean = clean_hours(hourly_readings(spark, sf_dir))
    d = quality.gate_decision(quality.run_checks(clean, testdata.dim_city(spark, sf_dir)))
    return d.select("may_publish", F.array_join("blocking_checks", ",").alias("blocking_checks"), "failed_checks")


def q_dq_missing_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected sites without any stored hour (one for each region has none)."""
    return quality.missing_site_rows(silver_from_readings(spark, sf_dir), testdata.sites_with_gaps(spark, sf_dir))


def q_dim_unique_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated site ids in a dimension that has some."""
    from .lakehouse import repeated_sites

    return repeated_sites(testdata.repeated_sites(spark, sf_dir))


def q_dim_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the site dimension published over an older version, and read back."""
    path = scratch(spark, "sites")
    publish_dimension(testdata.dim_city(spark, sf_dir).limit(0).select("city_id"), path)
    publish_dimension(testdata.dim_city(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_merge_upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: silver after merging runs 5..7 into runs 1..4."""
    return upsert.merged_state(merge_plan_of(spark, sf_dir), SILVER_OUT)


def q_merge_upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: rows per merge action."""
    return upsert.merge_counts(merge_plan_of(spark, sf_dir)).withColumnRenamed("_action", "action")


def q_merge_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: before-images of the rows the merge updated."""
    return upsert.revisions(merge_plan_of(spark, sf_dir))


def q_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: rows and local-date range of the batch."""
    _, batch = merge_inputs(spark, sf_dir)
    return batch.agg(F.count("*").alias("batch_rows"), F.min("obs_date_ist").alias("date_min"),
                     F.max("obs_date_ist").alias("date_max"))


def _old_new_gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target, batch = merge_inputs(spark, sf_dir)
    merged = upsert.merged_state(upsert.merge_plan(target, batch, columns=SILVER_OUT), SILVER_OUT)
    return gold_of(target), gold_of(merged)


def q_replace_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + P11: old gold with the republished range replaced by the recomputed days."""
    old, new = _old_new_gold(spark, sf_dir)
    return replace_range(old, new, P.REPLACE_START, P.REPLACE_END)


def q_late_revision_gold_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: site-days whose index changed (or appeared) after the late batch was merged."""
    old, new = _old_new_gold(spark, sf_dir)
    o = old.select("city_id", "obs_date_ist", F.col("aqi").alias("old_aqi"),
                   F.col("prominent_pollutant").alias("old_main"), F.lit(True).alias("_o"))
    n = new.select("city_id", "obs_date_ist", F.col("aqi").alias("new_aqi"),
                   F.col("prominent_pollutant").alias("new_main"), F.lit(True).alias("_n"))
    j = o.join(n, ["city_id", "obs_date_ist"], "full_outer")
    changed = ~F.col("old_aqi").eqNullSafe(F.col("new_aqi")) | F.col("_o").isNull() | F.col("_n").isNull()
    return j.where(changed).select("city_id", "obs_date_ist", "old_aqi", "new_aqi", "old_main", "new_main")


def q_incremental_merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after merging the seven runs one batch at a time, in ingestion order."""
    return sequential_merge(spark, sf_dir, P.ARRIVAL_IN_ORDER)


def q_merge_out_of_order_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches arriving out of order end at the values of a full replay."""
    state = sequential_merge(spark, sf_dir, P.ARRIVAL_OUT_OF_ORDER)
    return state.select("city_id", "ts_utc", *VALUE_COLS)


def q_incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next window from the newest stored day."""
    return windows.incremental_window(silver_from_readings(spark, sf_dir), P.TODAY, P.LOOKBACK_DAYS,
                                      P.BACKFILL_DAYS)


def q_window_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each site's stored date span split into contiguous chunks."""
    spans = silver_from_readings(spark, sf_dir).groupBy("city_id").agg(
        F.min("obs_date_ist").alias("window_start"), F.max("obs_date_ist").alias("window_end"))
    return windows.date_chunks(spans, P.CHUNK_DAYS)


def q_skip_loaded_files_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + D0: landing files not yet in bronze (bronze holds the files of runs 1..4)."""
    env = envelopes(spark, sf_dir).drop("version").withColumnRenamed("_file", "source_file")
    loaded = env.where(F.col("run_id").isin([f"run-{i}" for i in range(1, P.TARGET_LAST_RUN + 1)]))
    fresh = landing.new_files_only(env, loaded, key="source_file")
    return fresh.select("city_id", "run_id", "window_start", "source_file")


def q_landing_roundtrip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 -> files -> S1: envelopes written as JSON lines and read back FAILFAST."""
    folder = scratch(spark, "landing")
    landing.write_landing(envelopes(spark, sf_dir), folder)
    back = landing.read_landing(spark, folder)
    parsed = parse_payload(back)
    return parsed.select("city_id", "run_id", F.date_format("window_start", "yyyy-MM-dd").alias("window_start"),
                         "ingested_at", F.size("p.hourly.time").cast("long").alias("hours"))


def q_events_trailing_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 on a second table with irregular timestamps: per user, mean event value over the
    trailing 8 hours (a time-range frame), partitioned by (user, 6-hour bucket) with halo rows."""
    ev = testdata.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    ev = ev.withColumn("obs_date_ist", local_date(F.col("ts")))
    rolled = with_trailing_means(ev, {"value_8h": "value"}, hours=P.EVENT_WINDOW_HOURS,
                                 min_count=P.EVENT_MIN_COUNT, key="user_id", ts="ts",
                                 bucket_hours=P.EVENT_BUCKET_HOURS)
    return rolled.select("event_id", "user_id", "ts", round_half_up(F.col("value_8h"), 4).alias("value_8h"))


def q_stream_landing_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming (I1, I4, I5): landing files arrive in two waves (runs 1..4, then 5..7);
    each `availableNow` run of the stream picks up only the new files and applies them
    (bronze append, staged merge, gate, commit, gold). Result: silver keys and values."""
    from ..streaming import landing_stream
    from .lakehouse import at

    root = scratch(spark, "stream")
    env = envelopes(spark, sf_dir, by_run=True)
    first_wave = F.col("run_id").isin([f"run-{i}" for i in range(1, P.TARGET_LAST_RUN + 1)])
    dim = testdata.dim_city(spark, sf_dir)
    for wave in (first_wave, ~first_wave):
        landing.write_landing(env.where(wave), at(root, "landing"), as_built=True)
        landing_stream.start(spark, root, dim).awaitTermination()
    return spark.read.parquet(at(root, "silver")).select("city_id", "ts_utc", *VALUE_COLS)


def seven_run_lakehouse(spark: SparkSession, sf_dir: str) -> str:
    """Seven lakehouse runs, one per ingestion run, in order, in a new lakehouse. Returns its root."""
    from .lakehouse import at, run

    root = scratch(spark, "lake")
    landing.write_landing(envelopes(spark, sf_dir, by_run=True), at(root, "landing"), F.col("run_id"), as_built=True)  # built once, loaded run by run
    spans = {r["run_id"]: (r["s"], r["e"]) for r in testdata.readings(spark, sf_dir).groupBy("run_id").agg(  # one row for each run
        F.to_date(F.min("ts_utc")).alias("s"), F.to_date(F.max("ts_utc")).alias("e")).collect()}
    dim = testdata.dim_city(spark, sf_dir)
    for i in P.ARRIVAL_IN_ORDER:
        folder = landing.batch_folder(at(root, "landing"), f"run-{i}")
        start, end = spans.get(f"run-{i}", (P.TODAY, P.TODAY))
        run(spark, root, dim, landing_files=[folder] if fs.exists(spark, folder) else None, run_id=f"run-{i}", mode="backfill",
            start=start, end=end, as_of=P.FRESHNESS_AS_OF, tolerance=TIE_TOLERANCE)
    return root


def _gold(spark: SparkSession, root: str) -> DataFrame:
    from .lakehouse import at

    return spark.read.parquet(at(root, "gold")).select(*GOLD_COLUMNS)


def q_lakehouse_runs_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I7 (with I1, I4, I5, K2, K6): after seven lakehouse runs (each loads its landing files,
    merges, gates, commits and republishes the changed days and their next days), the published gold
    equals the daily index over all data."""
    return _gold(spark, seven_run_lakehouse(spark, sf_dir))


def q_lakehouse_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I7 + K2 + A8: the audit rows of the seven runs (window asked for, bronze rows appended, silver inserted
    and updated, gold rows republished)."""
    from .lakehouse import at

    return spark.read.parquet(at(seven_run_lakehouse(spark, sf_dir), "audit")).drop("finished_at")


def q_lakehouse_resumed_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 + I7 across a failure: the second batch is merged but its publish doesn't happen; a third run that brings
    nothing new publishes the pending site-days. Gold equals the daily index over all data."""
    from . import lakehouse as L

    root = scratch(spark, "lake")
    dim = testdata.dim_city(spark, sf_dir)
    early = F.col("run_id").isin([f"run-{i}" for i in range(1, P.TARGET_LAST_RUN + 1)])
    live = {"as_of": P.FRESHNESS_AS_OF, "mode": "incremental", "today": P.TODAY, "tolerance": TIE_TOLERANCE}
    env = envelopes(spark, sf_dir, by_run=True).where("run_id is not null").withColumn("run_id", F.when(early, "early").otherwise("late"))
    landing.write_landing(env, L.at(root, "landing"), F.col("run_id"), as_built=True)  # built once, loaded batch by batch
    for name in ("early", "late"):
        folder = landing.batch_folder(L.at(root, "landing"), name)
        if name == "early":
            L.run(spark, root, dim, landing_files=[folder], run_id=name, **live)
            continue
        L.load_bronze(spark, [folder], root)
        rows = L.rows_of_runs(L.stored(spark, root, "bronze"), [name])
        L.merge_rows(spark, root, rows, dim, name, P.FRESHNESS_AS_OF, tolerance=TIE_TOLERANCE, publish=False)
    L.run(spark, root, dim, run_id="resume", **live)
    return _gold(spark, root)


def q_lakehouse_run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1..Q8 in runs: the check table of two runs, the first with half of the sites and the second with the rest."""
    from . import lakehouse as L

    root = scratch(spark, "lake")
    rows = testdata.readings(spark, sf_dir, keep_source=True)
    dim = testdata.dim_city(spark, sf_dir)
    first = F.expr(P.FIRST_SITES_SQL)
    for i, part in enumerate((first, ~first), 1):
        folder = f"{L.at(root, 'landing')}/sites-{i}"
        env = landing.build_envelopes(rows.where(part), source="lineitem", order=testdata.TIEBREAK_COLS, by_run=True)
        landing.write_landing(env.withColumn("run_id", F.concat(F.col("run_id"), F.lit(f"-{i}"))), folder, as_built=True)
        # the bronze rows keep their own run ids; the run merges all that was landed for it
        L.load_bronze(spark, [folder], root)
        bronze = L.stored(spark, root, "bronze").where(F.col("run_id").endswith(f"-{i}"))
        L.merge_rows(spark, root, bronze, dim, f"sites-{i}", P.FRESHNESS_AS_OF, tolerance=TIE_TOLERANCE)
    return spark.read.parquet(L.at(root, "checks")).drop("checked_at")


def two_batches(spark: SparkSession, sf_dir: str) -> str:
    """A lakehouse of two runs: the early ingestion runs, then the late ones of some sites. Returns its root."""
    from . import lakehouse as L

    root = scratch(spark, "lake")
    rows = testdata.readings(spark, sf_dir, keep_source=True)
    dim = testdata.dim_city(spark, sf_dir)
    early = F.col("l_linenumber") <= P.TARGET_LAST_RUN
    for name, part in (("early", early), ("late", ~early & F.expr(P.LATE_SITES_SQL))):
        folder = f"{L.at(root, 'landing')}/{name}"
        env = landing.build_envelopes(rows.where(part), source="lineitem", order=testdata.TIEBREAK_COLS, by_run=True)
        landing.write_landing(env.withColumn("run_id", F.lit(name)), folder, as_built=True)
        L.run(spark, root, dim, landing_files=[folder], run_id=name, tolerance=TIE_TOLERANCE)
    return root


def q_gold_delta_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 + K6 by key: gold after the late batch of some sites, and which rows that run computed: the changed site-days and their
    next days; all other rows of the same days keep their time."""
    from . import lakehouse as L

    root = two_batches(spark, sf_dir)
    first = L.run_times(spark, root)["early"]
    gold = L.stored(spark, root, "gold")
    return gold.select("city_id", "obs_date_ist", "aqi", "prominent_pollutant", (F.col("computed_at") > F.lit(first)).alias("recomputed"))


def q_gate_from_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1..Q7 + A6 over all of silver after two runs, read from the summary that their commits kept up to date."""
    from . import lakehouse as L

    return L.full_checks(spark, two_batches(spark, sf_dir), testdata.dim_city(spark, sf_dir), P.FRESHNESS_AS_OF)


def q_silver_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: silver as it was at the end of each of the seven runs, read after the last."""
    from . import lakehouse as L

    root = seven_run_lakehouse(spark, sf_dir)
    return L.silver_as_of(spark, root, L.run_times(spark, root)).select("as_of", "city_id", "ts_utc", "run_id", *VALUE_COLS)


def q_rebuild_to_empty_then_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I6 + S6 + K3: bronze holds forecasts only, so a rebuild leaves tables without a row; the next run merges all readings into them."""
    from . import lakehouse as L

    root = scratch(spark, "lake")
    rows = testdata.readings(spark, sf_dir, keep_source=True)
    dim = testdata.dim_city(spark, sf_dir)
    before = rows.withColumn("ingested_at", F.expr("timestampadd(YEAR, -1, ingested_at)"))
    for name, part in (("forecasts", before), ("readings", rows)):
        folder = f"{L.at(root, 'landing')}/{name}"
        env = landing.build_envelopes(part, source="lineitem", order=testdata.TIEBREAK_COLS, by_run=True)
        landing.write_landing(env, folder, as_built=True)
        if name == "forecasts":
            L.load_bronze(spark, [folder], root)
            L.rebuild(spark, root, dim, tolerance=TIE_TOLERANCE)
            continue
        L.load_bronze(spark, [folder], root)
        L.merge_rows(spark, root, L.stored(spark, root, "bronze"), dim, name, tolerance=TIE_TOLERANCE)
    return _gold(spark, root)


def q_events_hot_user_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 with a hot key: a third of all events belong to one user; the sliding means are taken by ranges of (user, time)."""
    ev = testdata.table(spark, sf_dir, "events").select("event_id", F.expr(P.HOT_USER_SQL).alias("user_id"), "ts", "value")
    means = sliding_means(ev, {"value_8h": "value"}, hours=P.EVENT_WINDOW_HOURS, min_count=P.EVENT_MIN_COUNT, key="user_id", ts="ts")
    return means.select("event_id", "user_id", "ts", round_half_up(F.col("value_8h"), 4).alias("value_8h"))


def q_events_numbered_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 at scale: the place of every event among all by kind, and among its kind by value, numbered by ranges."""
    ev = testdata.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    overall = numbered(ev, [F.col("event_type"), F.col("event_id")], "place")
    return numbered(overall, [-F.col("value"), F.col("event_id")], "place_in_type", ["event_type"])


def q_rebuild_equals_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver keys and values after seven runs and a rebuild from bronze."""
    from . import lakehouse as L

    root = seven_run_lakehouse(spark, sf_dir)
    L.rebuild(spark, root, testdata.dim_city(spark, sf_dir), tolerance=TIE_TOLERANCE)
    return spark.read.parquet(L.at(root, "silver")).select("city_id", "ts_utc", *VALUE_COLS)


QUERIES: dict[str, tuple[Query, Callable[[], str] | None]] = {
    "daily_aqi": (q_daily_aqi, osql.daily_aqi),
    "dedupe_latest": (q_dedupe_latest, osql.dedupe_latest),
    "silver_transform": (q_silver_transform, osql.silver_transform),
    "json_envelope_roundtrip": (q_json_envelope_roundtrip, osql.json_envelope_roundtrip),
    "landing_roundtrip_counts": (q_landing_roundtrip_counts, osql.landing_roundtrip_counts),
    "local_day_hour": (q_local_day_hour, osql.local_day_hour),
    "drop_future_hours": (q_drop_future_hours, osql.drop_future_hours),
    "rolling_8h_mean": (q_rolling_8h_mean, osql.rolling_8h_mean),
    "daily_hours_and_means": (q_daily_hours_and_means, osql.daily_hours_and_means),
    "sub_index_all_pollutants": (q_sub_index_all_pollutants, osql.sub_index_all_pollutants),
    "aqi_category_dist": (q_aqi_category_dist, osql.aqi_category_dist),
    "latest_aqi_ranked": (q_latest_aqi_ranked, osql.latest_aqi_ranked),
    "ranked_report_rows": (q_ranked_report_rows, osql.ranked_report_rows),
    "dq_results_long": (q_dq_results_long, osql.dq_results_long),
    "dq_duplicate_keys": (q_dq_duplicate_keys, osql.dq_duplicate_keys),
    "dq_freshness_asof": (q_dq_freshness_asof, osql.dq_freshness_asof),
    "dq_gate_decision": (q_dq_gate_decision, osql.dq_gate_decision),
    "dq_missing_cities": (q_dq_missing_cities, osql.dq_missing_cities),
    "dim_unique_key_check": (q_dim_unique_key_check, osql.dim_unique_key_check),
    "dim_publish": (q_dim_publish, osql.dim_publish),
    "merge_upsert_state": (q_merge_upsert_state, osql.merge_upsert_state),
    "merge_upsert_actions": (q_merge_upsert_actions, osql.merge_upsert_actions),
    "merge_revisions": (q_merge_revisions, osql.merge_revisions),
    "batch_stats": (q_batch_stats, osql.batch_stats),
    "replace_date_range": (q_replace_date_range, osql.replace_date_range),
    "late_revision_gold_delta": (q_late_revision_gold_delta, osql.late_revision_gold_delta),
    "incremental_merge_state": (q_incremental_merge_state, osql.incremental_merge_state),
    "merge_out_of_order_values": (q_merge_out_of_order_values, osql.merge_out_of_order_values),
    "incremental_window": (q_incremental_window, osql.incremental_window),
    "window_chunks": (q_window_chunks, osql.window_chunks),
    "skip_loaded_files_anti": (q_skip_loaded_files_anti, osql.skip_loaded_files_anti),
    "events_trailing_mean": (q_events_trailing_mean, osql.events_trailing_mean),
    "stream_landing_silver": (q_stream_landing_silver, osql.stream_landing_silver),
    "lakehouse_runs_gold": (q_lakehouse_runs_gold, osql.daily_aqi),
    "lakehouse_run_audit": (q_lakehouse_run_audit, osql.lakehouse_run_audit),
    "lakehouse_resumed_gold": (q_lakehouse_resumed_gold, osql.daily_aqi),
    "lakehouse_run_checks": (q_lakehouse_run_checks, osql.lakehouse_run_checks),
    "rebuild_equals_incremental": (q_rebuild_equals_incremental, osql.rebuild_equals_incremental),
    "gold_delta_by_key": (q_gold_delta_by_key, osql.gold_delta_by_key),
    "gate_from_summary": (q_gate_from_summary, osql.gate_from_summary),
    "silver_as_of": (q_silver_as_of, osql.silver_as_of),
    "rebuild_to_empty_then_run": (q_rebuild_to_empty_then_run, osql.daily_aqi),
    "events_hot_user_mean": (q_events_hot_user_mean, osql.events_hot_user_mean),
    "events_numbered_by_value": (q_events_numbered_by_value, osql.events_numbered_by_value),
    "dq_null_keys": (q_dq_null_keys, lambda: osql.dq_faulty("not_null_keys")),
    "dq_negative": (q_dq_negative, lambda: osql.dq_faulty("no_negative_concentrations")),
    "dq_implausible": (q_dq_implausible, lambda: osql.dq_faulty("plausible_concentrations")),
    "drop_all_null_rows": (q_drop_all_null_rows, osql.drop_all_null_rows),
    "drop_bad_timestamps": (q_drop_bad_timestamps, osql.drop_bad_timestamps),
    "select_run_rows": (q_select_run_rows, osql.select_run_rows),
}


def queries() -> dict[str, Query]:
    return {k: q for k, (q, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: o() for k, (_, o) in QUERIES.items() if o is not None}
