"""SQL text of the registered queries for the DuckDB check (driver tables pre-registered as views).

Each rule is written out here on its own, in its plain form (the sub-indices band by band, the 8-hour
mean as one RANGE window per site, the merge as one full outer join per batch); nothing is taken from
`airshed.functions` or from the operators.
"""

from __future__ import annotations

from ..sources.testdata import DIM_CITY_SQL, TIEBREAK_COLS, faulty_sql, readings_sql
from . import params as P

# ---------------------------------------------------------------------------------------
# Fixed values (published method): index by concentration, band by band.
SUB_INDEX = {
    "pm2_5": """CASE WHEN {c} <= 30 THEN 50.0 * {c} / 30 WHEN {c} <= 60 THEN 51 + 49.0 * ({c} - 31) / 29
      WHEN {c} <= 90 THEN 101 + 99.0 * ({c} - 61) / 29 WHEN {c} <= 120 THEN 201 + 99.0 * ({c} - 91) / 29
      WHEN {c} <= 250 THEN 301 + 99.0 * ({c} - 121) / 129 ELSE 401 + 99.0 * ({c} - 250) / 250 END""",
    "pm10": """CASE WHEN {c} <= 50 THEN {c} WHEN {c} <= 100 THEN 51 + 49.0 * ({c} - 51) / 49
      WHEN {c} <= 250 THEN 101 + 99.0 * ({c} - 101) / 149 WHEN {c} <= 350 THEN 201 + 99.0 * ({c} - 251) / 99
      WHEN {c} <= 430 THEN 301 + 99.0 * ({c} - 351) / 79 ELSE 401 + 99.0 * ({c} - 430) / 430 END""",
    "no2": """CASE WHEN {c} <= 40 THEN 50.0 * {c} / 40 WHEN {c} <= 80 THEN 51 + 49.0 * ({c} - 41) / 39
      WHEN {c} <= 180 THEN 101 + 99.0 * ({c} - 81) / 99 WHEN {c} <= 280 THEN 201 + 99.0 * ({c} - 181) / 99
      WHEN {c} <= 400 THEN 301 + 99.0 * ({c} - 281) / 119 ELSE 401 + 99.0 * ({c} - 400) / 400 END""",
    "so2": """CASE WHEN {c} <= 40 THEN 50.0 * {c} / 40 WHEN {c} <= 80 THEN 51 + 49.0 * ({c} - 41) / 39
      WHEN {c} <= 380 THEN 101 + 99.0 * ({c} - 81) / 299 WHEN {c} <= 800 THEN 201 + 99.0 * ({c} - 381) / 419
      WHEN {c} <= 1600 THEN 301 + 99.0 * ({c} - 801) / 799 ELSE 401 + 99.0 * ({c} - 1600) / 1600 END""",
    "o3": """CASE WHEN {c} <= 50 THEN {c} WHEN {c} <= 100 THEN 51 + 49.0 * ({c} - 51) / 49
      WHEN {c} <= 168 THEN 101 + 99.0 * ({c} - 101) / 67 WHEN {c} <= 208 THEN 201 + 99.0 * ({c} - 169) / 39
      WHEN {c} <= 748 THEN 301 + 99.0 * ({c} - 209) / 539 ELSE 401 + 99.0 * ({c} - 748) / 748 END""",
    "co": """CASE WHEN {c} <= 1 THEN 50.0 * {c} WHEN {c} <= 2 THEN 51 + 49.0 * ({c} - 1.1) / 0.9
      WHEN {c} <= 10 THEN 101 + 99.0 * ({c} - 2.1) / 7.9 WHEN {c} <= 17 THEN 201 + 99.0 * ({c} - 10) / 7
      WHEN {c} <= 34 THEN 301 + 99.0 * ({c} - 17) / 17 ELSE 401 + 99.0 * ({c} - 34) / 34 END""",
}
CATEGORY = """CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Satisfactory' WHEN aqi <= 200 THEN 'Moderate'
      WHEN aqi <= 300 THEN 'Poor' WHEN aqi <= 400 THEN 'Very Poor' WHEN aqi <= 500 THEN 'Severe' END"""
POLLUTANT_ORDER = ["pm2_5", "pm10", "no2", "so2", "o3", "co"]
DAILY_MEAN_POLLUTANTS = ["pm2_5", "pm10", "no2", "so2"]
LABELS = "WHEN 'pm2_5' THEN 'PM2.5' WHEN 'pm10' THEN 'PM10' WHEN 'no2' THEN 'NO2' WHEN 'so2' THEN 'SO2' WHEN 'o3' THEN 'O3' WHEN 'co' THEN 'CO'"
TOO_HIGH = "pm2_5 > 2000 OR pm10 > 3000 OR no2 > 2000 OR so2 > 3000 OR o3 > 2000 OR co_mg_m3 > 200"
# End of fixed values.
# ---------------------------------------------------------------------------------------


def rnd(expr: str, digits: int) -> str:
    """Half up to `digits`; sums in another order may differ by 1e-7, which counts as the tie in compared queries."""
    return f"floor(({expr}) * 1e{digits} + 0.5 + 1e-7) / 1e{digits}"


def index_of(pollutant: str, conc: str) -> str:
    raw = "CAST(" + SUB_INDEX[pollutant].format(c=f"({conc})") + " AS DOUBLE)"
    return f"CASE WHEN ({conc}) IS NOT NULL THEN CAST(floor(greatest(0, least(500, {raw})) + 0.5 + 1e-7) AS INTEGER) END"


VALUES = ["pm2_5", "pm10", "no2", "so2", "o3"]
VALUE_COLS = ["pm2_5", "pm10", "no2", "so2", "o3", "co_mg_m3"]
SILVER_OUT = ["city_id", "ts_utc", "obs_date_ist", "obs_hour_ist", *VALUE_COLS, "grid_latitude", "grid_longitude",
              "run_id", "ingested_at"]
SILVER_SEL = ", ".join(SILVER_OUT)
COLUMN_OF = {"pm2_5": "pm2_5", "pm10": "pm10", "no2": "no2", "so2": "so2", "o3": "o3", "co": "co_mg_m3"}


def _d(day) -> str:
    return f"DATE '{day.isoformat()}'"


def clean_cte(source: str = "readings") -> str:
    """P5..P9 (keeps tie-break columns and the line number)."""
    nan = ", ".join(f"CASE WHEN NOT isnan({c}) THEN {c} END AS {c}" for c in VALUES)
    tb = ", ".join(TIEBREAK_COLS)
    return f"""SELECT city_id, ts_utc, run_id, ingested_at, {tb}, l_linenumber, {nan},
    CASE WHEN NOT isnan(co) THEN co END / 1000.0::DOUBLE AS co_mg_m3,
    latitude AS grid_latitude, longitude AS grid_longitude,
    CAST(ts_utc + INTERVAL 330 MINUTE AS DATE) AS obs_date_ist,
    CAST(hour(ts_utc + INTERVAL 330 MINUTE) AS INTEGER) AS obs_hour_ist
  FROM {source}
  WHERE ts_utc IS NOT NULL AND ts_utc <= ingested_at
    AND coalesce(pm2_5, pm10, no2, so2, o3, co) IS NOT NULL"""


def newest_first_sql() -> str:
    return "ingested_at DESC, run_id DESC, " + ", ".join(f"{c} DESC" for c in TIEBREAK_COLS)


def dedupe_sql(source: str = "clean", where: str = "TRUE") -> str:
    return f"""SELECT {SILVER_SEL} FROM (
    SELECT *, row_number() OVER (PARTITION BY city_id, ts_utc ORDER BY {newest_first_sql()}) AS _rank
    FROM {source} WHERE {where}) WHERE _rank = 1"""


def base_ctes(early_ingest: bool = False) -> str:
    return (f"readings AS ({readings_sql(early_ingest=early_ingest, keep_source=True)}),\n"
            f"clean AS ({clean_cte()}),\nsilver AS ({dedupe_sql()})")


def rolled_sql(source: str = "silver") -> str:
    frame = "(PARTITION BY city_id ORDER BY ts_utc RANGE BETWEEN INTERVAL 7 HOUR PRECEDING AND CURRENT ROW)"
    return f"""SELECT *,
    CASE WHEN count(o3) OVER {frame} >= 6 THEN avg(o3) OVER {frame} END AS o3_8h,
    CASE WHEN count(co_mg_m3) OVER {frame} >= 6 THEN avg(co_mg_m3) OVER {frame} END AS co_8h
  FROM {source}"""


def measures_sql(source: str = "rolled") -> str:
    means = ", ".join(f"avg({p}) AS {p}_24h" for p in DAILY_MEAN_POLLUTANTS)
    hours = ", ".join(f"count({COLUMN_OF[p]}) AS {p}_hours" for p in POLLUTANT_ORDER)
    return f"""SELECT city_id, obs_date_ist, {means}, max(o3_8h) AS o3_8h_max, max(co_8h) AS co_8h_max, {hours}
  FROM {source} GROUP BY city_id, obs_date_ist"""


def scored_sql(source: str = "measures") -> str:
    value = {p: f"{p}_24h" for p in DAILY_MEAN_POLLUTANTS} | {"o3": "o3_8h_max", "co": "co_8h_max"}
    si_defs = ", ".join(f"CASE WHEN {p}_hours >= 16 THEN {index_of(p, value[p])} END AS si_{p}" for p in POLLUTANT_ORDER)
    rounded = ", ".join(f"{rnd(f'{p}_24h', 2)} AS {p}_24h" for p in DAILY_MEAN_POLLUTANTS)
    return f"""SELECT city_id, obs_date_ist, aqi, {CATEGORY} AS aqi_category,
    CASE aqi WHEN si_pm2_5 THEN 'pm2_5' WHEN si_pm10 THEN 'pm10' WHEN si_no2 THEN 'no2' WHEN si_so2 THEN 'so2'
      WHEN si_o3 THEN 'o3' WHEN si_co THEN 'co' END AS prominent_pollutant, reported AS pollutants_reported,
    {rounded}, {rnd('o3_8h_max', 2)} AS o3_8h_max,
    {rnd('co_8h_max', 3)} AS co_8h_max_mg_m3,
    {', '.join(f'si_{p}' for p in POLLUTANT_ORDER)},
    {', '.join(f'{p}_hours' for p in POLLUTANT_ORDER)}
  FROM (SELECT *, CASE WHEN reported >= 3 AND coalesce(si_pm2_5, si_pm10) IS NOT NULL
      THEN list_max([si_pm2_5, si_pm10, si_no2, si_so2, si_o3, si_co]) END AS aqi
    FROM (SELECT *, CAST(len(list_filter([si_pm2_5, si_pm10, si_no2, si_so2, si_o3, si_co], lambda x: x IS NOT NULL)) AS INTEGER) AS reported
      FROM (SELECT *, {si_defs} FROM {source})))"""


def gold_ctes(name: str, silver: str) -> str:
    """`{name}` = daily index over silver CTE `silver`."""
    return (f"{name}_rolled AS ({rolled_sql(silver)}),\n{name}_measures AS ({measures_sql(name + '_rolled')}),\n"
            f"{name} AS ({scored_sql(name + '_measures')})")


DIM = f"dim_city AS ({DIM_CITY_SQL})"


def merge_sql(target: str, batch: str) -> str:
    """K4 as one full outer join: merged rows with _action and before-images."""
    non_key = [c for c in SILVER_OUT if c not in ("city_id", "ts_utc")]
    changed = " OR ".join(f"t.{c} IS DISTINCT FROM b.{c}" for c in VALUE_COLS)
    action = f"""CASE WHEN t.city_id IS NULL THEN 'insert' WHEN b.city_id IS NULL THEN 'keep'
      WHEN b.ingested_at > t.ingested_at AND ({changed}) THEN 'update' ELSE 'unchanged' END"""
    inner = f"""SELECT t.city_id AS t_city, t.ts_utc AS t_ts, b.city_id AS b_city, b.ts_utc AS b_ts, {action} AS _action,
      {', '.join(f't.{c} AS t_{c}, b.{c} AS b_{c}' for c in non_key)}
    FROM {target} t FULL OUTER JOIN {batch} b ON t.city_id = b.city_id AND t.ts_utc = b.ts_utc"""
    take = "_action IN ('insert', 'update')"
    cols = ", ".join(f"CASE WHEN {take} THEN b_{c} ELSE t_{c} END AS {c}" for c in non_key)
    old = ", ".join(f"CASE WHEN _action = 'update' THEN t_{c} END AS _old_{c}" for c in non_key)
    return f"""SELECT coalesce(t_city, b_city) AS city_id, coalesce(t_ts, b_ts) AS ts_utc, {cols}, _action, {old}
  FROM ({inner})"""


def merge_ctes() -> str:
    t = f"l_linenumber <= {P.TARGET_LAST_RUN}"
    b = f"l_linenumber > {P.TARGET_LAST_RUN}"
    return (base_ctes() + f",\ntarget AS ({dedupe_sql('clean', t)}),\nbatch AS ({dedupe_sql('clean', b)}),\n"
            f"plan AS ({merge_sql('target', 'batch')}),\nmerged AS (SELECT {SILVER_SEL} FROM plan)")


# ------------------------------------------------------------------------------ queries


def daily_aqi() -> str:
    return f"WITH {base_ctes()},\n{gold_ctes('gold', 'silver')}\nSELECT * FROM gold"


def dedupe_latest() -> str:
    return f"WITH {base_ctes()}\nSELECT * FROM silver"


def silver_transform() -> str:
    return dedupe_latest()


def json_envelope_roundtrip() -> str:
    return f"""WITH readings AS ({readings_sql()})
SELECT city_id, run_id, ingested_at, ts_utc, pm2_5, pm10, no2, so2, o3, co,
  latitude AS grid_latitude, longitude AS grid_longitude FROM readings"""


def local_day_hour() -> str:
    return f"""WITH {base_ctes()}
SELECT obs_date_ist, obs_hour_ist, count(*) AS hours, min(ts_utc) AS first_ts_utc, max(ts_utc) AS last_ts_utc
FROM silver GROUP BY obs_date_ist, obs_hour_ist"""


def drop_future_hours() -> str:
    return f"""WITH readings AS ({readings_sql(early_ingest=True, keep_source=True)}), clean AS ({clean_cte()})
SELECT run_id, count(*) AS kept_rows, max(ts_utc) AS last_ts_utc, min(ingested_at) AS ingested_at
FROM clean GROUP BY run_id"""


def rolling_8h_mean() -> str:
    return f"""WITH {base_ctes()}, rolled AS ({rolled_sql()})
SELECT city_id, ts_utc, obs_date_ist, {rnd('o3_8h', 4)} AS o3_8h, {rnd('co_8h', 6)} AS co_8h FROM rolled"""


def daily_hours_and_means() -> str:
    hours = ", ".join(f"{p}_hours" for p in POLLUTANT_ORDER)
    means = ", ".join(f"{rnd(f'{p}_24h', 4)} AS {p}_24h" for p in DAILY_MEAN_POLLUTANTS)
    return f"""WITH {base_ctes()}, rolled AS ({rolled_sql()}), measures AS ({measures_sql()})
SELECT city_id, obs_date_ist, {means}, {rnd('o3_8h_max', 4)} AS o3_8h_max, {rnd('co_8h_max', 6)} AS co_8h_max,
  {hours} FROM measures"""


def sub_index_all_pollutants() -> str:
    parts = []
    for p in POLLUTANT_ORDER:
        c = COLUMN_OF[p]
        parts.append(f"SELECT city_id, ts_utc, '{p}' AS pollutant, {c} AS conc, {index_of(p, c)} AS si "
                     f"FROM silver WHERE {c} IS NOT NULL")
    return f"WITH {base_ctes()}\n" + "\nUNION ALL\n".join(parts)


def aqi_category_dist() -> str:
    return f"""WITH {base_ctes()},\n{gold_ctes('gold', 'silver')}
SELECT aqi_category, count(*) AS site_days, min(aqi) AS min_aqi, max(aqi) AS max_aqi
FROM gold GROUP BY aqi_category"""


def latest_aqi_sql_ctes() -> str:
    return f"""{base_ctes()},\n{gold_ctes('gold', 'silver')},\n{DIM},
reported AS (SELECT * FROM gold WHERE aqi IS NOT NULL),
latest_day AS (SELECT city_id, max(obs_date_ist) AS obs_date_ist FROM reported GROUP BY city_id),
latest AS (SELECT d.name, r.obs_date_ist, r.aqi, r.aqi_category, r.prominent_pollutant, r.pm2_5_24h, r.pm10_24h
  FROM reported r JOIN latest_day l ON r.city_id = l.city_id AND r.obs_date_ist = l.obs_date_ist
  JOIN dim_city d ON r.city_id = d.city_id)"""


def latest_aqi_ranked() -> str:
    return f"WITH {latest_aqi_sql_ctes()}\nSELECT * FROM latest"


def ranked_report_rows() -> str:
    return f"""WITH {latest_aqi_sql_ctes()},
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY aqi DESC, name) AS INTEGER) AS rank,
  coalesce(CASE prominent_pollutant {LABELS} END, prominent_pollutant) AS main_pollutant_label FROM latest)
SELECT *, printf('| %d | %s | %s | **%d** | %s | %s | %s | %s |', rank, name, CAST(obs_date_ist AS VARCHAR),
  aqi, aqi_category, main_pollutant_label, CAST(pm2_5_24h AS VARCHAR), CAST(pm10_24h AS VARCHAR)) AS line FROM ranked"""


def _row_checks(source: str) -> tuple[str, str]:
    negative = " OR ".join(f"{c} < 0" for c in VALUE_COLS)
    stats = f"""SELECT count(*) FILTER (WHERE city_id IS NULL OR ts_utc IS NULL) AS null_keys,
    count(*) FILTER (WHERE {negative}) AS negative, count(*) FILTER (WHERE {TOO_HIGH}) AS implausible FROM {source}"""
    return stats, """SELECT 'not_null_keys' AS check_name, 'critical' AS severity, null_keys = 0 AS passed, null_keys || ' rows' AS observed FROM stats
UNION ALL SELECT 'no_negative_concentrations', 'critical', negative = 0, negative || ' rows' FROM stats
UNION ALL SELECT 'plausible_concentrations', 'warning', implausible = 0, implausible || ' rows' FROM stats"""


def _fresh(source: str, as_of) -> str:
    ts = f"TIMESTAMP '{as_of.isoformat(sep=' ')}'"
    return f"""SELECT 'fresh_within_48h' AS check_name, 'warning' AS severity, coalesce(max(ts_utc) >= {ts} - INTERVAL 48 HOUR, false) AS passed,
  'latest hour ' || coalesce(strftime(max(ts_utc), '%Y-%m-%d %H:%M'), 'NULL') || ' UTC' AS observed FROM {source}"""


def _dq_all(source: str) -> str:
    stats, rows = _row_checks(source)
    return f"""stats AS ({stats}),
dupes AS (SELECT count(*) AS n FROM (SELECT city_id, ts_utc FROM {source} GROUP BY city_id, ts_utc HAVING count(*) > 1)),
missing AS (SELECT d.city_id FROM (SELECT DISTINCT city_id FROM dim_city) d
  WHERE d.city_id NOT IN (SELECT DISTINCT city_id FROM {source} WHERE city_id IS NOT NULL)),
results AS ({rows}
UNION ALL SELECT 'unique_city_hour', 'critical', n = 0, n || ' duplicate keys' FROM dupes
UNION ALL SELECT 'all_cities_present', 'warning', count(*) = 0, 'missing: ' || count(*) || ' sites' FROM missing)"""


def dq_results_long() -> str:
    return f"WITH {base_ctes()},\n{DIM},\n{_dq_all('silver')}\nSELECT * FROM results"


def dq_duplicate_keys() -> str:
    return f"""WITH {base_ctes()}
SELECT city_id, ts_utc, count(*) AS versions FROM clean GROUP BY city_id, ts_utc HAVING count(*) > 1"""


def dq_freshness_asof() -> str:
    return f"WITH {base_ctes()}\n{_fresh('silver', P.FRESHNESS_AS_OF)}"


FAULTY = f"faulty AS (SELECT *, co / 1000.0 AS co_mg_m3 FROM ({faulty_sql()}))"


def dq_faulty(check: str) -> str:
    stats, rows = _row_checks("faulty")
    return f"WITH {FAULTY},\nstats AS ({stats}),\nr AS ({rows})\nSELECT * FROM r WHERE check_name = '{check}'"


def drop_all_null_rows() -> str:
    return f"""WITH {FAULTY}
SELECT run_id, count(*) AS rows, count(*) FILTER (WHERE NOT empty) AS kept FROM (
  SELECT run_id, coalesce(pm2_5, pm10, no2, so2, CASE WHEN NOT isnan(o3) THEN o3 END, co) IS NULL AS empty
  FROM faulty WHERE ts_utc IS NOT NULL) GROUP BY run_id"""


def drop_bad_timestamps() -> str:
    return f"WITH {FAULTY}\nSELECT run_id, count(*) AS rows, count(ts_utc) AS parsed, max(ts_utc) AS last_ts_utc FROM faulty GROUP BY run_id"


def select_run_rows() -> str:
    runs = ", ".join(f"'{r}'" for r in P.SELECTED_RUNS)
    return f"""WITH {_envelopes_sql()}
SELECT city_id, run_id, strftime(d, '%Y-%m-%d') AS window_start, ingested_at, hours FROM envelopes WHERE run_id IN ({runs})"""


def dq_gate_decision() -> str:
    return f"""WITH {base_ctes()},\n{DIM},\n{_dq_all('clean')}
SELECT count(*) FILTER (WHERE severity = 'critical' AND NOT passed) = 0 AS may_publish,
  coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (WHERE severity = 'critical' AND NOT passed), '')
    AS blocking_checks,
  count(*) FILTER (WHERE NOT passed) AS failed_checks
FROM results"""


def dq_missing_cities() -> str:
    return f"""WITH {base_ctes()},\n{DIM}
SELECT city_id FROM (SELECT city_id FROM dim_city UNION SELECT 'R' || r_regionkey FROM region) d
WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.city_id = d.city_id)"""


def dim_unique_key_check() -> str:
    return f"""WITH {DIM}
SELECT city_id, count(*) AS n FROM (SELECT city_id FROM dim_city UNION ALL SELECT 'C' || n_nationkey FROM nation)
GROUP BY city_id HAVING count(*) > 1"""


def dim_publish() -> str:
    return f"WITH {DIM}\nSELECT * FROM dim_city"


def merge_upsert_state() -> str:
    return f"WITH {merge_ctes()}\nSELECT * FROM merged"


def merge_upsert_actions() -> str:
    return f"WITH {merge_ctes()}\nSELECT _action AS action, count(*) AS rows FROM plan GROUP BY _action"


def merge_revisions() -> str:
    old = [c for c in SILVER_OUT if c not in ("city_id", "ts_utc")]
    return f"""WITH {merge_ctes()}
SELECT city_id, ts_utc, {', '.join(f'_old_{c} AS {c}' for c in old)}, run_id AS superseded_by_run
FROM plan WHERE _action = 'update'"""


def batch_stats() -> str:
    return f"""WITH {merge_ctes()}
SELECT count(*) AS batch_rows, min(obs_date_ist) AS date_min, max(obs_date_ist) AS date_max FROM batch"""


def replace_date_range() -> str:
    s, e = _d(P.REPLACE_START), _d(P.REPLACE_END)
    return f"""WITH {merge_ctes()},\n{gold_ctes('old_gold', 'target')},\n{gold_ctes('new_gold', 'merged')}
SELECT * FROM old_gold WHERE NOT (obs_date_ist BETWEEN {s} AND {e})
UNION ALL SELECT * FROM new_gold WHERE obs_date_ist BETWEEN {s} AND {e}"""


def late_revision_gold_delta() -> str:
    return f"""WITH {merge_ctes()},\n{gold_ctes('old_gold', 'target')},\n{gold_ctes('new_gold', 'merged')}
SELECT coalesce(o.city_id, n.city_id) AS city_id, coalesce(o.obs_date_ist, n.obs_date_ist) AS obs_date_ist,
  o.aqi AS old_aqi, n.aqi AS new_aqi, o.prominent_pollutant AS old_main, n.prominent_pollutant AS new_main
FROM old_gold o FULL OUTER JOIN new_gold n ON o.city_id = n.city_id AND o.obs_date_ist = n.obs_date_ist
WHERE o.aqi IS DISTINCT FROM n.aqi OR o.city_id IS NULL OR n.city_id IS NULL"""


def sequential_merge_ctes(order: list[int]) -> str:
    parts = [base_ctes()]
    prev = None
    for i, run in enumerate(order):
        parts.append(f"b{i} AS ({dedupe_sql('clean', f'l_linenumber = {run}')})")
        if prev is None:
            prev = f"b{i}"
            continue
        parts.append(f"p{i} AS ({merge_sql(prev, f'b{i}')}),\ns{i} AS (SELECT {SILVER_SEL} FROM p{i})")
        prev = f"s{i}"
    return ",\n".join(parts), prev


def incremental_merge_state() -> str:
    ctes, last = sequential_merge_ctes(P.ARRIVAL_IN_ORDER)
    return f"WITH {ctes}\nSELECT * FROM {last}"


def merge_out_of_order_values() -> str:
    ctes, last = sequential_merge_ctes(P.ARRIVAL_OUT_OF_ORDER)
    return f"WITH {ctes}\nSELECT city_id, ts_utc, {', '.join(VALUE_COLS)} FROM {last}"


def incremental_window() -> str:
    today = _d(P.TODAY)
    return f"""WITH {base_ctes()}, latest AS (SELECT max(obs_date_ist) AS d FROM silver)
SELECT CASE WHEN d IS NULL THEN CAST({today} - INTERVAL {P.BACKFILL_DAYS} DAY AS DATE)
            ELSE least(CAST(d - INTERVAL {P.LOOKBACK_DAYS} DAY AS DATE), {today}) END AS window_start,
       {today} AS window_end FROM latest"""


def window_chunks() -> str:
    n = P.CHUNK_DAYS
    return f"""WITH {base_ctes()},
span AS (SELECT city_id, min(obs_date_ist) AS s, max(obs_date_ist) AS e FROM silver GROUP BY city_id),
starts AS (SELECT city_id, e, CAST(unnest(generate_series(s, e, INTERVAL {n} DAY)) AS DATE) AS chunk_start FROM span)
SELECT city_id, chunk_start, least(CAST(chunk_start + INTERVAL {n - 1} DAY AS DATE), e) AS chunk_end FROM starts"""


def _envelopes_sql(source: str = "readings") -> str:
    """One row per landing envelope: (site, run, UTC day, version slot) with its hour count.
    Defines `source` as the readings view unless it is "readings" defined elsewhere."""
    tb = ", ".join(TIEBREAK_COLS)
    return f"""{source} AS ({readings_sql(keep_source=True)}),
slotted AS (SELECT *, CAST(ts_utc AS DATE) AS d,
  row_number() OVER (PARTITION BY city_id, run_id, ts_utc ORDER BY {tb}) - 1 AS slot FROM {source}),
envelopes AS (SELECT city_id, run_id, d, slot, min(l_linenumber) AS l_linenumber, max(ingested_at) AS ingested_at,
  count(*) AS hours FROM slotted GROUP BY city_id, run_id, d, slot)"""


def skip_loaded_files_anti() -> str:
    return f"""WITH {_envelopes_sql()}
SELECT city_id, run_id, strftime(d, '%Y-%m-%d') AS window_start,
  printf('%s_%s_v%05d_landing.jsonl', run_id, strftime(d, '%Y%m%d'), slot) AS source_file
FROM envelopes WHERE l_linenumber > {P.TARGET_LAST_RUN}"""


def landing_roundtrip_counts() -> str:
    return f"""WITH {_envelopes_sql()}
SELECT city_id, run_id, strftime(d, '%Y-%m-%d') AS window_start, ingested_at, hours FROM envelopes"""


def events_trailing_mean() -> str:
    h, m = P.EVENT_WINDOW_HOURS, P.EVENT_MIN_COUNT
    frame = f"(PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {h - 1} HOUR PRECEDING AND CURRENT ROW)"
    return f"""SELECT event_id, user_id, ts,
  {rnd(f'CASE WHEN count(value) OVER {frame} >= {m} THEN avg(value) OVER {frame} END', 4)} AS value_8h
FROM events"""


def stream_landing_silver() -> str:
    return f"WITH {base_ctes()}\nSELECT city_id, ts_utc, {', '.join(VALUE_COLS)} FROM silver"


def _run_steps() -> tuple[str, list[tuple[int, str, str, str, str]]]:
    """CTEs of seven runs merged in order; for each its changed rows, the state after it and its counts."""
    ctes, _ = sequential_merge_ctes(P.ARRIVAL_IN_ORDER)
    steps = [(P.ARRIVAL_IN_ORDER[0], "b0", "b0", "(SELECT count(*) FROM b0)", "0")]
    for i, run in enumerate(P.ARRIVAL_IN_ORDER[1:], 1):
        steps.append((run, f"(SELECT * FROM p{i} WHERE _action IN ('insert', 'update'))", f"s{i}",
                      f"(SELECT count(*) FROM p{i} WHERE _action = 'insert')", f"(SELECT count(*) FROM p{i} WHERE _action = 'update')"))
    return ctes, steps


def lakehouse_run_audit() -> str:
    """Audit rows: the window asked for (the days landed), the counts, and the gold rows of changed days and their next days."""
    ctes, steps = _run_steps()
    rows = [f"""SELECT 'run-{run}' AS run_id, 'backfill' AS mode, (SELECT min(d) FROM envelopes WHERE run_id = 'run-{run}') AS window_start,
    (SELECT max(d) FROM envelopes WHERE run_id = 'run-{run}') AS window_end, 'success' AS status,
    (SELECT count(*) FROM envelopes WHERE run_id = 'run-{run}') AS bronze_rows, {ins} AS silver_inserted, {upd} AS silver_updated,
    (SELECT count(*) FROM (SELECT DISTINCT city_id, obs_date_ist FROM {state} WHERE obs_date_ist IN (
       SELECT obs_date_ist FROM {changed} UNION SELECT CAST(obs_date_ist + INTERVAL 1 DAY AS DATE) FROM {changed}))) AS gold_rows,
    CAST(NULL AS VARCHAR) AS error""" for run, changed, state, ins, upd in steps]
    env = _envelopes_sql("env_readings")  # `readings` is already defined by the merge CTEs
    return f"WITH {ctes},\n{env}\n" + "\nUNION ALL\n".join(rows)


def lakehouse_run_checks() -> str:
    """The check table of runs by site half: row checks see the days of a run's batch, site and freshness checks all of silver."""
    ctes = f"""{base_ctes()},\n{DIM},
first_half AS ({dedupe_sql('clean', P.FIRST_SITES_SQL)}),
whole AS ({dedupe_sql('clean')}),
second_days AS (SELECT * FROM whole WHERE obs_date_ist IN (SELECT obs_date_ist FROM clean WHERE NOT ({P.FIRST_SITES_SQL})))"""
    parts = []
    for run, staged, after in (("sites-1", "first_half", "first_half"), ("sites-2", "second_days", "whole")):
        stats, rows = _row_checks(staged)
        parts.append(f"""SELECT '{run}' AS run_id, * FROM (WITH stats AS ({stats}) {rows}
UNION ALL SELECT 'unique_city_hour', 'critical', n = 0, n || ' duplicate keys'
  FROM (SELECT count(*) AS n FROM (SELECT 1 FROM {staged} GROUP BY city_id, ts_utc HAVING count(*) > 1))
UNION ALL SELECT 'all_cities_present', 'warning', count(*) = 0, 'missing: ' || count(*) || ' sites'
  FROM dim_city d WHERE NOT EXISTS (SELECT 1 FROM {after} s WHERE s.city_id = d.city_id)
UNION ALL {_fresh(after, P.FRESHNESS_AS_OF)})""")
    return f"WITH {ctes}\n" + "\nUNION ALL\n".join(parts)


def _late_sites_ctes() -> str:
    """Silver after the early runs and after the late runs of some sites, and the merge between them."""
    early, late = f"l_linenumber <= {P.TARGET_LAST_RUN}", f"l_linenumber > {P.TARGET_LAST_RUN} AND {P.LATE_SITES_SQL}"
    return (base_ctes() + f",\ntarget AS ({dedupe_sql('clean', early)}),\nbatch AS ({dedupe_sql('clean', late)}),\n"
            f"plan AS ({merge_sql('target', 'batch')}),\nmerged AS (SELECT {SILVER_SEL} FROM plan)")


def gold_delta_by_key() -> str:
    return f"""WITH {_late_sites_ctes()},\n{gold_ctes('gold', 'merged')},
changed AS (SELECT DISTINCT city_id, obs_date_ist AS d FROM plan WHERE _action IN ('insert', 'update'))
SELECT city_id, obs_date_ist, aqi, prominent_pollutant,
  EXISTS (SELECT 1 FROM changed c WHERE c.city_id = gold.city_id AND gold.obs_date_ist - c.d BETWEEN 0 AND 1) AS recomputed
FROM gold"""


def gate_from_summary() -> str:
    return f"""WITH {_late_sites_ctes()},\n{DIM},\n{_dq_all('merged')}
SELECT * FROM results UNION ALL {_fresh('merged', P.FRESHNESS_AS_OF)}"""


def silver_as_of() -> str:
    ctes, steps = _run_steps()
    cols = ", ".join(["city_id", "ts_utc", "run_id", *VALUE_COLS])
    states = "\nUNION ALL\n".join(f"SELECT 'run-{run}' AS as_of, {cols} FROM {state}" for run, _, state, _, _ in steps)
    return f"WITH {ctes}\n{states}"


def events_hot_user_mean() -> str:
    return f"""WITH hot AS (SELECT event_id, {P.HOT_USER_SQL} AS user_id, ts, value FROM events)
{events_trailing_mean().replace("FROM events", "FROM hot")}"""


def events_numbered_by_value() -> str:
    return """SELECT event_id, event_type, value, row_number() OVER (ORDER BY event_type, event_id) AS place,
  row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place_in_type FROM events"""


def rebuild_equals_incremental() -> str:
    """Values of a full replay, as kept by the rebuilt silver."""
    return f"WITH {base_ctes()}\nSELECT city_id, ts_utc, {', '.join(VALUE_COLS)} FROM silver"
