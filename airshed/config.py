"""Constants of the index method and of the lakehouse layout."""

from __future__ import annotations

# ---------------------------------------------------------------------------------------
# Fixed values (must equal the published method and the source data's field names).
# API variable name -> our column name, in request order.
POLLUTANTS: dict[str, str] = {
    "pm2_5": "pm2_5",
    "pm10": "pm10",
    "nitrogen_dioxide": "no2",
    "sulphur_dioxide": "so2",
    "ozone": "o3",
    "carbon_monoxide": "co",
}
# Local reporting time is that of Asia/Kolkata: UTC+05:30 all year (no daylight saving).
LOCAL_OFFSET_MINUTES = 330
# Incremental runs re-read this many days before the newest stored day.
INCREMENTAL_LOOKBACK_DAYS = 2
# An empty lakehouse loads this many days of history.
DEFAULT_BACKFILL_DAYS = 30
# Longest window per source request, in days.
MAX_DAYS_PER_REQUEST = 31
# Quality-gate limits (silver column -> highest plausible value) and freshness.
MAX_PLAUSIBLE: dict[str, float] = {
    "pm2_5": 2000, "pm10": 3000, "no2": 2000, "so2": 3000, "o3": 2000, "co_mg_m3": 200,
}
FRESHNESS_HOURS = 48
# Display labels of pollutant codes in the report.
POLLUTANT_LABELS: dict[str, str] = {
    "pm2_5": "PM2.5", "pm10": "PM10", "no2": "NO2", "so2": "SO2", "o3": "O3", "co": "CO",
}
# Silver value columns (CO already converted to mg/m3) and key.
VALUE_COLS = ["pm2_5", "pm10", "no2", "so2", "o3", "co_mg_m3"]
SILVER_KEY = ["city_id", "ts_utc"]
# End of fixed values.
# ---------------------------------------------------------------------------------------
