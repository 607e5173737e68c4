"""Daily index per site and local day."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame  # noqa: F401
from pyspark.sql import functions as F

from ..functions import aqi
from ..functions.breakpoints import (
    DAILY_MEAN_POLLUTANTS,
    MIN_HOURS_FOR_SUBINDEX,
    POLLUTANT_ORDER,
    ROLLING_8H_POLLUTANTS,
)
from ..functions.numeric import round_half_up
from .rolling import DAY_COL, with_trailing_means

# pollutant code -> silver column
SILVER_COLUMN = {"pm2_5": "pm2_5", "pm10": "pm10", "no2": "no2", "so2": "so2", "o3": "o3", "co": "co_mg_m3"}

GOLD_COLUMNS = [
    "city_id", "obs_date_ist", "aqi", "aqi_category", "prominent_pollutant", "pollutants_reported",
    "pm2_5_24h", "pm10_24h", "no2_24h", "so2_24h", "o3_8h_max", "co_8h_max_mg_m3",
    *[f"si_{p}" for p in POLLUTANT_ORDER],
    *[f"{p}_hours" for p in POLLUTANT_ORDER],
]


def daily_measures(hourly: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """A2/X3/X4 inputs per (city_id, obs_date_ist): 24-h means, daily max of 8-h means, hour counts.

    One shuffle: the rolling window and this aggregate share the (city_id, day) partitioning.
    Hour counts are raw non-null hours in the day (not window frames). `keys`: the distinct site-days wanted, if not all; they join
    on that partitioning too.
    """
    rolled = with_trailing_means(hourly, {f"{p}_8h": SILVER_COLUMN[p] for p in ROLLING_8H_POLLUTANTS}, only=keys)
    aggs: list[Column] = []
    for p in DAILY_MEAN_POLLUTANTS:
        aggs.append(F.avg(SILVER_COLUMN[p]).alias(f"{p}_24h"))
    for p in ROLLING_8H_POLLUTANTS:
        aggs.append(F.max(f"{p}_8h").alias(f"{p}_8h_max"))
    for p in POLLUTANT_ORDER:
        aggs.append(F.count(SILVER_COLUMN[p]).alias(f"{p}_hours"))
    return rolled.groupBy("city_id", DAY_COL).agg(*aggs).withColumnRenamed(DAY_COL, "obs_date_ist")


def score_daily(measures: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """X1..X8 on daily measures: gated sub-indices, index, category, main pollutant, rounding."""
    value = {p: f"{p}_24h" for p in DAILY_MEAN_POLLUTANTS}
    value.update({p: f"{p}_8h_max" for p in ROLLING_8H_POLLUTANTS})
    gated = [
        F.when(F.col(f"{p}_hours") >= F.lit(MIN_HOURS_FOR_SUBINDEX), aqi.sub_index(p, value[p], tolerance))
        .alias(f"si_{p}") for p in POLLUTANT_ORDER
    ]
    with_si = measures.select("*", *gated)
    si = {p: f"si_{p}" for p in POLLUTANT_ORDER}
    with_aqi = with_si.select("*", aqi.overall_index(si).alias("aqi"))
    rounded = {f"{p}_24h": round_half_up(f"{p}_24h", 2, tolerance) for p in DAILY_MEAN_POLLUTANTS}
    rounded["o3_8h_max"] = round_half_up("o3_8h_max", 2, tolerance)
    rounded["co_8h_max_mg_m3"] = round_half_up("co_8h_max", 3, tolerance)
    derived = {
        "aqi_category": aqi.category("aqi"),
        "prominent_pollutant": aqi.main_pollutant(si, "aqi"),
        "pollutants_reported": aqi.pollutants_reported(si),
        **rounded,
    }
    return with_aqi.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in GOLD_COLUMNS])


def daily_aqi(
    silver: DataFrame,
    start: _dt.date | None = None,
    end: _dt.date | None = None,
    *,
    days: list[_dt.date] | None = None,
    keys: DataFrame | None = None,
    tolerance: float = 0.0,
    audit: bool = True,
) -> DataFrame:
    """Gold rows for local days [start, end] (all days when both are None), or for exactly `days`; of these only
    the site-days in `keys` (distinct city_id, obs_date_ist) if given.

    The scan is widened one day back so the 8-hour means just after midnight are complete; with
    silver partitioned by obs_date_ist both filters prune partitions. The date filter has to be
    written below the window by hand: Catalyst does not push it through a Window on other keys.
    """
    hourly = silver
    if start is not None and end is not None:
        hourly = silver.where(F.col("obs_date_ist").between(F.lit(start - _dt.timedelta(days=1)), F.lit(end)))
    if days is not None:
        hourly = hourly.where(F.col("obs_date_ist").isin(sorted({*days, *(d - _dt.timedelta(days=1) for d in days)})))
    measures = daily_measures(hourly, keys)  # a site-day needs its own hours and the halo of the evening before
    if days is not None:
        measures = measures.where(F.col("obs_date_ist").isin(days))
    if start is not None and end is not None:
        measures = measures.where(F.col("obs_date_ist").between(F.lit(start), F.lit(end)))
    gold = score_daily(measures, tolerance)
    return gold.withColumn("computed_at", F.current_timestamp()) if audit else gold
