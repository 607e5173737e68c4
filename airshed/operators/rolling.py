"""Trailing time-range means per site (W2), parallel by site-day instead of by site.

A trailing window of H hours per site, ordered over the whole history, would put each site's
full history into one sorted task (a hot site = one huge task). Here each row belongs to its
local day, and rows in the last H-1 hours of a day get one extra "halo" copy in the next day.
The window then runs per (site, day): groups hold at most a day plus H-1 hours, the frame of
every own-day row is complete, and the result equals the per-site window exactly. Halo copies
are dropped after the window. The (site, day) hash partitioning is kept for the daily
aggregate that follows, so the whole daily job needs one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.breakpoints import MIN_HOURS_IN_8H_WINDOW
from ..config import LOCAL_OFFSET_MINUTES
from ..functions.localtime import epoch_micros, local_day_start_utc

DAY_COL = "_wday"  # the local day a (possibly halo) row is evaluated in


def with_halo(hourly: DataFrame, hours: int, ts: str = "ts_utc", day: str = "obs_date_ist") -> DataFrame:
    """Add `_wday` (own day, or the next day for halo copies) and `_halo` (bool)."""
    next_day_start = local_day_start_utc(F.date_add(F.col(day), 1))
    in_tail = F.col(ts) >= next_day_start - F.make_dt_interval(F.lit(0), F.lit(hours - 1))
    shifts = F.when(in_tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        hourly.withColumn("_shift", F.explode(shifts))
        .withColumn(DAY_COL, F.date_add(F.col(day), F.col("_shift")))
        .withColumn("_halo", F.col("_shift") == 1)
        .drop("_shift")
    )


def with_bucket_halo(rows: DataFrame, hours: int, bucket_hours: int, ts: str = "ts_utc") -> DataFrame:
    """Like `with_halo`, with buckets of `bucket_hours` (aligned to local midnight) instead of
    days; `_wbucket` is the bucket number. For high-frequency data, where one key-day could
    be huge: a group then holds at most bucket_hours + hours - 1 hours of one key. A row is
    copied into each later bucket within `hours - 1` hours of it (several when the bucket is
    shorter than the frame)."""
    hour_us = 3600 * 1_000_000
    width = F.lit(bucket_hours * hour_us)
    local_us = epoch_micros(F.col(ts)) + F.lit(LOCAL_OFFSET_MINUTES * 60 * 1_000_000)
    bucket = F.floor(local_us / width)
    # every later bucket whose rows can still reach back to this row gets a copy
    reach = F.floor((local_us + F.lit((hours - 1) * hour_us)) / width)
    shifts = F.sequence(F.lit(0).cast("long"), (reach - bucket).cast("long"))
    return (
        rows.withColumn("_shift", F.explode(shifts))
        .withColumn("_wbucket", bucket + F.col("_shift"))
        .withColumn("_halo", F.col("_shift") > 0)
        .drop("_shift")
    )


def with_trailing_means(
    hourly: DataFrame,
    columns: dict[str, str],
    *,
    hours: int = 8,
    min_count: int = MIN_HOURS_IN_8H_WINDOW,
    key: str = "city_id",
    ts: str = "ts_utc",
    day: str = "obs_date_ist",
    bucket_hours: int = 24,
    only: DataFrame | None = None,
) -> DataFrame:
    """Add `out` = mean of `src` over [ts - (hours-1)h, ts] per key, null when < min_count values.

    `columns` maps output name -> source column. The frame is a time range, so missing hours
    shrink it (and may fail the count gate) instead of pulling in older rows. With the default
    24-hour buckets the window runs per (key, local day) and keeps `_wday` (equal to `day` on
    the returned rows) for a following aggregate by (key, day) without another shuffle. With
    shorter `bucket_hours` (high-frequency data) it runs per (key, bucket); halo copies then
    make up (hours - 1) / bucket_hours of extra rows. `only` (with 24-hour buckets): the distinct (key, day) that are wanted; rows
    of others are dropped before the window, by a join on the window's own partitioning.
    """
    if bucket_hours != 24:
        halo = with_bucket_halo(hourly, hours, bucket_hours, ts)
        part = "_wbucket"
    else:
        halo = with_halo(hourly, hours, ts, day)
        part = DAY_COL
        if only is not None:  # distinct keys, far fewer than rows: hashed by partition, so that only the window sorts the rows
            halo = halo.join(only.select(key, F.col(day).alias(DAY_COL)).hint("shuffle_hash"), [key, DAY_COL], "left_semi")
    w = (
        Window.partitionBy(key, part)
        .orderBy(epoch_micros(F.col(ts)))
        .rangeBetween(-(hours - 1) * 3600 * 1_000_000, 0)
    )
    means = [
        F.when(F.count(src).over(w) >= F.lit(min_count), F.avg(src).over(w)).alias(out)
        for out, src in columns.items()
    ]
    out = halo.select("*", *means).where(~F.col("_halo")).drop("_halo")
    return out.drop("_wbucket") if part == "_wbucket" else out


def rolling_8h_mean(hourly: DataFrame, columns: dict[str, str] | None = None, **kw) -> DataFrame:
    """W2 for the index: trailing 8-hour means of o3 and co (mg/m3) on each hourly row."""
    columns = columns or {"o3_8h": "o3", "co_8h": "co_mg_m3"}
    out = with_trailing_means(hourly, columns, **kw)
    return out.drop(DAY_COL) if DAY_COL in out.columns else out
