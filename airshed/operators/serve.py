"""Serving: latest reported index per site, worst first (X11), and the ranked report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import POLLUTANT_LABELS
from .joins import join_dimension
from .ranges import numbered

REPORT_COLUMNS = ["name", "obs_date_ist", "aqi", "aqi_category", "prominent_pollutant", "pm2_5_24h", "pm10_24h"]


def latest_per_site(gold: DataFrame) -> DataFrame:
    """A4 + J3: the row of each site's latest day with a reported index (P15: aqi not null).

    One aggregate keyed by site with map-side partial aggregation (a site with a third of all
    days is pre-reduced on every map task), instead of max-date + self-join.
    """
    reported = gold.where(F.col("aqi").isNotNull())
    fields = [c for c in reported.columns if c != "city_id"]
    latest = reported.groupBy("city_id").agg(
        F.max_by(F.struct(*[F.col(c) for c in fields]), F.col("obs_date_ist")).alias("_r"))
    return latest.select("city_id", *[F.col(f"_r.{c}").alias(c) for c in fields])


def latest_aqi(gold: DataFrame, dim: DataFrame) -> DataFrame:
    """X11: latest reported day per site joined to the dimension (J4, inner), worst index first (O1)."""
    latest = latest_per_site(gold.select("city_id", *REPORT_COLUMNS[1:]))
    joined = join_dimension(latest, dim.select("city_id", "name"), "city_id")
    return joined.select(*REPORT_COLUMNS).orderBy(F.col("aqi").desc(), F.col("name"))


def label(code: Column) -> Column:
    """Display label of a pollutant code; unknown codes pass through."""
    mapping = F.create_map(*[F.lit(x) for kv in POLLUTANT_LABELS.items() for x in kv])
    return F.coalesce(mapping[code], code)


def global_rank(df: DataFrame, order: list[Column], then: Sequence[Column] = (), name: str = "rank") -> DataFrame:
    """1-based position in `order`, by range partitions (`ranges.numbered`): neither a single-task window nor a task for each
    value of the index. `df` is evaluated once. The order must be total for positions to be deterministic; rows equal in `order` follow
    `then`, whose columns may be sort orders (`desc()`)."""
    return numbered(df, order, name, then=then).withColumn(name, F.col(name).cast("int"))


def report_rows(latest: DataFrame) -> DataFrame:
    """Rank, label and one markdown table line per site (content of the published table)."""
    ranked = global_rank(latest, [-F.col("aqi"), F.col("name")])
    line = F.format_string("| %d | %s | %s | **%d** | %s | %s | %s | %s |", F.col("rank"), F.col("name"),
                           F.col("obs_date_ist").cast("string"), F.col("aqi"), F.col("aqi_category"),
                           F.col("main_pollutant_label"), F.col("pm2_5_24h").cast("string"),
                           F.col("pm10_24h").cast("string"))
    return (ranked.withColumn("main_pollutant_label", label(F.col("prominent_pollutant")))
            .withColumn("line", line))
