"""Reading silver as it was: versions of each hour with the time they were valid, from the current rows and the kept before-images (I8)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SILVER_KEY


def versions(silver: DataFrame, revisions: DataFrame | None) -> DataFrame:
    """Every version of every hour with `valid_from` and `valid_to` (null: still valid).

    A before-image carries the time of the merge that replaced it, so no window over an hour's versions is needed. A merge that broke
    after writing its before-images was done again later: the same version is then there twice, and the last replacement is the real one.
    """
    fields = [c for c in silver.columns if c != "updated_at"]
    current = silver.select(*fields, F.col("updated_at").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    if revisions is None:
        return current
    rest = [c for c in fields if c not in SILVER_KEY]
    old = revisions.groupBy(*SILVER_KEY, "updated_at").agg(F.max(F.struct("superseded_at", *rest)).alias("_v"))
    old = old.select(*SILVER_KEY, *[F.col(f"_v.{c}").alias(c) for c in rest], F.col("updated_at").alias("valid_from"),
                     F.col("_v.superseded_at").alias("valid_to"))
    unreplaced = silver.select(*SILVER_KEY, "updated_at").withColumnRenamed("updated_at", "valid_from")
    lost = old.join(unreplaced, [*SILVER_KEY, "valid_from"], "left_anti")  # a before-image of a merge that never came to be
    return current.unionByName(lost.select(*current.columns))


def as_of(history: DataFrame, times: dict[str, _dt.datetime]) -> DataFrame:
    """The state at each of some named times: rows of `history` with the name in `as_of`.

    An interval join with the times as an array of each row's plan, in one pass: a version is given out once for each time inside its
    interval and is compared with no other row. `times` is a list the caller writes down (runs, reporting dates).
    """
    points = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(t).alias("t")) for name, t in times.items()])
    inside = F.filter(points, lambda p: (F.col("valid_from") <= p["t"]) & (F.col("valid_to").isNull() | (F.col("valid_to") > p["t"])))
    return history.select(*[c for c in history.columns if c not in ("valid_from", "valid_to")], F.explode(inside).alias("_p")).select(
        F.col("_p.name").alias("as_of"), "*").drop("_p")
