"""Latest version per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """Keep one row per key: the one with the largest (newest_first[0], newest_first[1], ...).

    Planned as an aggregate, max(struct(order columns..., other columns...)) per key: struct
    comparison is field by field with nulls lowest, i.e. the first row of an ORDER BY ... DESC
    NULLS LAST. The aggregate runs partially on every map task before the shuffle, so a hot key
    with millions of versions ships one row per map task, and no sort of whole groups is
    needed. Give a total order (add tie-breakers) to make the winner deterministic.
    """
    order = [c for c in newest_first if c not in keys]  # a key is constant inside its group
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    # group with fixed-width keys first: the sort behind the aggregate then resolves most
    # comparisons on its 8-byte prefix instead of comparing strings
    types = dict(df.dtypes)
    grouping = sorted(keys, key=lambda k: types[k] in ("string", "binary"))
    best = df.groupBy(*grouping).agg(F.max(packed).alias("_best"))
    return best.select(*[F.col(k) for k in keys], *[F.col(f"_best.{c}").alias(c) for c in order + rest])
