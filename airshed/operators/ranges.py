"""Numbers and running sums along a total order, by range partitions: no key's rows are gathered in one task.

Rows are range partitioned by (key, order) and that is written, so that what partition a row lies in is a fact and not the outcome of
one run. Inside a partition a window counts or adds up; what lies before it comes from one small row for each partition and key part. A
key with any share of the rows is spread over as many partitions as its rows fill.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.localtime import epoch_micros
from ..session import checkpoint_dir

SUM_TYPE = "decimal(38,10)"  # running sums are exact to ten places, so their differences are
TERM_TYPE = "decimal(35,10)"  # narrow enough that adding two keeps all ten places
CROWD = 1 << 17  # rows of one key that a task may sort
BUCKETS = 1 << 16  # of keys, counted first


def in_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """`df` range partitioned by `order` and written, with the partition's number in `_part`; read back in as many files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _earlier(parts: DataFrame, keys: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """For each partition and key part, the sums over the key's earlier partitions: `sums` maps output name -> column."""
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_part", *keys, *[F.sum(c).over(before).alias(out) for out, c in sums.items()])


def _join_parts(rows: DataFrame, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = starts.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_start_key{i}") for i, k in enumerate(keys)],
                          *[c for c in starts.columns if c != "_part" and c not in keys])
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_start_key{i}"))
    return rows.join(named, same, "left").drop("_p", *[f"_start_key{i}" for i in range(len(keys))])


def crowded(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame | None:
    """The keys (as `_hot_<key>`) with more than `most` rows, written; None without any.

    Rows are counted by hash bucket, at most `BUCKETS` numbers a task, and by key only inside a bucket with more than `most`.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    full = [r[0] for r in df.groupBy(bucket.alias("_b")).count().where(F.col("count") > most).select("_b").collect()]  # bucket numbers
    if not full:
        return None
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/crowded-{uuid.uuid4().hex}"
    counted = df.where(bucket.isin(full)).groupBy(*keys).count().where(F.col("count") > most)
    counted.select(*[F.col(k).alias(f"_hot_{k}") for k in keys]).write.parquet(path)
    hot = spark.read.parquet(path)
    return None if hot.isEmpty() else hot


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position", keys: Sequence[str] = (), then: Sequence[Column] = ()) -> DataFrame:
    """Add `name`: the row's place from 1 within its `keys` (none: overall) in `order`, then in the sort orders `then`. Rows equal in all of
    them take places in any order."""
    names = [f"_o{i}" for i in range(len(order))]
    rows = in_ranges(df.withColumns(dict(zip(names, order))), [*[F.col(k) for k in keys], *[F.expr(n) for n in names], *then], "numbered")
    one = [F.lit(0).alias("_all")] if not keys else []
    sizes = rows.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
    starts = _earlier(sizes.select("*", *one), [*keys, *(["_all"] if one else [])], {"_before": "_n"}).drop("_all")
    local = Window.partitionBy("_part", *keys).orderBy(*names, *then)
    placed = _join_parts(rows.withColumn("_row", F.row_number().over(local)), starts, keys)
    return placed.select(*df.columns, (F.coalesce("_before", F.lit(0)) + F.col("_row")).alias(name))


def sliding_means(rows: DataFrame, columns: dict[str, str], *, hours: int, min_count: int, key: str, ts: str) -> DataFrame:
    """W2 whatever a key's share of the rows: `out` = mean of `src` over [ts - (hours-1)h, ts] of the key, null when < min_count values.

    Equal (key, ts) rows are added up first. A frame's sum is the running sum at its end less the running sum before its start, and the
    latter is the running sum at the point (key, ts - frame), a row of its own that is sorted in with the others: no row is
    copied into another's frame, so neither a hot key nor a crowded hour makes more work than its rows. Sums are decimals, exact to ten
    places; a value beyond 28 digits is an error.
    """
    micros = epoch_micros(F.col(ts))
    src = list(dict.fromkeys(columns.values()))
    value = {c: F.col(c).cast("decimal(28,10)") for c in src}
    added = [F.coalesce(F.sum(value[c]), F.lit(0)).cast(SUM_TYPE).alias(f"_s{i}") for i, c in enumerate(src)]
    counted = [F.count(c).alias(f"_n{i}") for i, c in enumerate(src)]
    points = rows.select(F.col(key).alias("_key"), micros.alias("_t"), *src).groupBy("_key", "_t").agg(*added, *counted)
    sums = [f"_{x}{i}" for i in range(len(src)) for x in "sn"]
    frame = (hours - 1) * 3600 * 1_000_000
    ends = points.select("_key", F.col("_t").alias("_at"), F.col("_t"), F.lit(1).alias("_own"), *sums)
    starts = points.select("_key", (F.col("_t") - frame).alias("_at"), F.col("_t"), F.lit(0).alias("_own"),
                           *[F.lit(0).cast(SUM_TYPE if s.startswith("_s") else "long").alias(s) for s in sums])
    line = in_ranges(ends.unionByName(starts), [F.col("_key"), F.col("_at")], "sliding")
    parts = line.groupBy("_part", "_key").agg(*[F.sum(s).cast(SUM_TYPE if s.startswith("_s") else "long").alias(s) for s in sums])
    before = _earlier(parts, ["_key"], {f"{s}b": s for s in sums})
    local = Window.partitionBy("_part", "_key").orderBy("_at")
    upto = local.rangeBetween(Window.unboundedPreceding, 0)  # a frame's end has its peers
    below = local.rangeBetween(Window.unboundedPreceding, -1)  # before its start, it hasn't
    own = F.col("_own") == 1
    running = [F.coalesce(F.when(own, F.sum(s).over(upto)).otherwise(F.sum(s).over(below)), F.lit(0)).alias(s) for s in sums]
    summed = _join_parts(line.select("_part", "_key", "_t", "_own", *running), before, ["_key"])
    held = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(TERM_TYPE if c.startswith("_s") else "long")
    totals = [held(s) + held(f"{s}b") for s in sums]
    frames = summed.groupBy("_key", "_t").agg(*[F.sum(F.when(own, x).otherwise(-x)).alias(s) for s, x in zip(sums, totals)])
    place = {c: i for i, c in enumerate(src)}
    means = [F.when(F.col(f"_n{place[c]}") >= min_count, (F.col(f"_s{place[c]}").cast("double") / F.col(f"_n{place[c]}"))).alias(out)
             for out, c in columns.items()]
    found = frames.select("_key", "_t", *means)
    same = F.col(key).eqNullSafe(F.col("_key")) & (micros == F.col("_t"))
    return rows.join(found, same, "left").select(*rows.columns, *columns)
