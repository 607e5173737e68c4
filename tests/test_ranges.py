"""Hot keys and crowded values: numbering, ranks and sliding means by ranges give whole results and even tasks."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airshed.operators import ranges
from airshed.operators.serve import global_rank
from airshed.sources.landing import build_envelopes, write_landing

from . import brute


@pytest.fixture
def wide(spark):
    """Range partitions as many as on a small cluster, whatever AQE makes of tiny ones."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield 16
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[0])
    spark.conf.set("spark.sql.shuffle.partitions", old[1])


def test_rank_with_nine_of_ten_rows_at_one_value(spark, wide):
    df = spark.range(40_000).select(F.when(F.col("id") % 10 < 9, 100).otherwise(F.col("id") % 500).cast("int").alias("aqi"),
                                    F.format_string("site %06d", (F.col("id") * 7919) % 40_000).alias("name"))
    ranked = global_rank(df, [-F.col("aqi"), F.col("name")])
    got = ranked.orderBy("rank").collect()
    assert [(r.aqi, r.name) for r in got] == sorted(((r.aqi, r.name) for r in df.collect()), key=lambda t: (-t[0], t[1]))
    assert [r.rank for r in got] == list(range(1, 40_001))
    parts = ranges.in_ranges(df, [-F.col("aqi"), F.col("name")], "t").groupBy("_part").count().collect()
    assert len(parts) == wide and max(r["count"] for r in parts) < 3 * 40_000 / wide


def test_numbering_within_keys_and_ties(spark, wide):
    rng = random.Random(4)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else f"k{i % 7}", rng.randrange(40), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(8)
    got = defaultdict(list)
    for r in ranges.numbered(df, [F.col("v"), F.col("id")], "n", ["k"]).collect():
        got[r.k].append((r.n, r.v, r.id))
    for k, found in got.items():
        assert [x[1:] for x in sorted(found)] == sorted((v, i) for key, v, i in rows if key == k)
        assert sorted(x[0] for x in found) == list(range(1, len(found) + 1))
    ties = ranges.numbered(df, [F.lit(0)], "n").collect()
    assert sorted(r.n for r in ties) == list(range(1, 5001))


def test_sliding_means_with_a_hot_user(spark, wide):
    start = dt.datetime(2026, 1, 1)
    rng = random.Random(8)
    rows = [(i, "hot" if i % 3 == 0 else f"u{i % 90}", start + dt.timedelta(seconds=rng.randrange(400_000) // 600 * 600),
             None if i % 11 == 0 else rng.uniform(-50, 50), float(i % 7)) for i in range(3000)]
    rows += [(5000, None, start, 1.0, 2.0), (5001, None, start, 3.0, 2.0)]
    df = spark.createDataFrame(rows, "id int, user string, ts timestamp_ntz, a double, b double").repartition(8)
    out = ranges.sliding_means(df, {"a_m": "a", "b_m": "b"}, hours=8, min_count=3, key="user", ts="ts").collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {"id", "user", "ts", "a", "b", "a_m", "b_m"}
    by_user = defaultdict(list)
    for _, user, ts, a, b in rows:
        by_user[user].append((ts, a, b))
    want = {user: [brute.rolling([(t, v[k]) for t, *v in found], 8, 3) for k in (0, 1)] for user, found in by_user.items()}
    for r in out:
        for got, expected in ((r.a_m, want[r.user][0][r.ts]), (r.b_m, want[r.user][1][r.ts])):
            assert (got is None) == (expected is None) and (got is None or abs(got - expected) < 1e-8)
    micros = F.expr("unix_micros(cast(ts as timestamp))")
    parts = ranges.in_ranges(df, [F.col("user"), micros], "t").where("user = 'hot'").groupBy("_part").count().collect()
    assert len(parts) >= wide // 4  # a third of the rows in a third of the partitions


def test_many_versions_of_one_hour(spark, tmp_path, wide):
    n = 30_000
    hot = spark.range(n).select(
        F.lit("A").alias("city_id"), F.lit("run").alias("run_id"), F.lit(dt.datetime(2026, 9, 2)).cast("timestamp_ntz").alias("ingested_at"),
        F.lit(dt.datetime(2026, 9, 1)).cast("timestamp_ntz").alias("ts_utc"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"),
        *[F.col("id").cast("double").alias(c) for c in ("pm2_5", "pm10", "no2", "so2", "o3", "co")], "id")
    env = build_envelopes(hot, "test", ["id"])
    assert env.agg(F.count("*"), F.min("version"), F.max("version"), F.countDistinct("version")).first()[:] == (n, 0, n - 1, n)
    write_landing(env, str(tmp_path / "landing"))
    files = [str(p.relative_to(tmp_path)) for p in (tmp_path / "landing").rglob("*.json")]
    assert len(files) <= wide and all("version=" not in f for f in files)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k string, ts timestamp_ntz, v double")
    assert ranges.numbered(none, [F.col("v")], "n", ["k"]).count() == 0 == ranges.numbered(none, [F.col("v")], "n").count()
    assert ranges.sliding_means(none, {"m": "v"}, hours=8, min_count=1, key="k", ts="ts").count() == 0
