from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import shuffle_shards as S


@pytest.fixture(scope="module")
def many(odd_docs):
    more = odd_docs.crossJoin(odd_docs.sparkSession.range(40)).withColumn("doc_id", F.col("doc_id") * 100 + F.col("id")).drop("id")
    return odd_docs.unionByName(more).where("text is null or length(text) < 5000").cache()


def test_sizes_slots_and_growth(many):
    out = S.write_shards(many, shards=6, bucket_bytes=20_000)
    rows = out.collect()
    assert sorted(map(str, (r.record for r in rows))) == sorted(map(str, many.collect()))
    for r in rows:
        raw = (r.record.text or "").encode()
        assert r._size == len(raw) + 8 and r._crc == zlib.crc32(raw) and r._doc == r.record.doc_id
        assert r._grown in (r._shard, 6)  # a further shard takes rows only into itself
    by = {}
    for r in rows:
        by.setdefault(r._shard, []).append(r._slot)
    assert set(by) == set(range(6)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({(r._shard, r._bucket) for r in rows}) > 12  # several buckets a shard
    assert 0 < sum(r._grown == 6 for r in rows) < len(rows) / 3
    order = [r._doc for r in sorted((r for r in rows if r._shard == 0 and r._doc is not None), key=lambda r: r._slot)]
    assert order != sorted(order)


def test_same_result_from_other_partitions(many):
    key = lambda df: sorted(str((r._doc, r._crc, r._shard, r._slot)) for r in df.collect())
    distinct = many.dropDuplicates(["doc_id", "text"])
    assert key(S.write_shards(distinct.repartition(3), 4, bucket_bytes=30_000)) == key(S.write_shards(distinct.repartition(7), 4, bucket_bytes=30_000))


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(0)
    counts = {}
    for _ in range(12000):
        k = tuple(S.fisher_yates(3, rng).tolist())
        counts[k] = counts.get(k, 0) + 1
    assert len(counts) == 6 and all(abs(c - 2000) < 200 for c in counts.values())


def test_empty_table(no_docs):
    assert S.write_shards(no_docs).count() == 0


@pytest.mark.parametrize("doc_id, text", [(7, "the same row"), (None, None)])
def test_equal_rows_are_spread_over_buckets(spark, many, doc_id, text):
    """A hot key's rows all lie in its shard, in buckets of about the asked size; slots stay gapless."""
    n = 60_000
    hot = spark.range(0, n, numPartitions=5).select(F.lit(doc_id).cast("long").alias("doc_id"), F.lit(text).cast("string").alias("text"))
    docs = many.select("doc_id", "text").unionByName(hot)
    one = 8 + len(text or "")
    out = S.write_shards(docs, shards=4, bucket_bytes=64 << 10)
    rows = out.groupBy("_shard", "_bucket").agg(F.sum("_size").alias("bytes"), F.count("*").alias("n"), F.max("_slot").alias("last")).collect()
    assert sum(r.n for r in rows) == docs.count()
    big = max((r.bytes, r._shard) for r in rows)
    assert big[0] < 3 * (64 << 10)  # all rows in one bucket would be 7 to 18 times the size
    home = {r._shard for r in out.where(F.col("_doc").eqNullSafe(F.lit(doc_id))).select("_shard").distinct().collect()}
    assert len(home) == 1
    filled = [r for r in rows if r._shard in home]
    assert len(filled) >= n * one // (64 << 10)
    assert max(r.last for r in filled) + 1 == sum(r.n for r in filled)


def test_repeated_rows_same_result_from_other_partitions(spark):
    rows = [(i % 50, f"text {i % 25}") for i in range(400)] + [(None, None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda df: sorted(str((r._doc, r._crc, r._copy, r._shard, r._bucket)) for r in df.collect())
    assert key(S.write_shards(docs.repartition(3), 4, bucket_bytes=500)) == key(S.write_shards(docs.repartition(7), 4, bucket_bytes=500))


def test_one_shuffle_places_buckets_by_number(spark):
    numbered = spark.range(100).select(F.pmod(F.xxhash64("id"), F.lit(5)).cast("int").alias("_number"))
    plan = numbered.repartitionById(5, "_number").groupBy("_number").applyInArrow(lambda t: t, numbered.schema)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
