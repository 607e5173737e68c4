"""Sharding by a two-pass external shuffle.

Pass one scatters records: a shard by the law `key` (rendezvous hashing of doc_id, so the shard follows from doc_id
and the number of shards, and a further shard takes rows only into itself), and inside a shard a bucket by a seeded hash of
the record. The number of a shard's buckets follows from the bytes of its rows, so that a bucket fits in memory
whatever the table's size and however many rows one key has. Rows equal in doc_id and text have the same hash: they are numbered, in
parallel and from a written table, and each copy's number goes into its hash. Pass two reads each bucket into one task, brings it into a defined order, shuffles it by Fisher-Yates with a
generator seeded by (seed, shard, bucket), and writes it; a slot is the bucket's first slot in its shard plus the place in it.

The result depends on the records, the seed and the sizes only, not on partitioning or task order, so a
lost executor's bucket is built again the same.

Defined cases: null text has size 8 and CRC 0; null doc_id is a key like any other; repeated rows take a
slot each and are spread over their shard's buckets (equal rows are interchangeable); an empty table gives no row; other columns are written along, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import as_record, scratch_path, ship, written

SHARDS = 24
SEED = 20240
BUCKET_BYTES = 16 << 20  # text bytes of an average bucket
ROW_BYTES = 8  # counted for each row besides its text


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """Rendezvous hashing: the shard whose hash with the key is largest."""
    draws = F.array(*[F.struct(F.xxhash64(F.lit(seed), key, F.lit(s)).alias("h"), F.lit(s).alias("s")) for s in range(shards)])
    return F.array_max(draws)["s"]


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniformly random order of n records: the last place of the rest swaps with a random one."""
    order = np.arange(n)
    draws = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64)  # draws[i] in 0..i
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return order


def _shuffle_bucket(seed: int, names: list[str]):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        shard, bucket = t.column("_shard")[0].as_py(), t.column("_bucket")[0].as_py()
        t = t.sort_by([("_doc", "ascending"), ("_crc", "ascending"), ("_size", "ascending")])
        order = fisher_yates(t.num_rows, np.random.default_rng([seed, shard, bucket]))
        t = t.take(pa.array(order))
        return t.append_column("_place", pa.array(np.arange(t.num_rows, dtype=np.int64))).select(names)

    return run


_EQUAL = ["_doc", "_crc", "_size"]  # rows alike in these have the same hash


def with_copy_numbers(rows: DataFrame) -> DataFrame:
    """`rows` with `_copy`: 0, 1, 2... among rows that are alike in `_EQUAL`; no group of them lies in one task.

    Only keys that repeat are numbered: their rows are written with the partition they come from, a row's number is its place in
    that partition plus the key's rows in earlier ones. So which numbers there are doesn't depend on partitions.
    """
    keys = rows.groupBy(*_EQUAL).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    keys = written(keys.select(*[F.col(k).alias(f"{k}2") for k in _EQUAL]), "shard-repeats")
    same = F.lit(True)
    for k in _EQUAL:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}2"))
    repeated = rows.join(keys, same, "left_semi").withColumns({"_part": F.spark_partition_id(), "_rid": F.monotonically_increasing_id()})
    repeated = written(repeated, "shard-copies")
    narrow = repeated.select("_rid", "_part", *_EQUAL)
    parts = narrow.groupBy("_part", *_EQUAL).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*_EQUAL).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("_part").alias("_part2"), *[F.col(k).alias(f"{k}2") for k in _EQUAL], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = narrow.withColumn("_row", F.row_number().over(Window.partitionBy("_part", *_EQUAL).orderBy("_rid")))
    numbers = local.join(starts, same & (F.col("_part") == F.col("_part2"))).select(
        F.col("_rid").alias("_rid2"), (F.col("_start") + F.col("_row") - 1).cast("long").alias("_copy"))
    copies = repeated.join(numbers, F.col("_rid") == F.col("_rid2")).select(*rows.columns, "_copy")
    return rows.join(keys, same, "left_anti").withColumn("_copy", F.lit(0).cast("long")).unionByName(copies)


def write_shards(documents: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
                 path: str | None = None) -> DataFrame:
    """Write all records, shuffled, below `path` (by default in the shared folder) and return them as a table.

    Files are partitioned by `_shard`; rows hold the input columns inside the struct `record`, and _bucket, _place, _slot,
    _doc, _size, _crc, _copy, _grown (the shard with one more shard).
    """
    spark = documents.sparkSession
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES
    crc = F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")
    doc = F.col("doc_id").cast("long")
    totals = dict(documents.groupBy(shard_of(doc, shards, seed).alias("s")).agg(F.sum(size)).collect())  # one number a shard
    buckets = [max(1, math.ceil(totals.get(s, 0) / bucket_bytes)) for s in range(shards)]
    first = [sum(buckets[:s]) for s in range(shards)]  # number of a shard's first bucket
    keyed = documents.select(
        as_record(documents, "record"), doc.alias("_doc"), size.alias("_size"), crc.alias("_crc"),
        shard_of(doc, shards, seed).alias("_shard"), shard_of(doc, shards + 1, seed).alias("_grown"))
    of_shard = lambda numbers: F.array(*[F.lit(x) for x in numbers])[F.col("_shard")]
    rows = with_copy_numbers(keyed).withColumn(
        "_bucket", F.pmod(F.xxhash64(F.lit(~seed), "_doc", "_crc", "_copy"), of_shard(buckets)).cast("int"))
    names = [*rows.columns, "_place"]
    ship(spark)
    schema = StructType([*rows.schema.fields, StructField("_place", LongType())])
    path = path or scratch_path(spark, "shards")
    numbered = rows.withColumn("_number", of_shard(first) + F.col("_bucket"))
    shuffled = numbered.repartitionById(sum(buckets), "_number").groupBy("_number").applyInArrow(_shuffle_bucket(seed, names), schema)
    shuffled.write.partitionBy("_shard").parquet(path)
    stored = spark.read.schema(shuffled.schema).parquet(path)
    sizes = stored.groupBy("_shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    starts = written(starts, "shard-starts")
    return stored.join(starts, ["_shard", "_bucket"]).withColumn("_slot", F.col("_start") + F.col("_place")).drop("_start")
