"""Helpers shared by the training-data operators: tables, shared scratch tables, worker imports, positions."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = r"[^\x20\x09-\x0D]+"  # the word pattern of the text contracts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's source tree (local runs; a cluster installs it)."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if REPO_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([REPO_ROOT, *filter(None, paths)])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(value: Column, use) -> Column:
    """`use(value)` with `value` computed once a row: inside lambdas a plain expression is computed for each element."""
    return F.transform(F.array(value), use)[0]


def as_record(df: DataFrame, name: str = "_row") -> Column:
    """All columns of `df` as one struct, so that an operator's own columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def with_text(changed: DataFrame, documents: DataFrame) -> DataFrame:
    """The columns of `documents` from rows (_row, text, _changed): with the new text, and n_chars where it changed."""
    new = {"text": F.col("text").cast(documents.schema["text"].dataType)}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("_changed"), F.char_length("text").cast(kind)).otherwise(F.col("_row.n_chars"))
    return changed.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in documents.columns])


def positions(df: DataFrame, group: str, order: Sequence[str], out: str = "position") -> DataFrame:
    """Add `out`: the row's 0-based place in its group by `order`, without gathering a group in one task.

    Rows are range partitioned by (group, order) and the result of that is written, so partition
    numbers are stable. Inside a partition the place is a row_number; a group that runs over
    several partitions adds the sizes of its parts in earlier partitions, a table of at most one row per
    partition and group part. Rows equal in all of `order` take places in any order.
    """
    spread = df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id())
    spread = written(spread.withColumn("_null_group", F.col(group).isNull()), "positions")
    sizes = spread.groupBy("_part", "_null_group", group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_null_group", group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long"))).drop("_n")
    local = Window.partitionBy("_part", "_null_group", group).orderBy(*order)
    s = spread.withColumn("_row", F.row_number().over(local)).alias("s")
    t = starts.alias("t")
    on = [F.col("s._part") == F.col("t._part"), F.col(f"s.{group}").eqNullSafe(F.col(f"t.{group}"))]
    return s.join(t, on, "left").select(*[F.col(f"s.{c}") for c in df.columns],
                                        (F.col("s._row") - 1 + F.col("t._start")).cast("long").alias(out))
