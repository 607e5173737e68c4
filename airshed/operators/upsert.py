"""Merge upsert without a table format.

`merge_plan` is the whole MERGE as one DataFrame: a full outer join of target and batch on the
key, an `_action` per row, and the merged values. `upsert` persists it for a parquet table
partitioned by `obs_date_ist`: only partitions the batch touches are read (its days are
collected as it is written), the merged rows are staged first and then
written over just the changed partitions, so a failed job never leaves a half-written table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import SILVER_KEY, VALUE_COLS
from ..schemas import SILVER_COLUMNS, TABLE_DDL
from ..sources import fs

INSERT, UPDATE, UNCHANGED, KEEP = "insert", "update", "unchanged", "keep"


def any_changed(left: str, right: str, cols: list[str]) -> Column:
    """True when any column differs, null-safely (null vs value counts as a change)."""
    out = F.lit(False)
    for c in cols:
        out = out | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def merge_plan(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str] = SILVER_KEY,
    compare_cols: list[str] = VALUE_COLS,
    version_col: str = "ingested_at",
    columns: list[str] | None = None,
) -> DataFrame:
    """Merged rows with `_action` in insert / update / unchanged / keep.

    A matched row is updated (all columns) only when the batch version is strictly newer and a
    compared value differs; unmatched batch rows are inserted; target rows are never deleted.
    Before-images of updated rows are kept in `_old_*` columns (for I8). Keys must be unique
    on both sides.
    """
    columns = columns or [c for c in target.columns if not c.startswith("_")]
    non_key = [c for c in columns if c not in keys]
    t = target.select(*[F.col(c) for c in columns], F.lit(True).alias("_in_t")).alias("t")
    b = batch.select(*[F.col(c) for c in columns], F.lit(True).alias("_in_b")).alias("b")
    cond = None
    for k in keys:
        e = F.col(f"t.{k}") == F.col(f"b.{k}")
        cond = e if cond is None else cond & e
    j = t.join(b, cond, "full_outer")
    in_t, in_b = F.col("t._in_t").isNotNull(), F.col("b._in_b").isNotNull()
    newer = F.col(f"b.{version_col}") > F.col(f"t.{version_col}")
    action = (F.when(~in_t, F.lit(INSERT))
              .when(~in_b, F.lit(KEEP))
              .when(newer & any_changed("t", "b", compare_cols), F.lit(UPDATE))
              .otherwise(F.lit(UNCHANGED)))
    j = j.withColumn("_action", action)
    take_b = F.col("_action").isin(INSERT, UPDATE)
    merged = [F.coalesce(F.col(f"t.{k}"), F.col(f"b.{k}")).alias(k) for k in keys]
    merged += [F.when(take_b, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in non_key]
    before = [F.when(F.col("_action") == UPDATE, F.col(f"t.{c}")).alias(f"_old_{c}") for c in non_key]
    return j.select(*merged, "_action", *before)


def changes() -> dict[str, Column]:
    """Which rows of a merge are changes, by kind."""
    return {"inserted": F.col("_action") == INSERT, "updated": F.col("_action") == UPDATE}


def merge_counts(plan: DataFrame) -> DataFrame:
    """K5: rows per action (insert / update / unchanged / keep)."""
    return plan.groupBy("_action").agg(F.count("*").alias("rows"))


def merged_state(plan: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The target after the merge."""
    cols = columns or [c for c in plan.columns if not c.startswith("_")]
    return plan.select(*cols)


def revisions(plan: DataFrame, keys: list[str] = SILVER_KEY, superseded_by: str = "run_id") -> DataFrame:
    """I8: before-images of updated rows, with the run that replaced them and, where rows have `updated_at`, until when they were valid."""
    old = [c[len("_old_"):] for c in plan.columns if c.startswith("_old_")]
    until = [F.col("updated_at").alias("superseded_at")] if "updated_at" in old else []
    return plan.where(F.col("_action") == UPDATE).select(
        *keys, *[F.col(f"_old_{c}").alias(c) for c in old if c not in keys],
        F.col(superseded_by).alias("superseded_by_run"), *until,
    )


@dataclass
class MergeResult:
    inserted: int
    updated: int
    changed_dates: list  # local dates with inserts or updates (bounded by the batch's days)


class StagedMerge:
    """K4 written to a staging folder beside the table, not yet applied.

    `candidate` holds the merged rows of the partitions that change (what a commit would
    publish); gates can check it before `commit()` rewrites those partitions.
    """

    def __init__(self, spark: SparkSession, table_path: str, staged_path: str | None, cols: list[str],
                 partition_col: str, staged: DataFrame, first: bool = False):
        self.spark, self.table_path, self.staged_path, self._staged = spark, table_path, staged_path, staged
        self.cols, self.partition_col, self._first = cols, partition_col, first
        self._stats: list | None = None

    def count_by(self, counted: DataFrame) -> None:
        """Take the counts from a summary of the staged rows by their day (and more), with `inserted` and `updated`."""
        self._stats = counted.groupBy(self.partition_col).agg(F.sum("inserted").alias("ins"), F.sum("updated").alias("upd")).collect()

    @property
    def stats(self) -> list:
        """One row for each day of the batch with its inserts and updates; the staged rows are counted where no summary was given."""
        if self._stats is None:
            self.count_by(self._staged.groupBy(self.partition_col).agg(*[F.count_if(c).alias(n) for n, c in changes().items()]))
        return self._stats

    @property
    def inserted(self) -> int:
        return sum(r["ins"] for r in self.stats)

    @property
    def updated(self) -> int:
        return sum(r["upd"] for r in self.stats)

    @property
    def dates(self) -> list:
        return [r[self.partition_col] for r in self.stats]

    @property
    def changed_dates(self) -> list:
        return sorted(r[self.partition_col] for r in self.stats if r["ins"] or r["upd"])

    @property
    def plan(self) -> DataFrame:
        return self._staged if self._first else self._staged.where(F.col(self.partition_col).isin(self.changed_dates))

    @property
    def candidate(self) -> DataFrame:
        return merged_state(self.plan, self.cols)

    @property
    def checked(self) -> DataFrame:
        """All staged days, whether they change or not, with `_action`: what row checks look at."""
        return self._staged.select(*self.cols, "_action")

    def commit(self, revisions_path: str | None = None) -> MergeResult:
        """Before-images first: a commit that breaks after them is merged again and writes them twice, which readers of history
        allow for (`history.versions`), while the other way round they would be lost."""
        if self.changed_dates:
            if revisions_path and not self._first:
                (revisions(self.plan).withColumn("revised_at", F.current_timestamp())
                 .write.mode("append").parquet(revisions_path))
            (self.candidate.hint("rebalance", F.col(self.partition_col)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(self.partition_col).parquet(self.table_path))
        self.discard()
        return MergeResult(self.inserted, self.updated, self.changed_dates)

    def discard(self) -> None:
        if self.staged_path:
            fs.delete(self.spark, self.staged_path)


def _kept(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """`df` written and read back with its own columns, so that no file is opened to find them."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_merge(spark: SparkSession, batch: DataFrame, table_path: str,
                partition_col: str = "obs_date_ist", table_ddl: str = TABLE_DDL["silver"]) -> StagedMerge:
    """Evaluate K4 once against the partitions the batch touches and stage the result.

    Only target partitions holding a batch date are read: the dates are observed as the batch is written. Where the table is missing
    (K3) or holds no row of those dates, all rows are inserts and the batch itself is what is staged; a table without rows is
    one like any other, as it is read with its declared columns.
    """
    cols = [c for c in SILVER_COLUMNS if c in batch.columns]
    staged_path = fs.staging_path(table_path)
    batch_path = f"{staged_path}-batch"  # the batch is evaluated once and read from here
    seen = Observation("batch_days")
    batch = batch.select(*cols).withColumn("_action", F.lit(INSERT)).observe(seen, F.collect_set(partition_col).alias("days"))
    inserts, touched = _kept(spark, batch, batch_path), None
    if fs.table_exists(spark, table_path):
        # Size bound: one date per distinct calendar day of the batch (a decade of history is ~3,650).
        touched = spark.read.schema(table_ddl).parquet(table_path).select(*cols).where(F.col(partition_col).isin(seen.get["days"] or []))
    if touched is None or touched.isEmpty():
        return StagedMerge(spark, table_path, batch_path, cols, partition_col, inserts, first=True)
    staged = _kept(spark, merge_plan(touched, inserts.select(*cols), columns=cols), staged_path)  # inputs are fully read before any rewrite
    fs.delete(spark, batch_path)
    return StagedMerge(spark, table_path, staged_path, cols, partition_col, staged)


def upsert(spark: SparkSession, batch: DataFrame, table_path: str, revisions_path: str | None = None,
           partition_col: str = "obs_date_ist") -> MergeResult:
    """K4 persisted into a parquet table partitioned by `partition_col` (silver: obs_date_ist).

    The partition column is a function of the key, so a key never changes partition. Only the
    partitions holding an insert or update are rewritten (dynamic partition overwrite), from
    the staged merge, so a failed job never leaves a half-merged table.
    """
    return stage_merge(spark, batch, table_path, partition_col).commit(revisions_path)
