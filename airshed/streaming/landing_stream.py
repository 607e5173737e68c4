"""Landing -> bronze -> silver -> gold as a Structured Streaming job (I1, I4, I5 incrementally).

The file source's checkpoint remembers which landing files were read, which gives the
"skip files already loaded" rule of the batch loader for free; `trigger(availableNow=True)`
processes what has landed and stops, so the same job serves scheduled runs. Each micro-batch
is applied with the batch operators in `foreachBatch`, written so that replaying an epoch
after a failure converges: bronze appends only files it does not hold yet, the silver merge
leaves equal versions unchanged, and days logged as pending are published whatever the batch changes.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import lakehouse
from ..schemas import BRONZE_COLUMNS, VERSIONED_LANDING
from ..sources import landing


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of landing JSON lines with the declared schema; corrupt lines fail."""
    reader = (spark.readStream.schema(VERSIONED_LANDING).option("mode", "FAILFAST")
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    path = F.col("_metadata.file_path")
    raw = reader.json(landing_dir).select(*VERSIONED_LANDING.fieldNames(), F.col("_metadata.file_name").alias("source_file"),
                                          path.alias("source_path"), landing.ingest_date_of(path).alias("ingest_date"),
                                          F.col("_metadata.file_size").alias("file_size"))
    return landing.parse_envelopes(raw)


def apply_batch(spark: SparkSession, root: str, dim: DataFrame, batch: DataFrame, epoch_id: int,
                halo_days: int = 1, as_of: _dt.datetime | None = None) -> dict:
    """One micro-batch: bronze append (new files only), then merge, gate, commit and publish as in a run.

    Days that an interrupted epoch left pending are published here even if this batch changes nothing.
    """
    size = F.col("file_size") if "file_size" in batch.columns else F.lit(0)
    files = batch.select("ingest_date", "source_path", size.alias("size")).distinct()
    listed = [tuple(r) for r in files.groupBy("ingest_date").agg(F.count(F.lit(1)), F.sum("size")).collect()]  # one for each calendar day
    fresh = landing.unread_lines(batch, lakehouse.stored(spark, root, "bronze"), [date for date, *_ in listed])
    lakehouse.append_bronze(spark, fresh, root, as_landed=landing.are_few(listed))
    # the batch's own rows (replays included) go through silver; merging them again is a no-op
    done = lakehouse.merge_rows(spark, root, batch.select(*BRONZE_COLUMNS), dim, f"stream-{epoch_id}", as_of, halo_days)
    return {"epoch": epoch_id, "inserted": done["silver_inserted"], "updated": done["silver_updated"], "gold_rows": done["gold_rows"]}


def start(spark: SparkSession, root: str, dim: DataFrame, *, checkpoint: str | None = None,
          available_now: bool = True, processing_time: str | None = None, log: list | None = None,
          max_files_per_trigger: int | None = None, live: bool = True) -> StreamingQuery:
    """Start the landing stream. The checkpoint defaults to a folder under the lakehouse root
    (shared storage), never a machine-local one. `live`: each epoch checks freshness at its own time."""
    checkpoint = checkpoint or f"{root.rstrip('/')}/_meta/stream_checkpoints/landing"

    def each(batch: DataFrame, epoch_id: int) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None) if live else None
        out = apply_batch(spark, root, dim, batch, epoch_id, as_of=now)
        if log is not None:
            log.append(out)

    writer = (landing_stream(spark, lakehouse.at(root, "landing"), max_files_per_trigger).writeStream.foreachBatch(each)
              .option("checkpointLocation", checkpoint).queryName(f"airshed_landing_{uuid.uuid4().hex[:8]}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")
    return writer.start()
