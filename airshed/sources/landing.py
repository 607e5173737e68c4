"""Landing zone: JSON envelopes around untouched source responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import POLLUTANTS
from ..operators.ranges import CROWD, crowded, numbered
from ..schemas import LANDING_SCHEMA, PAYLOAD_SCHEMA, RESPONSES_SCHEMA, VERSIONED_LANDING

HOUR_FORMAT = "yyyy-MM-dd'T'HH:mm"
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
NO_INGEST_DATE = "unknown"
FEW_FILES = 4  # of a date
SOME_FILES = 32  # of a date, of SOME_BYTES each: what the tasks of one load write
SOME_BYTES = 1 << 20
LARGE_FILE = 4 << 20  # bytes
LINES_A_FILE = 1 << 16  # a gzipped file is read by one task: more files of a batch, more tasks
REQUIRED_FIELDS = ["run_id", "ingested_at", "city_id", "payload"]


def _field(name: str):
    return lambda e: e[name]


def response_struct(entries: Column, latitude: Column, longitude: Column) -> Column:
    """Source-shaped response from an array of hour structs (ts_utc + API-named values)."""
    hourly = F.struct(
        F.transform(entries, lambda e: F.date_format(e["ts_utc"], HOUR_FORMAT)).alias("time"),
        *[F.transform(entries, _field(api)).alias(api) for api in POLLUTANTS],
    )
    return F.struct(latitude.alias("latitude"), longitude.alias("longitude"), hourly.alias("hourly"))


def build_envelopes(hourly: DataFrame, source: str, order: list[str] | None = None, crowd: int = CROWD, by_run: bool = False) -> DataFrame:
    """K1 as a DataFrame: source-shaped envelopes of hourly readings, one value per hour each.

    `hourly` has city_id, run_id, ingested_at (NTZ, UTC), ts_utc, latitude, longitude and the
    six values under our column names (co in ug/m3). A run that reports the same hour more
    than once gets one envelope per version: `version` is the ordinal within (site,
    run, hour), in `order` (ascending); a later version wins ties in the silver dedupe. An envelope therefore covers one site, one UTC
    day, one run and one slot: at most 24 entries, like a real source response, whatever the data volume. Arrays
    are built from structs sorted by time; to_json keeps nulls inside arrays, so values
    round-trip.

    One shuffle by (site, run, day) serves both the numbering and the grouping; with `by_run` it is one by ranges of (run, site, day), so that
    a task's envelopes are of one run or a few and `write_landing` can land them `as_built`. Site-days of a run with more than `crowd` rows are numbered by range partitions instead, so that an hour with any number of versions is spread over tasks.
    """
    order = order or []
    site_day, hour = ["city_id", "run_id", "_day"], ["city_id", "run_id", "_day", "ts_utc"]
    needed = ["city_id", "run_id", "ts_utc", "ingested_at", "latitude", "longitude", *POLLUTANTS.values()]
    rows = hourly.select(*dict.fromkeys([*needed, *order])).withColumn("_day", F.to_date("ts_utc"))
    in_order = [F.col(c) for c in order] or [F.lit(0)]
    place = F.row_number().over(Window.partitionBy(*hour).orderBy(*in_order))
    together = (lambda df: df.repartitionByRange("run_id", "city_id", "_day")) if by_run else (lambda df: df.repartition(*site_day))
    hot = crowded(rows, site_day, crowd)
    if hot is None:
        return _grouped(together(rows).withColumn("_slot", place), source)
    same = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in site_day]
    few = together(rows.join(hot, same, "left_anti")).withColumn("_slot", place)
    many = numbered(rows.join(hot, same, "left_semi"), in_order, "_slot", hour)
    return _grouped(few, source).unionByName(_grouped(many, source))


def _grouped(numbered_rows: DataFrame, source: str) -> DataFrame:
    """Envelopes of rows with their place from 1 among the versions of their hour (`_slot`)."""
    api_of = {col: api for api, col in POLLUTANTS.items()}
    slotted = numbered_rows.withColumn("_slot", (F.col("_slot") - 1).cast("long"))
    entry = F.struct(F.col("ts_utc"), *[F.col(col).alias(api_of[col]) for col in POLLUTANTS.values()])
    grouped = slotted.groupBy("city_id", "run_id", "_day", "_slot").agg(
        F.max("ingested_at").alias("_ingested"),
        F.min("latitude").alias("_lat"),
        F.min("longitude").alias("_lon"),
        F.array_sort(F.collect_list(entry)).alias("_entries"),
    )
    return grouped.select(
        "run_id",
        F.date_format("_ingested", INSTANT_FORMAT).alias("ingested_at"),
        F.lit(source).alias("source"),
        "city_id",
        F.date_format("_day", "yyyy-MM-dd").alias("window_start"),
        F.date_format("_day", "yyyy-MM-dd").alias("window_end"),
        F.to_json(response_struct(F.col("_entries"), F.col("_lat"), F.col("_lon"))).alias("payload"),
        F.format_string("%s_%s_v%05d_landing.jsonl", F.col("run_id"), F.date_format("_day", "yyyyMMdd"),
                        F.col("_slot")).alias("_file"),
        F.col("_slot").alias("version"),
    )


def write_landing(envelopes: DataFrame, landing_dir: str, batch: Column | None = None, as_built: bool = False) -> None:
    """K1 sink: gzipped JSON lines under ingest_date=<date of ingestion>/, appended, never rewritten; a few files a date, as rows are
    rebalanced, of at most `LINES_A_FILE` lines. The version of an hour is a field of the line. `batch`: several batches land in one pass, each in its `batch_folder`. `as_built`:
    the envelopes were built `by_run` and are written by the tasks that built them, without a further shuffle of their texts."""
    folders = ["ingest_date"] if batch is None else ["batch", "ingest_date"]
    dated = envelopes.withColumn("ingest_date", F.substring("ingested_at", 1, 10)).drop("_file")
    placed = dated if batch is None else dated.withColumn("batch", batch)
    (placed if as_built else placed.hint("rebalance", *[F.col(c) for c in folders])).write \
        .mode("append").option("compression", "gzip").option("maxRecordsPerFile", LINES_A_FILE).partitionBy(*folders).json(landing_dir)


def batch_folder(landing_dir: str, name: str) -> str:
    """Where `write_landing` puts a batch."""
    return f"{landing_dir.rstrip('/')}/batch={name}"


def _require(c: str) -> Column:
    return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"landing line without {c}"))).otherwise(F.col(c))


def parse_envelopes(raw: DataFrame) -> DataFrame:
    """Type the envelope strings; a missing required field fails the job (FAILFAST spirit)."""
    from ..functions.localtime import to_utc_ntz

    checked = raw.select(*[_require(c).alias(c) if c in REQUIRED_FIELDS else F.col(c) for c in raw.columns])
    return checked.select(
        "run_id",
        to_utc_ntz(F.to_timestamp("ingested_at")).alias("ingested_at"),
        "source",
        "city_id",
        F.to_date("window_start").alias("window_start"),
        F.to_date("window_end").alias("window_end"),
        "payload",
        (F.coalesce("version", F.lit(0)) if "version" in raw.columns else F.lit(0)).cast("long").alias("version"),
        *[c for c in raw.columns if c not in VERSIONED_LANDING.fieldNames()],
    )


def ingest_date_of(path: Column) -> Column:
    """The ingest date in a landing path, as text; files outside such a folder share one value."""
    found = F.regexp_extract(path, "/ingest_date=([^/]+)/", 1)
    return F.when(found != "", found).otherwise(F.lit(NO_INGEST_DATE))


def landing_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Landing lines not yet parsed: `value`, the file's base name (`source_file`), its full path (`source_path`, the skip key: base
    names can repeat across ingest dates) and the ingest date in that path."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    path = F.col("_metadata.file_path")
    return lines.where(F.trim("value") != "").select("value", F.col("_metadata.file_name").alias("source_file"), path.alias("source_path"),
                                                     ingest_date_of(path).alias("ingest_date"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Envelope fields of landing lines, typed; a corrupt line stops the job."""
    envelope = F.from_json("value", VERSIONED_LANDING, {"mode": "FAILFAST"})
    parsed = lines.select(envelope.alias("e"), *[c for c in lines.columns if c != "value"])
    return parse_envelopes(parsed.select("e.*", *[c for c in parsed.columns if c != "e"]))


def read_landing(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Landing JSON lines with the declared schema; corrupt lines stop the job."""
    return parse_lines(landing_lines(spark, paths))


def landing_dates(spark: SparkSession, paths: list[str] | str) -> list[str]:
    """Ingest dates of landing files, from their names alone: a listing, no file is opened. At most one entry for each calendar day."""
    return [date for date, *_ in landing_files(spark, paths)]


def landing_files(spark: SparkSession, paths: list[str] | str) -> list[tuple[str, int, int]]:
    """Each ingest date of landing files with their number and bytes, from a listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length")
    dated = files.groupBy(ingest_date_of(F.col("path")).alias("date")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"))
    return sorted((r["date"], r["n"], r["size"]) for r in dated.collect())


def are_few(files: list[tuple[str, int, int]]) -> bool:
    """Whether the files of each date are few or large, so that a table written in their layout is no heap of small files."""
    return all(n <= FEW_FILES or size >= n * LARGE_FILE or n <= SOME_FILES and size >= n * SOME_BYTES for _, n, size in files)


def unread_lines(lines: DataFrame, bronze: DataFrame | None, dates: list[str]) -> DataFrame:
    """The lines of files that bronze doesn't hold, found before they are parsed.

    A file's ingest date follows from its path and bronze is partitioned by it, so only the partitions of `dates` are read. What is joined
    is one row for each landing file of those dates, not one for each line, so it is broadcast and the lines stay where they are read:
    by their path they would be shuffled into as many tasks as there are files.
    """
    if bronze is None:
        return lines
    return new_files_only(lines, F.broadcast(bronze.where(F.col("ingest_date").isin(dates)).select("source_path").distinct()))


def new_files_only(landing: DataFrame, bronze: DataFrame | None, key: str = "source_path") -> DataFrame:
    """Drop landing rows whose file is already in bronze (left anti join on the file key).

    The anti join needs no distinct below it; where many rows share a file, `unread_lines` joins the distinct files.
    """
    if bronze is None:
        return landing
    return landing.join(bronze.select(key), key, "left_anti")


def read_saved_responses(spark: SparkSession, path: str, dim_ordered: DataFrame, run_id: str, source: str,
                         ingested_at: str) -> DataFrame:
    """S2 + J6: a saved file of responses (JSON array, or one object) paired with sites by position.

    `dim_ordered` has (position, city_id) with position 0.. in configured order. Sites past the
    number of responses are not used; a response without a site fails the job. The window of
    every envelope is the first and last hour of the first response. The file is read whole
    (a saved source response is small); the pairing is an equi-join on position.
    """
    text = spark.read.text(path, wholetext=True)
    as_array = F.from_json("value", RESPONSES_SCHEMA)
    as_object = F.from_json("value", PAYLOAD_SCHEMA)
    body = text.select(F.when(F.trim("value").startswith("["), as_array)
                       .otherwise(F.array(as_object)).alias("responses"),
                       F.col("_metadata.file_name").alias("_name"))
    first_times = F.col("responses")[0]["hourly"]["time"]
    exploded = body.select("_name",
                           F.substring(F.element_at(first_times, 1), 1, 10).alias("window_start"),
                           F.substring(F.element_at(first_times, -1), 1, 10).alias("window_end"),
                           F.posexplode("responses").alias("position", "r"))
    paired = exploded.join(dim_ordered.select("position", "city_id"), "position", "left")
    return paired.select(
        F.lit(run_id).alias("run_id"),
        F.lit(ingested_at).alias("ingested_at"),
        F.concat(F.lit(source), F.lit(":"), F.col("_name")).alias("source"),
        F.when(F.col("city_id").isNotNull(), F.col("city_id"))
        .otherwise(F.raise_error(F.lit("more responses than configured sites"))).alias("city_id"),
        "window_start",
        "window_end",
        F.to_json("r").alias("payload"),
    )

