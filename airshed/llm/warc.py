"""WARC archives of pages: written as one gzip stream a file, normalised to a gzip member a record, and read back by an offset index.

`write_archives` writes each partition's records into archives whose whole content is one gzip stream, as tools that
compress a finished file do: no record can be reached without inflating all before it. `normalise` inflates such a stream once, from its start
to its end, rewrites every record as a member of its own, and writes beside the archive a sidecar with a line for each record: where its
member lies. `read_records` reads only members, by those offsets, and checks payload digests. Archives and sidecars lie in the
shared folder; each task writes under a name of its own attempt, and a table written by Spark's commit protocol names the files that
count, so what a lost executor left behind is never read.

Records with equal payloads of at least `min_payload` bytes are written once: that with the largest page_id is the response, the others
revisit it and carry only their headers, among them the full payload's length and digest.

Defined cases: null html is the empty payload; a null url has no target URI; null page_ids come before all others, so they are responses only if
their payload has no other id, and then all of them; rows equal in page_id and payload are records of the same type each; an
empty table gives no archive and no row; other columns of the pages are ignored. Records are streamed in pieces, so a very long one takes memory for
itself only.
"""

from __future__ import annotations

import base64
import contextlib
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_path, ship, written

MIN_PAYLOAD = 0
ARCHIVE_BYTES = 64 << 20  # of records, beyond which a task begins another archive
PIECE = 1 << 18  # bytes read or inflated at a time
READ_BYTES = 8 << 20  # members that are read in one go (or one longer member)
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"  # of all records, so that archives depend on the pages only

# Names and forms of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URI_CHARACTERS = "%/:?#[]@!$&'()*+,;=-._~"
# End of fixed values.
PAGE_URN = "urn:page:"

FILES = "file string, records long, bytes long"
ENTRY = "file string, offset long, length long, record_id string, record_type string, payload_digest string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _arrow(ddl)
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _attempt_name(suffix: str) -> str:
    """A file name that no other attempt of any task uses."""
    from pyspark import TaskContext

    return f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"


# --------------------------------------------------------------------------------------------- records


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, record_type: str, refers_to: int | None) -> bytes:
    """One WARC record: HTTP headers with the payload (response) or alone (revisit)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if record_type == "response" else http
    lines = [f"WARC-Type: {record_type}", f"WARC-Record-ID: <{PAGE_URN}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=URI_CHARACTERS)}")
    lines.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if record_type == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{PAGE_URN}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; `head` ends before the empty line and begins with the version or status line."""
    fields = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in fields}


def parse(raw: bytes) -> dict:
    """A whole record: page_id, url, payload_bytes, payload_digest, record_type, refers_to. Raises where record and payload disagree."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(VERSION):
        raise ValueError(f"not a WARC record: {head[:40]!r}")
    fields = headers(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(headers(http)["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest or length")
    number = lambda name: (lambda v: int(v) if v else None)(fields.get(name, "").strip("<>").removeprefix(PAGE_URN))
    return {"page_id": number("warc-record-id"), "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": number("warc-refers-to")}


# --------------------------------------------------------------------------------------------- writing


def with_targets(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """page_id, url, payload, refers_to of each page; refers_to is null for responses.

    The largest id of each payload is a partial aggregate on its digest; only ids of payloads that occur twice or more are joined back.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("_digest", F.unhex(F.sha1("payload")))
    large = F.octet_length("payload") >= min_payload
    kept = rows.where(large).groupBy("_digest").agg(F.max("page_id").alias("_kept"), F.count(F.lit(1)).alias("_n"))
    kept = kept.where("_n > 1").select(F.col("_digest").alias("_same"), "_kept")
    joined = rows.join(kept, large & (F.col("_digest") == F.col("_same")), "left")
    refers = F.when(~F.col("_kept").eqNullSafe(F.col("page_id")), F.col("_kept"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def _write_partition(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _place(folder)
        fs.create_dir(base)
        done: list[tuple] = []
        with contextlib.ExitStack() as open_files:
            stream = name = None
            records = size = 0
            for batch in batches:
                for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if stream is None:
                        name, records, size = _attempt_name(".warc.gz"), 0, 0
                        sink = open_files.enter_context(fs.open_output_stream(f"{base}/{name}", compression=None))
                        stream = open_files.enter_context(gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=LEVEL, mtime=0))
                    raw = record(page_id, url, payload, "response" if refers_to is None else "revisit", refers_to)
                    stream.write(raw)
                    records, size = records + 1, size + len(raw)
                    if size >= archive_bytes:
                        open_files.close()
                        done.append((f"{folder}/{name}", records, size))
                        stream = None
            open_files.close()
            if stream is not None:
                done.append((f"{folder}/{name}", records, size))
        yield _batch(done, FILES)

    return run


def write_archives(pages: DataFrame, folder: str | None = None, min_payload: int = MIN_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages into archives of one gzip stream each; returns the table of files (FILES)."""
    spark = pages.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "warc")
    return written(with_targets(pages, min_payload).mapInArrow(_write_partition(folder, archive_bytes), FILES), "warc-files")


# ----------------------------------------------------------------------------------------- normalising


def inflate(source) -> Iterator[bytes]:
    """The content of a gzip file in pieces of at most PIECE bytes, each byte of the stream read once; members in a row are one content."""
    machine = zlib.decompressobj(31)
    fresh = True
    while data := source.read(PIECE):
        while data:
            fresh = False
            if piece := machine.decompress(data, PIECE):
                yield piece
            if machine.eof:
                data, machine, fresh = machine.unused_data, zlib.decompressobj(31), True
            else:
                data = machine.unconsumed_tail
    while not fresh and not machine.eof:
        piece = machine.decompress(b"", PIECE)
        if not piece:
            raise EOFError("the gzip stream ends too soon")
        yield piece


class Pieces:
    """A stream of byte strings, read up to a separator or a number of bytes."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, bytearray()

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with `mark`; None at the end of the stream."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                if self.held.strip():
                    raise EOFError("a record is cut off")
                return None
        out = bytes(self.held[:at + len(mark)])
        del self.held[:at + len(mark)]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces."""
        while n:
            if not self.held and not self._more():
                raise EOFError("a record is cut off")
            out = bytes(self.held[:n])
            del self.held[:n]
            n -= len(out)
            yield out


class Counted:
    """A sink that counts what was written."""

    def __init__(self, sink):
        self.sink, self.size = sink, 0

    def write(self, data: bytes) -> int:
        self.sink.write(data)
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        self.sink.flush()


def rewrite(source, sink, file: str) -> Iterator[tuple]:
    """Copy a stream of records to `sink`, a gzip member for each; yields their index entries (ENTRY)."""
    pieces, out = Pieces(inflate(source)), Counted(sink)
    while (head := pieces.until(b"\r\n\r\n")) is not None:
        start = len(head) - len(head.lstrip(b"\r\n"))  # spare line ends between records
        head = head[start:]
        if not head.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {head[:40]!r}")
        fields = headers(head[:-4])
        offset = out.size
        with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=LEVEL, mtime=0) as member:
            member.write(head)
            for piece in pieces.take(int(fields["content-length"]) + 4):
                member.write(piece)
        yield (file, offset, out.size - offset, fields.get("warc-record-id"), fields.get("warc-type"),
               fields.get("warc-payload-digest", "").removeprefix("sha1:") or None)


def _normalise_files(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _place(folder)
        fs.create_dir(base)
        names, done = [f.split()[0] for f in ENTRY.split(", ")], []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name, n = _attempt_name(".warc.gz"), 0
                from_fs, source = _place(path)
                with (from_fs.open_input_stream(source, compression=None) as stream,
                      fs.open_output_stream(f"{base}/{name}", compression=None) as sink,
                      fs.open_output_stream(f"{base}/{name}.index.jsonl", compression=None) as sidecar):
                    for entry in rewrite(stream, sink, f"{folder}/{name}"):
                        sidecar.write((json.dumps(dict(zip(names, entry))) + "\n").encode())
                        n += 1
                    size = sink.tell()
                done.append((f"{folder}/{name}", n, size))
        yield _batch(done, FILES)

    return run


def normalise(files: DataFrame, folder: str | None = None) -> DataFrame:
    """Rewrite every archive of `files` (column `file`), one task an archive; returns the table of new files (FILES).

    Beside each archive lies `<archive>.index.jsonl`, a line (ENTRY) for each record in order.
    """
    spark = files.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "warc-members")
    dealt = files.select("file").repartition(max(1, files.count()))
    return written(dealt.mapInArrow(_normalise_files(folder), FILES), "warc-members")


def read_index(files: DataFrame) -> DataFrame:
    """The sidecar lines of the given archives (ENTRY); files that no finished task named are left out."""
    spark = files.sparkSession
    folders = [r[0] for r in files.select(F.regexp_replace("file", "/[^/]*$", "")).distinct().collect()]  # one for each `normalise`
    if not folders:
        return spark.createDataFrame([], ENTRY)
    lines = spark.read.schema(ENTRY).json([f"{f}/*.index.jsonl" for f in folders])
    return lines.join(files.select("file"), "file", "left_semi").select(*[f.split()[0] for f in ENTRY.split(", ")])


# --------------------------------------------------------------------------------------------- reading


def _read_members(read_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted(zip(*(c.to_pylist() for c in batch.columns)))
            at, found = 0, []
            while at < len(rows):  # members that lie side by side are read together
                file, first, size = rows[at]
                stop = at + 1
                while stop < len(rows) and rows[stop][0] == file and rows[stop][1] == first + size and size < read_bytes:
                    size += rows[stop][2]
                    stop += 1
                fs, path = _place(file)
                with fs.open_input_file(path) as source:
                    source.seek(first)
                    data = memoryview(source.read(size))
                for _, offset, length in rows[at:stop]:
                    raw = gzip.decompress(data[offset - first:offset - first + length])
                    found.append((*parse(raw).values(), file, offset))
                at = stop
            yield _batch(found, RECORDS)

    return run


def read_records(index: DataFrame) -> DataFrame:
    """The records behind index entries (file, offset, length), their payloads checked: RECORDS."""
    ship(index.sparkSession)
    return index.select("file", "offset", "length").mapInArrow(_read_members(READ_BYTES), RECORDS)


def roundtrip(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write the pages, normalise the archives, and read every record back by its index entry."""
    return read_records(read_index(normalise(write_archives(pages, min_payload=min_payload))))
