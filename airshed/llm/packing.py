"""Packing: bounded-space online packing of token sequences.

Every input partition is one online packer. A document's ids end with id 0; full windows are cut
from its front and the tail is placed best-fit among a fixed number of open windows. If none has
room, the fullest open window is emitted and a new one opened. Windows still open at the end of a
partition are left over: they are merged across partitions by the same rule, group by group, so that
neither a task nor the driver holds more than `MERGE_ROWS` leftovers.

Defined cases: null and empty texts are the single end id; repeated rows are packed once each; null
doc_id stays null; an empty table gives no piece; input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .subword import default_path, subwords

WINDOW = 1024
OPEN_WINDOWS = 64
END_ID = 0
MERGE_ROWS = 100_000  # leftover windows merged in one task (a few numbers each)
LOCAL_BITS = 33  # sequence ids: partition number above, window number of the partition below
MERGED = 1 << 62  # merged leftovers have ids from here

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """At most `limit` open windows; `place` returns (window, offset) for an item of `size` <= capacity."""

    def __init__(self, capacity: int, limit: int, first_id: int = 0):
        self.capacity, self.limit = capacity, limit
        self.used: dict[int, int] = {}
        self.next_id = first_id

    def new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, size: int) -> tuple[int, int, int | None]:
        """Window and offset for the item, and the window emitted to make room, if any."""
        fit = [(self.capacity - used - size, w) for w, used in self.used.items() if used + size <= self.capacity]
        emitted = None
        if fit:
            _, window = min(fit)
        else:
            if len(self.used) >= self.limit:
                emitted = max(self.used, key=lambda w: (self.used[w], -w))
                del self.used[emitted]
            window = self.new()
            self.used[window] = 0
        at = self.used[window]
        self.used[window] = at + size
        if self.used[window] == self.capacity:
            del self.used[window]
        return window, at, emitted


def _pack_partition(path: str, window: int, open_windows: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        words, packer = subwords(path), OpenWindows(window, open_windows)
        end = np.array([END_ID], dtype="<u4").tobytes()
        filled: dict[int, int] = {}  # leftover bookkeeping: tokens in each open window
        cols: list[list] = [[] for _ in range(9)]

        def flush():
            arrays = [pa.array(c, t) for c, t in zip(cols, _types(with_ids))]
            out = pa.RecordBatch.from_arrays(arrays, names=_names(with_ids))
            for c in cols:
                c.clear()
            return out

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo in range(0, len(texts), 256):
                some = texts.slice(lo, 256).to_pylist()
                for doc_id, raw in zip(doc_ids[lo:lo + 256], words.encode(some)):
                    raw += end
                    n = len(raw) // 4
                    for start in range(0, n, window):
                        piece = raw[4 * start:4 * (start + window)]
                        size = len(piece) // 4
                        if size == window:
                            w, at = packer.new(), 0
                        else:
                            w, at, _ = packer.place(size)
                        row = (doc_id, start, size, zlib.crc32(piece), n, (part << LOCAL_BITS) + w, at, part,
                               piece if with_ids else None)
                        for c, v in zip(cols, row):
                            c.append(v)
                if len(cols[0]) >= 4096:
                    yield flush()
        if cols[0]:
            yield flush()
        for w, used in packer.used.items():
            filled[w] = used
        if filled:  # one marker row per leftover window: length holds its tokens, doc_tokens is null
            for w, used in filled.items():
                for c, v in zip(cols, (None, None, used, None, None, (part << LOCAL_BITS) + w, None, part, None)):
                    c.append(v)
            yield flush()

    return run


def _names(with_ids: bool) -> list[str]:
    return ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part"] + \
        (["ids"] if with_ids else [])


def _types(with_ids: bool) -> list[pa.DataType]:
    return [pa.int64()] * 8 + ([pa.binary()] if with_ids else [])


def _merge_group(window: int, open_windows: int):
    """Leftover windows of one group, largest first, into merged windows; ids are unique by group."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        base = MERGED + (key[0].as_py() << LOCAL_BITS)
        rows = sorted(zip(t["length"].to_pylist(), t["sequence_id"].to_pylist()), key=lambda r: (-r[0], r[1]))
        packer = OpenWindows(window, open_windows)
        out = []
        for size, seq in rows:
            w, at, _ = packer.place(size)
            out.append((seq, base + w, at))
        seqs, to, at = (list(c) for c in zip(*out))
        return pa.table({"old_id": pa.array(seqs, pa.int64()), "new_id": pa.array(to, pa.int64()),
                         "shift": pa.array(at, pa.int64())})

    return run


def pack(documents: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, with_ids: bool = False) -> DataFrame:
    """One row per piece (PIECES); `with_ids` adds `ids`, the piece's little-endian unsigned 32-bit ids.

    Pieces of one sequence_id lie without gaps from offset 0 and together hold at most `window` ids.
    A document is cut only at multiples of `window`.
    """
    spark = documents.sparkSession
    ship(spark)
    path = tokenizer_path or default_path()
    schema = PIECES + ", part long" + (", ids binary" if with_ids else "")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = written(docs.mapInArrow(_pack_partition(path, window, open_windows, with_ids), schema), "packing")
    is_marker = F.col("doc_tokens").isNull()
    left = placed.where(is_marker).select("sequence_id", "length", "part")
    # about MERGE_ROWS leftovers a group: whole partitions, each with at most `open_windows` rows
    per_group = max(1, MERGE_ROWS // open_windows)
    left = left.withColumn("grp", (F.col("part") / per_group).cast("long"))
    moved = left.groupBy("grp").applyInArrow(_merge_group(window, open_windows),
                                             "old_id long, new_id long, shift long")
    p = placed.where(~is_marker)
    joined = p.join(moved, p.sequence_id == moved.old_id, "left")
    return joined.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.coalesce("new_id", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        *(["ids"] if with_ids else []))
