"""Importance resampling: documents drawn by how much more likely their hashed n-grams are in a target than in the corpus.

Each task turns a slice of texts into features with Arrow kernels: ASCII lower case, a split at what separates words, the
flattened words and their dictionary. An n-gram is the number of its first n - 1 words beside the dictionary index of its last, taken from the
indices shifted by a place; the CRC of each distinct pair continues that of its first part, so a CRC is computed once for each distinct n-gram
of a slice and taken for all others. The bucket counts of tasks are added by Spark into a table of `buckets` rows, its proven bound; as
gains it goes to all tasks, which take one for each feature and add them up by document. Scores are ranked by range partitions: only
numbers are shuffled, and no group is gathered.

Defined cases: null, empty and word-less texts have no feature and weight 0; texts of any length are read whole, in
slices of some megabytes or one text; repeated rows are scored alike and take a rank each; a null doc_id has the text '' in its hash and comes
last among equals; without documents there is no row, without target texts every t and T is 0; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positions, ship, written

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what lies between words, once lower-cased
MAX_N = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
SLICE_BYTES = 8 << 20  # text of a slice, or one longer text


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """The first row and the texts of each slice: rows in order, of at most `most` bytes together unless a single one."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def word_indices(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of some texts, the index of each word in order, and the row of each word."""
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")), pattern=GAPS)
    words, rows = pc.list_flatten(split), pc.list_parent_indices(split)
    filled = pc.not_equal(words, "")  # a split has an empty end beside a gap at an end
    coded = words.filter(filled).dictionary_encode()
    return ([w.encode() for w in coded.dictionary.to_pylist()], coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            rows.filter(filled).to_numpy(zero_copy_only=False).astype(np.int64))


def features(texts: pa.Array, max_n: int = MAX_N, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n up to `max_n`: row and bucket of every run of n words."""
    words, index, rows = word_indices(texts)
    crcs = np.fromiter((zlib.crc32(w) for w in words), dtype=np.int64, count=len(words))
    grams = index  # number of the n-gram that begins at each word, as far as its row goes
    yield rows, (crcs % buckets)[grams]
    for n in range(2, max_n + 1):
        whole = rows[:len(rows) - n + 1] == rows[n - 1:]
        starts = np.flatnonzero(whole)
        if not len(starts):
            return
        pairs = grams[starts] * len(words) + index[starts + n - 1]
        distinct, numbers = np.unique(pairs, return_inverse=True)
        crcs = np.fromiter((zlib.crc32(b" " + words[p % len(words)], int(crcs[p // len(words)])) for p in distinct.tolist()),
                           dtype=np.int64, count=len(distinct))
        grams = np.zeros(len(rows), dtype=np.int64)
        grams[starts] = numbers
        yield rows[starts], (crcs % buckets)[numbers]


def _count_buckets(max_n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                for _, bucket in features(texts, max_n, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return run


def bucket_counts(table: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket: at most `buckets` rows reach the driver, added up by Spark."""
    ship(table.sparkSession)
    counted = table.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_buckets(max_n, buckets), "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the corpus)) of each bucket, counts plus one."""
    size = len(corpus)
    s_all, t_all = float(corpus.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def _weigh(gains: np.ndarray, max_n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                size = len(texts)
                counted, added, words = (np.zeros(size, dtype=np.int64) for _ in range(3))
                for n, (rows, bucket) in enumerate(features(texts, max_n, len(gains)), 1):
                    by_row = np.bincount(rows, minlength=size)
                    counted += by_row
                    words = by_row if n == 1 else words
                    ends = np.cumsum(by_row)
                    sums = np.concatenate([[0], np.cumsum(gains[bucket])])
                    added += sums[ends] - sums[ends - by_row]
                mean = np.floor_divide(added, np.maximum(counted, 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, size), pa.array(words), pa.array(counted), pa.array(mean)],
                                                 names=["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * a Gumbel draw) that depends on the seed and the document only."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, max_n: int = MAX_N,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document; rank is null where it isn't drawn.

    Drawn are the `percent` (rounded down) of the documents with `min_words` words or more that score highest.
    """
    gains = bucket_gains(bucket_counts(documents, max_n, buckets), bucket_counts(target, max_n, buckets))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weighed = docs.mapInArrow(_weigh(gains, max_n), "doc_id long, n_words long, n_features long, weight long")
    scored = written(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resampling")
    fit = F.col("n_words") >= min_words
    draws = scored.where(fit).count() * percent // 100
    keys = {"_unfit": ~fit, "_down": -F.col("score"), "_nameless": F.col("doc_id").isNull()}
    ranked = positions(scored.withColumns(keys), "_unfit", ["_down", "_nameless", "doc_id"], out="_place")
    rank = F.when(~F.col("_unfit") & (F.col("_place") < draws), F.col("_place") + 1)
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn(documents: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The documents with a drawn doc_id, all their columns. Only ids are shuffled beside them; a null id can't be found again."""
    picked = resample(documents, target, **settings).where("rank is not null").select(F.col("doc_id").alias("_drawn"))
    return documents.join(picked, F.col("doc_id").cast("long") == F.col("_drawn"), "left_semi")
