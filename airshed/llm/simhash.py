"""SimHash near-dedup: a binary trie self-join over 64-bit fingerprints.

Copies share a fingerprint, so the trie holds each distinct fingerprint once, with its smallest
document. The trie's upper levels are walked by Spark: a fingerprint belongs to the subtree of its first
`depth` bits, and each pair of subtrees whose roots differ in at most `max_bits` bits is one unit of work.
Within a unit both subtrees are walked together bit by bit, with the differing bits added up, and a
node pair is dropped as soon as they exceed the budget. A unit keeps a spanning forest of its links,
not the links, so its output never exceeds its input. A fingerprint has at most
1 + 64 + 64*63/2 fingerprints within 2 bits, so no group of copies can make a unit quadratic.

Defined cases: null, empty and word-less texts have fingerprint 0 and link like any other; texts of
fewer words than a shingle are one shingle; repeated rows are copies of each other; null doc_ids take part in
links but are never a component's id unless all its ids are null (then null); an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_record, ship, written
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SUBTREE_TARGET = 4_000  # distinct fingerprints in a subtree on average; more documents: a deeper split
BLOCK_PAIRS = 1 << 18  # node pairs expanded at once


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), (ends[shingle - 1:] - 1).tolist())),
                    np.uint64, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        part = h[lo:lo + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            out = np.zeros(len(texts), np.uint64)
            for i in range(len(texts)):
                out[i] = fingerprint(texts[i].as_py(), shingle)
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(out.view(np.int64))],
                                             names=[*(batch.schema.names[i] for i in keep), "fp"])

    return run


class Forest:
    """Component labels (smallest index) of n nodes under links that arrive in blocks."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[u], label[v]
            apart = a != b
            if not apart.any():
                return
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(label, high, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def trie_links(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int, forest: Forest) -> None:
    """Walk two subtries (sorted distinct fingerprints with one common prefix of `depth` bits each) together.

    `b` None: the subtrie with itself. Links go to `forest`; nodes of `b` are numbered after those of `a`.
    """
    self_join = b is None
    b = a if self_join else b
    shift_b = 0 if self_join else len(a)
    if not len(a) or not len(b):
        return
    below = np.uint64((1 << (64 - depth)) - 1)
    zeros: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def before(level: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of zero bits at `level` before each index, for both sides."""
        if level not in zeros:
            bit = np.uint64(63 - level)
            count = [np.concatenate(([0], np.cumsum((x >> bit) & np.uint64(1) == 0))) for x in ((a,) if self_join else (a, b))]
            zeros[level] = (count[0], count[-1])
        return zeros[level]

    start = np.array([[0, len(a), 0, len(b), 0]], np.int64)  # from, to in a; from, to in b; differing bits
    stack = [(depth, start)]
    while stack:
        level, nodes = stack.pop()
        if len(nodes) > BLOCK_PAIRS:
            stack.append((level, nodes[BLOCK_PAIRS:]))
            nodes = nodes[:BLOCK_PAIRS]
        leaf = ((nodes[:, 1] - nodes[:, 0]) == 1) & ((nodes[:, 3] - nodes[:, 2]) == 1)
        if leaf.any():  # single fingerprints: the bits below are added at once
            i, j = nodes[leaf, 0], nodes[leaf, 2]
            near = np.bitwise_count((a[i] ^ b[j]) & below) <= budget
            forest.link(i[near], j[near] + shift_b)
            nodes = nodes[~leaf]
        if not len(nodes) or level == 64:
            continue
        za, zb = before(level)
        lo, hi, lo2, hi2, used = nodes.T
        mid, mid2 = lo + za[hi] - za[lo], lo2 + zb[hi2] - zb[lo2]
        same = self_join & (lo == lo2) & (hi == hi2)
        children = [(lo, mid, lo2, mid2, used, None), (mid, hi, mid2, hi2, used, None),
                    (lo, mid, mid2, hi2, used + 1, None), (mid, hi, lo2, mid2, used + 1, ~same if self_join else None)]
        out = []
        for c0, c1, c2, c3, u, only in children:
            ok = (c1 > c0) & (c3 > c2) & (u <= budget)
            if only is not None:
                ok &= only
            if self_join:  # a single fingerprint with itself
                ok &= ~((c1 - c0 == 1) & (c3 - c2 == 1) & (c0 == c2))
            if ok.any():
                out.append(np.column_stack([c0[ok], c1[ok], c2[ok], c3[ok], u[ok]]))
        if out:
            stack.append((level + 1, np.concatenate(out)))


def _unit(depth: int, max_bits: int):
    """One pair of subtrees: rows (left prefix, right prefix, fp) -> (u, v) of a spanning forest."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        left, right = key[0].as_py(), key[1].as_py()
        fps = np.unique(t["fp"].to_numpy().view(np.uint64))
        prefix = fps >> np.uint64(64 - depth) if depth else np.zeros(len(fps), np.uint64)
        budget = max_bits - (left ^ right).bit_count()
        forest = Forest(len(fps))
        a = fps[prefix == left]
        if left == right:
            trie_links(a, None, depth, budget, forest)
        else:  # left < right, so a's fingerprints come first in `fps`
            trie_links(a, fps[prefix == right], depth, budget, forest)
        linked = np.flatnonzero(forest.label != np.arange(len(fps)))
        signed = fps.view(np.int64)
        return pa.table({"u": pa.array(signed[linked]), "v": pa.array(signed[forest.label[linked]])})

    return run


def _near_prefixes(prefix: int, depth: int, max_bits: int) -> list[int]:
    out = [prefix]
    near = {prefix}
    for _ in range(max_bits):
        near = {p ^ (1 << k) for p in near for k in range(depth)} | near
    return out + sorted(near - {prefix})


def _to_units(depth: int, max_bits: int):
    """Each fingerprint to every unit its subtree takes part in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.array(_near_prefixes(0, depth, max_bits), np.int64)
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for lo in range(0, len(fps), 8192):
                some = fps[lo:lo + 8192]
                own = (some.view(np.uint64) >> np.uint64(64 - depth)).astype(np.int64) if depth else np.zeros(len(some), np.int64)
                other = own[:, None] ^ masks[None, :]
                own = np.broadcast_to(own[:, None], other.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(own, other).ravel()), pa.array(np.maximum(own, other).ravel()),
                     pa.array(np.repeat(some, len(masks)))], names=["l", "r", "fp"])

    return run


def trie_self_join(classes: DataFrame, count: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect all fingerprints `fp` of `classes` within `max_bits`: a forest for each unit."""
    depth = max(4, (count // SUBTREE_TARGET).bit_length())
    units = classes.select("fp").mapInArrow(_to_units(depth, max_bits), "l long, r long, fp long")
    return units.groupBy("l", "r").applyInArrow(_unit(depth, max_bits), "u long, v long")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document row: doc_id, text_key (hash of the text), fp, root_doc and root_key.

    (root_doc, root_key) is the smallest (doc_id, text_key) of the document's component, null ids last.
    """
    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    prints = written(rows.mapInArrow(_fingerprints(shingle), "doc_id long, text_key long, fp long"), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_key"))
    classes = written(prints.groupBy("fp").agg(F.min(first).alias("first")), "classes")
    roots = components(trie_self_join(classes, classes.count(), max_bits))
    labelled = classes.join(roots, classes.fp == roots.u, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    heads = labelled.groupBy("root").agg(F.min("first").alias("head"))
    members = written(labelled.join(heads, "root").select(F.col("fp").alias("member"), "head"), "members")
    return prints.join(members, prints.fp == members.member).select(
        "doc_id", "text_key", "fp", F.col("head.doc_id").alias("root_doc"), F.col("head.text_key").alias("root_key"))


def keep_one(documents: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """`documents` (same columns) with one row of each group of near duplicates, the one with the smallest doc_id."""
    groups = near_duplicates(documents, shingle, max_bits)
    heads = groups.where(F.col("doc_id").eqNullSafe(F.col("root_doc")) & (F.col("text_key") == F.col("root_key")))
    heads = heads.select(F.col("doc_id").alias("_head_doc"), F.col("text_key").alias("_head_key")).distinct()
    rows = documents.select(as_record(documents), F.col("doc_id").cast("long").alias("_doc"),
                            F.xxhash64(F.col("text").cast("string")).alias("_key"))
    kept = rows.join(heads, F.col("_doc").eqNullSafe(F.col("_head_doc")) & (F.col("_key") == F.col("_head_key")), "left_semi")
    return kept.dropDuplicates(["_doc", "_key"]).select(*[F.col(f"_row.`{c}`") for c in documents.columns])
