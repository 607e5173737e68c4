"""Scoring texts with a causal self-attention language model over subword ids.

Documents are cut into blocks of some megabytes. A block's distinct words are tokenized once; its row holds each document's word
numbers, the words, their counts in training documents, and their subword ids. Word and subword counts are sums over all blocks. Attention
sees subword ids, each with a vector of its own, and predicts the next id from the hidden state by binary decisions: six lead to one of 64 classes
(the most frequent ids and the end alone, the others by frequency and place in a word), the class's Huffman tree leads on to the id. Decisions start
at the corpus shares. A text's probability is exact and every document's probabilities sum to one.

All weights are fitted on all training tokens, each of them a target once, in windows side by side: in each of `ROUNDS` rounds, every partition passes over
the next of `ROUNDS` interleaved parts of its blocks' windows, cut from the blocks as they are read; the partitions' weights are averaged
by Spark: some 5,000 numbers by windows, an id's or decision's vector by how often a partition saw it, two vectors an id of the vocabulary at most. Distinct words of blocks, not tokens, are shuffled, once: a word's rows sum up its count,
which goes back to their blocks. Scoring runs over overlapping windows, each token scored once.

Defined cases: null and empty texts have the end token only; null doc_ids train like others; repeated rows are scored alike; without
training documents counts are zero and the model is nearly uniform; an empty table gives no row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import attention as A
from .common import ship, written

BLOCK_BYTES = 6 << 20  # text of a block
ROUNDS = 3
RANKS = "byte_bpe_50k.tiktoken"  # vocabulary of byte pieces; the id after the last one is the end
TOGETHER = 512  # words tokenized in one call
BATCH = 256  # windows cut at once
STEP_WINDOWS = 32  # of them scored at once, small enough for a core's cache
WEIGHTS = [f"w{k}" for k in range(A.WIDTH)]  # columns of a row of weights

BLOCK_SCHEMA = ("block long, doc_ids array<long>, held array<boolean>, sizes array<int>, numbers binary, words array<string>, "
                "train array<long>, sub binary, sub_sizes binary, sub_ids array<int>, sub_counts array<long>")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> "Pieces":
    """One instance per process and file."""
    return Pieces(path)


class Pieces:
    """Byte-pair ids of words; words that begin with a space and hold none may be tokenized in one string."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        self.encoding = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths, self.begins = np.zeros(self.size, np.int64), np.zeros(self.size, bool)
        for piece, i in ranks.items():
            self.lengths[i], self.begins[i] = len(piece), piece[:1] == b" "

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and the number of ids of each."""
        ids, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), TOGETHER):
            some = [f" {w}" for w in words[at:at + TOGETHER]]
            joined = "".join(some)
            if not joined.isprintable() or joined.count(" ") > len(some):  # other space inside: one by one
                apart = [self.encoding.encode_ordinary(w) for w in some]
                ids.append(np.array([i for a in apart for i in a], np.int64))
                sizes.append(np.array([len(a) for a in apart], np.int64))
                continue
            found = np.array(self.encoding.encode_ordinary(joined), np.int64)
            ends = np.searchsorted(np.cumsum(self.lengths[found]), np.cumsum([len(w.encode()) for w in some])) + 1
            ids.append(found)
            sizes.append(np.diff(ends, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)


def packed(values: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones and so on, compressed, after their size."""
    raw = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(raw: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], size, "zstd", asbytes=True), np.uint8)
    return planes.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).reshape(-1)


def _flat(lengths: np.ndarray, starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Positions of all subwords of a sequence of words."""
    sizes = lengths[numbers]
    ends = np.cumsum(sizes)
    kind = np.int32 if not len(ends) or max(ends[-1], starts[-1]) < 1 << 31 else np.int64
    at = np.repeat((starts[numbers] - (ends - sizes)).astype(kind), sizes)
    at += np.arange(len(at), dtype=kind)
    return at


class _Numbers(dict):
    """Gives each new word the next number."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _block_row(block: int, doc_ids: list, held: list[bool], docs: list[list[bytes]], pieces: Pieces) -> list:
    known = _Numbers({b"": 0})  # the end is word 0
    number = known.__getitem__
    parts = [np.fromiter((*map(number, words), 0), np.int32, len(words) + 1) for words in docs]
    numbers = np.concatenate(parts)
    sizes = np.array([len(p) for p in parts])
    learn = np.repeat(~np.array(held), sizes)
    train = np.bincount(numbers[learn], minlength=len(known))
    words = [w.decode("utf-8", "surrogatepass") for w in known]
    sub, sub_sizes = pieces.encode(words[1:])
    sub, sub_sizes = np.concatenate(([pieces.end], sub)).astype("<u2"), np.concatenate(([1], sub_sizes))
    starts = np.cumsum(sub_sizes) - sub_sizes
    counts = np.bincount(sub, weights=np.repeat(train, sub_sizes), minlength=1).astype(np.int64)
    seen = np.flatnonzero(counts)
    return [block, doc_ids, held, sizes.tolist(), packed(numbers.astype("<i4")), words, train.tolist(), packed(sub),
            packed(sub_sizes.astype("<u4")), seen.tolist(), counts[seen].tolist()]


def _record(schema: pa.Schema, rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
    ("numbers", pa.binary()), ("words", pa.list_(pa.string())), ("train", pa.list_(pa.int64())), ("sub", pa.binary()),
    ("sub_sizes", pa.binary()), ("sub_ids", pa.list_(pa.int32())), ("sub_counts", pa.list_(pa.int64()))])


def _to_blocks(path: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pieces = vocabulary_of(path)
        part, k = TaskContext.get().partitionId(), 0
        doc_ids, held, docs, size = [], [], [], 0
        for batch in batches:
            ids, flags, texts = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text")
            for i, doc_id in enumerate(ids):
                text = (texts[i].as_py() or "").encode("utf-8", "surrogatepass")
                doc_ids.append(doc_id)
                held.append(flags[i])
                docs.append(text.lower().split())
                size += len(text)
                if size >= block_bytes:
                    yield _record(_BLOCK_ARROW, [_block_row((part << 32) + k, doc_ids, held, docs, pieces)])
                    doc_ids, held, docs, size, k = [], [], [], 0, k + 1
        if docs:
            yield _record(_BLOCK_ARROW, [_block_row((part << 32) + k, doc_ids, held, docs, pieces)])

    return run


def id_classes(counts: np.ndarray, begins_word: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each subword id, natural log of its share in its class (add one), and the classes' shares.

    Half of the classes are the most frequent ids (and the end); the others split the rest, word beginnings and
    inner pieces apart, into parts of like mass by falling frequency.
    """
    alone = A.CLASSES // 2
    order = np.lexsort((np.arange(len(counts)), -counts))
    order = np.concatenate(([end_id], order[order != end_id]))
    of = np.zeros(len(counts), np.int64)
    of[order[:alone]] = np.arange(alone)
    rest = order[alone:]
    at, each = alone, (A.CLASSES - alone) // 2
    for part in (rest[begins_word[rest]], rest[~begins_word[rest]]):
        mass = np.cumsum(counts[part] + 1.0)
        of[part] = at + np.minimum(each - 1, (mass - counts[part] - 1) * each // max(1.0, mass[-1] if len(mass) else 1.0)).astype(np.int64)
        at += each
    smooth = counts + 1.0
    total = np.bincount(of, weights=smooth, minlength=A.CLASSES)
    total = np.where(total > 0, total, 1.0)
    return of, np.log(smooth / total[of]), total / total.sum()


def _subwords(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A block's subword ids one after the other, and the number of each document."""
    sizes, numbers = np.array(row["sizes"], np.int64), unpacked(row["numbers"], "<i4")
    sub_sizes = unpacked(row["sub_sizes"], "<u4").astype(np.int64)
    doc_subs = np.add.reduceat(sub_sizes[numbers], np.cumsum(sizes) - sizes)
    return unpacked(row["sub"], "<u2")[_flat(sub_sizes, np.cumsum(sub_sizes) - sub_sizes, numbers)], doc_subs


def training_windows(doc_subs: np.ndarray, held: np.ndarray, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and first token of the windows of one of `parts` interleaved parts of a block's training windows.

    Training windows lie side by side, so that each training token is a target once.
    """
    doc, start = A.window_starts(doc_subs, A.CONTEXT)
    chosen = np.flatnonzero(~held[doc])[part::parts]
    return doc[chosen], start[chosen]


def _fit_partition(shared, part: int, parts: int):
    """Rows of `A.WIDTH` weights with the number of windows or times seen; without ids' vectors in `shared`, classes are the tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        A.keep_memory()
        flat, of, *vectors = shared.value
        weights, n, adam = flat, 0, A.Adam(A.RATE / (1 + part))  # smaller steps from round to round
        vectors = [v.copy() for v in vectors]  # the worker process keeps the shared ones
        more = [*vectors, *(A.IdSteps(v, A.ID_RATE / (1 + part)) for v in vectors)]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, doc_subs = _subwords(row)
                doc, start = training_windows(doc_subs, np.array(row["held"], bool), part, parts)
                if not len(doc):
                    continue
                begins = np.cumsum(doc_subs) - doc_subs
                tokens, before = (ids.astype(np.int32), len(of)) if vectors else (of[ids], A.START)
                for at in range(0, len(doc), BATCH):
                    some = slice(at, at + BATCH)
                    inputs, targets, there = A.windows(tokens, begins, doc_subs, doc[some], start[some], before)
                    weights = A.fit(weights, inputs, np.where(there, targets, -1), adam, *more)
                n += len(doc)
        if n:
            rows, times = [weights.reshape(-1, A.WIDTH)], [np.full(A.SIZE // A.WIDTH, n)]
            for v, steps in zip(vectors, more[1:]):
                rows, times = [*rows, v.own, v.nodes], [*times, *steps.seen]
            rows, times = np.concatenate(rows).astype(np.float32), np.concatenate(times)
            seen = np.flatnonzero(times)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(times[seen]), *(pa.array(c) for c in rows[seen].T)], names=["i", "n", *WEIGHTS])

    return run


def train(blocks: DataFrame, tokenizer_path: str, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, A.Ids]:
    """Attention weights, class of each id, log share of each id in its class, and the ids' vectors."""
    spark = blocks.sparkSession
    pieces = vocabulary_of(tokenizer_path)
    counts = np.zeros(pieces.size, np.int64)
    pairs = blocks.select(F.inline(F.arrays_zip("sub_ids", "sub_counts")))
    for i, n in pairs.groupBy("sub_ids").agg(F.sum("sub_counts")).collect():  # at most the vocabulary's size
        counts[i] = n
    of, log_share, shares = id_classes(counts, pieces.begins, pieces.end)
    flat, vectors = A.initial(shares), A.Ids(of, counts + 1.0)
    learn = blocks.select("held", "sizes", "numbers", "sub", "sub_sizes")
    for k in range(rounds):
        shared = spark.sparkContext.broadcast((flat, of, vectors))
        fitted = learn.mapInArrow(_fit_partition(shared, k, rounds), "i long, n long, " + ", ".join(f"{w} float" for w in WEIGHTS))
        sums = fitted.groupBy("i").agg(*(F.sum(F.col(w).cast("double") * F.col("n")) / F.sum("n") for w in WEIGHTS))
        found = sums.toArrow()  # a row for each of the model's vectors
        shared.destroy()
        rows = np.concatenate([flat.reshape(-1, A.WIDTH), vectors.own, vectors.nodes])
        rows[found.column(0).to_numpy()] = np.stack([c.to_numpy() for c in found.columns[1:]], axis=1)
        flat, own, nodes = np.split(rows, [len(flat) // A.WIDTH, len(flat) // A.WIDTH + len(vectors.own)])
        flat, vectors = flat.reshape(-1), vectors.copy()
        vectors.own, vectors.nodes = own, nodes
    return flat, of, log_share, vectors


def _text_scores(flat: np.ndarray, of: np.ndarray, log_share: np.ndarray, ids: np.ndarray, sizes: np.ndarray, vectors: A.Ids | None = None) -> np.ndarray:
    """Natural log probability of each document; `ids`: the documents' subword ids one after the other.

    Without `vectors`, an id has its share in its class.
    """
    p, begins = A.views(flat), np.cumsum(sizes) - sizes
    if vectors is None:
        tokens, before, total = of[ids], A.START, np.add.reduceat(log_share[ids], begins)
    else:
        tokens, before, total = ids.astype(np.int32), len(of), np.zeros(len(sizes))
    doc, start = A.window_starts(sizes)
    for group, skip in ((np.flatnonzero(start == 0), 0), (np.flatnonzero(start > 0), A.CONTEXT - A.STEP)):
        for at in range(0, len(group), BATCH):
            some = group[at:at + BATCH]
            inputs, targets, there = A.windows(tokens, begins, sizes, doc[some], start[some], before)
            scored = A.log_probs(p, inputs, targets, skip, vectors, STEP_WINDOWS) * there[:, skip:]
            total += np.bincount(doc[some], weights=scored.sum(axis=1, dtype=np.float64), minlength=len(sizes))
    return total


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        A.keep_memory()
        flat, of, log_share, vectors, n_all, n_words = shared.value
        denominator = np.log10(n_all + n_words + 1.0)
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                numbers = unpacked(row["numbers"], "<i4")
                counts = np.zeros(len(unpacked(row["sub_sizes"], "<u4")), np.int64)
                counts[np.array(row["at"], np.int64)] = row["count"]
                begins = np.cumsum(sizes) - sizes
                base = np.add.reduceat((np.log10(counts + 1.0) - denominator)[numbers], begins)
                known = np.add.reduceat((counts > 0)[numbers].astype(np.int64), begins)
                ids, doc_subs = _subwords(row)
                score = _text_scores(flat, of, log_share, ids, doc_subs, vectors) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(sizes), pa.array(known),
                     pa.array(np.full(len(sizes), n_all)), pa.array(base), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def word_counts(blocks: DataFrame) -> DataFrame:
    """For each distinct word of a block that training documents hold: block, at (its number there), count (in all of them),
    first (true in one row of a word). A word has at most a row a block.
    """
    rows = blocks.select("block", F.posexplode(F.arrays_zip("words", "train")).alias("at", "_word"))
    rows = rows.select("block", "at", F.col("_word.words").alias("word"), F.col("_word.train").alias("train"))
    same = Window.partitionBy("word")
    rows = rows.select("block", "at", F.sum("train").over(same).alias("count"), (F.col("block") == F.min("block").over(same)).alias("first"))
    return rows.where("count > 0")


def score(documents: DataFrame, held_out, tokenizer_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    `held_out`: a boolean column; the model and all counts come from the other documents.
    """
    spark = documents.sparkSession
    ship(spark)
    path = tokenizer_path or default_path()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                            F.col("text").cast("string").alias("text"))
    blocks = written(rows.mapInArrow(_to_blocks(path, block_bytes), BLOCK_SCHEMA), "lm-blocks")
    counts = written(word_counts(blocks), "lm-counts")
    n_all, n_words = counts.where("first").agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    flat, of, log_share, vectors = train(blocks, path)
    answers = counts.groupBy(F.col("block").alias("_block")).agg(F.collect_list("at").alias("at"), F.collect_list("count").alias("count"))  # in one order
    shared = spark.sparkContext.broadcast((flat, of, log_share, vectors, int(n_all), int(n_words)))  # vocabulary file's size and the model
    needed = blocks.select("block", "doc_ids", "held", "sizes", "numbers", "sub", "sub_sizes")
    joined = needed.join(answers, F.col("block") == F.col("_block"), "left").select(
        "doc_ids", "held", "sizes", "numbers", "sub", "sub_sizes",
        F.coalesce("at", F.array().cast("array<int>")).alias("at"), F.coalesce("count", F.array().cast("array<long>")).alias("count"))
    return joined.mapInArrow(_score(shared), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                             "base_score double, score double")
