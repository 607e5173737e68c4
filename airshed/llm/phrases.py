"""Phrase collocation mining: contiguous phrases that stay together, by a HAT-trie count of word-id sequences.

1. Texts become blocks of word numbers, a block for each language of a slice of some megabytes, with the slice's distinct words and their
   counts. Word counts are sums over blocks; frequent words get dense ids by range partitions, the most frequent the
   smallest, and the ids go back to the blocks by a join on a block's distinct words, not on its tokens. A part of a frequent phrase is
   frequent itself, so a rare word ends a sequence without losing any phrase.
2. Pairs of ids, and then sequences of up to `max_words` ids of which each pair beside each other may be frequent, are counted in
   HAT-tries (`hat_trie`): one for each language of a task, spilling whole subtrees as sorted runs that are written as a table. What pairs may be frequent a
   filter tells: a bitmap of at most FILTER_BITS bits of the frequent pairs' hashes. It only errs towards keeping, so counts are whole.
3. Runs are merged per prefix partition. Runs of pairs, the bulk, are cut at partitions that follow from the ids, packed, and added up
   partition by partition. Longer sequences are sorted by Spark's range partitions; a pass over each adds up every prefix of 3 to
   `max_words` ids, and prefixes that lie at a partition's edge are added up across partitions. No key's rows are gathered in one task.
4. Every cut of a frequent phrase is scored by joins with the counts of both parts, in decimals of 38 digits (an overflow is an error, not a wrong
   number), and phrases inside a longer one that is as frequent are dropped by a join.

Defined cases: null and empty texts have no words; a null lang is `und`, together with a lang of that name; repeated rows count each; ties in
score and count go by the phrase in byte order; a language without a frequent phrase has no row, nor has an empty table; other columns are ignored.
A text longer than a slice is a slice of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positions, ship, written
from .hat_trie import BUDGET, HatTrie, add_up, columns_of, id_at, pack
from .resampling import slices

BREAKS = r"[.,;:!?\x0A-\x0D]+"  # what ends a piece
GAPS = r"[\x20\x09]+"  # what ends a word
MARK = "\n"  # stands for a piece's end; no word holds it
MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
ABSORB_PERCENT = 100
FILTER_BITS = 1 << 26  # 8 MB at most
CHUNK_BITS = 1 << 15
BLOCK_BYTES = 8 << 20  # text of a slice that is cut into blocks
PARTITION_WORDS = 1 << 22  # occurrences in a prefix partition, about

BLOCK = "lang string, block long, words array<string>, counts array<long>, n_words long, n_tokens long, tokens binary"


# ---------------------------------------------------------------------------------------- blocks of ids


def token_numbers(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of some texts, and all their words as numbers from 1 in order; 0 where a piece or text ends."""
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    spaced = pc.binary_join_element_wise(pc.replace_substring_regex(lowered, pattern=BREAKS, replacement=f" {MARK} "), MARK, " ")
    words = pc.list_flatten(pc.split_pattern_regex(spaced, pattern=GAPS))
    coded = words.filter(pc.not_equal(words, "")).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    mark = pc.index(coded.dictionary, MARK).as_py()
    numbers = np.where(index == mark, 0, index + (index < mark)).astype(np.int32)
    return pc.filter(coded.dictionary, pc.not_equal(coded.dictionary, MARK)), numbers


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 33
    for batch in batches:
        for start, texts in slices(batch.column(1), BLOCK_BYTES):
            lang = batch.column(0).slice(start, len(texts))
            for name in lang.unique().to_pylist():
                words, numbers = token_numbers(texts.filter(pc.equal(lang, name)))
                if not len(words):
                    continue
                counts = np.bincount(numbers, minlength=len(words) + 1)[1:]
                row = [[name], [block], [words], [counts], [int(counts.sum())], [len(numbers)], [zlib.compress(numbers.tobytes(), 1)]]
                types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([c[0].to_pylist()], t) if isinstance(c[0], pa.Array) else pa.array(c, t)
                                                  for c, t in zip(row, types)], names=[f.split()[0] for f in BLOCK.split(", ")])
                block += 1


def word_blocks(documents: DataFrame) -> DataFrame:
    """The texts as blocks (BLOCK), written."""
    ship(documents.sparkSession)
    docs = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return written(docs.mapInArrow(_blocks, BLOCK), "phrase-blocks")


def frequent_words(blocks: DataFrame, min_count: int) -> DataFrame:
    """lang, word, f, id of the words found `min_count` times or more; ids of a language are dense from 1, frequent words first."""
    words = blocks.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))))
    found = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    placed = positions(found.withColumn("_down", -F.col("f")), "lang", ["_down", "word"], out="_place")
    return written(placed.select("lang", "word", "f", (F.col("_place") + 1).alias("id")), "phrase-words")


def with_ids(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """lang, n_tokens, tokens of each block, with `local` (the block's numbers of frequent words) and `ids` (their ids); written."""
    numbered = blocks.select("block", "lang", F.posexplode("words").alias("_at", "word"))
    same = ["lang", "word"]
    # every word of a block, most of them rare; by shuffle whatever the size, as the words have no proven bound for a broadcast
    looked_up = numbered.join(words.select(*same, "id").hint("merge"), same, "left")
    known = F.when(F.col("id").isNotNull(), F.struct((F.col("_at") + 1).cast("int").alias("at"), F.col("id").cast("int").alias("id")))
    found = looked_up.groupBy("block").agg(F.collect_list(known).alias("_found"))
    joined = blocks.select("lang", "block", "n_tokens", "tokens").join(found, "block")
    return written(joined.select("lang", "n_tokens", "tokens", F.col("_found.at").alias("local"), F.col("_found.id").alias("ids")), "phrase-ids")


# ------------------------------------------------------------------------------------------- counting


def pair_places(lang: str, pairs: np.ndarray, bits: int) -> np.ndarray:
    """Place of each pair in a bitmap of `bits` (a power of two) bits."""
    h = (pairs.astype(np.uint64) ^ np.uint64(zlib.crc32(lang.encode()) * 0x9E3779B1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64)


def sequences(ids: np.ndarray, may_pair: np.ndarray, least: int, most: int) -> list[np.ndarray]:
    """Columns of the longest sequence of up to `most` ids from each place on, of those with `least` ids or more.

    `may_pair[i]`: the ids at i and i + 1 may stand in one sequence.
    """
    n = len(ids)
    reach = [np.ones(n, bool)]
    for k in range(1, most):
        step = np.zeros(n, bool)
        step[:max(0, n - k)] = reach[-1][:max(0, n - k)] & may_pair[k - 1:n - 1]
        reach.append(step)
    starts = np.flatnonzero(reach[least - 1])
    padded = np.concatenate([ids, np.zeros(most, ids.dtype)])
    return pack([np.where(reach[k][starts], padded[starts + k], 0) for k in range(most)])


def _block_ids(row: dict) -> np.ndarray:
    """The ids of a block's tokens in order; 0 for rare words and ends of pieces."""
    numbers = np.frombuffer(zlib.decompress(row["tokens"]), dtype=np.int32)
    of = np.zeros(int(numbers.max(initial=0)) + 1, dtype=np.int32)
    of[np.array(row["local"], dtype=np.int64)] = np.array(row["ids"], dtype=np.int32)
    return of[numbers]


def _run_schema(depth: int) -> str:
    return ", ".join(["lang string", *(f"k{i} long" for i in range(columns_of(depth))), "n long"])


def _spilled(depth: int, least: int, bitmap: bytes | None, trie_settings: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Language and sorted run of whatever the tries of a task spill."""
    tries: dict[str, HatTrie] = {}
    known = None if bitmap is None else np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").view(bool)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            lang, ids = row["lang"], _block_ids(row)
            may_pair = (ids[:-1] > 0) & (ids[1:] > 0)
            if known is not None:
                at = np.flatnonzero(may_pair)
                may_pair[at] = known[pair_places(lang, pack([ids[at], ids[at + 1]])[0], len(known))]
            trie = tries.setdefault(lang, HatTrie(depth, **trie_settings))
            for run in trie.add(sequences(ids, may_pair, least, depth)):
                yield lang, run
            if sum(map(len, tries.values())) > trie.budget:  # several languages in one task
                name = max(tries, key=lambda t: len(tries[t]))
                for run in tries[name].spill():
                    yield name, run
    for lang, trie in tries.items():
        for run in trie.spill():
            yield lang, run


def _count(depth: int, least: int, bitmap: bytes | None, trie_settings: dict):
    names = [f.split()[0] for f in _run_schema(depth).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, (columns, counts) in _spilled(depth, least, bitmap, trie_settings, batches):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), *map(pa.array, columns), pa.array(counts)], names=names)

    return run


def runs(coded: DataFrame, depth: int, least: int = 2, bitmap: bytes | None = None, **trie_settings) -> DataFrame:
    """Sorted runs of sequences of `least` to `depth` ids with their counts, written."""
    return written(coded.mapInArrow(_count(depth, least, bitmap, trie_settings), _run_schema(depth)), "phrase-runs")


# Pairs are the bulk of what is counted, so their runs are cut into packed prefix partitions instead of rows.


def prefix_partition(pairs: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that say which prefix partition a pair belongs to; sorted pairs of one partition lie side by side.

    Ids are ranks by frequency, so the words of an octave of ids have about as many occurrences as any other octave's. An octave is cut into 16
    parts of ids or, with more words in the corpus, into so many that a part has some PARTITION_WORDS occurrences; a
    single id with more is cut by the second id's octaves, and these in turn.
    """
    first, second = pairs >> 32, pairs & ((1 << 32) - 1)
    octave = lambda ids: np.frexp(np.maximum(ids, 1).astype(np.float64))[1].astype(np.int64) - 1
    spare = octave(first) + int(np.floor(np.log2(12 * PARTITION_WORDS / max(1, n_words))))  # log2 of ids that fit into a partition
    shift = np.clip(np.minimum(spare, octave(first) - 4), 0, None)
    more = np.clip(-spare, 0, 28)  # log2 of parts of one id
    finer = np.clip(octave(second) - np.clip(more - 4, 0, None), 0, None)
    return (octave(first) << 32) | (first >> shift), np.where(more > 0, (octave(second) << 32) | (second >> finer), 0)


def packed(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs as differences and counts, both with equal bytes side by side before compression."""
    steps = np.diff(pairs, prepend=0).astype("<u8")
    planes = np.concatenate([x.view(np.uint8).reshape(-1, 8).T.ravel() for x in (steps, counts.astype("<u8"))])
    return zlib.compress(planes.tobytes(), 1)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(2, 8, -1)
    steps, counts = (np.ascontiguousarray(p.T).view("<u8").ravel().astype(np.int64) for p in planes)
    return np.cumsum(steps), counts


def _count_pairs(n_words: int, trie_settings: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ((pairs,), counts) in _spilled(2, 2, None, trie_settings, batches):
            p, q = prefix_partition(pairs, n_words)
            cuts = [0, *(np.flatnonzero((p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1).tolist(), len(pairs)]
            blobs = [packed(pairs[i:j], counts[i:j]) for i, j in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(blobs), pa.string()), pa.array(p[cuts[:-1]]), pa.array(q[cuts[:-1]]),
                                              pa.array(blobs, pa.binary())], names=["lang", "p", "q", "run"])

    return run


def _merge_pairs(min_count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, size, last = None, [], 0, 0  # `last`: what was left when parts were added up

        def settle() -> tuple[np.ndarray, np.ndarray]:
            (pairs,), counts = add_up([np.concatenate([p for p, _ in parts])], np.concatenate([n for _, n in parts]))
            return pairs, counts

        def whole() -> pa.RecordBatch:
            pairs, counts = settle()
            kept = counts >= min_count
            return pa.RecordBatch.from_arrays([pa.array([at[0]] * int(kept.sum()), pa.string()), pa.array(pairs[kept]), pa.array(counts[kept])],
                                              names=["lang", "k0", "a"])

        for batch in batches:
            for *key, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if at is not None and key != at:
                    yield whole()
                    parts, size, last = [], 0, 0
                at = key
                parts.append(unpacked(blob))
                size += len(parts[-1][0])
                if size > BUDGET + last and len(parts) > 1:
                    parts = [settle()]
                    size = last = len(parts[0][0])
        if parts:
            yield whole()

    return run


def frequent_pairs(coded: DataFrame, n_words: int, min_count: int, **trie_settings) -> DataFrame:
    """lang, k0, a of the pairs found `min_count` times or more, written. Runs are merged prefix partition by prefix partition, one at a time."""
    found = written(coded.mapInArrow(_count_pairs(n_words, trie_settings), "lang string, p long, q long, run binary"), "phrase-pair-runs")
    keys = ["lang", "p", "q"]
    merged = found.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merge_pairs(min_count), "lang string, k0 long, a long")
    return written(merged, "phrase-pairs")


def _merge(depth: int, least: int, min_count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = columns_of(depth)
        names = ["lang", *(f"k{i}" for i in range(width)), "len", "n"]
        held: dict[int, tuple] = {}  # the prefix of each length that is still growing: lang, columns, count, whether it is the first
        out: list[tuple] = []

        def emit(length: int, entry: tuple, edge: bool) -> None:
            lang, key, n, first = entry
            if edge or first or n >= min_count:
                out.append((lang, *key, length, n))

        def flush() -> pa.RecordBatch:
            types = [pa.string(), *[pa.int64()] * (width + 2)]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
            out.clear()
            return made

        for batch in batches:
            if not batch.num_rows:
                continue
            lang = batch.column(0).dictionary_encode()
            code, langs = lang.indices.to_numpy(zero_copy_only=False), lang.dictionary.to_pylist()
            keys = [batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(width)]
            counts = batch.column(1 + width).to_numpy(zero_copy_only=False)
            for length in range(least, depth + 1):
                long = np.flatnonzero(id_at(keys, length - 1) > 0)
                if not len(long):
                    continue
                cut = [k[long] for k in keys[:columns_of(length)]]
                if length % 2:
                    cut[-1] = (cut[-1] >> 32) << 32
                of = code[long]
                new = of[1:] != of[:-1]
                for k in cut:
                    new |= k[1:] != k[:-1]
                at = np.concatenate([[0], np.flatnonzero(new) + 1])
                sums = np.add.reduceat(counts[long], at)
                pad = (0,) * (width - len(cut))
                entry = lambda j: (langs[of[at[j]]], (*(int(k[at[j]]) for k in cut), *pad))
                first = entry(0)
                if length in held and held[length][:2] == first:
                    sums[0] += held[length][2]
                    is_first = held[length][3]
                else:
                    if length in held:
                        emit(length, held[length], False)
                    is_first = length not in held
                last = len(at) - 1
                for j in np.flatnonzero((sums >= min_count) | (np.arange(len(at)) == 0)).tolist():
                    if j != last:
                        emit(length, (*entry(j), int(sums[j]), j == 0 and is_first), False)
                held[length] = (*entry(last), int(sums[last]), last == 0 and is_first)
            if out:
                yield flush()
        for length, entry in held.items():
            emit(length, entry, True)
        if out:
            yield flush()

    return run


def prefix_counts(found: DataFrame, depth: int, least: int, min_count: int) -> DataFrame:
    """lang, k0.., len, a of each prefix of `least` to `depth` ids that the runs hold `min_count` times or more, written."""
    keys = ["lang", *[f"k{i}" for i in range(columns_of(depth))]]
    sorted_runs = found.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = ", ".join(["lang string", *(f"{k} long" for k in keys[1:]), "len long", "n long"])
    parts = sorted_runs.mapInArrow(_merge(depth, least, min_count), schema)
    whole = parts.groupBy(*keys, "len").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)
    return written(whole, "phrase-counts")


def _bit_places(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, pairs = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            for name in lang.unique().to_pylist():
                mine = pc.equal(lang, name).to_numpy(zero_copy_only=False)
                at = np.unique(pair_places(name, pairs[mine], bits))
                yield pa.RecordBatch.from_arrays([pa.array(at // CHUNK_BITS), pa.array(at % CHUNK_BITS)], names=["chunk", "bit"])

    return run


def _chunk(key: tuple, t: pa.Table) -> pa.Table:
    bits = np.zeros(CHUNK_BITS, np.uint8)
    bits[t["bit"].to_numpy()] = 1
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def pair_filter(pairs: DataFrame, most_bits: int = FILTER_BITS) -> bytes:
    """Bitmap of the pairs' places: some 16 bits a pair, at most `most_bits` bits, put together by Spark in chunks of 4 KB."""
    bits = CHUNK_BITS
    n = pairs.count()
    while bits < min(most_bits, 16 * n):
        bits *= 2
    places = pairs.select("lang", "k0").mapInArrow(_bit_places(bits), "chunk long, bit long").distinct()
    out = np.zeros((bits // CHUNK_BITS, CHUNK_BITS // 8), np.uint8)
    for chunk, part in places.groupBy("chunk").applyInArrow(_chunk, "chunk long, bits binary").collect():  # at most `bits` bits
        out[chunk] = np.frombuffer(part, np.uint8)
    return out.tobytes()


# -------------------------------------------------------------------------------------------- phrases


def counted_phrases(documents: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, **trie_settings) -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of 1 to `max_words` words found `min_count` times or more (lang, words, phrase, a), and lang, n of each language."""
    blocks = word_blocks(documents)
    totals = written(blocks.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-totals")
    words = frequent_words(blocks, min_count)
    coded = with_ids(blocks, words)
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    pairs = frequent_pairs(coded, n_words, min_count, **trie_settings)
    keys = [f"k{i}" for i in range(columns_of(max_words))]
    found = pairs.select("lang", "k0", *[F.lit(0).cast("long").alias(k) for k in keys[1:]], F.lit(2).cast("long").alias("len"), "a")
    if max_words > 2:
        longer = runs(coded, max_words, 3, pair_filter(pairs), **trie_settings)
        found = found.unionByName(prefix_counts(longer, max_words, 3, min_count))
    halves = [F.array(F.shiftright(k, 32), F.col(k).bitwiseAND(F.lit((1 << 32) - 1))) for k in keys]
    spelt = found.select("lang", *keys, "a", F.posexplode(F.filter(F.concat(*halves), lambda i: i > 0)).alias("_at", "id"))
    spelt = spelt.join(words.select("lang", "id", "word"), ["lang", "id"]).groupBy("lang", *keys, "a").agg(
        F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_w"))  # at most `max_words` rows a group
    phrases = spelt.select("lang", F.col("_w.word").alias("words"), "a")
    single = words.select("lang", F.array("word").alias("words"), F.col("f").alias("a"))
    return written(phrases.unionByName(single).withColumn("phrase", F.array_join("words", " ")), "phrases"), totals


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, words, phrase, a, l, r, n, score of each phrase of two words or more: of its lowest-scoring cut, the first of equals."""
    part = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = counts.where(F.size("words") > 1).select("lang", "words", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"_first": part(F.lit(1), F.col("k")), "_rest": part(F.col("k") + 1, F.size("words") - F.col("k"))})
    known = lambda part, count: counts.select(F.col("lang"), F.col("phrase").alias(part), F.col("a").alias(count))
    cuts = cuts.join(known("_first", "l"), ["lang", "_first"]).join(known("_rest", "r"), ["lang", "_rest"]).join(totals, "lang")
    big = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {big('a')} * {big('n')}) div ({big('l')} * {big('r')})")
    lowest = cuts.withColumn("score", score).groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    return lowest.select("lang", "words", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")


def absorbed(counts: DataFrame, max_words: int, percent: int) -> DataFrame:
    """lang, phrase of phrases inside a longer one with at least `percent` percent of their count."""
    def inside(words: Column) -> Column:
        spans = [(i, m) for m in range(2, max_words) for i in range(1, max_words)]
        fits = [F.when((F.size(words) > m) & (F.lit(i + m - 1) <= F.size(words)), F.array_join(F.slice(words, i, m), " ")) for i, m in spans]
        return F.array_distinct(F.array_compact(F.array(*fits)))

    if max_words < 3:
        return counts.where("false").select("lang", "phrase")
    longest = counts.where(F.size("words") > 2).select("lang", F.explode(inside(F.col("words"))).alias("phrase"), F.col("a").alias("_longer")).groupBy(
        "lang", "phrase").agg(F.max("_longer").alias("_longer"))
    return counts.select("lang", "phrase", "a").join(longest, ["lang", "phrase"]).where(100 * F.col("_longer") >= percent * F.col("a")).select("lang", "phrase")


def mine(documents: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, absorb_percent: int = ABSORB_PERCENT,
         **trie_settings) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first `top` phrases."""
    counts, totals = counted_phrases(documents, min_count, max_words, **trie_settings)
    kept = scored(counts, totals).join(absorbed(counts, max_words, absorb_percent), ["lang", "phrase"], "left_anti")
    ordered = kept.drop("words").withColumns({"_by_score": -F.col("score"), "_by_count": -F.col("a")})
    placed = positions(ordered, "lang", ["_by_score", "_by_count", "phrase"], out="_place").where(F.col("_place") < top)
    return placed.select("lang", (F.col("_place") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
