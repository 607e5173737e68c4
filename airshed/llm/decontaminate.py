"""Benchmark decontamination: a generalised suffix automaton of normalised test items.

The items' words become a generalised suffix automaton (one automaton for all items of a block).
Documents are streamed through it word by word, tracking the longest suffix that occurs in an
item. Wherever that length reaches a window's length, the matched words are hit; spans of hits
are removed, or the document as a whole when hits cover too much of it.

The benchmark is the bounded side: it is read in blocks of at most `BLOCK_WORDS` words, and each block's
automaton (some 150 bytes a word, 200 while it is built) is broadcast and run over all documents. With more than one block a
pass's rows are written in the shared folder before the next, so one automaton is alive at a time and a benchmark of any size works
with bounded memory. A text takes time in proportion to its words, however long its matches are.

Defined cases: null or word-less texts and items have no windows; items of fewer words than a window
are one window as a whole; repeated documents each give their row; repeated items count once per item_id;
null item_ids match but carry no id; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from .common import as_record, ship, with_text, written

WINDOW_WORDS = 10
BLOCK_WORDS = 500_000
MAX_COVERAGE = 0.5  # share of hit words beyond which a whole document goes

_FOUND = StructType([StructField("_n_words", LongType()), StructField("_spans", ArrayType(ArrayType(LongType()))),
                     StructField("_items", ArrayType(StringType()))])

# the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, a-z and all beyond ASCII
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                  for c in range(256))
_WORD_CHARS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Normalised words of a text as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


class ItemAutomaton:
    """Generalised suffix automaton over word numbers of several items.

    States are numbers in compact arrays. Most states have one transition, kept in two arrays; only branching states have a
    dictionary. After `finish`, every state knows its suffix of window length and its longest suffix that is a whole short item, so a
    word of a document is looked up in constant time, whatever the length of the match.
    """

    def __init__(self, window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.names: list = []  # item ids by number
        self.length, self.link = array("i"), array("i")
        self.word, self.to = array("i"), array("i")  # a state's first transition
        self.more: dict[int, dict[int, int]] = {}  # further transitions of branching states
        self.at_window, self.at_whole = array("i"), array("i")  # see `finish`
        self.whole: dict[int, dict[int, list[int]]] = {}  # state -> words of short items that end there as a whole -> their numbers
        self.owner = array("i")  # state of a window -> first cell of the list of its items, -1 for none
        self.cell_item, self.cell_next = array("i"), array("i")
        self.least = window  # fewest words of any window
        self._state(0, -1)

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(-1)
        self.to.append(-1)
        return len(self.length) - 1

    def follow(self, state: int, word: int) -> int:
        """The state after `word`, -1 if it doesn't follow here."""
        if self.word[state] == word:
            return self.to[state]
        more = self.more.get(state)
        return more.get(word, -1) if more else -1

    def _connect(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _clone(self, p: int, q: int, word: int) -> int:
        c = self._state(self.length[p] + 1, self.link[q])
        self.word[c], self.to[c] = self.word[q], self.to[q]
        if q in self.more:
            self.more[c] = dict(self.more[q])
        self.link[q] = c
        while p != -1 and self.follow(p, word) == q:
            self._connect(p, word, c)
            p = self.link[p]
        return c

    def _extend(self, last: int, word: int) -> int:
        q = self.follow(last, word)
        if q != -1:  # the word already follows here, from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        new = self._state(self.length[last] + 1, 0)
        p = last
        while p != -1 and (q := self.follow(p, word)) == -1:
            self._connect(p, word, new)
            p = self.link[p]
        if p != -1:
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return new

    def add(self, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary)))

    def finish(self) -> None:
        """After all `add` calls: `at_window`, the state of each state's suffix of window length (-1 if all are shorter)."""
        n = len(self.length)
        self.at_window = array("i", [-1]) * n
        self.owner = array("i", [-1]) * n
        for s in sorted(range(1, n), key=self.length.__getitem__):  # suffix links lead to shorter states
            if self.length[s] >= self.window:
                up = self.link[s]
                self.at_window[s] = s if self.length[up] < self.window else self.at_window[up]

    def label(self, item, words: list[bytes]) -> None:
        """After `finish`: note where this item's windows end."""
        ids = [self.vocabulary[w] for w in words]
        if not ids:
            return
        number = len(self.names)
        self.names.append(item)
        state = length = 0
        if len(ids) < self.window:
            self.least = min(self.least, len(ids))
            for w in ids:
                state = self.follow(state, w)
            self.whole.setdefault(state, {}).setdefault(len(ids), []).append(number)
            return
        for w in ids:
            state, length = self.step(state, length, w)
            if length >= self.window:
                at = self.at_window[state]
                if self.owner[at] == -1 or self.cell_item[self.owner[at]] != number:
                    self.cell_item.append(number)
                    self.cell_next.append(self.owner[at])
                    self.owner[at] = len(self.cell_item) - 1

    def finish_whole(self) -> None:
        """After all `label` calls: `at_whole`, the nearest state on the way of suffix links (itself first) where short items end."""
        n = len(self.length) if self.whole else 0
        self.at_whole = array("i", [0]) * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            self.at_whole[s] = s if s in self.whole else self.at_whole[self.link[s]]

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """Longest suffix of what was read, with `word`, that occurs in an item."""
        while (to := self.follow(state, word)) == -1:
            if not state:
                return 0, 0
            state = self.link[state]
            length = self.length[state]
        return to, length + 1

    def scan(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set]:
        """Hit word ranges [from, to), sorted and apart, and the items whose windows occur; ids: word numbers, -1 unknown.

        Unknown words end every match, so only runs of known words are streamed.
        """
        known = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        ranges: list[tuple[int, int]] = []
        windows: set[int] = set()
        shorts: set[tuple[int, int]] = set()

        def cover(a: int, b: int) -> None:  # ends never fall, so each range is put in and taken out once
            while ranges and a <= ranges[-1][1]:
                a = min(a, ranges.pop()[0])
            ranges.append((a, b))

        for lo, hi in zip(known[::2].tolist(), known[1::2].tolist()):
            if hi - lo < self.least:
                continue
            state = length = 0
            for i, w in enumerate(ids[lo:hi].tolist(), lo):
                state, length = self.step(state, length, w)
                if length >= self.window:
                    cover(i + 1 - length, i + 1)
                    windows.add(self.at_window[state])
                if self.whole:
                    s = self.at_whole[state]
                    while s:  # short items are of fewer words than a window, each state on the way ends others
                        for n in self.whole[s]:
                            if n <= length:  # its words are a suffix of the match
                                cover(i + 1 - n, i + 1)
                                shorts.add((s, n))
                        s = self.at_whole[self.link[s]]
        found = {number for s, n in shorts for number in self.whole[s][n]}
        for state in windows:
            cell = self.owner[state]
            while cell != -1:
                found.add(self.cell_item[cell])
                cell = self.cell_next[cell]
        return ranges, {self.names[number] for number in found}


def merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def build(items: list[tuple[str | None, list[bytes]]], window: int) -> ItemAutomaton:
    auto = ItemAutomaton(window)
    for _, words in items:
        auto.add(words)
    auto.finish()
    for item, words in items:
        auto.label(item, words)
    auto.finish_whole()
    return auto


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of at most `block_words` words (or one item), read one partition at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, size = [], 0
    for item, text in rows.toLocalIterator():
        words = words_of(text)
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        if words:
            block.append((item, words))
            size += len(words)
    if block:
        yield block


def _scanner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto: ItemAutomaton = shared.value
        find = auto.vocabulary.get
        for batch in batches:
            n_words, spans, items = [], [], []
            texts = batch.column("text")
            for lo in range(0, len(texts), 256):
                for text in texts.slice(lo, 256).to_pylist():
                    words = words_of(text)
                    ids = np.fromiter((find(w, -1) for w in words), np.int64, len(words))
                    ranges, found = auto.scan(ids)
                    n_words.append(len(words))
                    spans.append(ranges)
                    items.append(sorted(i for i in found if i is not None))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                 pa.array(items, pa.list_(pa.string()))],
                names=[*batch.schema.names, "_n_words", "_spans", "_items"])

    return run


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS,
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """All columns of `documents` with `_n_words`, `_spans` (hit word ranges [from, to)) and `_items`.

    With more than one block the documents are passed through one automaton after the other and
    each pass's findings are added to the row: no shuffle. A pass that another follows is written, and its automaton let go.
    """
    spark = documents.sparkSession
    ship(spark)
    out = documents.withColumns({"_n_words": F.lit(0).cast("long"),
                                 "_spans": F.array().cast("array<array<long>>"),
                                 "_items": F.array().cast("array<string>")})
    blocks = item_blocks(benchmark, block_words)
    first = next(blocks, [])
    while True:
        shared = spark.sparkContext.broadcast(build(first, window))
        given = out.withColumnsRenamed({"_spans": "_spans0", "_items": "_items0"}).drop("_n_words")
        schema = StructType([*given.schema.fields, *_FOUND.fields])
        passed = given.mapInArrow(_scanner(shared), schema)
        out = passed.select(*documents.columns, "_n_words", F.concat("_spans0", "_spans").alias("_spans"),
                            F.array_union("_items0", "_items").alias("_items"))
        first = next(blocks, None)
        if first is None:
            return out
        out = written(out, "decontamination-pass")
        shared.unpersist()


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS,
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted item ids whose windows occur), contaminated."""
    found = scan(documents.select("doc_id", F.col("text").cast("string").alias("text")), benchmark, window, block_words)
    covered = F.aggregate(  # union length of sorted ranges
        F.sort_array("_spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), s[1] - F.greatest(s[0], a["end"]))).alias("n"),
            F.greatest(a["end"], s[1]).alias("end")),
        lambda a: a["n"])
    return found.select("doc_id", F.col("_n_words").alias("n_words"), covered.alias("n_hit"),
                        F.sort_array("_items").alias("items")).withColumn("contaminated", F.col("n_hit") > 0)


def _remover(max_coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, texts, changed = [], [], []
            rows = batch.column("text")
            for i, (spans, n) in enumerate(zip(batch.column("_spans").to_pylist(), batch.column("_n_words").to_pylist())):
                ranges = merged([tuple(r) for r in spans])
                if sum(b - a for a, b in ranges) > max_coverage * n:
                    continue
                text = rows[i].as_py()
                if ranges:
                    places = [m.span() for m in _WORD_CHARS.finditer(text)]
                    parts, at = [], 0
                    for a, b in ranges:
                        parts.append(text[at:places[a][0]])
                        at = places[b - 1][1]
                    text = "".join(parts) + text[at:]
                keep.append(i)
                texts.append(text)
                changed.append(bool(ranges))
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("_row"), pa.array(texts, pa.string()), pa.array(changed, pa.bool_())],
                                             names=["_row", "text", "_changed"])

    return run


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS,
                  max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`documents` (same columns) without benchmark text.

    Hit spans are cut from a text and `n_chars`, where there is one, is counted anew; a document whose hit
    words are more than `max_coverage` of its words goes. Documents without hits stay as they are.
    """
    rows = documents.select(as_record(documents), F.col("text").cast("string").alias("text"))
    marked = scan(rows, benchmark, window, block_words).drop("_items")
    schema = StructType([rows.schema["_row"], rows.schema["text"], StructField("_changed", BooleanType())])
    out = marked.mapInArrow(_remover(max_coverage), schema)
    return with_text(out, documents)


def items_digest(items) -> str:
    """Lowercase hex SHA-256 of the comma-joined sorted item ids (helper for tests)."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
