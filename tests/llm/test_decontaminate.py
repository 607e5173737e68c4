from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.llm import decontaminate as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(words, items, window):
    hit, found = set(), set()
    for item, w in items:
        n = min(window, len(w))
        grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(item)
    return hit, found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=12), max_size=6), st.text("abc", max_size=40), st.integers(1, 5))
def test_automaton_against_all_windows(items, doc, window):
    named = [(str(i), [c.encode() for c in t]) for i, t in enumerate(items)]
    auto = D.build([x for x in named if x[1]], window)
    words = [c.encode() for c in doc]
    import numpy as np

    ranges, found = auto.scan(np.array([auto.vocabulary.get(w, -1) for w in words], dtype=np.int64))
    hit, want = brute(words, named, window)
    assert {k for a, b in ranges for k in range(a, b)} == hit and found == want


@pytest.fixture(scope="module")
def bench(spark):
    rng = random.Random(1)
    items = [" ".join(f"w{rng.randrange(30)}" for _ in range(n)) for n in (25, 14, 10, 9, 3, 1)]
    rows = [(i, t) for i, t in enumerate(items)] + [(2, items[2]), (90, None), (91, " .,"), (None, "null id item of ten words is here and it counts")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def leaky(spark, bench, odd_docs):
    items = [r.text for r in bench.collect() if r.text]
    rows = [(1000 + i, f"before it {t.upper().replace(' ', ', ')} after it") for i, t in enumerate(items)] + [(2000, items[0])]
    rows += [(2001, "w1 w2 " + " ".join(items[0].split()[4:16]) + " tail " * 30)]
    return odd_docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 12])
def test_hits_against_brute_force(spark, bench, leaky, block_words):
    items = [(None if r.item_id is None else str(r.item_id), brute_words(r.text)) for r in bench.collect()]
    got = sorted(map(str, D.hits(leaky, bench, block_words=block_words).collect()))
    want = []
    for r in leaky.collect():
        words = brute_words(r.text)
        hit, found = brute(words, items, 10)
        want.append(str((r.doc_id, len(words), len(hit), sorted(x for x in found if x is not None), bool(hit))))
    assert [re.sub(r"\w+=", "", g.removeprefix("Row")) for g in got] == sorted(want)


def test_spans_go_and_clean_documents_stay(spark, bench, leaky, odd_docs):
    out = D.decontaminate(leaky, bench)
    assert D.hits(out, bench).where("contaminated").count() == 0
    texts = {r.doc_id: r.text for r in out.collect()}
    assert 2000 not in texts  # nothing but a benchmark item
    assert texts[2001].startswith("w1 w2  tail")
    clean = D.decontaminate(odd_docs, bench)
    assert clean.schema.names == odd_docs.schema.names
    assert sorted(map(str, clean.collect())) == sorted(map(str, odd_docs.collect()))


def test_empty_tables(spark, bench, no_docs, odd_docs):
    assert D.hits(no_docs, bench).count() == 0
    assert D.hits(odd_docs, bench.where("false")).where("contaminated or n_hit > 0").count() == 0


def seconds(do) -> float:
    import time

    best = float("inf")
    for _ in range(3):
        start = time.process_time()
        do()
        best = min(best, time.process_time() - start)
    return best


@pytest.mark.parametrize("short", [[], [[b"a"], [b"a"] * 3]])
def test_time_follows_the_words_of_a_text(short):
    """One word over and over matches an item of the same kind at every length: twice the words, some twice the time."""
    import numpy as np

    took = []
    for n in (60_000, 120_000):
        auto = D.build([("long", [b"a"] * n), *[(f"s{i}", w) for i, w in enumerate(short)]], 10)
        ids = np.zeros(n, np.int64)
        assert auto.scan(ids)[0] == [(0, n)]
        took.append(seconds(lambda: auto.scan(ids)))
    assert took[1] <= 2.5 * took[0] + 0.05


def test_a_window_of_many_items():
    """Items that share a window are listed once each, and a text that repeats it is no slower for it."""
    import numpy as np

    words = [b"w%d" % i for i in range(12)]
    auto = D.build([(str(i), words) for i in range(3000)], 10)
    ids = np.array([auto.vocabulary[w] for w in words] * 500, dtype=np.int64)
    ranges, found = auto.scan(ids)
    assert ranges == [(0, 6000)] and found == {str(i) for i in range(3000)}
    assert len(auto.cell_item) == 3 * 3000


def test_memory_a_word():
    import tracemalloc

    rng = random.Random(3)
    items = [(str(i), [b"word%d" % rng.randrange(20_000) for _ in range(50)]) for i in range(1000)]
    tracemalloc.start()
    auto = D.build(items, 10)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert auto.names and held < 250 * 50_000
