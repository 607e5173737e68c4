from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from airshed.llm import resampling as R
from airshed.llm.common import table

from .conftest import SF, prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, max_n):
    words = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return words, [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, max_n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    """(doc_id, n_words, n_features, weight, score, rank) of rows (doc_id, text), sorted."""
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, text in docs for g in grams(text, max_n)[1])
    t = Counter(bucket(g) for text in target for g in grams(text, max_n)[1])
    s_all, t_all = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for doc, text in docs:
        words, found = grams(text, max_n)
        weight = sum(gain(bucket(g)) for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(fit, 1):
        r.append(place if place <= percent * len(fit) // 100 else None)
    return sorted(str(tuple(r) if len(r) == 6 else (*r, None)) for r in rows)


@pytest.fixture(scope="module")
def target(spark):
    rows = [(f"i{i}", t) for i, t in enumerate([None, "", "river stone, RIVER Stone", prose(3, 50), "aé中 one"])]
    return spark.createDataFrame(rows, "item_id string, text string")


@pytest.mark.parametrize("settings", [{}, {"max_n": 3, "buckets": 97, "percent": 50, "min_words": 3, "seed": 7}])
def test_against_brute_force(odd_docs, target, settings):
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()], [r.text for r in target.collect()], **settings)
    got = R.resample(odd_docs.repartition(5), target, **settings).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_slices_hold_all_rows_and_few_bytes():
    texts = pa.array(["a" * 10, None, "b" * 50, "", "c" * 3, "d" * 7])
    cut = list(R.slices(texts, 12))
    assert [s for s, _ in cut] == [0, 2, 3] and [len(t) for _, t in cut] == [2, 1, 3]
    assert list(R.slices(pa.array([], pa.string()))) == []
    assert pa.concat_arrays([t for _, t in cut]).equals(texts)


def test_sliced_texts_give_the_same_features(monkeypatch, odd_docs, target):
    """Features of a slice do not depend on the texts beside them."""
    texts = pa.array([r.text for r in odd_docs.collect()])
    whole = [(r.tolist(), b.tolist()) for r, b in R.features(texts, 2, 1000)]
    parts = [list(R.features(t, 2, 1000)) for _, t in R.slices(texts, 100)]
    starts = [s for s, _ in R.slices(texts, 100)]
    for n, (rows, buckets) in enumerate(whole):
        assert np.concatenate([p[n][0] + s for p, s in zip(parts, starts) if len(p) > n]).tolist() == rows
        assert np.concatenate([p[n][1] for p in parts if len(p) > n]).tolist() == buckets


def test_target_texts_are_preferred(spark):
    """Documents of the target's words are drawn far more often than others."""
    rows = [(i, prose(i, 40) if i % 5 else prose(i, 40, ("quartz", "basalt", "gneiss"))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame([(prose(10_000 + i, 60, ("quartz", "basalt", "gneiss")),) for i in range(20)], "text string")
    out = R.drawn(docs, wanted).collect()
    assert len(out) == 60 and out[0].asDict().keys() == {"doc_id", "text"}
    assert sum(r.doc_id % 5 == 0 for r in out) >= 30  # 12 by chance


def test_empty_tables(spark, no_docs, odd_docs, target):
    assert R.resample(no_docs, target).count() == 0
    none = R.resample(odd_docs, target.where("false"))
    assert sorted(str(tuple(r)) for r in none.collect()) == brute([(r.doc_id, r.text) for r in odd_docs.collect()], [])
    assert R.drawn(odd_docs, target).columns == odd_docs.columns


def test_given_tables(spark):
    docs, wanted = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in wanted.collect()])
    assert sorted(str(tuple(r)) for r in R.resample(docs, wanted).collect()) == want
