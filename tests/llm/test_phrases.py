from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import hat_trie as H
from airshed.llm import phrases as P


def brute(rows, min_count, max_words=5, top=2000, percent=100):
    """(lang, rank, phrase, a, l, r, n, score) of rows (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        longest = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i:i + m]] = max(longest[p[i:i + m]], a)
        found = []
        for p, a in cand.items():
            if p in longest and 100 * longest[p] >= percent * a:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), a, counts[p[:k]], counts[p[k:]], score))
        for rank, (_, _, phrase, a, left, right, score) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n[lang], score))
    return sorted(map(str, out))


def texts(n=400, seed=3):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma", "Δelta", "x\x00y", "la", "la", "la", "#", "中文"]
    gaps = [" ", " ", " ", " ", "\t ", ". ", ",", "\n", "!? "]
    made = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(0, 60))) for _ in range(n)]
    made += ["fixed point theorem holds here"] * 12 + [None, "", " \t", "...", "la " * 3000]
    return made


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", "fr", None, "und"]
    rows = [(i, t, langs[i % 4] if i % 3 else "en", "z", 3, "k") for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[5], rows[5]], "doc_id long, text string, lang string, word string, n long, k0 string").repartition(4)


def found(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("settings", [
    {"min_count": 5}, {"min_count": 3, "max_words": 2, "top": 7}, {"min_count": 8, "max_words": 3, "absorb_percent": 60},
    {"min_count": 4, "max_words": 4, "burst": 4, "budget": 32}, {"min_count": 10_000}])
def test_against_brute_force(docs, settings):
    plain = {k: v for k, v in settings.items() if k not in ("burst", "budget")}
    plain["percent"] = plain.pop("absorb_percent", 100)
    want = brute([(r.text, r.lang) for r in docs.select("text", "lang").collect()], **plain)
    assert found(P.mine(docs, **settings)) == want
    assert want or settings["min_count"] == 10_000


def test_small_blocks_and_slices_change_nothing(monkeypatch, docs):
    """Counts don't depend on where texts are cut into blocks, nor on a filter full of false positives."""
    few = docs.coalesce(1)
    want = found(P.mine(few, 5))
    monkeypatch.setattr(P, "FILTER_BITS", 8)  # the smallest bitmap of one chunk
    monkeypatch.setattr(P, "pair_filter", lambda pairs: b"\xff" * 4096)  # lets every pair through
    assert found(P.mine(few.repartition(9), 5)) == want


@pytest.mark.parametrize("depth,burst,budget", [(2, 4, 40), (5, 3, 25), (3, 50, 10_000), (1, 2, 5)])
def test_trie_counts_like_a_counter(depth, burst, budget):
    rng = np.random.default_rng(depth)
    trie, want, got = H.HatTrie(depth, burst, budget), Counter(), Counter()

    def take(runs):
        for columns, counts in runs:
            ids = [H.id_at(columns, i).tolist() for i in range(depth)]
            rows = list(zip(*ids))
            assert rows == sorted(set(rows))  # a run is sorted, each sequence once
            got.update(dict(zip(rows, counts.tolist())))

    for _ in range(30):
        ids = [np.minimum(rng.zipf(1.6, 200), 500).astype(np.int64) for _ in range(depth)]
        for k in range(2, depth):
            ids[k] = np.where((ids[k - 1] == 0) | (rng.random(200) < 0.3), 0, ids[k])
        want.update(zip(*(i.tolist() for i in ids)))
        for run in trie.add(H.pack(ids)):
            take([run])
        assert len(trie) <= budget
    take(trie.spill())
    assert len(trie) == 0 and got == want


def test_hot_containers_burst_into_nodes():
    trie = H.HatTrie(2, burst=8, budget=10_000)
    ids = np.arange(1, 400, dtype=np.int64)
    for _ in range(6):  # a container bursts once for each batch that reaches it
        list(trie.add(H.pack([np.full(399, 7, np.int64), ids])))  # one first id, many second ids
        list(trie.add(H.pack([ids, ids])))
    hot = [c for c in trie.root.children if c.node is not None]
    assert [(c.low, c.high) for c in hot] == [(7, 8)] and len(hot[0].node.children) > 10
    assert [c.high for c in trie.root.children[:-1]] == [c.low for c in trie.root.children[1:]]


@pytest.mark.parametrize("n_words", [1, 10**8, 10**11, 10**15])
def test_prefix_partitions_of_sorted_pairs_lie_side_by_side(n_words):
    rng = np.random.default_rng(n_words % 97)
    firsts, seconds = (np.minimum(rng.zipf(1.2, 20_000), P.FILTER_BITS) for _ in range(2))
    pairs = np.unique((firsts << 32) | seconds)
    keys = list(zip(*(x.tolist() for x in P.prefix_partition(pairs, n_words))))
    starts = [k for k, before in zip(keys, [None, *keys]) if k != before]
    assert len(starts) == len(set(starts))
    sizes = Counter(keys)
    assert len(sizes) < 700 if n_words == 1 else len(sizes) >= 100
    got, counts = P.unpacked(P.packed(pairs, np.arange(len(pairs))))
    assert (got == pairs).all() and (counts == np.arange(len(pairs))).all()


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right, n = 3_000_000_019, 3_000_000_033, 3_000_000_037, 90_000_000_000_013
    counts = spark.createDataFrame([("en", ["p", "q"], a, "p q"), ("en", ["p"], left, "p"), ("en", ["q"], right, "q")],
                                   "lang string, words array<string>, a long, phrase string")
    row = P.scored(counts, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert row.score == 1000 * a * n // (left * right) and 1000 * a * n > 1 << 64


def test_edges_of_partitions_are_added_up(spark):
    """A prefix that lies in many partitions is counted whole."""
    rows = [("en", (1 << 32) | 2, (i << 32) | 1, 1) for i in range(1, 301)] + [("fr", (1 << 32) | 2, 0, 4), ("en", (9 << 32) | 9, 0, 2)]
    df = spark.createDataFrame(rows, "lang string, k0 long, k1 long, n long").repartition(6)
    got = sorted(tuple(r) for r in P.prefix_counts(df, 4, 2, 100).collect())
    assert got == [("en", (1 << 32) | 2, 0, 2, 300)]
    low = P.prefix_counts(df, 4, 2, 2).where("len = 2").collect()
    assert sorted(r.a for r in low) == [2, 4, 300]


def test_empty_tables(docs):
    assert P.mine(docs.where("false")).count() == 0
    assert P.mine(docs.where(F.col("text").isNull())).count() == 0
