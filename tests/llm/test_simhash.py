from __future__ import annotations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.llm import simhash as S
from airshed.llm.components import components


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.lists(st.integers(0, 63), max_size=5)), max_size=40), st.integers(0, 3), st.sampled_from([0, 1, 5]))
def test_trie_walk_against_all_pairs(made, bits, depth):
    """Fingerprints near a few centres; every pair of subtrees walked as the units do."""
    centres = [0, 0xFFFF0000FFFF0000, 0x123456789ABCDEF0, 0x8000000000000001]
    fps = sorted({centres[c] ^ sum({1 << f for f in flips}) for c, flips in made})
    arr = np.array(fps, np.uint64)
    prefix = arr >> np.uint64(64 - depth) if depth else np.zeros(len(arr), np.uint64)
    root = np.arange(len(fps))
    links = []
    for left in range(1 << depth):
        for right in range(left, 1 << depth):
            budget = bits - (left ^ right).bit_count()
            if budget < 0:
                continue
            a, b = np.flatnonzero(prefix == left), np.flatnonzero(prefix == right)
            idx = a if left == right else np.concatenate([a, b])
            forest = S.Forest(len(idx))
            S.trie_links(arr[a], None if left == right else arr[b], depth, budget, forest)
            links += [(int(idx[i]), int(idx[forest.label[i]])) for i in range(len(idx)) if forest.label[i] != i]
    for _ in fps:
        for u, v in links:
            root[u] = root[v] = min(root[u], root[v])
    assert root.tolist() == brute_components(fps, bits)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 260)] + [(7, 7), (1, 2), (2, 1), (1, 2)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{x: 5 for x in range(200, 260)}, 2: 1}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.fixture(scope="module")
def groups(odd_docs):
    return S.near_duplicates(odd_docs).collect()


def test_documents_against_brute_force(odd_docs, groups):
    rows = odd_docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    part = brute_components(fps, 2)
    least = {}
    for r, p in zip(rows, part):
        if r.doc_id is not None:
            least[p] = min(r.doc_id, least.get(p, r.doc_id))
    want = sorted((str(r.doc_id), f, least.get(p)) for r, f, p in zip(rows, fps, part))
    assert sorted((str(g.doc_id), g.fp & (1 << 64) - 1, g.root_doc) for g in groups) == want


def test_one_of_each_group_stays(odd_docs, groups, no_docs):
    kept = S.keep_one(odd_docs)
    assert kept.schema.names == odd_docs.schema.names
    assert sorted(r.doc_id for r in kept.collect()) == sorted({g.root_doc for g in groups})
    assert S.keep_one(no_docs).count() == 0
