from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import attention as A
from airshed.llm import lm_score as L
from airshed.llm.common import table


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    flat = A.initial(np.full(A.CLASSES, 1 / A.CLASSES)).astype(np.float64)
    inputs, targets = rng.integers(0, A.CLASSES + 1, (3, A.CONTEXT)), rng.integers(-1, A.CLASSES, (3, A.CONTEXT))
    _, grad = A.loss_and_gradient(flat, inputs, targets)
    for k in rng.integers(0, A.SIZE, 25):
        step = np.zeros(A.SIZE)
        step[k] = 1e-4
        diff = (A.loss_and_gradient(flat + step, inputs, targets)[0] - A.loss_and_gradient(flat - step, inputs, targets)[0]) / 2e-4
        assert diff == pytest.approx(grad[k], abs=1e-5)


@pytest.mark.parametrize("n", [1, 31, 32, 33, 56, 57, 400])
def test_each_token_is_scored_once_and_causally(n):
    rng = np.random.default_rng(n)
    flat = A.initial(rng.dirichlet(np.ones(A.CLASSES)), seed=n)
    of, share = np.arange(A.CLASSES), np.zeros(A.CLASSES)
    ids = rng.integers(0, A.CLASSES, n)
    want = 0.0  # token by token, from its window's earlier tokens
    for t in range(n):
        start = 0 if t < A.CONTEXT else -(-(t - A.CONTEXT + 1) // A.STEP) * A.STEP
        inputs = np.full((1, A.CONTEXT), 3)  # what stands after the token must not matter
        inputs[0, :t - start + 1] = [A.START if k == 0 else ids[k - 1] for k in range(start, t + 1)]
        targets = np.full((1, A.CONTEXT), ids[t])
        want += float(A.log_probs(A.views(flat), inputs, targets, 0)[0, t - start])
    got = L._text_scores(flat, of, share, np.concatenate([ids, ids]), np.array([n, n]))
    assert got == pytest.approx([want, want], rel=1e-4)


def test_probabilities_sum_to_one():
    counts = np.random.default_rng(1).integers(0, 50, 500)
    of, log_share, shares = L.id_classes(counts, np.arange(500) % 3 == 0, 7)
    assert np.allclose(np.bincount(of, weights=np.exp(log_share), minlength=A.CLASSES)[np.unique(of)], 1)
    assert shares.sum() == pytest.approx(1) and (of == of[7]).sum() == 1 and len(np.unique(of)) == A.CLASSES


def brute(rows, held):
    tok = lambda t: (t or "").encode().lower().split() + [b""]
    counts = Counter(w for d, t in rows if not held(d) for w in tok(t))
    n, v = sum(counts.values()), len(counts)
    return [(str(d), held(d), len(tok(t)), sum(counts[w] > 0 for w in tok(t)), n,
             sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tok(t))) for d, t in rows]


@pytest.mark.parametrize("block_bytes", [L.BLOCK_BYTES, 20_000])
def test_base_scores_against_brute_force(odd_docs, block_bytes):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    out = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
                 for r in L.score(odd_docs, held_out(), block_bytes=block_bytes).collect())
    for got, want in zip(out, sorted(brute(rows, held)), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], rel=1e-9)


def test_every_training_token_is_learned_from_once(monkeypatch):
    """Over the rounds, each token of each training document is a target once, in windows side by side, and none of a held-out document."""
    pieces, seen = L.vocabulary_of(L.default_path()), Counter()
    docs = [[b"w%d" % (1000 * d + i) for i in range(n)] for d, n in enumerate((0, 1, 40, 700, 90))]
    held = [False, False, True, False, False]
    row = L._block_row(0, list(range(5)), held, docs, pieces)
    batch = L._record(L._BLOCK_ARROW, [row])

    def fit(flat, inputs, targets, adam):
        seen.update(map(tuple, targets.tolist()))
        return flat

    monkeypatch.setattr(A, "fit", fit)
    flat = A.initial(np.full(A.CLASSES, 1 / A.CLASSES))
    shared = type("Shared", (), {"value": (flat, np.arange(pieces.size))})  # every id as a class of its own
    learned = [r.column("n")[0].as_py() for k in range(L.ROUNDS) for r in L._fit_partition(shared, k, L.ROUNDS)(iter([batch]))]
    ids = [[i for w in words for i in pieces.encode([w.decode()])[0].tolist()] + [pieces.end] for words in docs]
    want = Counter()
    for text, out in zip(ids, held):
        for start in range(0, len(text), A.CONTEXT) if not out else ():
            part = text[start:start + A.CONTEXT]
            want[tuple(part + [-1] * (A.CONTEXT - len(part)))] += 1
    assert seen == want and sum(learned) == sum(want.values()) > 70
    tokens = Counter(t for window, n in seen.items() for t in window * n if t >= 0)
    assert tokens == Counter(i for text, out in zip(ids, held) if not out for i in text)


def test_model_learns_order(spark):
    """Held-out texts are likelier than the same texts with their words in another order, and than under shares alone."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("text is not null and length(text) > 400")
    mixed = docs.where(held_out()).withColumn("text", F.array_join(F.reverse(F.split("text", "")), ""))
    both = docs.unionByName(mixed.withColumn("lang", F.lit("mixed"))).repartition(2)
    rows = L.score(both.select("doc_id", "text"), held_out()).where("held_out").groupBy("doc_id").agg(F.max("score").alias("a"), F.min("score").alias("b")).collect()
    assert sum(r.a > r.b for r in rows) == len(rows) > 50


def test_empty_table(no_docs):
    assert L.score(no_docs, held_out()).count() == 0


def odd_ids(n=300, seed=0):
    """Ids of some frequencies with random vectors."""
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 50, n)
    of, log_share, shares = L.id_classes(counts, np.arange(n) % 3 == 0, 7)
    ids = A.Ids(of, counts + 1.0)
    ids.own, ids.nodes = rng.normal(0, 0.5, ids.own.shape), rng.normal(0, 0.5, ids.nodes.shape)
    return ids, A.initial(shares).astype(np.float64), log_share, shares


def test_ids_probabilities_sum_to_one_and_begin_at_the_corpus_shares():
    ids, flat, log_share, shares = odd_ids()
    n = len(log_share)
    inputs = np.full((n, A.CONTEXT), 11)
    targets = np.repeat(np.arange(n)[:, None], A.CONTEXT, axis=1)
    assert np.exp(A.log_probs(A.views(flat), inputs, targets, 0, ids)).sum(axis=0) == pytest.approx(np.ones(A.CONTEXT), rel=1e-5)
    ids.nodes[:] = 0
    p = A.views(flat)
    p["out"][:] = 0
    assert np.allclose(A.log_probs(p, inputs, targets, 0, ids)[:, 5], log_share + np.log(shares)[ids.of[:-1]], atol=1e-5)


def test_an_id_is_told_from_the_others_of_its_class():
    """The input's own id, not only its class, changes what follows; the hidden state changes an id's share in its class."""
    ids, flat, *_ = odd_ids()
    a, b = np.flatnonzero(ids.of == np.bincount(ids.of[:-1]).argmax())[:2]
    inputs = np.full((2, A.CONTEXT), 11)
    inputs[1, 3] = b
    inputs[0, 3] = a
    log_p = [A.log_probs(A.views(flat), inputs, np.full((2, A.CONTEXT), t), 0, ids) for t in (a, b)]
    assert abs(log_p[0][0, 3] - log_p[0][1, 3]) > 1e-3
    share = log_p[0] - log_p[1]
    assert abs(share[0, 3] - share[1, 3]) > 1e-3


def test_gradient_of_ids_vectors_against_differences():
    ids, flat, *_ = odd_ids()
    rng = np.random.default_rng(3)
    inputs, targets = rng.integers(0, 301, (3, A.CONTEXT)), rng.integers(-1, 300, (3, A.CONTEXT))
    _, grad, n, found = A._gradients(flat, inputs, targets, ids)
    assert n == (targets >= 0).sum()

    def difference(values, at):
        kept = values[at]
        loss = []
        for step in (1e-4, -1e-4):
            values[at] = kept + step
            loss.append(A.loss_and_gradient(flat, inputs, targets, ids)[0])
        values[at] = kept
        return (loss[0] - loss[1]) / 2e-4

    for k in rng.integers(0, A.SIZE, 25):
        assert difference(flat, k) == pytest.approx(grad[k], abs=1e-5)
    for table, (rows, often, sums), total in ((ids.own, found[0], inputs.size), (ids.nodes, found[1], ids.lengths[targets[targets >= 0]].sum())):
        assert often.sum() == total and len(set(rows.tolist())) == len(rows)
        for r in rng.integers(0, len(rows), 15):
            assert difference(table, (rows[r], 5)) == pytest.approx(sums[r, 5] / n, abs=1e-5)
        unseen = np.setdiff1d(np.arange(len(table)), rows)[:3]
        assert all(difference(table, (r, 5)) == 0 for r in unseen)


def test_ids_vectors_are_fitted_on_every_training_token():
    """A partition's rows say how often each input id's vector was seen: once for each token after which a training token stands."""
    pieces, seen, want = L.vocabulary_of(L.default_path()), Counter(), Counter()
    docs = [[b"w%d" % (1000 * d + i) for i in range(n)] for d, n in enumerate((0, 1, 40, 700, 90))]
    held = [False, False, True, False, False]
    batch = L._record(L._BLOCK_ARROW, [L._block_row(0, list(range(5)), held, docs, pieces)])
    ids = [[i for w in words for i in pieces.encode([w.decode()])[0].tolist()] + [pieces.end] for words in docs]
    of, _, shares = L.id_classes(np.bincount(np.concatenate(ids), minlength=pieces.size), pieces.begins, pieces.end)
    vectors = A.Ids(of, np.ones(len(of)))
    shared = type("Shared", (), {"value": (A.initial(shares), of, vectors)})
    for k in range(L.ROUNDS):
        for r in L._fit_partition(shared, k, L.ROUNDS)(iter([batch])):
            seen.update(dict(zip(r.column("i").to_pylist(), r.column("n").to_pylist())))
    assert not vectors.own.any() and not vectors.nodes.any()  # a task works on its own copy
    for text, out in zip(ids, held):
        if not out:
            want.update(vectors.node[s] for t in text for s in range(vectors.starts[t], vectors.starts[t] + vectors.lengths[t]))
    first = A.SIZE // A.WIDTH + len(vectors.own)
    assert {i - first: n for i, n in seen.items() if i >= first} == want


def test_order_of_ids_in_mixed_classes_is_learned(spark):
    """Each of 150 equally frequent ids has one that follows it: held-out texts are far likelier than under word counts, and than with words shuffled."""
    pieces, rng = L.vocabulary_of(L.default_path()), np.random.default_rng(5)
    words = [w for w in (f"{a}{b}" for a in "abcdefghijklmnoprstw" for b in "abcdefghijklmnoprstuw") if pieces.encode([w])[1][0] == 1][:150]
    assert len(words) == 150
    follows = np.roll(order := rng.permutation(150), 1)[np.argsort(order)]
    rows = []
    for d in range(4000):
        at, text = int(rng.integers(150)), []
        for _ in range(45):
            text.append(words[at])
            at = follows[at]
        rows.append((d, d % 10 == 0, " ".join(text)))
        if d % 10 == 0:
            rows.append((d, True, " ".join(rng.permutation(text).tolist())))
    df = spark.createDataFrame(rows, "doc_id long, held boolean, text string").repartition(1)
    got = {}
    for r in L.score(df, F.col("held")).where("held_out").collect():
        got.setdefault(r.doc_id, []).append((r.score, r.base_score))
    pairs = [(max(p)[0], min(p)[0], p[0][1]) for p in got.values()]
    assert len(pairs) == 400 and sum(good > 0.3 * base for good, _, base in pairs) >= 380
    assert sum(good - 5 > bad for good, bad, _ in pairs) >= 380


def test_words_of_blocks_are_shuffled_once(spark):
    """Word counts come from one shuffle without a join; each block gets the counts of its own words."""
    pieces = L.vocabulary_of(L.default_path())
    docs = [[[b"a", b"b", b"a"], [b"c"]], [[b"b", b"d"], [b"a"]], [[b"e"]]]
    held = [[False, True], [False, False], [True]]
    made = [L._block_row(7 * k, list(range(len(d))), h, d, pieces) for k, (d, h) in enumerate(zip(docs, held))]
    blocks = spark.createDataFrame([(r[0], r[5], r[6]) for r in made], "block long, words array<string>, train array<long>")
    found = L.word_counts(blocks)
    plan = found._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(word") == 1 and "Join" not in plan
    rows = found.collect()
    want = {b"": 4 - 1, b"a": 3, b"b": 2, b"d": 1}  # the ends of three training documents
    got = {(r.block, made[r.block // 7][5][r.at].encode()): r["count"] for r in rows}
    assert got == {(7 * k, w): want[w] for k, d in enumerate(docs) for w in {b"", *(w for x in d for w in x)} if w in want} and len(got) == len(rows)
    assert sorted(r["count"] for r in rows if r.first) == sorted(want.values())


@pytest.mark.parametrize("kind", ["<i4", "<u2", "<u4"])
def test_packed_numbers_come_back_and_are_small(kind):
    values = np.minimum(np.random.default_rng(2).zipf(1.3, 100_000), 60_000).astype(kind)
    assert (L.unpacked(L.packed(values), kind) == values).all() and len(L.unpacked(L.packed(values[:0]), kind)) == 0
    if kind == "<i4":
        assert len(L.packed(values)) < 0.9 * len(zlib.compress(values.tobytes(), 1))
