from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import langid as L
from airshed.llm import queries
from airshed.llm.common import table


def test_features_count_every_gram_once():
    assert L.features(None) is L.features("") is L.features("12 .,\n") is None
    v = L.features("Abc é")
    assert v.shape == (L.FEATURES,) and np.linalg.norm(v) == pytest.approx(1, abs=1e-5)
    long = "lorem ipsum dolor " * 120_000  # more than one block of bytes
    raw = np.frombuffer((" " + long.strip() + "  ").encode(), np.uint8).astype(np.uint32)
    one = raw * L._A
    two = (one[:-1] ^ (raw[1:] + np.uint32(257))) * L._B
    three = (two[:-1] ^ (raw[2:] + np.uint32(521))) * L._A
    counts = sum(np.bincount(g >> np.uint32(32 - L.FEATURE_BITS), minlength=L.FEATURES) for g in (one, two, three))
    assert np.allclose(L.features(long), np.sqrt(counts) / np.linalg.norm(np.sqrt(counts)), atol=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op2_langid(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = rows.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 200 and right >= 0.97 * n
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    model = L.train(odd_docs)
    out = L.predict(odd_docs, model).collect()
    assert len(out) == odd_docs.count()
    by = {r.doc_id: r for r in out}
    for i in (0, 1, 2):  # null, empty, white space
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert {r.lang_pred for r in out} <= {"en", "de", "und"}
    assert L.train(no_docs) is None
    assert {r.lang_pred for r in L.predict(odd_docs, None).collect()} == {"und"}
    one = L.train(odd_docs.where("lang = 'en'"))
    assert {r.lang_pred for r in L.predict(odd_docs, one).collect()} == {"en", "und"}


def test_numbers_and_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "½ ² ① 12 _ Ⅷ"), (2, "½ tree"), (3, "ª"), (4, "\u4e2d")], "doc_id long, text string")
    model = L.Hierarchy(np.stack([L.features("tree"), L.features("baum")]), ["en", "de"])
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, model).collect()}
    assert got[1] == ("und", 0.0) and all(got[i][0] in ("en", "de") for i in (2, 3, 4))


def test_votes_against_brute_force():
    """Family by the largest margin; in it every pair of languages is asked anew, most duels win, then larger sums, then the name."""
    rng = np.random.default_rng(5)
    names = ["en", "de", "nl", "sv", "fr", "es", "it", "zz"]
    x = rng.random((160, L.FEATURES)).astype(np.float32)
    langs = [names[i % len(names)] for i in range(160)]
    for i, lang in enumerate(langs):
        x[i, names.index(lang)] += 20
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = L.Hierarchy(x, langs)
    for v in (rng.random((60, L.FEATURES)) + 3 * (np.arange(L.FEATURES) < 8) * rng.random((60, L.FEATURES))).astype(np.float32):
        v /= np.linalg.norm(v)
        margins = {f: sum(float(a) * float(b) for a, b in zip(model.family_weights[k], v)) for k, f in enumerate(model.families)}
        family = max(margins, key=margins.get)
        members = [n for n in names if L.family_of(n) == family]
        table_ = []
        for m in members:
            duels = []
            for other in members:
                if other != m:
                    a, b = sorted((m, other))
                    p = 1 / (1 + np.exp(-4 * float(model.pairs[a, b] @ v)))
                    duels.append(p if m == a else 1 - p)
            table_.append((sum(d >= 0.5 for d in duels), sum(duels), m))
        assert model.predict(v)[0] == max(table_)[2]


def test_training_sample_is_drawn_before_any_shuffle(spark):
    """One language with nine tenths of the rows: its texts meet the thresholds where they are read, no exchange by language."""
    docs = spark.range(20_000, numPartitions=4).selectExpr("id as doc_id", "if(id % 10 = 0, concat('l', id % 7), 'en') as lang", "concat('text ', id) as text")
    sample = L.training_sample(docs, 100)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(lang#" in plan.split("BroadcastHashJoin")[0]
    assert "hashpartitioning" not in plan.split("BroadcastHashJoin")[1]
    sizes = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert len(sizes) == 8 and all(50 < n < 160 for n in sizes.values())
    assert L.training_sample(docs, 100, langs=2).select("lang").distinct().count() == 2
