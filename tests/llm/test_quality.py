from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import pytest

from airshed.llm import quality as Q
from airshed.llm import quality_sql
from airshed.llm.common import table
from pyspark.sql import functions as F

from .conftest import SF, prose


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = {k for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    base = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated), base)


def test_counts_against_brute_force(spark, odd_docs):
    phrase = " ".join(f"w{i}" for i in range(9))
    more = spark.createDataFrame([(500, f"{phrase} {phrase}\n{phrase} x " + prose(1, 50) + " #a|b| <x>"), (501, "la " * 40)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text", "lang").union(more.withColumn("lang", F.lit("en")))
    got = Q.measured(docs).select("doc_id", *Q.COUNTS, "base_failed").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((r.doc_id, *brute(r.text))) for r in docs.collect())


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.3), (200, 1, 0.05), (4000, 30, 0.0125), (100000, 1100, 0.0125), (50, 20, 0.1)])
def test_binomial_tail(spark, n, k, p):
    got = spark.range(1).select(Q.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), F.lit(p)).alias("x")).first().x
    logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p) for j in range(k + 1)]
    assert got == pytest.approx(1.0 if k >= n * p else sum(map(math.exp, logs)), rel=1e-8)


@pytest.fixture(scope="module")
def corpus(spark):
    """2,000 good and 300 junk English texts, 30 French ones: symbols tell them apart."""
    rows = [(i, prose(i, 40), "en", 1) for i in range(2000)]
    rows += [(3000 + i, prose(i, 40).replace(" ", "$$ ")[:400], "en", 0) for i in range(300)]
    rows += [(5000 + i, prose(i, 40) if i % 2 else prose(i, 40).replace(" ", "$$ "), "fr", i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int").repartition(4)
    return df.drop("quality"), df.select("doc_id", "quality", F.lit(0).alias("toxic"))


def test_certified_cutoffs_reject_junk_only(corpus):
    docs, labels = corpus
    out = Q.judge(docs, labels).select("doc_id", "kept").collect()
    kept = {r.doc_id for r in out if r.kept}
    assert set(range(2000)) <= kept
    assert not kept & set(range(3000, 3300))
    assert set(range(5000, 5030)) <= kept  # too few labels to certify anything


def test_noise_labels_certify_no_costly_cutoff(corpus):
    docs, labels = corpus
    noise = labels.withColumn("quality", F.when(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0, 1).otherwise(0))
    rows = Q.judge(docs, noise).where("not base_failed").join(noise.where("quality = 1"), "doc_id")
    n, lost = rows.agg(F.count("*"), F.count_if(~F.col("kept"))).first()
    assert lost <= Q.RISK * n


def test_same_result_as_sql(corpus):
    docs, labels = corpus
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("labels", labels.toPandas())
    names = ["doc_id", *Q.COUNTS, "base_failed", "kept"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({quality_sql.QUERY}) ORDER BY 1").fetchall()
    assert [tuple(r) for r in Q.judge(docs, labels).select(*names).orderBy("doc_id").collect()] == want


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    labels = table(spark, SF, "labels")
    odd = labels.union(spark.createDataFrame([(None, 1, 0), (3, None, None), (5, 0, 0), (5, 1, 0)], labels.schema))
    out = Q.filter_documents(odd_docs, odd)
    assert out.schema.names == odd_docs.schema.names
    assert all(r.text and not brute(r.text)[-1] for r in out.collect())
    assert Q.filter_documents(no_docs, odd).count() == 0
    assert Q.judge(odd_docs, labels.where("false")).where("kept").count() == sum(not brute(r.text)[-1] for r in odd_docs.collect())


def test_copies_of_rows_and_texts_change_no_cutoff(spark, corpus):
    """A text is one trial: the same rows many times over, and the same texts under other ids, certify what one of each does."""
    docs, labels = corpus
    cutoffs = lambda d, la: sorted(map(str, Q.certify(Q.measured(d), la).collect()))
    want = cutoffs(docs, labels)
    assert want and "None" not in want[0]
    again = docs.withColumn("doc_id", F.col("doc_id") + 100_000)
    more = labels.withColumn("doc_id", F.col("doc_id") + 100_000)
    assert cutoffs(docs.union(docs).union(again), labels.union(labels).union(more)) == want
    few = docs.where("doc_id < 60 or doc_id between 3000 and 3059")
    many = few
    for _ in range(5):
        many = many.union(many)
    assert cutoffs(many, labels) == cutoffs(few, labels)


def test_junk_of_equal_words_is_rejected(spark, corpus):
    """Runs of one word have no symbols, capitals, repeated lines or repeated windows: the rule of adjacent words finds them."""
    docs, labels = corpus
    runs = [(9000 + i, " ".join(w for k, w in enumerate(prose(i, 30).split()) for _ in range(4 if k % 3 else 1)), "en") for i in range(120)]
    found = docs.union(spark.createDataFrame(runs, docs.schema))
    marked = labels.union(spark.createDataFrame([(9000 + i, 0, 0) for i in range(100)], labels.schema))
    out = {r.doc_id: r for r in Q.judge(found, marked).collect()}
    assert not any(out[9000 + i].kept or out[9000 + i].base_failed for i in range(120))
    assert sum(out[i].kept for i in range(2000)) >= 1900


def test_good_texts_lost_stay_within_the_risk(spark):
    """Random halves of labels: the share of good texts rejected among unseen ones stays near the risk even when junk looks alike."""
    rows = [(i, prose(i, 25 + i % 50) + (" #" * (i % 7)), "en") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = docs.select("doc_id", F.when(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
    out = Q.judge(docs, labels.where("doc_id < 750")).join(labels, "doc_id").where("doc_id >= 750 and quality = 1")
    n, lost = out.agg(F.count("*"), F.count_if(~F.col("kept"))).first()
    assert lost <= 1.5 * Q.RISK * n
