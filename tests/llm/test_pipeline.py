from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from airshed.llm import queries
from airshed.llm.common import table

from ..compare import compare, duck
from .conftest import SF


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    ok, message = compare(queries.queries()[name](spark, SF), duck(SF), queries.oracle_sql()[name])
    assert ok, message


def test_entry_lists_all():
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def test_stages_take_effect(spark, odd_docs, tmp_path):
    """Each stage on odd documents with planted cases: columns stay, its decision is made, clean documents stay."""
    item = table(spark, SF, "benchmark").where("length(text) > 150").first().text
    prose = odd_docs.where("doc_id between 7 and 12").select("text").collect()
    clean, other = prose[0].text, prose[1].text
    rows = [(900, clean), (901, clean), (902, f"{other} {item}"), (903, "x"), (904, f"{other} write to jo@example.com now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    names = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r[0]: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == names
    assert set(seen["quality_rules"]) == {900, 901, 902, 904}
    assert set(seen["near_dedup"]) == {900, 902, 904}
    assert item not in seen["decontamination"][902].text and seen["decontamination"][900].text == clean
    assert seen["pii"][904].text.endswith("write to <EMAIL> now") and seen["pii"][904].n_chars == len(seen["pii"][904].text)
    assert set(seen["packing"]) == {900, 902, 904}


def test_stages_on_odd_and_empty_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() >= 0 and (name == "packing" or out.columns == docs.columns)
