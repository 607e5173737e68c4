"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, html_text, langid, lm_score, packing, phrases, phrases_sql, pii, quality, quality_sql, resampling, resampling_sql, shuffle_shards, simhash, warc
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and found spans of every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"),
                        pii.digest(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"),
                        *[F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in ("id", "secret")])


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; documents whose crc32(doc_id) mod 4 is 2 are held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = langid.train(docs.where(~held_out).select("doc_id", "lang", "text"))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 1024 ids: one row per piece."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls and results derived from all conversations, linked, ordered, validated and serialised."""
    return chat.link(chat.tool_messages(table(spark, sf_dir, "conversations")), chat.TOOLS)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of the certified cutoffs for every document."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         F.col("root_doc").alias("component_id"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law `key`."""
    rows = shuffle_shards.write_shards(table(spark, sf_dir, "documents"))
    return rows.select(F.col("_doc").alias("doc_id"), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                       F.lit("key").alias("law"), F.col("_shard").cast("int").alias("shard"), F.col("_slot").cast("long").alias("slot"),
                       F.col("_grown").cast("int").alias("grown_shard"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document; documents whose crc32(doc_id) mod 7 is 2 are held out."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    return lm_score.score(table(spark, sf_dir, "documents"), held_out)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's words, and its rank if it is drawn."""
    rows = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of each language of all documents."""
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, read back from normalised archives."""
    rows = warc.roundtrip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION_SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
           FROM docs, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (SELECT rid, i, starts.n, item FROM starts JOIN win
        ON starts.n = win.n AND array_to_string(w[i:i + starts.n - 1], ' ') = win.win),
words AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS k FROM hit) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)"""

_BITS = "array_to_string(list_transform(range(40), lambda i: lpad(bin(('0x' || substr(hex, i + 1, 1))::INT), 4, '0')), '')"
_BASE32 = ("array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum("
           "list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::INT << (4 - j)))::INT, 1)), '')")

WARC_SQL = f"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper FROM pages),
digests AS (SELECT html, {_BASE32} AS digest
            FROM (SELECT html, {_BITS} AS bits FROM (SELECT html, sha1(html) AS hex FROM (SELECT DISTINCT html FROM rows))))
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN keeper IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper IS DISTINCT FROM page_id THEN keeper END AS refers_to
FROM rows JOIN digests USING (html)"""

QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_pii": (op1_pii, None),
    "op2_langid": (op2_langid, None),
    "op3_html_text": (op3_html_text, None),
    "op4_packing": (op4_packing, None),
    "op5_chat_format": (op5_chat_format, chat.SQL),
    "op6_quality_rules": (op6_quality_rules, quality_sql.QUERY),
    "op7_simhash": (op7_simhash, None),
    "op8_sharding": (op8_sharding, None),
    "op9_lm_score": (op9_lm_score, None),
    "op10_decontamination": (op10_decontamination, DECONTAMINATION_SQL),
    "op11_resampling": (op11_resampling, resampling_sql.QUERY),
    "op12_phrases": (op12_phrases, phrases_sql.QUERY),
    "op13_warc": (op13_warc, WARC_SQL),
}


def queries() -> dict[str, Query]:
    return {k: q for k, (q, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql is not None}
