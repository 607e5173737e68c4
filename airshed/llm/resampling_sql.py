"""DuckDB statement of importance resampling with its registered parameters (single words as features)."""

from .resampling import BUCKETS, MIN_WORDS, PERCENT, SEED

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_GAIN = f"floor(1000 * ln((t + 1)::DOUBLE * (t_size.s_all + {BUCKETS}) / ((s + 1)::DOUBLE * (t_size.t_all + {BUCKETS}))))::BIGINT"

QUERY = f"""
WITH steps AS (SELECT list_transform(generate_series(0, 255), lambda i: list_reduce(generate_series(1, 8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS step),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
d AS (SELECT rid, unnest(words) AS word FROM docs),
b AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM d UNION SELECT word FROM b)),
bytes AS (SELECT word, list_transform(generate_series(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT) AS bytes FROM hexed),
bucketed AS (SELECT word, xor(4294967295, list_reduce(bytes, lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1]), 4294967295)) % {BUCKETS} AS bucket
             FROM bytes, steps),
counts AS (SELECT bucket, count(*) FILTER (corpus) AS s, count(*) FILTER (NOT corpus) AS t
           FROM (SELECT word, true AS corpus FROM d UNION ALL SELECT word, false FROM b) JOIN bucketed USING (word) GROUP BY bucket),
t_size AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (SELECT bucket, {_GAIN} AS gain FROM counts, t_size),
weighed AS (SELECT rid, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM d JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY rid),
scored AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                  ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
           FROM docs LEFT JOIN weighed USING (rid)),
full_score AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
                  count(*) OVER (PARTITION BY n_features >= {MIN_WORDS}) AS n_fit FROM full_score)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= {MIN_WORDS} AND place <= {PERCENT} * n_fit // 100 THEN place END AS rank FROM placed"""
