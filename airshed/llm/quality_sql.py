"""DuckDB statement of the quality rules (same result as `quality.judge`)."""

from .quality import ERROR, GRID, GOOD_WEIGHT, LEVELS, LONG_WORD, MARGINS, RISK, RULES

FEATURES = r"""
base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
words AS (SELECT rid, doc_id, stratum, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM base),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n
  FROM (SELECT rid, i, array_to_string(w[i:i+7], ' ') AS win
        FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS i FROM words WHERE len(w) >= 8))),
rep AS (
  SELECT rid, sum(least(8, coalesce(nxt, 1000000000) - i)) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM win WHERE n > 1) GROUP BY rid),
counted AS (
  SELECT words.rid, doc_id, stratum, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]+', '', 'g')))::BIGINT AS n_capitals,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, sha256(t) AS digest,
         len(list_filter(w, lambda x, i: i > 1 AND x = w[i - 1])) AS n_adjacent
  FROM words LEFT JOIN rep ON words.rid = rep.rid),
feat AS (
  SELECT *, RATIOS, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM counted)
"""

RATIOS = {
    "symbols": "n_symbols::DOUBLE / greatest(word_chars, 1)", "capitals": "n_capitals::DOUBLE / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines::DOUBLE / greatest(n_lines, 1)", "repeats": "n_repeat_words::DOUBLE / greatest(n_words, 1)",
    "adjacent": "n_adjacent::DOUBLE / greatest(n_words, 1)", "long_words": f"word_chars::DOUBLE / greatest(n_words, 1) / {LONG_WORD}",
    "short_words": "n_words::DOUBLE / greatest(word_chars, 1)",
}
FEATURES = FEATURES.replace("RATIOS", ", ".join(f"ceil(least(1.0::DOUBLE, {e}) * {GRID})::INT AS {r}" for r, e in RATIOS.items()))

_STEPS = " UNION ALL ".join(f"SELECT stratum, digest, good, first, '{r}' AS rule, {r} AS step FROM tried" for r in RULES)

CUTOFFS = f"""
label AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
tried AS (SELECT stratum, digest, {', '.join(f'any_value({r}) AS {r}' for r in RULES)}, bool_and(good) AS good, digest < '8' AS first
          FROM feat JOIN label ON feat.doc_id = label.doc_id WHERE NOT base_failed GROUP BY stratum, digest),
per_rule AS ({_STEPS}),
grid AS (SELECT DISTINCT stratum, rule, s.step FROM per_rule, (SELECT unnest(generate_series(0, {GRID}))::INT AS step) s),
good_first AS (SELECT stratum, rule, step, count(*) AS c FROM per_rule WHERE good AND first GROUP BY ALL),
tail AS (SELECT stratum, rule, step,
                CASE WHEN k > 0 THEN ceil(k * {LEVELS} / n)::INT ELSE -(((step - top) * {MARGINS}) // ({GRID} - top)) END AS level FROM (
  SELECT stratum, rule, step, sum(coalesce(c, 0)) OVER (PARTITION BY stratum, rule ORDER BY step DESC) AS k,
         sum(coalesce(c, 0)) OVER (PARTITION BY stratum, rule) AS n, max(step) FILTER (c > 0) OVER (PARTITION BY stratum, rule) AS top
  FROM grid LEFT JOIN good_first USING (stratum, rule, step)) WHERE n > 0),
levels AS (SELECT stratum, digest, good, min(level) AS level FROM per_rule JOIN tail USING (stratum, rule, step) WHERE NOT first GROUP BY ALL),
tally AS (SELECT stratum, level, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS junk FROM levels GROUP BY ALL),
points AS (SELECT DISTINCT stratum, s.level FROM tally, (SELECT unnest(generate_series(-{MARGINS}, {LEVELS}))::INT AS level) s),
cut AS (SELECT stratum, level, sum(coalesce(good, 0)) OVER g AS n, sum(coalesce(junk, 0)) OVER g AS n_junk,
               (sum(coalesce(good, 0)) OVER upto)::BIGINT AS k, sum(coalesce(junk, 0)) OVER upto AS k_junk
        FROM points LEFT JOIN tally USING (stratum, level)
        WINDOW g AS (PARTITION BY stratum), upto AS (PARTITION BY stratum ORDER BY level)),
tested AS (SELECT *, CASE WHEN k >= n * {RISK!r} THEN 1.0 ELSE (
      SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK!r}) + (n - j) * ln(1 - {RISK!r})))
      FROM (SELECT unnest(generate_series(0, k)) AS j)) END AS p FROM cut),
passed AS (SELECT *, min(p <= {ERROR!r} / (SELECT count(DISTINCT stratum) FROM tried)) OVER (PARTITION BY stratum ORDER BY level) AS all_ok FROM tested),
best AS (SELECT stratum, arg_max(level, (k_junk / greatest(n_junk, 1) - {GOOD_WEIGHT} * k / greatest(n, 1), -level)) AS point
         FROM passed WHERE all_ok GROUP BY stratum),
cutoff AS (SELECT stratum, rule, min(step) AS step FROM tail JOIN best USING (stratum) WHERE level <= point GROUP BY ALL)
"""

_REJECTED = " OR ".join(
    f"coalesce({r} >= (SELECT step FROM cutoff c WHERE c.stratum = feat.stratum AND rule = '{r}'), false)" for r in RULES)

JUDGED = f"judged AS (SELECT *, NOT base_failed AND NOT ({_REJECTED}) AS kept FROM feat)"

QUERY = f"""WITH {FEATURES}, {CUTOFFS}, {JUDGED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""
