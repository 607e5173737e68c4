"""DuckDB statement of phrase mining with its registered parameters."""

from .phrases import ABSORB_PERCENT, MAX_WORDS, MIN_COUNT, TOP

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUERY = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang),
grams AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m
          FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
                FROM worded, (SELECT unnest(generate_series(1, {MAX_WORDS})) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, phrase, m, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
cand AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT lang, phrase, m, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
         FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM cand)),
tested AS (SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score
           FROM cuts c JOIN f x ON c.lang = x.lang AND c.first = x.phrase JOIN f y ON c.lang = y.lang AND c.rest = y.phrase
           JOIN sizes s ON c.lang = s.lang),
lowest AS (SELECT * FROM tested QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(w[i:i + p - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT lang, w, a, p, unnest(generate_series(1, m - p + 1)) AS i
                 FROM cand, (SELECT unnest(generate_series(2, {MAX_WORDS})) AS p) WHERE p < m) GROUP BY ALL),
kept AS (SELECT t.* FROM lowest t LEFT JOIN inside i ON t.lang = i.lang AND t.phrase = i.phrase
         WHERE i.longer IS NULL OR 100 * i.longer < {ABSORB_PERCENT} * t.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= {TOP}"""
