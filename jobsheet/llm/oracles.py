"""DuckDB SQL of the queries that SQL can express, written apart from the operators."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS s, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, s, array_to_string(w[i:i + s - 1], ' ') AS g
       FROM (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM d, (SELECT DISTINCT s FROM bw) WHERE len(w) >= s)),
hit AS (SELECT DISTINCT doc_id, i, s, item_id FROM dw JOIN bw USING (s, g)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + s)) AS p FROM (SELECT DISTINCT doc_id, i, s FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP3_BASE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g
      JOIN (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1) USING (doc_id, g)) GROUP BY doc_id),
l AS (SELECT doc_id, sum(n - 1) AS n FROM (SELECT doc_id, l, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
      WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, list_sum([length(x) FOR x IN w])::BIGINT AS word_chars,
       len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)
"""

OP3 = rf"""
WITH base AS (SELECT * REPLACE (coalesce(word_chars, 0)::BIGINT AS word_chars), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM ({OP3_BASE})),
raw AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS x FROM documents),
line AS (SELECT doc_id, source, text, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
         regexp_replace(lower(array_to_string(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), ' ')), '[0-9]+', '0', 'g') AS l
         FROM raw WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
host AS (SELECT source, count(DISTINCT text) AS docs FROM documents GROUP BY source),
over AS (SELECT source, l FROM (SELECT source, l, count(DISTINCT text) AS n FROM line GROUP BY ALL) JOIN host USING (source) WHERE n > 20 AND n > 0.005 * docs),
gone AS (SELECT doc_id, sum(n) AS n FROM line SEMI JOIN over USING (source, l) GROUP BY doc_id)
SELECT base.*, NOT base_failed AND n_words - coalesce(gone.n, 0) >= 0.5 * n_words AS kept FROM base LEFT JOIN gone USING (doc_id)
"""

OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id < y.doc_id
      JOIN n AS p ON p.doc_id = x.doc_id JOIN n AS q ON q.doc_id = y.doc_id GROUP BY x.doc_id, y.doc_id
      HAVING 100 * count(*) >= 85 * (any_value(p.n) + any_value(q.n) - count(*))),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM reach AS r JOIN edge AS e ON e.a = r.to_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.least AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(to_id) AS least FROM reach GROUP BY doc_id) AS c USING (doc_id)
"""

OP9 = r"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
f AS MATERIALIZED (SELECT doc_id, i, hash(substr(x, 2 * i + 1, 60)) AS g FROM (SELECT doc_id, x, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400)),
c AS (SELECT doc_id, i FROM f JOIN (SELECT g FROM f GROUP BY g HAVING count(*) > 1) USING (g)),
s AS MATERIALIZED (SELECT doc_id, i, hash(substr(x, 2 * i + 1, 800)) AS g FROM c JOIN d USING (doc_id)),
r AS (SELECT doc_id, i FROM s JOIN (SELECT g FROM s GROUP BY g HAVING count(*) > 1) USING (g)),
m AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r),
run AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m),
span AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM run GROUP BY doc_id, k),
gap AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_, a AS to_ FROM span
        UNION ALL SELECT d.doc_id, 1e18, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN span USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * from_::BIGINT + 1, 2 * (to_ - from_)::BIGINT), '' ORDER BY a) AS x FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(t.n_removed, 0)::BIGINT AS n_removed, coalesce(t.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.x)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id) AS t USING (doc_id)
"""

OP11 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP13 = rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
d AS (SELECT * FROM w WHERE len(t) > 0),
k AS (SELECT count(*)::BIGINT AS docs, sum(len(t))::BIGINT AS words FROM d),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark) GROUP BY ALL),
f AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
g AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM (SELECT term, count(*) AS df FROM f GROUP BY term), k),
p AS (SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words))) AS part FROM f JOIN g USING (term), k),
s AS (SELECT item_id, r, doc_id, sum(times * part)::BIGINT AS score FROM i JOIN p USING (term) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""
