"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"

OP9 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS body FROM documents),
cut AS (SELECT doc_id, regexp_split_to_array(body, '{_SPACE}') AS ws FROM d),
w AS (
    SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i
    FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM cut) WHERE word <> ''),
g AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
    FROM (SELECT doc_id, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
          FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i))
    WHERE c IS NOT NULL),
repeats AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM g, (VALUES (0), (1), (2)) t(k) WHERE g.n > 1 GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
l AS (
    SELECT doc_id, source, body, line, trim(regexp_replace(lower(line), '{_SPACE}', ' ', 'g')) AS norm
    FROM (SELECT doc_id, source, body, unnest(string_split(body, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT body) AS n FROM d GROUP BY source),
often AS (
    SELECT source, norm FROM l JOIN hosts USING (source) GROUP BY source, norm, hosts.n
    HAVING count(DISTINCT body) > 20 AND count(DISTINCT body) > 0.05 * hosts.n),
gone AS (
    SELECT doc_id, sum(len(string_split(norm, ' '))) AS n FROM l JOIN often USING (source, norm) GROUP BY doc_id),
base AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
        length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_gone
    FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)
    LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words - n_gone >= 0.3 * n_words AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
"""

_KEY = r"(?i:password|passwd|secret|token|api_?key)"

OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
cut AS (
    SELECT doc_id, 'assign' AS kind, 1 AS rank, regexp_extract_all(body, '{_KEY}["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS hits,
        regexp_split_to_array(body, '{_KEY}["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS parts FROM d
    UNION ALL SELECT doc_id, 'access', 2, regexp_extract_all(body, 'AKIA[A-Z0-9]+'), regexp_split_to_array(body, 'AKIA[A-Z0-9]+') FROM d
    UNION ALL SELECT doc_id, 'hex', 3, regexp_extract_all(body, '[0-9a-f]+'), regexp_split_to_array(body, '[0-9a-f]+') FROM d),
e AS (
    SELECT doc_id, kind, rank, hit, sum(length(hit) + length(part)) OVER (PARTITION BY doc_id, kind ORDER BY k) AS stop
    FROM (SELECT doc_id, kind, rank, unnest(hits) AS hit, unnest(parts[:len(hits)]) AS part, unnest(range(len(hits))) AS k FROM cut)),
f AS (
    SELECT *, stop - length(hit) AS start FROM e
    WHERE CASE kind WHEN 'access' THEN length(hit) >= 18 WHEN 'hex' THEN length(hit) >= 16
        ELSE length(regexp_extract(hit, '{_KEY}["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1)) >= 12 END),
s AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank) AS spans
    FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (doc_id)
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP3 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
p AS (
    SELECT DISTINCT item_id, m, array_to_string(ws[k:k + m - 1], ' ') AS pattern
    FROM (SELECT item_id, ws, least(10, len(ws)) AS m, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS k
          FROM b WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT m FROM p),
w AS (
    SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS pattern
    FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, lengths WHERE len(ws) >= m)),
found AS (SELECT doc_id, i, m, item_id FROM w JOIN p USING (m, pattern)),
hit AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Bytes are handled as pairs of hex digits.
OP4 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS raw FROM documents),
w AS (
    SELECT doc_id, i, md5(substring(raw, 2 * i + 1, 200)) AS h
    FROM (SELECT doc_id, raw, unnest(range(len(raw) // 2 - 99)) AS i FROM d WHERE len(raw) >= 200)),
later AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
marked AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS opens FROM later),
runs AS (
    SELECT doc_id, min(i) AS start, max(i) + 100 AS stop
    FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run),
gaps AS (
    SELECT doc_id, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS start, start AS stop FROM runs
    UNION ALL SELECT doc_id, max(stop), NULL FROM runs GROUP BY doc_id),
sums AS (SELECT doc_id, CAST(sum(stop - start) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id),
rest AS (
    SELECT doc_id, string_agg(CASE WHEN stop IS NULL THEN substring(raw, 2 * start + 1) ELSE substring(raw, 2 * start + 1, 2 * (stop - start)) END,
        '' ORDER BY start) AS kept
    FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(raw) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, raw))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

OP12 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY lang, source, term),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 10),
v AS (SELECT lang, count(*) AS kept, sum(n) AS total FROM k GROUP BY lang),
t AS (SELECT c.lang, c.source, sum(c.n) AS total FROM c JOIN k USING (lang, term) GROUP BY c.lang, c.source),
g AS (
    SELECT lang, source, coalesce(t.total, 0) AS total, coalesce(kept, 0) AS kept
    FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN t USING (lang, source) LEFT JOIN v USING (lang)),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.kept) AS p,
        1 + (1000000000::HUGEINT * (k.n + 2)) // (v.total + 2 * v.kept) AS q
    FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
u AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
WHERE part = 'pair' OR rank <= 10
"""

OP11 = r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
    SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
    FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) t(m) WHERE len(ws) >= m)),
n AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30),
cut AS (
    SELECT lang, m, phrase, a, k, array_to_string(ws[:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
    FROM (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m > 1)),
scored AS (
    SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score, k
    FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
    SELECT lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, max(a) AS top
    FROM (SELECT lang, a, ws, s, unnest(range(1, m - s + 2)) AS i
          FROM (SELECT lang, m, a, string_split(phrase, ' ') AS ws FROM f WHERE m > 2), (VALUES (2), (3)) t(s) WHERE s < m)
    GROUP BY ALL),
left_over AS (
    SELECT b.* FROM best b LEFT JOIN inner_parts i USING (lang, phrase) WHERE i.top IS NULL OR 100::HUGEINT * i.top < 80::HUGEINT * b.a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over) JOIN n USING (lang)
WHERE rank <= 2000
"""
