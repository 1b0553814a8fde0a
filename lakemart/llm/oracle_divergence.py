"""The SQL that the divergence of sources is compared with."""

SEGMENT_TREES = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents),
words AS (
    SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
    SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (
    SELECT l.lang, count(term) AS v, coalesce(sum(total), 0) AS n
    FROM (SELECT DISTINCT lang FROM docs) AS l LEFT JOIN kept USING (lang) GROUP BY l.lang),
own AS (
    SELECT w.lang, w.source, w.term, count(*) AS c FROM words AS w JOIN kept USING (lang, term)
    GROUP BY w.lang, w.source, w.term),
grouped AS (
    SELECT g.lang, g.source, coalesce(sum(c), 0) AS n
    FROM (SELECT DISTINCT lang, source FROM docs) AS g LEFT JOIN own USING (lang, source) GROUP BY g.lang, g.source),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(o.c, 0) AS c,
           1 + (1000000000::HUGEINT * (coalesce(o.c, 0) + 1)) // (g.n + l.v) AS p,
           1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS whole
    FROM grouped AS g JOIN langs AS l USING (lang) JOIN kept AS k USING (lang)
    LEFT JOIN own AS o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
priced AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM grouped AS a JOIN grouped AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN priced AS p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - whole) * (p - whole)) // whole AS value
    FROM shares WHERE c > 0 AND p > whole),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) AS parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
