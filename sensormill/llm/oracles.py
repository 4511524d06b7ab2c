"""SQL of the operators on words, vectors and phrases, as DuckDB runs it on whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: One step of CRC-32 per byte, bit by bit: no table is needed.
_BIT = "CASE WHEN {c} % 2 = 1 THEN xor({c} // 2, 3988292384) ELSE {c} // 2 END"
_STEP = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda r, z: " + _BIT.format(c="r") + ")"

SPELLING = f"""WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents),
per AS (SELECT id, run, count(*) AS k, encode(id || ':' || run) AS bytes FROM runs GROUP BY id, run),
coded AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(1, octet_length(bytes) + 1), lambda i: CAST(('0x' || substr(hex(bytes), 2 * i - 1, 2)) AS BIGINT))),
         lambda c, b: {_STEP}), 4294967295) AS h FROM per),
w AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM coded)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
holes AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS (
  SELECT a.word AS word, b.word AS other, b.n AS n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN w b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min((-n, other)) AS top FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top[1] >= 2 * w.n THEN top[2] END AS form, CASE WHEN -top[1] >= 2 * w.n THEN -top[1] END AS form_n
  FROM w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT chain.word, formed.form, steps + 1 FROM chain JOIN formed ON chain.root = formed.word WHERE formed.form IS NOT NULL)
SELECT f.word, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form, CAST(f.form_n AS BIGINT) AS form_n, r.root
FROM formed f JOIN (SELECT word, max_by(root, steps) AS root FROM chain GROUP BY word) r USING (word)"""

EMBEDDINGS = """WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.95),
reach AS (SELECT DISTINCT x, x AS y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
least AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
       coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)"""

COLLOCATIONS = f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda w: w <> '') AS w FROM pieces),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
sizes AS (SELECT lang, w, unnest(range(1, 6)) AS m FROM lists),
starts AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sizes WHERE len(w) >= m),
f AS (SELECT lang, m, list_slice(w, i, i + m - 1) AS p, count(*) AS a FROM starts GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, m, p, a, unnest(range(1, m)) AS k FROM f WHERE m >= 2),
scored AS (
  SELECT c.lang, c.m, c.p, c.a, c.k, l.a AS l, r.a AS r, n.n,
         (1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS score
  FROM cuts c JOIN n USING (lang) JOIN f l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, c.k)
  JOIN f r ON r.lang = c.lang AND r.p = list_slice(c.p, c.k + 1, c.m)),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM scored),
longer AS (
  SELECT lang, list_slice(p, 1, m - 1) AS p, a AS b FROM f WHERE m >= 3
  UNION ALL SELECT lang, list_slice(p, 2, m), a FROM f WHERE m >= 3),
most AS (SELECT lang, p, max(b) AS b FROM longer GROUP BY lang, p),
kept AS (
  SELECT s.lang, array_to_string(s.p, ' ') AS phrase, s.a, s.l, s.r, s.n, CAST(s.score AS BIGINT) AS score
  FROM lowest s LEFT JOIN most USING (lang, p) WHERE place = 1 AND NOT coalesce(100 * b >= 100 * s.a, false))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000"""
