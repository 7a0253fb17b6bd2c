"""DuckDB SQL for the registered queries of this package that SQL can express.  The others are
held against brute force in tests/llm."""

from __future__ import annotations

AUDIT = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
first_of AS (SELECT t, min(doc_id) AS doc_id FROM w GROUP BY t),
rows AS (
  SELECT part,
         (CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 10 * length(w.t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN w.doc_id > f.doc_id THEN 16 ELSE 0 END) AS mask,
         CASE WHEN w.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS good,
         CASE WHEN w.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS toxic
  FROM w JOIN first_of f ON f.t = w.t),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM rows GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
  JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
steps AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0) AS before
  FROM orders, range(1, 6) r(k)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & CAST(before + bit AS INTEGER) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted"""

# the crc32 of `<doc_id>:<run>`, byte by byte over its table of 256
SPELLING = r"""
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT w, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda x:
             CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
                  ELSE [CAST(195 AS BIGINT), CAST(unicode(x) - 64 AS BIGINT)] END))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, tab),
written AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2)
              ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
  SELECT word, n, CAST(i AS INTEGER) AS i, substr(word, 1, CAST(i AS INTEGER) - 1) || substr(word, CAST(i AS INTEGER) + 1) AS rest
  FROM words, range(1, 200) r(i) WHERE i <= length(word)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n
  FROM pairs GROUP BY word),
own AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.form_n >= 10 * w.n THEN b.form END AS form, CASE WHEN b.form_n >= 10 * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (
  SELECT word, word AS root, 0 AS k FROM own
  UNION ALL SELECT walk.word, own.form, k + 1 FROM walk JOIN own ON own.word = walk.root WHERE own.form IS NOT NULL),
last AS (SELECT word, first(root ORDER BY k DESC) AS root FROM walk GROUP BY word)
SELECT own.word, own.form, last.root, own.n, CAST(own.n_near AS BIGINT) AS n_near, own.form_n
FROM own JOIN last ON last.word = own.word"""


def _secrets() -> str:
    # written for an engine without look-around: kind, rank, base?, the whole match, its value, least length
    kinds = [
        ("assign", True, r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
         r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 1, 8),
        ("access", True, r"AKIA[A-Z0-9]+", 0, 16),
        ("hex", True, r"[0-9a-f]{32,}", 0, 32),
        ("loose", False, r"(?:[Pp][Ww][Dd]|[Pp][Aa][Ss][Ss][Pp][Hh][Rr][Aa][Ss][Ee]|[Aa][Uu][Tt][Hh]|"
         r"[Cc][Rr][Ee][Dd][Ee][Nn][Tt][Ii][Aa][Ll][Ss]?|[Bb][Ee][Aa][Rr][Ee][Rr]|[Aa][Cc][Cc][Ee][Ss][Ss]_?[Ii][Dd]|"
         r"[Pp][Rr][Ii][Vv][Aa][Tt][Ee]_?[Kk][Ee][Yy]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd])[\"'']?\x20*[:=]?\x20*[\"'']?"
         r"([A-Za-z0-9+/_.=-]+)", 1, 12),
        ("service", False, r"(?:gh[opsu]_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|sk-|npm_|AIza|ya29\.|eyJ)"
         r"[A-Za-z0-9_.-]+", 0, 20),
        ("mixed", False, r"[A-Za-z0-9]{24,}", 0, 24),
    ]
    found = "\n  UNION ALL ".join(
        f"SELECT row, '{k}' AS kind, {i} AS o, {str(base).lower()} AS base, "
        f"unnest(regexp_extract_all(t, '{p}', 0)) AS m, unnest(regexp_extract_all(t, '{p}', {g})) AS value, "
        f"generate_subscripts(regexp_extract_all(t, '{p}', 0), 1) AS k, {least} AS least, "
        f"list_transform(string_split_regex(t, '{p}'), lambda x: length(x)) AS gaps "
        f"FROM docs WHERE regexp_matches(t, '{p}')" for i, (k, base, p, g, least) in enumerate(kinds))
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (
  SELECT *, list_sum(gaps[1:k]) + coalesce(sum(length(m)) OVER (
              PARTITION BY row, kind ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM found),
spans AS (
  SELECT row, kind, o, base, CAST(s AS BIGINT) AS s, CAST(s + length(m) AS BIGINT) AS e, value,
         len(list_distinct(string_split(value, ''))) >= 10 AND regexp_matches(value, '[0-9]')
         AND regexp_matches(value, '[A-Za-z]') AS random
  FROM placed WHERE length(value) >= least),
cands AS (
  SELECT x.* FROM spans x WHERE x.base OR NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.base AND b.row = x.row AND b.s < x.e AND x.s < b.e)),
held AS (SELECT value, source, doc_id, bool_or(random) AS random FROM cands JOIN docs USING (row) GROUP BY value, source, doc_id),
owned AS (SELECT value, source, count(*) AS n, bool_or(random) AS random FROM held GROUP BY value, source),
judged AS (
  SELECT value, CASE WHEN count(*) > 2 AND 2 * max(n) <= sum(n) THEN 'example' WHEN bool_or(random) THEN 'live' ELSE 'plain' END
         AS verdict FROM owned GROUP BY value),
kept AS (SELECT c.* FROM cands c JOIN judged j ON j.value = c.value WHERE c.base OR j.verdict = 'live')
SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (WHERE base), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o), '') AS spans
FROM docs d LEFT JOIN kept k ON k.row = d.row GROUP BY d.row, d.doc_id"""


#: Vectors whose components are all finite and not all zero, linked by cosine >= 0.9; who reaches whom by links.
#: All pairs, where the operator searches an index of stated recall and may miss a link.
NEAR_VECTORS = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
walk AS (SELECT a, b FROM links UNION SELECT w.a, l.b FROM walk w JOIN links l ON l.a = w.b),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),
first_of AS (SELECT a, min(b) AS low FROM walk GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN degree ON degree.a = vec_id LEFT JOIN first_of ON first_of.a = vec_id
"""

#: Documents by their sets of 3-word shingles; classes of equal sets are linked by full sets.
NEAR_DOCUMENTS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
                      WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                      ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 1),
                             lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) END AS s
  FROM w),
classes AS (SELECT s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY s),
posts AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b
  FROM posts a JOIN posts b ON a.x = b.x AND a.rep <> b.rep AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
walk AS (SELECT a, b FROM links UNION SELECT w.a, l.b FROM walk w JOIN links l ON l.a = w.b),
first_of AS (SELECT rep, least(rep, coalesce(min(b), rep)) AS low FROM classes LEFT JOIN walk ON a = rep GROUP BY rep)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(f.low, d.doc_id) AS component_id,
       d.doc_id = coalesce(f.low, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON len(d.s) > 0 AND c.s = d.s LEFT JOIN first_of f ON f.rep = c.rep
"""

ORACLES: dict[str, str] = {
    "op1_multi_index_dedup": NEAR_VECTORS,
    "op10_minhash_dedup": NEAR_DOCUMENTS,
    "op11_filter_audit": AUDIT,
    "op12_spelling_variants": SPELLING,
    "op13_secret_ownership": _secrets(),
}
