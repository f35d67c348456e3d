"""DuckDB SQL for the operators that SQL can express, over the same tables.

The others (2, 3, 4, 6, 9, 12, 13 and the pipeline) are compared with plain Python
in ``tests/llm``.
"""

from mentions.llm.sharding import LIMIT_BYTES

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS1 = r"regexp_extract_all(" + _LOWER.format("COALESCE(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS7 = r"regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH items AS (SELECT COALESCE(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS1} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item, len(list_slice(ws, i, i + 9)) AS n, array_to_string(list_slice(ws, i, i + 9), ' ') AS w
  FROM (SELECT item, ws, unnest(range(1, GREATEST(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0) x),
docs AS (SELECT doc_id, {_WORDS1} AS ws FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs CROSS JOIN sizes WHERE len(ws) >= n) x),
hits AS (SELECT r.doc_id, r.i, r.n, v.item FROM runs r JOIN windows v ON r.n = v.n AND r.w = v.w),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) c GROUP BY doc_id),
found AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hits) f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, COALESCE(c.n_hit, 0) AS n_hit, COALESCE(f.n_items, 0) AS n_items,
  sha256(COALESCE(f.items, '')) AS items_sha256, c.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id"""

OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
          ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.b FROM reach r JOIN links l ON r.y = l.a),
comp AS (SELECT x AS vec_id, MIN(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, COALESCE(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON e.vec_id = c.vec_id LEFT JOIN degree d ON e.vec_id = d.a"""

OP7 = f"""
WITH docs AS (SELECT doc_id, {_WORDS7} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM docs WHERE len(ws) >= 13) x),
firsts AS (SELECT w, MIN(doc_id) AS f FROM windows GROUP BY w HAVING COUNT(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
         FROM windows JOIN firsts USING (w) WHERE f < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM docs),
kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.p) AS t
         FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p WHERE g.p IS NULL GROUP BY w.doc_id),
lost AS (SELECT doc_id, COUNT(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, COALESCE(l.n, 0) AS n_removed, sha256(COALESCE(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN lost l ON d.doc_id = l.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id"""

OP8 = f"""
WITH split AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, p, line, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM split) x),
owners AS (SELECT key, MIN(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT l.doc_id, l.p, l.line, COALESCE(o.owner < l.doc_id, FALSE) AS gone
           FROM lines l LEFT JOIN owners o ON l.key = o.key)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE gone) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

# depths to 20 bits: far below the first at which equal buckets of these tables fit
OP10 = f"""
WITH h AS (
  SELECT doc_id, CAST(COALESCE(strlen(text), 0) AS BIGINT) AS bytes,
    CAST('0x' || substr(md5(concat_ws(chr(10), doc_id, text)), 1, 15) AS BIGINT) AS hash
  FROM documents),
levels AS (SELECT h.*, d, hash >> CAST(60 - d AS BIGINT) AS prefix FROM h CROSS JOIN range(0, 21) r(d)),
sums AS (SELECT d, prefix, SUM(bytes) AS shard_bytes, COUNT(*) AS shard_docs, MIN(hash) = MAX(hash) AS alone
         FROM levels GROUP BY d, prefix),
fits AS (SELECT * FROM sums WHERE shard_bytes <= {LIMIT_BYTES} OR alone),
leaf AS (SELECT l.doc_id, l.bytes, l.hash, MIN(l.d) AS d FROM levels l JOIN fits f ON l.d = f.d AND l.prefix = f.prefix
         GROUP BY l.doc_id, l.bytes, l.hash)
SELECT e.doc_id, e.bytes, e.hash, CASE WHEN e.d = 0 THEN '*' ELSE lpad(bin(e.hash >> CAST(60 - e.d AS BIGINT)), CAST(e.d AS INTEGER), '0') END AS shard,
  CAST(e.d AS INTEGER) AS depth, CAST(f.shard_bytes AS BIGINT) AS shard_bytes, f.shard_docs,
  f.shard_bytes > {LIMIT_BYTES} AS oversized
FROM leaf e JOIN fits f ON e.d = f.d AND e.hash >> CAST(60 - e.d AS BIGINT) = f.prefix"""

_P = "1 + CAST((CAST(1000000000 AS HUGEINT) * ({0} + 5)) // ({1} + 5 * {2}) AS BIGINT)"

OP11 = rf"""
WITH docs AS (
  SELECT COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
    regexp_extract_all({_LOWER.format("COALESCE(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
vocabulary AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ws)) AS term FROM docs) w GROUP BY lang, term HAVING COUNT(*) >= 30),
counts AS (
  SELECT o.lang, o.source, o.term, COUNT(*) AS n FROM (SELECT lang, source, unnest(ws) AS term FROM docs) o
  JOIN vocabulary v ON o.lang = v.lang AND o.term = v.term GROUP BY o.lang, o.source, o.term),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, COUNT(*) AS v FROM vocabulary GROUP BY lang),
totals AS (SELECT lang, source, SUM(n) AS total FROM counts GROUP BY lang, source),
lang_counts AS (SELECT lang, term, SUM(n) AS n FROM counts GROUP BY lang, term),
lang_totals AS (SELECT lang, SUM(n) AS total FROM counts GROUP BY lang),
shares AS (
  SELECT g.lang, g.source, v.term, COALESCE(c.n, 0) AS n, {_P.format("COALESCE(c.n, 0)", "COALESCE(t.total, 0)", "s.v")} AS p
  FROM groups g JOIN vocabulary v ON g.lang = v.lang JOIN sizes s ON g.lang = s.lang
  LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source AND v.term = c.term),
lang_shares AS (
  SELECT c.lang, c.term, {_P.format("c.n", "t.total", "s.v")} AS q
  FROM lang_counts c JOIN lang_totals t ON c.lang = t.lang JOIN sizes s ON c.lang = s.lang),
distances AS (
  SELECT a.lang, a.source, b.source AS item, SUM(ABS(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(COALESCE(d.value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN distances d ON g.lang = d.lang AND g.source = d.source AND h.source = d.item),
terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, CAST(s.p - q.q AS BIGINT) AS value
  FROM shares s JOIN lang_shares q ON s.lang = q.lang AND s.term = q.term WHERE s.n > 0 AND s.p > q.q),
ranked AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) x)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1,
    "op5_embedding_dedup": OP5,
    "op7_substring_dedup": OP7,
    "op8_line_dedup": OP8,
    "op10_sharding": OP10,
    "op11_source_divergence": OP11,
}
