"""DuckDB twins of those queries that SQL can express, by brute force."""

from __future__ import annotations

SPACE = r"[ \t\n\x0b\f\r]+"
WORDS = f"list_filter(regexp_split_to_array({{text}}, '{SPACE}'), lambda w: w <> '')"
#: Smallest id reachable over ``links`` (both directions) from every node of ``nodes``.
REACH = """
reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

SUBSTRING = f"""
WITH docs AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS key FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) AS i FROM docs)),
first AS (SELECT key, min(doc_id) AS least FROM windows GROUP BY key),
covered AS (SELECT DISTINCT doc_id, i + k AS pos FROM windows JOIN first USING (key) CROSS JOIN (SELECT unnest(range(50)) AS k) WHERE doc_id > least),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

# Base 32 takes four characters from every five hex digits.
_CHARS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (CAST('0x' || substr(h, {5 * (k // 4) + 1}, 5) AS INTEGER) >> {15 - 5 * (k % 4)}) % 32 + 1, 1)" for k in range(32))
WARC = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_CHARS} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM payloads
"""

MINHASH = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
good AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)),
links AS (SELECT a, b FROM good UNION ALL SELECT b, a FROM good),
nodes AS (SELECT DISTINCT doc_id AS id FROM docs),{REACH}
SELECT docs.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, docs.doc_id = component_id AS kept
FROM docs JOIN component ON id = docs.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id
"""

SPHERICAL = f"""
WITH RECURSIVE vectors AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
valid AS (SELECT * FROM vectors WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT x.id AS a, y.id AS b FROM valid x JOIN valid y ON x.label = y.label AND x.id <> y.id AND len(x.v) = len(y.v) WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
nodes AS (SELECT id FROM vectors),{REACH}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept FROM component
"""

DIVERGENCE = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c FROM groups g JOIN kept k USING (lang) LEFT JOIN counts USING (lang, source, term)),
p AS (SELECT *, 1 + (CAST(1000000000 AS HUGEINT) * (c + 5)) // (sum(c) OVER g + 5 * count(*) OVER g) AS p FROM grid WINDOW g AS (PARTITION BY lang, source)),
base AS (SELECT lang, term, sum(c) AS c FROM grid GROUP BY ALL),
q AS (SELECT *, 1 + (CAST(1000000000 AS HUGEINT) * (c + 5)) // (sum(c) OVER g + 5 * count(*) OVER g) AS q FROM base WINDOW g AS (PARTITION BY lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(v, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS v FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) t
            ON t.lang = a.lang AND t.source = a.source AND t.item = b.source),
terms AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.c > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

_ORDINALS = f"list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda c: CAST(ord(c) AS UBIGINT))"
# One byte into a CRC-32: eight steps with the reflected polynomial.
_CRC = ("list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), " + _ORDINALS + "), lambda crc, x: "
        "list_reduce(list_prepend(xor(crc, x), [CAST(0 AS UBIGINT) FOR i IN range(8)]), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS UBIGINT)) ELSE a >> 1 END))")


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(CAST({name} AS VARCHAR)) || ':' || {name} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {_field(text)})"


def _tree(nodes: str, name: str) -> str:
    """CTEs of a tree over ``nodes`` (grp, pos, h, n): ``name`` has every level's
    nodes with the siblings before and after each."""
    return f"""
{name}_up(lvl, grp, pos, h, n) AS (
  SELECT 0, grp, pos, h, n FROM {nodes}
  UNION ALL
  SELECT lvl + 1, grp, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM {name}_up WHERE n > 1 GROUP BY lvl, grp, pos // 3, n),
{name} AS (SELECT *, coalesce(string_agg(h, '' ORDER BY pos) FILTER (WHERE n > 1) OVER before, '') AS l, coalesce(string_agg(h, '' ORDER BY pos) FILTER (WHERE n > 1) OVER after, '') AS r
  FROM {name}_up WINDOW before AS (PARTITION BY lvl, grp, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                        after AS (PARTITION BY lvl, grp, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""


MERKLE = f"""
WITH RECURSIVE base AS (SELECT *, CASE WHEN ~({_CRC}) & 1 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents),
leaves AS (SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("other")} AS changed FROM base),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
                  dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM leaves),
ground AS (SELECT grp, pos, leaf AS h, n FROM placed),{_tree("ground", "low")},
subroots AS (SELECT 0 AS grp, grp AS pos, h, count(*) OVER () AS n FROM low WHERE n = 1),{_tree("subroots", "high")},
walk(doc_id, leaf, node, proof, grp, pos, lvl, n, top) AS (
  SELECT doc_id, leaf, changed, '', grp, pos, 0, n, false FROM placed
  UNION ALL
  SELECT doc_id, leaf, CASE WHEN w.n > 1 THEN sha256(coalesce(a.l, b.l) || node || coalesce(a.r, b.r)) ELSE node END,
         CASE WHEN w.n > 1 THEN proof || coalesce(a.l, b.l) || coalesce(a.r, b.r) ELSE proof END,
         CASE WHEN w.n > 1 THEN w.grp ELSE 0 END, CASE WHEN w.n > 1 THEN w.pos // 3 ELSE w.grp END, CASE WHEN w.n > 1 THEN w.lvl + 1 ELSE 0 END,
         CASE WHEN w.n > 1 THEN (w.n + 2) // 3 ELSE (SELECT count(*) FROM subroots) END, top OR w.n = 1
  FROM walk w LEFT JOIN low a ON NOT top AND a.grp = w.grp AND a.pos = w.pos AND a.lvl = w.lvl
              LEFT JOIN high b ON top AND b.grp = w.grp AND b.pos = w.pos AND b.lvl = w.lvl
  WHERE NOT (top AND w.n = 1)),
ends AS (SELECT doc_id, leaf, node AS folded_root, sha256(proof) AS proof_sha256 FROM walk WHERE top AND n = 1)
SELECT ends.doc_id, ends.leaf, s.h AS subroot, root.h AS root, proof_sha256, folded_root, folded_root = root.h AS verified
FROM ends JOIN placed USING (doc_id, leaf) JOIN subroots s ON s.pos = placed.grp CROSS JOIN (SELECT h FROM high WHERE n = 1) root
"""
