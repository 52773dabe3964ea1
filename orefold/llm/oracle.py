"""DuckDB equivalents of the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP10 = rf"""
WITH d AS (
  SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         ('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE
             - coalesce(sum(source_size * 3) OVER p, 0)::DOUBLE)
            / (sum(w) OVER () - coalesce(sum(w) OVER p, 0))::DOUBLE AS fill
  FROM s WINDOW p AS (ORDER BY source_size * 3 / w, source IS NULL, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least((source_size * 3)::DOUBLE, max(fill) OVER () * w) AS target FROM f),
g AS (
  SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
c AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY h
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT d.doc_id, d.size, t.source_size, t.target, d.source,
       (d.size * copies)::BIGINT AS taken, copies
FROM (
  SELECT d.doc_id, d.source, d.h, d.size,
         (CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END)::BIGINT
         + (c.before + c.n / 2 <= t.target - CASE WHEN t.source_size > 0
            THEN floor(t.target / t.source_size) * t.source_size ELSE 0 END AND t.source_size > 0)::BIGINT AS copies
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
         JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h) d
JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""

OP2 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS k FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
      FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT c.a, c.b FROM c JOIN n x ON c.a = x.doc_id JOIN n y ON c.b = y.doc_id
  WHERE 100 * c.common >= 80 * (x.n + y.n - c.common)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents
      UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON d.doc_id = m.a LEFT JOIN n ON d.doc_id = n.doc_id
"""

OP3 = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '<\|') AS body,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), replace(coalesce(text, ''), '<|', '<\|')) - 1 AS i
  FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (
  SELECT t.conv_id, p.speaker, t.i // 64 AS part, t.i, t.role = p.speaker AS mine,
         CASE WHEN t.role = p.speaker THEN '<|assistant|>' || chr(10)
              WHEN t.role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user name=' || replace(t.role, '<|', '<\|') || '|>' || chr(10) END AS head,
         t.body || '<|end|>' || chr(10) AS tail
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
m AS (
  SELECT *, sum(length(head) + length(tail)) OVER (PARTITION BY conv_id, speaker, part ORDER BY i)
            - length(tail) AS start FROM r)
SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (WHERE mine) AS n_trained,
       string_agg(head || tail, '' ORDER BY i) AS text,
       coalesce(string_agg(start || ':' || (start + length(tail)), ',' ORDER BY i) FILTER (WHERE mine), '') AS mask
FROM m GROUP BY conv_id, speaker, part
"""

OP5 = r"""
WITH l AS (
  SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents)),
r AS (
  SELECT *, lead(line) OVER d AS next, lead(i) OVER d AS has_next FROM l
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, i) > 1 AS later
  FROM r WHERE has_next IS NOT NULL),
s AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS later FROM l
  WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50),
g AS (
  SELECT l.doc_id, l.i, l.line, coalesce(a.later, false) OR coalesce(b.later, false) OR coalesce(s.later, false) AS gone
  FROM l LEFT JOIN f a ON l.doc_id = a.doc_id AND l.i = a.i
         LEFT JOIN f b ON l.doc_id = b.doc_id AND l.i = b.i + 1
         LEFT JOIN s ON l.doc_id = s.doc_id AND l.i = s.i),
h AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, gone ORDER BY i) AS run FROM g),
k AS (SELECT doc_id, run, count(*) AS n FROM h WHERE gone GROUP BY doc_id, run),
t AS (SELECT doc_id, count(*) AS n_runs, max(n) AS longest_run FROM k GROUP BY doc_id)
SELECT h.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       coalesce(any_value(t.n_runs), 0) AS n_runs, coalesce(any_value(t.longest_run), 0) AS longest_run,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM h LEFT JOIN t ON h.doc_id = t.doc_id GROUP BY h.doc_id
"""

_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                             lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""

# One row per conversation and prefix length; nodes are the distinct prefixes.
OP11 = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
m AS (SELECT conv_id, {_CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT m.conv_id, 0 AS part, t.i, t.role, t.text FROM m JOIN t ON t.conv_id = m.conv_id - m.conv_id % 100 AND t.i < m.h
  UNION ALL
  SELECT m.conv_id, 1, t.i, t.role, t.text FROM m JOIN t ON t.conv_id = m.conv_id AND t.i >= m.h),
c AS (
  SELECT m.conv_id, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY part, i)
                             FILTER (WHERE r.role IS NOT NULL), []) AS turns
  FROM m LEFT JOIN r ON m.conv_id = r.conv_id GROUP BY m.conv_id),
p AS (SELECT conv_id, turns[1:d] AS prefix, d, d = len(turns) AS over
      FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM c)),
n AS MATERIALIZED (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN d = 0 THEN 0 ELSE length(any_value(prefix[d].text)) END AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE over), '')) AS ends_sha256
  FROM p GROUP BY prefix, d),
k AS MATERIALIZED (
  SELECT n.prefix, n.d, n.n_convs, n.size, count(x.d) AS n_children
  FROM n LEFT JOIN n x ON x.d = n.d + 1 AND x.prefix[1:x.d - 1] = n.prefix GROUP BY ALL),
s AS (
  SELECT prefix[1:a] AS prefix, a AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM k) GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, o.conv_id AS parent_conv_id, n.n_convs, k.n_children, s.n_leaves, s.saved_tokens,
       n.ends_sha256
FROM n JOIN k ON n.d = k.d AND n.prefix = k.prefix JOIN s ON n.d = s.d AND n.prefix = s.prefix
       LEFT JOIN n o ON o.d = n.d - 1 AND o.prefix = n.prefix[1:n.d - 1]
"""

OP12 = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN latest END AS refers_to
FROM (SELECT *, strlen(coalesce(html, '')) >= 1000 AND page_id IS DISTINCT FROM latest AS again
      FROM (SELECT *, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS latest FROM pages))
"""

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP13 = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
f AS (SELECT doc_id, n, term, count(*) AS tf
      FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM f, s GROUP BY term, n_docs),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
r AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0
QUALIFY rank <= 50
"""

ORACLE: dict[str, str] = {
    "op2_superminhash": OP2,
    "op3_perspectives": OP3,
    "op5_line_runs": OP5,
    "op10_mix_sources": OP10,
    "op11_prefix_trie": OP11,
    "op12_warc": OP12,
    "op13_lexical_search": OP13,
}
