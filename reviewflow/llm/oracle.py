"""DuckDB SQL for the queries that SQL can express."""

from reviewflow.llm import licenses
from reviewflow.llm.licenses import TEMPLATES, THRESHOLD


def _grams(text: str) -> str:
    """Word list of a text column, as a DuckDB expression."""
    return f"string_split(trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"


def _license_sql() -> str:
    rows = ", ".join("({}, '{}', '{}')".format(k, n, t.replace("'", "''")) for k, (n, t) in enumerate(TEMPLATES))
    pairs = "[w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]"
    tag, spdx, exception, suffix = licenses.TAG, licenses.SPDX_ID, licenses.EXCEPTION, licenses.SUFFIX
    return f"""
WITH t(k, name, text) AS (VALUES {rows}),
tg AS (SELECT k, name, g, len(g) AS n, np, CAST(ceil({THRESHOLD} * len(g) / (2 - {THRESHOLD}) - 1e-9) AS INT) AS need,
              list_distinct([np, (5 * np + 3) // 4]) AS sizes
       FROM (SELECT k, name, list_distinct({pairs}) AS g, len(w) - 1 AS np FROM (SELECT k, name, {_grams('text')} AS w FROM t))),
d AS (SELECT doc_id, {pairs} AS g FROM (SELECT doc_id, {_grams("coalesce(text, '')")} AS w FROM documents)),
h AS (SELECT doc_id, k, pos FROM (SELECT doc_id, unnest(g) AS x, generate_subscripts(g, 1) AS pos FROM d)
      JOIN (SELECT k, unnest(g) AS x FROM tg) USING (x)),
c AS (SELECT *, count(*) OVER (PARTITION BY doc_id, k ORDER BY pos RANGE BETWEEN CURRENT ROW AND 400 FOLLOWING) AS ahead FROM h),
w AS (SELECT doc_id, k, name, n, pos AS s, least(pos + size, len(d.g) + 1) AS e, list_distinct(d.g[pos:pos + size - 1]) AS a, tg.g AS own
      FROM c JOIN (SELECT *, unnest(sizes) AS size FROM tg) AS tg USING (k) JOIN d USING (doc_id) WHERE ahead >= need),
m AS (SELECT doc_id, name, s, e, shared, 2.0::DOUBLE * shared / (size + n) AS score
      FROM (SELECT *, len(list_intersect(a, own)) AS shared, len(a) AS size FROM w)),
f AS (SELECT * FROM m WHERE score >= {THRESHOLD}),
found AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM f AS o WHERE o.doc_id = f.doc_id AND o.name <> f.name
            AND (o.shared > f.shared OR o.shared = f.shared AND o.score > f.score)
            AND 2 * (least(o.e, f.e) - greatest(o.s, f.s)) >= f.e - f.s)),
tags AS (SELECT doc_id, regexp_replace(id, '{suffix}', '') AS name FROM (SELECT doc_id, unnest(regexp_extract_all(
           regexp_replace(tag, '{exception}', '', 'g'), '{spdx}')) AS id
           FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{tag}', 1)) AS tag FROM documents)) WHERE id NOT IN ('AND', 'OR')),
every AS (SELECT doc_id, name, shared, score, '' AS tag FROM found UNION ALL SELECT doc_id, name, 0, 1.0, name FROM tags),
best AS (SELECT doc_id, name AS license, score FROM every QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, shared DESC, name) = 1),
a AS (SELECT doc_id, array_to_string(list_sort(list_distinct(list(name))), ',') AS licenses,
             array_to_string(list_sort(list_distinct(list(tag) FILTER (tag <> ''))), ',') AS tags FROM every GROUP BY doc_id)
SELECT doc_id, license, score, coalesce(licenses, '') AS licenses, coalesce(tags, '') AS tags
FROM documents LEFT JOIN a USING (doc_id) LEFT JOIN best USING (doc_id)"""


# Checksums of four bits: the CRC-32 polynomial 0xEDB88320 taken through four shifts.
def _crc_steps() -> list[int]:
    out = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, two nibbles a character, as a DuckDB expression."""
    step = "xor(a >> 4, {}[(xor(a, {}) & 15) + 1])"
    steps = f"({_crc_steps()}::BIGINT[])"
    nibbles = f"[4294967295] || flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT & 15, ascii(c)::BIGINT >> 4]))"
    return f"xor(list_reduce({nibbles}, lambda a, b: {step.format(steps, 'b')}), 4294967295)"


def _merkle_sql() -> str:
    def field(f):
        return f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')"

    def leaf(n):
        return "sha256(" + " || ".join(field(n if f == "n_chars" else f) for f in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('n_chars')} AS leaf,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS tampered FROM documents),
b AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM d),
lo(tree, level, idx, n, h) AS (
  SELECT tree, 0, idx, n, leaf FROM b
  UNION ALL
  SELECT tree, level + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM lo WHERE n > 1 GROUP BY tree, level, idx // 2),
sub AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM lo WHERE n = 1),
hi(level, idx, n, h) AS (
  SELECT 0, idx, n, subroot FROM sub
  UNION ALL
  SELECT level + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM hi WHERE n > 1 GROUP BY level, idx // 2),
lows AS (SELECT DISTINCT tree, level FROM lo WHERE n > 1), highs AS (SELECT DISTINCT level FROM hi WHERE n > 1),
low_path AS (
  SELECT b.tree, b.idx, list({{'h': coalesce(s.h, ''), 'l': (b.idx >> w.level) & 1}} ORDER BY w.level) AS p
  FROM b JOIN lows w USING (tree) LEFT JOIN lo s ON s.tree = b.tree AND s.level = w.level AND s.idx = xor(b.idx >> w.level, 1) GROUP BY ALL),
high_path AS (
  SELECT u.tree, list({{'h': coalesce(s.h, ''), 'l': (u.idx >> w.level) & 1}} ORDER BY w.level) AS p
  FROM sub u CROSS JOIN highs w LEFT JOIN hi s ON s.level = w.level AND s.idx = xor(u.idx >> w.level, 1) GROUP BY ALL),
j AS (SELECT b.doc_id, b.leaf, sub.subroot, (SELECT h FROM hi WHERE n = 1) AS root, coalesce(l.p, []) || coalesce(h.p, []) AS p, tampered
      FROM b JOIN sub USING (tree) LEFT JOIN low_path l ON l.tree = b.tree AND l.idx = b.idx LEFT JOIN high_path h ON h.tree = b.tree),
f AS (SELECT *, list_reduce([{{'h': coalesce(tampered, leaf), 'l': 0::BIGINT}}] || p, lambda a, s: {{
        'h': sha256(CASE WHEN s.l = 1 THEN s.h || a.h ELSE a.h || s.h END), 'l': 0::BIGINT}}).h AS folded_root FROM j)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([x.h FOR x IN p], '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM f"""


def _trie_sql() -> str:
    return f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, t.pos, m, chars FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
      UNION ALL SELECT c.conv_id, 1, t.pos, m, chars FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
whole AS (SELECT c.conv_id, coalesce(list(m ORDER BY part, pos) FILTER (m IS NOT NULL), []) AS ms,
                 coalesce(list(chars ORDER BY part, pos) FILTER (m IS NOT NULL), []) AS cs FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d, len(ms) AS total, ms[:d] AS path, CASE WHEN d > 0 THEN cs[d] ELSE 0 END AS chars
      FROM (SELECT *, unnest(range(len(ms) + 1)) AS d FROM whole)),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars, max(total) > d AS inner_node,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (total = d), '')) AS ends_sha256 FROM p GROUP BY path, d),
up AS (SELECT path[:k] AS path, sum(1 - CAST(inner_node AS INT)) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens, count(*) FILTER (d = k + 1) AS n_children
       FROM (SELECT *, unnest(range(d + 1)) AS k FROM n) GROUP BY path[:k], k)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, n.n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN up USING (path) LEFT JOIN n parent ON n.d > 0 AND parent.path = n.path[:n.d - 1]"""


ORACLE = {
    "op11_conversation_trie": _trie_sql(),
    "op13_merkle_manifest": _merkle_sql(),
    "op6_license_scan": _license_sql(),
    "op1_line_dedup": r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, i - 1 AS pos, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS t
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3)),
later AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, pos) AS k FROM w
          WHERE regexp_matches(t, '[^ \t\r\n\x0b\x0c]')) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM later),
lists AS (SELECT doc_id, list(pos) AS p FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed,
       CASE WHEN p IS NULL THEN text
            ELSE array_to_string([l[j] FOR j IN range(1, len(l) + 1) IF NOT list_contains(p, j - 1)], chr(10)) END AS text
FROM d LEFT JOIN lists USING (doc_id)""",
    "op4_exact_dedup": r"""
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM n""",
}
