"""DuckDB SQL of the operators over trees: Merkle manifest, conversation trie."""

from __future__ import annotations

#: CRC-32 by its rule: the 256 remainders, then a fold over the bytes of an ASCII text.
CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS crc
  FROM (SELECT unnest(range(256)) AS i))"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII expression, beside a row of ``crc_table``."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)), "
            "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)")


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join([*(_field(c) for c in ("doc_id", "source", "lang", "n_chars")), _field(text)]) + ")"


def _tree(name: str, start: str) -> str:
    return f"""
{name}(level, tree, pos, n, digest) AS (
  {start}
  UNION ALL
  SELECT level + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY level, tree, pos // 3, n)"""


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf('text')} AS leaf,
         CASE WHEN coalesce({crc32("doc_id::VARCHAR")} % 2 = 0, false)
              THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS altered
  FROM documents, crc_table),
l AS MATERIALIZED (
  SELECT *, row_number() OVER () AS rid,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM d),
{_tree("node", "SELECT 0, tree, pos, n, leaf FROM l")},
sub AS MATERIALIZED (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
{_tree("top", "SELECT 0, '', pos, n, subroot FROM sub")},
up AS (
  SELECT rid, level, string_agg(digest, '' ORDER BY k.pos) FILTER (k.pos < own) AS a,
         string_agg(digest, '' ORDER BY k.pos) FILTER (k.pos > own) AS b
  FROM (SELECT rid, tree, level, l.pos // (3 ** level)::BIGINT AS own FROM l, (SELECT DISTINCT level FROM node WHERE n > 1)) o
  JOIN node k USING (tree, level) WHERE k.n > 1 AND k.pos // 3 = own // 3 GROUP BY rid, level
  UNION ALL
  SELECT rid, 1000 + level, string_agg(digest, '' ORDER BY k.pos) FILTER (k.pos < own),
         string_agg(digest, '' ORDER BY k.pos) FILTER (k.pos > own)
  FROM (SELECT rid, level, sub.pos // (3 ** level)::BIGINT AS own FROM l JOIN sub USING (tree), (SELECT DISTINCT level FROM top WHERE n > 1)) o
  JOIN top k USING (level) WHERE k.n > 1 AND k.pos // 3 = own // 3 GROUP BY rid, level),
path AS MATERIALIZED (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY level) AS step, coalesce(a, '') AS a, coalesce(b, '') AS b FROM up),
folded(rid, step, digest) AS (
  SELECT rid, 0, altered FROM l
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(p.a || f.digest || p.b) FROM folded f JOIN path p ON p.rid = f.rid AND p.step = f.step + 1),
whole AS (SELECT rid, arg_max(digest, step) AS folded_root FROM folded GROUP BY rid),
proof AS (SELECT rid, sha256(string_agg(a || b, '' ORDER BY step)) AS proof_sha256 FROM path GROUP BY rid)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN sub USING (tree) JOIN whole USING (rid) LEFT JOIN proof USING (rid), (SELECT digest AS root FROM top WHERE n = 1)
"""


TRIE = f"""
WITH {CRC_TABLE},
t AS (
  SELECT conv_id AS c, strlen(text) AS size, key, count(*) OVER (PARTITION BY conv_id) AS len,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(text, '') AS text,
               md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key
        FROM conversations WHERE conv_id IS NOT NULL)),
k AS (SELECT c, len, c - c % 5 AS base, {crc32("c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c, len FROM t), crc_table),
m AS (SELECT k.c, k.base, k.h, least(k.h, coalesce(b.len, 0)) AS take, greatest(k.len - k.h, 0) AS own FROM k LEFT JOIN k b ON b.c = k.base),
r AS (
  SELECT m.c, t.pos + 1 AS d, key, size FROM m JOIN t ON t.c = m.base AND t.pos < m.h
  UNION ALL
  SELECT m.c, take + t.pos - m.h + 1, key, size FROM m JOIN t ON t.c = m.c AND t.pos >= m.h),
p AS MATERIALIZED (
  SELECT c, 0 AS d, '' AS node, 0 AS size FROM m
  UNION ALL
  SELECT c, d, string_agg(key, ',') OVER (PARTITION BY c ORDER BY d), size FROM r),
n AS MATERIALIZED (
  SELECT node, d, min(p.c) AS conv, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (take + own = d), '')) AS ends
  FROM p JOIN m ON m.c = p.c GROUP BY node, d),
u AS MATERIALIZED (
  SELECT n.*, p.node AS parent, (SELECT conv FROM n x WHERE x.node = p.node) AS parent_conv
  FROM n LEFT JOIN p ON p.c = n.conv AND p.d = n.d - 1),
f AS MATERIALIZED (SELECT u.*, coalesce(kids, 0) AS kids FROM u LEFT JOIN (SELECT parent AS node, count(*) AS kids FROM u GROUP BY parent) USING (node)),
s AS (
  SELECT p.node, count(*) FILTER (f.kids = 0) AS leaves, sum((f.n - 1) * f.size) AS saved
  FROM f JOIN p ON p.c = f.conv AND p.d <= f.d GROUP BY p.node)
SELECT conv AS conv_id, d::BIGINT AS depth, parent_conv AS parent_conv_id, n AS n_convs, kids AS n_children, leaves AS n_leaves,
       saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM f JOIN s USING (node)
"""
