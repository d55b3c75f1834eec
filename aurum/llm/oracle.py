"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from aurum.llm import mixing as M
from aurum.llm import url_filter as U

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST)
"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(rules, value) -> str:
    ranked = sorted(rules, key=lambda r: (len(r[0]), len(r[1]), r), reverse=True)
    arms = " ".join(
        f"WHEN (host = {_quoted(h)} OR ends_with(host, {_quoted('.' + h)})) AND starts_with(path, {_quoted(p)}) "
        f"THEN {_quoted(value(h, p, v))}" for h, p, v in ranked)
    return f"CASE {arms} END"


def url_filter_sql(rules=U.RULES) -> str:
    """The same tree, one CTE per level."""
    d_max = U.DEPTH
    sql = [f"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (SELECT *, {_case(rules, lambda h, p, v: h + p)} AS rule, {_case(rules, lambda h, p, v: v)} AS rule_verdict FROM u),
s AS (
  SELECT *, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x:
    CASE WHEN regexp_matches(regexp_extract(x, '^(.*?)(\\.[A-Za-z]{{1,5}})?$', 1), '^[0-9]+$') THEN '{{n}}'
         WHEN regexp_matches(regexp_extract(x, '^(.*?)(\\.[A-Za-z]{{1,5}})?$', 1),
              '^[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}$') THEN '{{uuid}}'
         WHEN regexp_matches(regexp_extract(x, '^(.*?)(\\.[A-Za-z]{{1,5}})?$', 1), '^[0-9a-f]{{8,}}$') THEN '{{hex}}'
         ELSE regexp_extract(x, '^(.*?)(\\.[A-Za-z]{{1,5}})?$', 1) END
    || regexp_extract(x, '^(.*?)(\\.[A-Za-z]{{1,5}})?$', 2)) AS segs FROM r),
l AS (SELECT page_id, host, path, rule, rule_verdict,
        CASE WHEN len(segs) > {d_max} THEN list_append(segs[1:{d_max}], array_to_string(segs[{d_max} + 1:], '/')) ELSE segs END AS leaf FROM s),
t0 AS (SELECT host, leaf, leaf AS template, count(*) AS n, count(rule_verdict) AS labelled,
        count(*) FILTER (rule_verdict = 'block') AS n_bad FROM l GROUP BY host, leaf)"""]
    for d in range(1, d_max + 2):
        sql.append(f"""
a{d} AS (SELECT *, template[1:{d - 1}] AS up, template[{d}] AS seg, template[{d + 1}:] AS rest FROM t{d - 1}),
c{d} AS (SELECT host, up, seg, sum(n) AS cn, sum(labelled) AS cl, sum(n_bad) AS cb,
          list_sort(list_distinct(list(array_to_string(rest, '/')))) AS shape
         FROM a{d} WHERE seg IS NOT NULL GROUP BY host, up, seg),
k{d} AS (SELECT *, count(*) OVER (PARTITION BY host, up) AS kids, sum(cn) OVER (PARTITION BY host, up) AS pn,
          sum(cl) OVER p AS pl, sum(cb) OVER p AS pb, count(*) FILTER (cl > 0) OVER p AS peers
         FROM c{d} WINDOW p AS (PARTITION BY host, up, shape)),
e{d} AS (SELECT *, peers > 1 AND cl > 0
          AND (cb * pl - cl * pb)::HUGEINT * (cb * pl - cl * pb)::HUGEINT * 100
              <= (cl * pb)::HUGEINT * (pl - pb)::HUGEINT * {U.Z2} AS alike FROM k{d}),
n{d} AS (SELECT host, up, seg,
          CASE WHEN kids >= {U.MIN_CHILDREN} AND 2 * kids > pn THEN '*'
               WHEN alike THEN '{{' || min(seg) FILTER (alike) OVER (PARTITION BY host, up, shape) || '~}}'
               ELSE seg END AS renamed FROM e{d}),
t{d} AS (SELECT a.host, a.leaf, CASE WHEN x.renamed IS NULL THEN a.template
           ELSE list_concat(list_append(a.up, x.renamed), a.rest) END AS template, a.n, a.labelled, a.n_bad
         FROM a{d} a LEFT JOIN n{d} x ON a.host = x.host AND a.up = x.up AND a.seg = x.seg)""")
    last = f"t{d_max + 1}"
    sql.append(f"""
pure AS (SELECT host, template, sum(labelled)::BIGINT AS l, sum(n_bad)::BIGINT AS b FROM {last} GROUP BY host, template),
ways AS (SELECT host, template, l, b, unnest(list_transform(range(len(template) + 1), lambda d: template[1:d])) AS node FROM pure),
sums AS (SELECT host, node, sum(l)::BIGINT AS nl, sum(b)::BIGINT AS nb FROM ways GROUP BY host, node),
down AS (SELECT w.host, w.template, list([s.nl, s.nb] ORDER BY len(w.node)) AS way
         FROM ways w JOIN sums s ON w.host = s.host AND w.node = s.node GROUP BY w.host, w.template),
v AS (SELECT host, template, CASE WHEN list_reduce(list_prepend([{U.ONE // 2}, 0]::BIGINT[], way),
               lambda s, a: [({U.ONE} * a[2] + {U.PULL} * s[1]) // (a[1] + {U.PULL}), 0])[1] >= {U.BLOCK}
               THEN 'block' ELSE 'allow' END AS tree_verdict FROM down)""")
    return ",".join(sql) + f"""
SELECT l.page_id, l.host, l.path, l.rule, coalesce(l.rule_verdict, v.tree_verdict) AS verdict
FROM l JOIN {last} t ON l.host = t.host AND l.leaf = t.leaf JOIN v ON t.host = v.host AND t.template = v.template
"""


def _weight(level: str, weights) -> str:
    arms = " ".join(f"WHEN {_quoted(k)} THEN {int(v)}" for k, v in sorted(weights.get(level, {}).items()))
    return f"(CASE {level} {arms} ELSE 1 END)::BIGINT" if arms else "1::BIGINT"


def mixing_sql(source: str = "documents", percent: int = 100, weights=M.WEIGHTS, max_epochs: int = M.MAX_EPOCHS,
               seed: int = M.SEED) -> str:
    sql = [f"""
WITH d AS (
  SELECT doc_id, lang, source,
         CASE WHEN source IS NULL THEN NULL
              WHEN regexp_extract(source, '([0-9]+)$', 1) = '' THEN 'other'
              ELSE 'd' || (right(regexp_extract(source, '([0-9]+)$', 1), 9)::BIGINT % 4)::VARCHAR END AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens,
         md5(coalesce(text, '')) AS text_md5
  FROM {source}),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS leaf_tokens, sum(tokens)::BIGINT * {max_epochs} AS cap
         FROM d GROUP BY domain, lang, source),
b0 AS (SELECT (coalesce(sum(leaf_tokens), 0)::BIGINT * {percent}) // 100 AS budget FROM leaf)"""]
    for i, level in enumerate(M.LEVELS):
        up = M.LEVELS[:i]
        cols = ", ".join(M.LEVELS[:i + 1])
        part = f"PARTITION BY {', '.join(up)}" if up else ""
        match = " AND ".join(f"k.{c} IS NOT DISTINCT FROM p.{c}" for c in up) or "true"
        sql.append(f"""
k{i} AS (SELECT {cols}, sum(cap)::BIGINT AS cap, {_weight(level, weights)} AS w FROM leaf GROUP BY {cols}),
g{i} AS (SELECT k.*, p.budget AS give FROM k{i} k JOIN b{i} p ON {match}),
s{i} AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s,
          sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr
         FROM g{i} WINDOW o AS ({part} ORDER BY cap::DOUBLE / w::DOUBLE, {level} ASC NULLS FIRST)),
f{i} AS (SELECT *, cap::HUGEINT * wr <= greatest(give - s, 0)::HUGEINT * w AS is_full FROM s{i}),
h{i} AS (SELECT *, coalesce(sum(cap) FILTER (is_full) OVER ({part}), 0)::BIGINT AS taken,
          coalesce(sum(w) FILTER (NOT is_full) OVER ({part}), 0)::BIGINT AS open_w FROM f{i}),
b{i + 1} AS (SELECT {cols}, CASE WHEN is_full THEN cap
          ELSE (greatest(give - taken, 0) * w) // nullif(open_w, 0) END AS budget FROM h{i})""")
    n = len(M.LEVELS)
    sql.append(f"""
share AS (SELECT l.domain, l.lang, l.source, b.budget // leaf_tokens AS whole, b.budget % leaf_tokens AS part
          FROM leaf l JOIN b{n} b ON l.domain IS NOT DISTINCT FROM b.domain AND l.lang IS NOT DISTINCT FROM b.lang
           AND l.source IS NOT DISTINCT FROM b.source WHERE leaf_tokens > 0),
x AS (SELECT d.*, whole, part,
        md5('{seed}|' || whole::VARCHAR || '|' || coalesce(doc_id::VARCHAR, '') || '|' || text_md5) AS h
      FROM d JOIN share ON d.domain IS NOT DISTINCT FROM share.domain AND d.lang IS NOT DISTINCT FROM share.lang
       AND d.source IS NOT DISTINCT FROM share.source),
y AS (SELECT *, whole + (sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= part)::BIGINT AS copies FROM x)""")
    return ",".join(sql) + """
SELECT doc_id, domain, lang, source, tokens, unnest(range(copies))::INTEGER AS epoch FROM y WHERE copies > 0
"""


TOPK = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

WARC = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
o AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> original THEN original END AS refers_to
FROM o
"""
