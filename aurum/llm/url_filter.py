"""URL verdicts: longest fitting rule, else a tree of path templates per host.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.  A null url or one
without ``://`` has empty host and path (and is judged like any other).

A rule (host, path) fits its host and all subdomains when the url's path starts
with the rule's; the longest rule wins (longest host, then longest path).

Urls without a rule are judged by the template tree, built in DataFrame steps:

1. *Leaves.*  Every path is cut into segments.  A segment that varies by
   construction (digits, hex ids, uuids, with or without an extension) becomes a
   wildcard of its shape.  Urls are summed up to (host, template, urls, labelled,
   bad): partial aggregation first, so a hot host shrinks before the shuffle.
2. *Generalising.*  From the root down, a node whose children are mostly
   different from each other (at least ``MIN_CHILDREN`` children, more than half
   as many as urls) has variable children: they become one ``*``.
3. *Merging.*  Labelled siblings with the same subtree shape are compared with
   their pooled bad share (a two-sided z test at ``Z2``); those that do not differ
   are merged into one branch.  Siblings without labels are left alone: there is
   nothing to compare them by.
4. *Purity.*  A node's bad share is smoothed towards its parent's:
   (bad + ``PULL`` * parent's share) / (labelled + ``PULL``), the host's towards 1/2.  A
   template is rejected when its share is at least ``BLOCK``.  Evidence so reaches branches
   without labels -- on a host whose labelled pages are all bad, an unknown branch is
   rejected -- and labels of a branch outweigh what lies above it.

Labels come from the caller: a boolean ``bad`` per url, null where unknown.  The
registered query uses the urls that a rule has settled.  All arithmetic is on
integers (shares are millionths), so the result does not depend on the order of rows.  What
lies beyond ``DEPTH`` segments of a path is one more segment, so levels are bounded and
paths that differ anywhere are different templates until they are generalised.

Null and empty urls have an empty host and path and are judged by the host's share; very
long paths are one row's array.  Repeated rows count as often as they come; rows may
repeat a page_id or have none.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.session_tables import broadcast_if_small, written

#: (host, path, verdict), fixed values of the contract.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEPTH = 6
MIN_CHILDREN = 8
#: Squared z value of a two-sided test at 5 %, in hundredths.
Z2 = 384
#: Shares are whole millionths; a template with at least ``BLOCK`` of them is rejected.
ONE, BLOCK = 1_000_000, 800_000
#: Labels that the parent's share counts for.
PULL = 2


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.regexp_extract(url, r"(?s)://(.*)$", 1), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_name(host: str, path: str) -> str:
    return host + path


def fits(rule: tuple[str, str, str]) -> Column:
    host, path, _ = rule
    h = F.col("host")
    return ((h == host) | h.endswith("." + host)) & F.col("path").startswith(path)


def by_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` (null where no rule fits).  The rules are
    a short list held in the program; ordered longest first, the first that fits wins."""
    ranked = sorted(rules, key=lambda r: (len(r[0]), len(r[1]), r), reverse=True)
    none = F.lit(None).cast("string")
    name = reduce(lambda acc, r: F.when(fits(r), F.lit(rule_name(r[0], r[1]))).otherwise(acc), reversed(ranked), none)
    verdict = reduce(lambda acc, r: F.when(fits(r), F.lit(r[2])).otherwise(acc), reversed(ranked), none)
    return urls.withColumns({"rule": name, "rule_verdict": verdict})


def segments(path: Column) -> Column:
    """The path's segments with variable ones turned into shape wildcards; what lies beyond
    ``DEPTH`` is one segment."""
    def shape(s: Column) -> Column:
        stem = F.regexp_extract(s, r"^(.*?)(\.[A-Za-z]{1,5})?$", 1)
        ext = F.regexp_extract(s, r"^.*?(\.[A-Za-z]{1,5})?$", 1)
        kind = (F.when(stem.rlike(r"^[0-9]+$"), F.lit("{n}"))
                 .when(stem.rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), F.lit("{uuid}"))
                 .when(stem.rlike(r"^[0-9a-f]{8,}$"), F.lit("{hex}"))
                 .otherwise(stem))
        return F.concat(kind, ext)
    parts = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), shape)
    tail = F.array_join(F.slice(parts, DEPTH + 1, 1 << 30), "/")
    return F.when(F.size(parts) > DEPTH, F.concat(F.slice(parts, 1, DEPTH), F.array(tail))).otherwise(parts)


def leaves(urls: DataFrame) -> DataFrame:
    """(host, leaf, n, labelled, bad): one row per host and lexical template."""
    one, bad = F.lit(1), F.col("bad")
    return (urls.groupBy("host", "leaf")
                .agg(F.count(one).alias("n"), F.count(bad).alias("labelled"),
                     F.count(F.when(bad, one)).alias("n_bad")))


def _level(nodes: DataFrame, d: int) -> DataFrame:
    """Rewrites segment ``d`` of the templates: generalised, then merged."""
    seg, rest = F.get("template", F.lit(d - 1)), F.slice("template", d + 1, DEPTH + 2)
    up = F.slice("template", 1, d - 1)
    at = nodes.withColumns({"_up": up, "_seg": seg, "_rest": rest})

    # variable children of one parent
    # a subtree's shape is the set of its templates' rests, as their number and two sums of hashes
    below = at.filter(F.col("_seg").isNotNull()).groupBy("host", "_up", "_seg", F.concat_ws("/", "_rest").alias("_below")).agg(
        F.sum("n").alias("cn"), F.sum("labelled").alias("cl"), F.sum("n_bad").alias("cb"))
    hashes = [F.sum(F.xxhash64(F.lit(k), "_below").cast("decimal(38,0)")) for k in (1, 2)]
    child = below.groupBy("host", "_up", "_seg").agg(
        F.sum("cn").alias("cn"), F.sum("cl").alias("cl"), F.sum("cb").alias("cb"),
        F.struct(F.count(F.lit(1)), *hashes).alias("shape"))
    kids = child.groupBy("host", "_up").agg(F.count(F.lit(1)).alias("kids"), F.sum("cn").alias("pn"))
    child = child.join(kids, ["host", "_up"])
    variable = (F.col("kids") >= MIN_CHILDREN) & (2 * F.col("kids") > F.col("pn"))

    # labelled siblings of the same shape whose bad share fits their pooled share
    pool = Window.partitionBy("host", "_up", "shape")
    child = child.withColumns({"pl": F.sum("cl").over(pool), "pb": F.sum("cb").over(pool),
                               "peers": F.count(F.when(F.col("cl") > 0, 1)).over(pool)})
    # (cb - cl * pb/pl)^2 <= z2 * cl * pb/pl * (1 - pb/pl), times pl^2, in whole numbers
    num = (F.col("cb") * F.col("pl") - F.col("cl") * F.col("pb")).cast("decimal(38,0)")
    spread = (F.col("cl") * F.col("pb")).cast("decimal(38,0)") * (F.col("pl") - F.col("pb")).cast("decimal(19,0)")
    alike = (F.col("peers") > 1) & (F.col("cl") > 0) & (num * num * F.lit(100) <= spread * F.lit(Z2))
    name = (F.when(variable, F.lit("*"))
             .when(alike, F.concat(F.lit("{"), F.min(F.when(alike, F.col("_seg"))).over(
                 Window.partitionBy("host", "_up", "shape")), F.lit("~}")))
             .otherwise(F.col("_seg")))
    renamed = child.select(F.col("host").alias("_h"), F.col("_up").alias("_u"), F.col("_seg").alias("_s"), name.alias("_to"))
    on = (F.col("host") == F.col("_h")) & (F.col("_up") == F.col("_u")) & (F.col("_seg") == F.col("_s"))
    joined = at.join(renamed, on, "left")
    out = F.when(F.col("_to").isNull(), F.col("template")).otherwise(
        F.concat("_up", F.array("_to"), "_rest"))
    return joined.select("host", "leaf", out.alias("template"), "n", "labelled", "n_bad")


def template_tree(urls: DataFrame) -> DataFrame:
    """(host, leaf, template, verdict) of every lexical template.

    ``urls`` has host, leaf (array of segments) and bad (boolean or null).  The
    work after the first aggregation is on templates, not urls."""
    nodes = written(leaves(urls).withColumn("template", F.col("leaf")), "url-leaves")
    deepest = nodes.agg(F.max(F.size("template"))).first()[0] or 0      # one number, at most DEPTH + 1
    for d in range(1, deepest + 1):
        nodes = written(_level(nodes, d), f"url-level{d}")
    judged = purity(nodes)
    return nodes.select("host", "leaf", "template").join(judged, ["host", "template"])


def purity(nodes: DataFrame) -> DataFrame:
    """(host, template, tree_verdict, share): every template by its smoothed bad share."""
    leaf = written(nodes.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("n_bad").alias("b")), "url-pure")
    prefix = F.explode(F.transform(F.sequence(F.lit(0), F.size("template")), lambda d: F.slice("template", F.lit(1), d)))
    paths = leaf.select("host", "template", "l", "b", prefix.alias("node"))
    sums = paths.groupBy("host", "node").agg(F.sum("l").alias("nl"), F.sum("b").alias("nb"))
    down = paths.select("host", "template", "node").join(sums, ["host", "node"]).groupBy("host", "template").agg(
        F.sort_array(F.collect_list(F.struct(F.size("node").alias("d"), "nl", "nb"))).alias("way"))      # one per level

    def smoothed(share: Column, at: Column) -> Column:
        return F.floor((ONE * at["nb"] + PULL * share) / (at["nl"] + PULL)).cast("bigint")
    share = F.aggregate("way", F.lit(ONE // 2).cast("bigint"), smoothed)
    rated = down.select("host", "template", share.alias("share"))
    return rated.withColumn("tree_verdict", F.when(F.col("share") >= BLOCK, F.lit("block")).otherwise(F.lit("allow")))


def url_filter(pages: DataFrame, rules=RULES, bad: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template of every row of ``pages``.

    ``bad`` labels rows for the tree (default: what the rules block or allow).
    Rows meet their template by (host, leaf): broadcast when the templates are
    few, else a join that carries urls only."""
    at = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                      *([bad.alias("bad")] if bad is not None else []))
    at = by_rule(at, rules).withColumn("leaf", segments(F.col("path")))
    if bad is None:
        at = at.withColumn("bad", F.when(F.col("rule_verdict").isNotNull(), F.col("rule_verdict") == "block"))
    tree = written(template_tree(at).select("host", "leaf", "tree_verdict",
                                            F.concat(F.lit("/"), F.concat_ws("/", "template")).alias("template")), "url-tree")
    out = at.join(broadcast_if_small(tree, 100_000), ["host", "leaf"], "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("rule_verdict", "tree_verdict").alias("verdict"), "template")
