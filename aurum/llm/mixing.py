"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain -> language -> source; a leaf is one (domain, lang, source)
with the documents in it.  Every node has a weight among its siblings (1 unless
given).  A token budget enters at the root:

* A node can absorb at most its leaves' tokens times ``max_epochs``.
* A node's budget is split among its children by weight.  A child that cannot
  absorb its share is filled, and what it leaves is shared again by weight among
  its *siblings*; only when the whole node is full does the shortage reach the
  node's own siblings, because a node never gets more than its subtree absorbs.
  Sorting siblings by capacity / weight gives the fixed point in one pass over
  running sums (water filling), in whole numbers.
* A leaf that owes ``b`` of its ``t`` tokens gives every document ``b div t``
  times and, of the next epoch's seeded permutation, the longest prefix whose
  tokens fit in ``b mod t``.  Each epoch has a permutation of its own
  (md5 of seed, epoch and document), so the choice does not depend on
  partitioning, and a larger budget keeps what a smaller one chose in the epoch.

A leaf may hold a third of all rows, so prefixes are not found by sorting a leaf
in one task: the hash range is cut into ``BUCKETS`` buckets, bucket totals are
summed with partial aggregation, whole buckets before the cut are taken and only
the documents of the one bucket that holds the cut are ranked.

Tokens are runs of characters outside ``[\\x20\\x09-\\x0D]`` of the whole text.
Null texts have no tokens; null domain, lang or source are a node of their own.
A leaf without any tokens has nothing to give and its documents are not chosen.
Rows that repeat a document (same doc_id and text) are ranked one after the
other.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.session_tables import broadcast_if_small, packed, unpacked, written

LEVELS = ["domain", "lang", "source"]
BUCKETS = 4096
SEED = 20240501
_DEC = "decimal(38,0)"


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def domain_of(source: Column) -> Column:
    """The registered queries' domains: four groups of sources by the number in
    their name (``src7`` -> d3); a name without a number is ``other``."""
    digits = F.regexp_extract(source, r"([0-9]+)$", 1)
    return (F.when(source.isNull(), F.lit(None).cast("string")).when(digits == "", F.lit("other"))
             .otherwise(F.concat(F.lit("d"), F.pmod(F.substring(digits, -9, 9).cast("bigint"), F.lit(4)).cast("string"))))


#: Target weights of the registered queries, by node name; every other node has 1.
WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 1, "src1": 2, "src2": 2},
}
MAX_EPOCHS = 2


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in sorted(weights.get(level, {}).items()):
        out = F.when(F.col(level).eqNullSafe(F.lit(name)), F.lit(int(w))).otherwise(out)
    return out.cast("bigint")


def measured(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """One narrow row per document: row, doc_id, the leaf, tokens, and the text's key."""
    domain = domain_of(F.col("source")) if domain is None else domain
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", domain.alias("domain"), "lang", "source",
        token_count(F.col("text")).alias("tokens"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"))


def leaf_budgets(rows: DataFrame, percent: int, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(domain, lang, source, leaf_tokens, budget), one row per leaf.

    ``percent``: the tokens to give out, in hundredths of the tokens there are."""
    leaf = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("leaf_tokens"))
    leaf = written(leaf.withColumn("cap", F.col("leaf_tokens") * F.lit(max_epochs)), "mix-leaves")
    tokens = leaf.agg(F.coalesce(F.sum("leaf_tokens"), F.lit(0))).first()[0]     # one number
    have = int(tokens) * percent // 100
    nodes = leaf.groupBy(LEVELS[0]).agg(F.sum("cap").alias("cap")).withColumn("give", F.lit(have).cast("bigint"))
    nodes = _split(nodes, [], weights)
    for d in range(1, len(LEVELS)):
        up = [F.col(c).alias(f"_{c}") for c in LEVELS[:d]] + [F.col("budget").alias("give")]
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS[:d]]
        kids = leaf.groupBy(*LEVELS[:d + 1]).agg(F.sum("cap").alias("cap"))
        nodes = _split(kids.join(nodes.select(*up), on).drop(*[f"_{c}" for c in LEVELS[:d]]), LEVELS[:d], weights)
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS]
    got = nodes.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "budget")
    return leaf.join(got, on).select(*LEVELS, "leaf_tokens", "budget")


def _split(kids: DataFrame, parent: list[str], weights) -> DataFrame:
    """Gives each child of a parent its part of ``give``: full children keep their
    capacity, the others share the rest by weight (rounded down)."""
    name = LEVELS[len(parent)]
    kids = kids.withColumn("w", _weight(name, weights))
    order = Window.partitionBy(*parent).orderBy((F.col("cap").cast("double") / F.col("w").cast("double")),
                                                F.col(name).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(*parent)
    kids = kids.withColumns({"s": F.coalesce(F.sum("cap").over(before), F.lit(0)),
                             "wr": F.sum("w").over(onward)})
    left = F.greatest(F.col("give") - F.col("s"), F.lit(0))
    full = F.col("cap").cast(_DEC) * F.col("wr").cast("decimal(19,0)") <= left.cast(_DEC) * F.col("w").cast("decimal(19,0)")
    kids = kids.withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0))
    open_w = F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(every), F.lit(0))
    kids = kids.withColumns({"taken": taken, "open_w": open_w})
    share = F.expr("(greatest(give - taken, 0) * w) div nullif(open_w, 0)")
    return kids.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share)).select(
        *parent, name, "cap", "budget")


def _leaf_join(rows: DataFrame, leaves: DataFrame, cols: list[str]) -> DataFrame:
    renamed = leaves.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], *cols)
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS]
    return rows.join(broadcast_if_small(renamed, 100_000), on).drop(*[f"_{c}" for c in LEVELS])


def choose(rows: DataFrame, budgets: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``copies``: how often each row is taken (0 rows are left out).

    ``rows`` and ``budgets`` are written tables."""
    some = budgets.filter(F.col("leaf_tokens") > 0).select(
        *LEVELS, (F.expr("budget div leaf_tokens")).alias("whole"), (F.expr("budget % leaf_tokens")).alias("part"))
    at = _leaf_join(rows, written(some, "mix-shares"), ["whole", "part"])
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("whole").cast("string"),
                          F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_md5")))
    at = at.withColumns({"h": h, "bucket": F.conv(F.substring(h, 1, 3), 16, 10).cast("int")})
    at = written(at.select("row", "doc_id", *LEVELS, "tokens", "whole", "part", "h", "bucket"), "mix-hashed")
    sums = at.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("bt"), F.max("part").alias("part"))
    before = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("bt").over(before), F.lit(0)))
    # the one bucket per leaf that holds the cut: all before it are whole, none after it is taken
    cut = (sums.filter((F.col("start") <= F.col("part")) & (F.col("start") + F.col("bt") > F.col("part")))
               .select(*LEVELS, F.col("bucket").alias("cut"), "start"))
    at = _leaf_join(at, written(cut, "mix-cuts"), ["cut", "start"])
    edge = at.filter(F.col("bucket") == F.col("cut"))
    run = Window.partitionBy(*LEVELS).orderBy("h", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("extra", (F.col("start") + F.sum("tokens").over(run) <= F.col("part")).cast("int"))
    rest = at.filter(F.col("bucket") != F.col("cut")).withColumn("extra", (F.col("bucket") < F.col("cut")).cast("int"))
    both = edge.unionByName(rest)
    return (both.withColumn("copies", (F.col("whole") + F.col("extra")).cast("int"))
                .filter(F.col("copies") > 0)
                .select("row", "doc_id", *LEVELS, "tokens", "copies"))


def mix(docs: DataFrame, percent: int = 100, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED, domain: Column | None = None) -> DataFrame:
    """One row per chosen document and epoch: doc_id, domain, lang, source, tokens, epoch."""
    rows = written(measured(docs, domain), "mix-rows")
    chosen = choose(rows, written(leaf_budgets(rows, percent, weights, max_epochs), "mix-budgets"), seed)
    return chosen.select("doc_id", *LEVELS, "tokens",
                         F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))


def mixed_documents(docs: DataFrame, percent: int = 100, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
                    seed: int = SEED) -> DataFrame:
    """The documents of the mixture with all their columns, once per epoch taken.

    Texts are matched to the choice by (doc_id, text); repeated rows share the
    choice of their group, one row each for as many copies as were chosen."""
    rows = written(measured(docs), "mix-rows")
    chosen = choose(rows, written(leaf_budgets(rows, percent, weights, max_epochs), "mix-budgets"), seed)
    names = ["doc_id", "text_md5", "lang", "source"]
    theirs = [F.col(c).alias(f"its_{c}") for c in names]
    on = [F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in names]
    picked = chosen.select("row", "copies").join(rows.select("row", *names), "row")
    picked = written(picked.groupBy(*names).agg(F.sum("copies").cast("int").alias("copies")).select(*theirs, "copies"), "mix-chosen")
    repeated = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(*theirs)
    repeated = written(repeated, "mix-repeated")
    base = packed(docs, doc_id=F.col("doc_id"), text_md5=F.md5(F.coalesce(F.col("text"), F.lit(""))),
                  lang=F.col("lang"), source=F.col("source"))
    if not repeated.isEmpty():               # one of the repeated rows carries the copies of its group
        twice = broadcast_if_small(repeated)
        base = base.join(twice, on, "left_anti").unionByName(base.join(twice, on, "left_semi").dropDuplicates(names))
    taken = base.join(broadcast_if_small(picked), on)
    return unpacked(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
