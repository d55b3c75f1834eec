"""Gradient boosting of histogram trees whose sums are whole numbers, hence repeatable.

Features are cut into quantile bins once.  A level of a tree is one aggregation: rows are summed
by (node, feature, bin) -- partially in every task, so what is shuffled has nodes x features x
bins rows whatever the data -- and the best split of every node follows from running
totals over the bins.  Targets and residuals are whole millionths: sums are exact, and a fit
gives the same trees on any partitioning, after any retry and on any engine.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.session import materialize

UNIT = 1_000_000
BINS = 32
MIN_ROWS = 20


@dataclass(frozen=True)
class Split:
    """Rows of ``node`` go left (2 * node) up to ``bin`` of ``feature``, else right (2 * node + 1)."""
    node: int
    feature: int
    bin: int


@dataclass
class Tree:
    splits: list[Split] = field(default_factory=list)
    values: dict[int, int] = field(default_factory=dict)     # leaf -> millionths


@dataclass
class Model:
    features: list[str]
    edges: dict[str, list[float]]
    start: int
    trees: list[Tree]

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        binned = df.select("*", *[bin_of(F.col(c), self.edges[c]).alias(_bin(j)) for j, c in enumerate(self.features)])
        total = F.lit(self.start)
        for t in self.trees:
            total = total + leaf_value(t)
        return binned.withColumn(name, total / F.lit(float(UNIT))).drop(*[_bin(j) for j in range(len(self.features))])


def _bin(j: int) -> str:
    return f"_b{j}"


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Upper edges of at most ``bins`` bins per feature, of about equal rows, at values that occur.

    Exact: rows are first counted by value, then the running share of each feature's values is
    cut.  The edges (bins x features numbers) come to the driver."""
    pairs = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(c).cast("double").alias("v")) for j, c in enumerate(features)]))
    counts = df.select(pairs.alias("p")).filter("p.v IS NOT NULL").groupBy("p.j", "p.v").agg(F.count(F.lit(1)).alias("n"))
    way = Window.partitionBy("j").orderBy("v")
    at = counts.select("j", "v", F.sum("n").over(way).alias("upto"), F.sum("n").over(Window.partitionBy("j")).alias("all"))
    slot = F.floor(((F.col("upto") - 1) * bins) / F.col("all"))
    tops = at.groupBy("j", slot.alias("slot")).agg(F.max("v").alias("v"))
    out: dict[str, list[float]] = {c: [] for c in features}
    for r in tops.orderBy("j", "v").collect():
        out[features[r.j]].append(r.v)
    return {c: e[:-1] for c, e in out.items()}               # the last bin has no edge


def bin_of(value: Column, edges: list[float]) -> Column:
    """0 for NULL, else 1 + the edges below the value."""
    v = value.cast("double")
    below = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < v)) if edges else F.lit(0)
    return F.when(v.isNull(), 0).otherwise(below + 1).cast("tinyint")


def _walk(splits: list[Split], leaf) -> Column:
    """``leaf(node)`` of the node that a row comes to: nested conditions, one per split."""
    at = {s.node: s for s in splits}

    def down(n: int) -> Column:
        if n not in at:
            return F.lit(leaf(n))
        return F.when(F.col(_bin(at[n].feature)) <= at[n].bin, down(2 * n)).otherwise(down(2 * n + 1))
    return down(1)


def node_of(splits: list[Split]) -> Column:
    """The node that a row has come to; the root is 1."""
    return _walk(splits, lambda n: n)


def leaf_value(tree: Tree) -> Column:
    return _walk(tree.splits, lambda n: tree.values.get(n, 0)).cast("bigint")


def histograms(rows: DataFrame, n_features: int) -> DataFrame:
    """(node, feature, bin, g, n): residual sum and rows, one aggregation for all nodes of a level."""
    cells = F.explode(F.array(*[F.struct(F.lit(j).alias("feature"), F.col(_bin(j)).alias("bin")) for j in range(n_features)]))
    return rows.select("node", "resid", cells.alias("c")).groupBy("node", F.col("c.feature").alias("feature"), F.col("c.bin").alias("bin")).agg(
        F.sum("resid").alias("g"), F.count(F.lit(1)).alias("n"))


def best_splits(hist: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """(node, feature, bin, g, n, score): the best split of every node, the first of equal ones."""
    way, whole = Window.partitionBy("node", "feature").orderBy("bin"), Window.partitionBy("node", "feature")
    at = hist.select("node", "feature", "bin", F.sum("g").over(way).alias("gl"), F.sum("n").over(way).alias("nl"),
                     F.sum("g").over(whole).alias("g"), F.sum("n").over(whole).alias("n"))
    at = at.filter((F.col("nl") >= min_rows) & (F.col("n") - F.col("nl") >= min_rows))
    d = lambda c: F.col(c).cast("double")
    gr, nr = (F.col("g") - F.col("gl")).cast("double"), (F.col("n") - F.col("nl")).cast("double")
    score = d("gl") * d("gl") / d("nl") + gr * gr / nr
    ranked = at.withColumn("score", score).filter(score > d("g") * d("g") / d("n"))
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "feature", "bin"))
    return ranked.withColumn("rank", first).filter("rank = 1").select("node", "feature", "bin", "g", "n", "score")


def _prepared(df: DataFrame, features: list[str], target: str, edges: dict[str, list[float]]) -> DataFrame:
    y = F.floor(F.col(target) * F.lit(float(UNIT)) + F.lit(0.5)).cast("bigint")
    return df.filter(F.col(target).isNotNull()).select(y.alias("y"), *[bin_of(F.col(c), edges[c]).alias(_bin(j)) for j, c in enumerate(features)])


def start_value(prepared: DataFrame) -> int:
    """The mean target in whole millionths."""
    s = prepared.agg(F.sum("y").alias("s"), F.count(F.lit(1)).alias("n")).first()
    return int(s.s // s.n) if s.n else 0


def grow(rows: DataFrame, n_features: int, depth: int, rate: float, min_rows: int = MIN_ROWS) -> Tree:
    """One tree on (resid, bins) rows: one job a level, then one for the leaves."""
    tree = Tree()
    for _ in range(depth):
        at = rows.withColumn("node", node_of(tree.splits))
        done = {s.node for s in tree.splits}
        new = [Split(r.node, r.feature, r.bin) for r in best_splits(histograms(at, n_features), min_rows).collect() if r.node not in done]
        if not new:
            break
        tree.splits += new
    leaves = rows.groupBy(node_of(tree.splits).alias("node")).agg(F.sum("resid").alias("g"), F.count(F.lit(1)).alias("n"))
    value = F.floor(F.lit(rate) * F.col("g").cast("double") / F.col("n").cast("double")).cast("bigint")
    tree.values = {r.node: r.v for r in leaves.select("node", value.alias("v")).collect()}       # at most 2 ** depth
    return tree


def fit(df: DataFrame, features: list[str], target: str, rounds: int = 20, depth: int = 3, rate: float = 0.3,
        bins: int = BINS, min_rows: int = MIN_ROWS) -> Model:
    """Boosts ``rounds`` trees; every round's residuals are written, so no plan grows and a lost
    executor costs one round's tasks."""
    edges = bin_edges(df, features, bins)
    prepared = materialize(_prepared(df, features, target, edges))
    model = Model(list(features), edges, start_value(prepared), [])
    rows = prepared.withColumn("resid", F.col("y") - F.lit(model.start))
    for r in range(rounds):
        tree = grow(rows, len(features), depth, rate, min_rows)
        model.trees.append(tree)
        if r < rounds - 1:
            rows = materialize(rows.withColumn("resid", F.col("resid") - leaf_value(tree)))
    return model


def first_tree(df: DataFrame, features: list[str], target: str, depth: int = 2, bins: int = BINS) -> DataFrame:
    """The splits of the first tree: (node, feature, split_bin, n_rows, resid_sum)."""
    edges = bin_edges(df, features, bins)
    prepared = materialize(_prepared(df, features, target, edges))
    rows = prepared.withColumn("resid", F.col("y") - F.lit(start_value(prepared)))
    splits, parts = [], []
    for _ in range(depth):
        best = materialize(best_splits(histograms(rows.withColumn("node", node_of(splits)), len(features))))
        parts.append(best)
        splits += [Split(r.node, r.feature, r.bin) for r in best.collect()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    name = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("feature") + 1)
    return out.select("node", name.alias("feature"), F.col("bin").cast("int").alias("split_bin"), F.col("n").alias("n_rows"), F.col("g").alias("resid_sum"))
