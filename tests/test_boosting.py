import random

from pyspark.sql import functions as F

from aurum.operators import boosting as B


def rows(n=600, seed=2):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = rnd.randrange(40), rnd.choice([None, 0, 1]), rnd.random()
        out.append((a, b, c, 10.0 * (a > 25) + 4.0 * (b == 1) + 0.01 * rnd.random()))
    return out


SCHEMA = "a int, b int, c double, y double"


def brute_split(data, edges):
    """The best split of the root by trying all."""
    def bin_of(v, e):
        return 0 if v is None else 1 + sum(x < v for x in e)
    y = [int(r[3] * 1e6 + 0.5) for r in data]
    start = sum(y) // len(y)
    best = None
    for j, f in enumerate("abc"):
        bins = [bin_of(r[j], edges[f]) for r in data]
        for cut in sorted(set(bins)):
            left = [v - start for v, b in zip(y, bins) if b <= cut]
            right = [v - start for v, b in zip(y, bins) if b > cut]
            if min(len(left), len(right)) >= B.MIN_ROWS:
                s = float(sum(left)) ** 2 / len(left) + float(sum(right)) ** 2 / len(right)
                if best is None or s > best[0]:
                    best = (s, j, cut)
    return best


def test_first_split_is_the_best_of_all(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    edges = B.bin_edges(df, ["a", "b", "c"])
    assert all(len(e) < B.BINS and e == sorted(set(e)) for e in edges.values()) and edges["b"] == [0.0]
    root = [r for r in B.first_tree(df, ["a", "b", "c"], "y", depth=2).collect() if r.node == 1][0]
    _, j, cut = brute_split(data, edges)
    assert (root.feature, root.split_bin, root.n_rows) == ("abc"[j], cut, len(data))
    assert root.feature == "a" and abs(edges["a"][root.split_bin - 1] - 25) <= 1


def test_fits_do_not_depend_on_partitions_and_learn_the_signal(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    a, b = (B.fit(df.repartition(p), ["a", "b", "c"], "y", rounds=6, depth=2, rate=0.5) for p in (1, 5))
    assert a == b and len(a.trees) == 6
    err = a.predict(df).select(F.avg(F.abs(F.col("y") - F.col("prediction"))).alias("m"),
                               F.avg(F.abs(F.col("y") - F.lit(a.start / B.UNIT))).alias("mean")).first()
    assert err.m < 0.2 * err["mean"]
    assert a.predict(df).columns == [*df.columns, "prediction"]


def test_few_constant_and_null_rows_give_no_split(spark):
    same = spark.createDataFrame([(1, None, 0.5, 2.0)] * 50, SCHEMA)
    m = B.fit(same, ["a", "b", "c"], "y", rounds=2)
    assert m.start == 2_000_000 and all(t.splits == [] for t in m.trees)
    assert [r.prediction for r in m.predict(same.limit(1)).collect()] == [2.0]
    none = B.fit(same.limit(0), ["a", "b", "c"], "y", rounds=1)
    assert none.start == 0 and none.trees[0].splits == []
