import numpy as np
import pytest

from aurum.llm import kdtree_topk as T

SCHEMA = "vec_id bigint, embedding array<float>, row int"


def brute(rows, k=5, every=50):
    able = [(i, v, [int(np.floor(256.0 * float(np.float32(x)))) for x in e]) for i, (v, e, _) in enumerate(rows)
            if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, q, a in able:
        if q is None or q % every:
            continue
        hits = sorted((-sum(x * y for x, y in zip(a, b)), v is None, v or 0, j) for j, v, b in able if j != i)[:k]
        out += [(q, r + 1, None if none else v, -s) for r, (s, none, v, _) in enumerate(hits)]
    return sorted(out, key=str)


def got(spark, rows):
    return sorted(map(tuple, T.topk(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


@pytest.mark.parametrize("shape", ["spread", "copies"])
def test_agrees_with_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(T, "SHARD_ROWS", 60)
    monkeypatch.setattr(T, "LEAF", 8)
    rng = np.random.default_rng(2)
    x = rng.normal(0, 0.3, (500, 6))
    if shape == "copies":
        x[100:300] = x[7]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    assert got(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(0, [1.0, 2.0], 0), (50, [1.0], 0), (50, [1.0], 0), (1, None, 0), (2, [None, 1.0], 0), (3, [float("nan"), 1.0], 0),
            (4, [float("inf")], 0), (None, [1.0, 2.0], 0), (100, [], 0), (8, [0.5, 0.5], 0), (7, [-1.0, 0.004], 0)]
    assert got(spark, rows) == brute(rows)
    assert T.topk(spark.createDataFrame([], SCHEMA)).count() == 0
    assert T.topk(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0


def test_large_components_stay_exact():
    a, b = np.array([[2 ** 40, -3]]), np.array([[2 ** 40, 5]])
    x, y = T.exact(a, b)
    assert int((x @ y.T)[0, 0]) == 2 ** 80 - 15


def test_bounds_hold_and_boxes_are_tight():
    rng = np.random.default_rng(3)
    v = rng.integers(-100, 100, (700, 5))
    tree = T.KdTree(v, np.arange(700), np.arange(700))
    q = rng.integers(-100, 100, (9, 5))
    bound = tree.bounds(q)
    for node, (a, b) in enumerate(tree.span):
        part = tree.v[a:b]
        assert (tree.lo[node] == part.min(axis=0)).all() and (tree.hi[node] == part.max(axis=0)).all()
        assert ((part @ q.T).max(axis=0) <= bound[:, node]).all()


def test_queries_of_a_shard_come_in_bounded_blocks(spark, monkeypatch):
    """Every vector is a query and the boxes exclude nothing: no task gets them all."""
    monkeypatch.setattr(T, "SHARD_ROWS", 60)
    monkeypatch.setattr(T, "QUERY_ROWS", 40, raising=False)
    made = T._search_groups

    def bounded(dim, k):
        run = made(dim, k)

        def one(vectors, queries):
            assert queries.num_rows <= 100, queries.num_rows
            return run(vectors, queries)
        return one
    monkeypatch.setattr(T, "_search_groups", bounded)
    x = np.random.default_rng(5).normal(0, 0.3, (400, 16))
    rows = [(50 * i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    assert got(spark, rows) == brute(rows)


def test_a_search_holds_bounds_of_few_queries(monkeypatch):
    monkeypatch.setattr(T, "BOUND_CELLS", 64, raising=False)
    v = np.random.default_rng(6).integers(-100, 100, (1500, 4))
    tree, seen = T.KdTree(v, np.arange(1500), np.arange(1500)), []
    real = tree.bounds
    monkeypatch.setattr(tree, "bounds", lambda q: seen.append(len(q)) or real(q))
    q = v[:200]
    found = list(tree.search(q, np.arange(200), [None] * 200, 3))
    assert max(seen) * len(tree.span) <= 64 and sum(seen) == 200
    for i, best in enumerate(found):
        assert [(-s, j) for s, j, _ in best] == [(s, j) for s, j in sorted(((int(v[j] @ q[i]), j) for j in range(1500) if j != i), key=lambda t: (-t[0], t[1]))[:3]]
