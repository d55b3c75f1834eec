import hashlib
import random
import zlib

import pytest

from aurum.llm import merkle as M

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return sha(*[field(v) for v in row[:4]], field(text))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def brute(rows):
    trees = {}
    for r in rows:
        tampered = r[4]
        if r[0] is not None and tampered is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            tampered = tampered.replace("\n", "")
        trees.setdefault(r[1], []).append((r[0], leaf(r, r[4]), leaf(r, tampered)))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        trees[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    made = {s: levels([x[1] for x in trees[s]]) for s in names}
    top = levels([made[s][-1][0] for s in names]) if names else []
    out = []
    for k, s in enumerate(names):
        for i, (d, a, b) in enumerate(trees[s]):
            proof, digest = [], b
            for tree, at in ((made[s], i), (top, k)):
                for level in tree[:-1]:
                    run = level[at // 3 * 3:at // 3 * 3 + 3]
                    proof += run[:at % 3] + run[at % 3 + 1:]
                    digest = sha(*run[:at % 3], digest, *run[at % 3 + 1:])
                    at //= 3
            out.append((d, a, made[s][-1][0], top[-1][0], sha(*proof), digest, digest == top[-1][0]))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in M.audit(df, **kw).collect()), key=str)


def corpus(n, seed, sources):
    rnd = random.Random(seed)
    return [(rnd.choice([i, i, i, 5, None]), rnd.choice(sources), rnd.choice(["de", None]), rnd.choice([None, i]),
             rnd.choice([None, "", "a\nb", f"t{i}\n", "é ü", f"x{i}"])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 90])
def test_frontier_and_fold(n):
    nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    tree = M.Frontier()
    for d in nodes:
        tree.append(d)
    root = tree.close(None)
    assert root.hex() == levels([d.hex() for d in nodes])[-1][0]
    for i, d in enumerate(nodes):
        assert M.fold(d, i, n, b"".join(tree.witness[i])) == root
    if n > 1:
        assert M.fold(nodes[1], 0, n, b"".join(tree.witness[0])) != root or n == 1
    with pytest.raises(ValueError):
        M.fold(nodes[0], 0, n, b"".join(tree.witness[0]) + bytes(32))


@pytest.mark.parametrize("levels", [1, 2])
def test_several_rounds_agree_with_brute_force(spark, levels):
    rows = corpus(190, 3, ["hot", "hot", "hot", "b", "é", "", None])      # blocks of 3 or 9: three to five rounds
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), levels=levels) == brute(rows)


def test_many_sources_lone_leaves_and_repeats(spark):
    rows = [(i, f"s{i:03d}", "en", i, "a\nb") for i in range(40)] + [(1, "s001", "en", 1, "a\nb")] * 30
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    have = got(df)
    assert have == brute(rows)
    assert {r[6] for r in have} == {True, False}


def test_one_row_empty_long_and_clashing_columns(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    row = (4, "a", None, None, None)
    assert got(spark.createDataFrame([row], SCHEMA)) == brute([row])
    assert got(spark.createDataFrame([row], SCHEMA))[0][4] == sha("")
    rows = [(i, None, None, None, "word \n" * 300_000) for i in range(3)] + [(9, "z", "l", 2, "\n")]
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA + ", leaf int, tree string, pos int")
    assert got(df) == brute(rows)


def test_witness_says_where_a_row_stands(spark):
    rows = corpus(60, 5, ["a", "b"])
    m = M.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in m:
        sub = M.fold(bytes(r.leaf), r.pos, r.n, bytes(r.head) + bytes(r.tail))
        assert sub == bytes(r.subroot) and M.fold(sub, r.top_pos, r.top_n, bytes(r.top_proof)) == bytes(r.root)
    assert sorted((r.source, r.pos) for r in m) == sorted((s, i) for s in "ab" for i in range(sum(x[1] == s for x in rows)))
