import random
import re

import numpy as np
import pyarrow as pa
import pytest

from aurum.llm import ngram_join as J
from aurum.llm.ngram_sets import shingle_sets

SCHEMA = "doc_id bigint, text string"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0d]+", low)
    if len(w) >= 5:
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()


def brute(rows):
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.ngram_join(df).collect()), key=str)


def corpus(seed, families=15, passage_docs=12):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(families):
        base = [rnd.choice(words) for _ in range(rnd.randint(3, 50))]
        for _ in range(rnd.randint(1, 7)):
            c = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                c[rnd.randrange(len(c))] = rnd.choice(words)
            docs.append(" ".join(c))
    passage = " ".join(rnd.choice(words) for _ in range(30))
    docs += [passage + " " + " ".join(rnd.choice(words) for _ in range(25)) for _ in range(passage_docs)]
    return docs


def test_sets_agree_with_words_across_slices():
    texts = ["One two\tthree  four FIVE six", "a b", "", None, "  ", "A  B", "é É x y z w", "one two three four five SIX", "x" * 3_000_000 + " b c d e f"]
    sets = list(shingle_sets(pa.array(texts)))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert np.array_equal(sets[0], sets[7]) and np.array_equal(sets[1], sets[5])


def test_components_agree_with_brute_force(spark):
    rows = [(3 * i, t) for i, t in enumerate(corpus(5))]
    rows += [(1, ""), (2, None), (4, "   "), (5, "a b"), (7, "A  b"), (8, "a b c d"), rows[0], (None, rows[1][1]), (None, "zz yy")]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_every_cut_is_exact(spark, monkeypatch):
    """Tiny blocks, batches and hot lists take all side paths; links stay the same."""
    for name, value in (("BLOCK", 2), ("FLUSH", 200), ("HOT_FROM", 2), ("CELLS", 5)):
        monkeypatch.setattr(J, name, value)
    rows = list(enumerate(corpus(9)))
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def links_of(rows):
    sets = [shingles(t) for _, t in rows]
    hit = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    return sorted(((d, sum(bool(hit(sets[i], b)) for j, b in enumerate(sets) if j != i)) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("cells", [2000, 5])
def test_links_agree_with_brute_force(spark, monkeypatch, cells):
    """Within a block, across blocks, over tasks, with copies of both ends."""
    monkeypatch.setattr(J, "CELLS", cells)
    monkeypatch.setattr(J, "BLOCK", 256 if cells > 5 else 2)
    docs = corpus(11)
    rows = list(enumerate(docs)) + [(1000 + i, t) for i, t in enumerate(docs[:40:3])] + [(7, docs[7]), (None, docs[1]), (-1, ""), (-2, None), (-1, "")]
    out = J.ngram_join(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want = links_of(rows)
    assert sorted(((r.doc_id, r.n_links) for r in out), key=str) == want
    assert max(n for _, n in want) > 3


def test_threshold_is_inclusive(spark):
    base = [f"a{i}" for i in range(11)]                       # 7 shingles
    near = base[:-1] + ["other"]                              # 6 shared of 8: exactly 75 %
    far = ["first"] + base[1:-1] + ["last"]                   # 5 of 9
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert {r[0]: r[2] for r in brute(rows)}[2] == 1


def test_one_document_of_each_group_stays(spark):
    rows = [(2 * i, t, i, "k") for i, t in enumerate(corpus(3))] + [(900, None, 0, "k"), (901, "", 1, "k"), (900, None, 0, "k")]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame(rows, SCHEMA + ", key int, text_key string")
    out = J.keep_one_per_group(df)
    assert out.columns == df.columns
    want = brute([r[:2] for r in rows])
    kept = sorted(r.doc_id for r in out.filter("text <> ''").collect())
    assert kept == sorted({c for _, n, c in want if n})
    empty = spark.createDataFrame([], SCHEMA)
    assert J.ngram_join(empty).count() == 0 and J.keep_one_per_group(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "u bigint, v bigint")
    assert sorted(map(tuple, J.components(edges).collect())) == [(i, 0) for i in range(1, 61)] + [(101, 100)]


def n_links(rows):
    sets = [shingles(t) for _, t in rows]
    return sorted((d, sum(100 * len(a & b) >= 75 * len(a | b) for j, b in enumerate(sets) if a and b and i != j))
                  for i, ((d, _), a) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("edits", [(0, 1), (0, 1, 2, 3, 4), (2, 3, 4, 5)])
def test_families_by_distance_are_exact(spark, monkeypatch, edits):
    """Tight families are known by their distances, loose ones are opened; links stay the same."""
    monkeypatch.setattr(J, "BLOCK", 6)
    rnd, rows = random.Random(len(edits)), []
    words = [f"w{i}" for i in range(400)]
    for family in range(3):
        base = [rnd.choice(words) for _ in range(70 + 25 * family)]
        for _ in range(40):
            c = list(base)
            for _ in range(rnd.choice(edits)):
                c[rnd.randrange(len(c))] = rnd.choice(words)
            rows.append((len(rows), " ".join(c)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    made = J.ngram_join(df).collect()
    assert sorted((r.doc_id, r.n_links) for r in made) == n_links(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in made), key=str) == brute(rows)


def test_a_tight_family_needs_no_opening(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 8)
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(200)]
    sets = []
    for k in range(60):
        c = list(base)
        c[0] = f"new{k}"                                      # one shingle of 196 differs: distances of about .01
        sets.append((k, sorted(int(x) for x in next(iter(shingle_sets(pa.array([" ".join(c)])))).view(np.int64)), 1))
    rows = spark.createDataFrame(sets, "cls bigint, toks array<bigint>, copies bigint")
    block, sure, inner = J.families(spark.createDataFrame([(k, 7) for k in range(60)], "cls bigint, g bigint"), rows)
    assert inner.isEmpty()
    assert sorted(r.links for r in sure.collect()) == [59] * 60
    assert block.groupBy("block").count().filter("count > 8").isEmpty()


def test_shared_tokens_take_little_memory():
    import tracemalloc
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 1 << 63, 400, np.uint64) >> np.uint64(6)) for _ in range(1500)]
    sets += [s.copy() for s in sets[::3]] + [np.append(s[:-1], s[-1] + np.uint64(1)) for s in sets[::5]]
    rows = []
    for lo in range(0, len(sets), 500):                      # a class may come from several tasks
        box = J._Outbox(6)
        for s in sets[lo:lo + 500]:
            box.add(J.fingerprint(s), s)
        rows += list(box.flush())
    table = pa.Table.from_batches(rows)
    table = table.filter(pa.array(table.column("slot").to_numpy() == 0))
    tokens = sum(int(np.frombuffer(b.as_buffer(), np.uint32, 1)[0]) for b in table.column("payload") if b.is_valid)
    assert tokens > 500_000
    tracemalloc.start()
    out = J._count_shared(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * tokens
    by_class = {}
    for cls, n in zip(out.column("cls").to_pylist(), out.column("n").to_pylist()):
        by_class[cls] = by_class.get(cls, 0) + n
    where = {}
    for s in {J.fingerprint(s): s for s in sets}.values():
        for t in s.tolist():
            where.setdefault(t & 0xFFFFFFFF, set()).add(J._class_id(J.fingerprint(s)))
    want = {}
    for s in {J.fingerprint(s): s for s in sets}.values():
        c, n = J._class_id(J.fingerprint(s)), sum(len(where[t & 0xFFFFFFFF]) > 1 for t in s.tolist())
        if n:
            want[c] = n
    assert {c for c in by_class} == set(want) and all(by_class[c] >= want[c] for c in want)
