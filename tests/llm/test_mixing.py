import random

import duckdb
import pyarrow as pa

from aurum.llm import mixing as M
from aurum.llm import oracle
from aurum.llm.session_tables import written

SCHEMA = "doc_id bigint, text string, lang string, source string, copies int"


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        src = rnd.choice(["src0"] * 8 + ["src1", "src2", "src5", "src7", "own", None])
        lang = rnd.choice(["en"] * 5 + ["de", "fr", "es", "xx", None])
        text = rnd.choice([None, "", " ", " ".join("w" * rnd.randint(1, 60))])
        out.append((rnd.choice([i, i, i, None]), text, lang, src, 1))
    return out


def sql(rows, **how):
    con = duckdb.connect()
    cols = [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())]
    con.register("documents", pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(cols)}))
    cur = con.execute(oracle.mixing_sql(**how))
    names = [d[0] for d in cur.description]
    return sorted((tuple(r[names.index(c)] for c in ("doc_id", "domain", "lang", "source", "tokens", "epoch")) for r in cur.fetchall()), key=str)


def got(df, **how):
    return sorted(map(tuple, M.mix(df, **how).collect()), key=str)


def test_agrees_with_sql_for_several_budgets(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for how in ({}, {"percent": 40}, {"percent": 75, "max_epochs": 1}, {"percent": 250, "max_epochs": 3}, {"percent": 900}):
        assert got(df, **how) == sql(rows, **how)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    def doc(i, lang, src, n):
        return (i, " ".join(["w"] * n), lang, src, 1)
    rows = [doc(1, "en", "src1", 5)] + [doc(10 + i, "en", "src5", 10) for i in range(40)] \
        + [doc(100 + i, "de", "src5", 10) for i in range(40)] + [doc(200 + i, "en", "src2", 10) for i in range(40)]
    weights = {"domain": {}, "lang": {}, "source": {}}
    b = {(r.domain, r.lang, r.source): r.budget for r in M.leaf_budgets(
        written(M.measured(spark.createDataFrame(rows, SCHEMA)), "t"), 33, weights, 1).collect()}
    have = (5 + 1200) * 33 // 100
    assert b["d2", "en", "src2"] == have // 2                                # the other domain is not touched
    assert b["d1", "en", "src1"] == 5                                        # full: its sibling source takes over
    assert b["d1", "en", "src5"] == have // 2 // 2 - 5
    assert b["d1", "de", "src5"] == have // 2 // 2


def test_budgets_are_kept_and_prefixes_nest(spark):
    rows = corpus(300, seed=4)
    df = spark.createDataFrame(rows, SCHEMA)
    base = written(M.measured(df), "t")
    some = got(df, percent=30, max_epochs=1)
    budget = {(r.domain, r.lang, r.source): r.budget for r in M.leaf_budgets(base, 30, M.WEIGHTS, 1).collect()}
    used = {}
    for _, d, la, s, n, _ in some:
        used[d, la, s] = used.get((d, la, s), 0) + n
    assert all(v <= budget[k] for k, v in used.items())
    longest = max((len((t or "").split()) for _, t, *_ in rows))
    assert all(budget[k] - used.get(k, 0) <= longest for k in budget)


def test_documents_of_the_mixture(spark):
    rows = corpus(120, seed=6)
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame(rows, SCHEMA)
    out = M.mixed_documents(df, percent=80)
    assert out.columns == df.columns
    key = lambda r: (r[0], r[2], r[3])
    assert sorted(map(str, map(key, out.collect()))) == sorted(str((r[0], r[2], r[3])) for r in sql(rows, percent=80))
    empty = spark.createDataFrame([], SCHEMA)
    assert M.mix(empty).count() == 0 and M.mixed_documents(empty).count() == 0
