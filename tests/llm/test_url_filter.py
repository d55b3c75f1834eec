import duckdb
import pytest
from pyspark.sql import functions as F

from aurum.llm import oracle
from aurum.llm import url_filter as U

SCHEMA = "page_id bigint, url string, host string, rule int"

URLS = [None, "", "no scheme", "http://", "HTTP://Example.COM", "http://WWW.Example.com/en/x?y=/es/", "http://sub.www.example.com/en/",
        "x://net/es/1#a://b", "ftp://xnet/es/", "http://a.net/fr/", "http://a.net/fr", "http://a.net/es/x/y", "http://example.com/en/1.html",
        "http://a.example.com/en/", "http://example.com/enx", "http://a.com?x=/en/", "http://a.org/b/c/d/e/f/g/h/i/1.html", "a://b://c/es/",
        "http://ünï.net/es/é", "http://a.org//x///y/", "http://net#/es/", "http://A.NET/ES/", "http://a.org/" + "x" * 5000]


def rows_of(spark, rows):
    return U.url_filter(spark.createDataFrame(rows, SCHEMA)).drop("template")


def from_sql(rows):
    import pyarrow as pa
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": pa.array([r[0] for r in rows], pa.int64()), "url": pa.array([r[1] for r in rows], pa.string())}))
    cur = con.execute(oracle.url_filter_sql())
    names = [d[0] for d in cur.description]
    return sorted((tuple(r[names.index(c)] for c in ("page_id", "host", "path", "rule", "verdict")) for r in cur.fetchall()), key=str)


def test_rules_and_edges_agree_with_sql(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS)] + [(None, URLS[5], "x", 1), (5, URLS[5], "x", 1)]
    got = sorted(map(tuple, rows_of(spark, rows).collect()), key=str)
    assert got == from_sql(rows) and len(got) == len(rows)
    by_id = {r[0]: r for r in got if r[0] is not None}
    assert by_id[5][3:] == ("www.example.com/en/", "allow")
    assert by_id[7][3:] == ("net/es/", "block") and by_id[8][3] is None
    assert by_id[12][3:] == ("example.com/en/", "block")
    assert rows_of(spark, rows).filter("false").count() == 0
    assert rows_of(spark, []).count() == 0


def tree_fixture():
    """One host with ids, many slugs, and labelled branches that differ or agree."""
    out = [f"http://h.org/item/{i}.html" for i in range(20)] + [f"http://h.org/story/title-{chr(97 + i)}x/read" for i in range(20)]
    for lang, n in (("aa", 12), ("bb", 9), ("cc", 4)):
        out += [f"http://n.net/{lang}/{i}" for i in range(n)]
    out += [f"http://n.net/es/{i}" for i in range(9)] + [f"http://n.net/fr/{i}" for i in range(9)]
    return list(enumerate(out))


def test_tree_generalises_merges_and_agrees_with_sql(spark):
    rows = [(i, u, "x", 1) for i, u in tree_fixture()]
    assert sorted(map(tuple, rows_of(spark, rows).collect()), key=str) == from_sql(rows)
    t = {r.url: r.template for r in U.url_filter(spark.createDataFrame(rows, SCHEMA)).join(
        spark.createDataFrame(rows, SCHEMA).select("page_id", "url"), "page_id").collect()}
    assert t["http://h.org/item/3.html"] == "/item/{n}.html"
    assert t["http://h.org/story/title-ax/read"] == "/story/*/read"
    assert t["http://n.net/es/1"] == t["http://n.net/fr/1"] != t["http://n.net/aa/1"]


def test_labels_of_the_caller_reject_impure_templates(spark):
    rows = [(i, f"http://s.org/{'ads' if i % 2 else 'news'}/{i}", "x", 1) for i in range(40)]
    bad = F.when(F.col("page_id") < 30, F.col("url").contains("/ads/"))
    out = U.url_filter(spark.createDataFrame(rows, SCHEMA), rules=[], bad=bad).collect() if U.RULES else []
    assert {r.verdict for r in out if "ads" in r.path} == {"block"}
    assert {r.verdict for r in out if "news" in r.path} == {"allow"}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_urls_agree_with_sql(spark, seed):
    import random
    rnd = random.Random(seed)
    hosts = ["a.net", "b.example.com", "www.example.com", "c.org"]
    segs = ["en", "es", "fr", "x", "12", "345", "deadbeef00", "p.html", "7.php"]
    rows = [(i, f"http://{rnd.choice(hosts)}/" + "/".join(rnd.choice(segs) for _ in range(rnd.randint(0, 8))), "x", 1) for i in range(250)]
    assert sorted(map(tuple, rows_of(spark, rows).collect()), key=str) == from_sql(rows)


def test_the_registered_labels_reach_branches_without_a_rule(spark):
    """On a host whose labelled pages are all blocked, a branch that no rule fits is rejected; a host
    with allowed pages, or without labels, keeps its branches."""
    rows = [(i, f"http://n.net/{'es' if i % 2 else 'fr'}/{i}", "x", 1) for i in range(40)]
    rows += [(100 + i, f"http://n.net/shop/{i}", "x", 1) for i in range(5)]
    rows += [(200 + i, f"http://good.com/{'en' if i % 2 else 'shop'}/{i}", "x", 1) for i in range(20)]
    rows += [(300 + i, f"http://new.org/shop/{i}", "x", 1) for i in range(5)]
    out = rows_of(spark, rows).collect()
    assert sorted(map(tuple, out), key=str) == from_sql(rows)
    verdicts = {r.page_id: (r.rule, r.verdict) for r in out}
    assert {verdicts[100 + i] for i in range(5)} == {(None, "block")}
    assert {v for k, (_, v) in verdicts.items() if k >= 200} == {"allow"}


@pytest.mark.parametrize("depth", [2, 7, 11])
def test_branches_are_told_apart_at_any_depth(spark, depth):
    up = "/".join("abcdefghijk"[:depth - 1])
    rows = [(i, f"http://s.org/{up}/{'ads' if i % 2 else 'news'}", "x", 1) for i in range(40)]
    out = U.url_filter(spark.createDataFrame(rows, SCHEMA), rules=[("none", "/", "allow")], bad=F.col("page_id") % 2 == 1).collect()
    assert {(r.path.rsplit("/", 1)[1], r.verdict) for r in out} == {("ads", "block"), ("news", "allow")}


def test_a_node_with_many_children_stays_a_narrow_row(spark):
    urls = spark.range(200_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://w.org/wiki/"), F.md5(F.col("id").cast("string")),
                                       F.lit("-page")).alias("url"))
    at = U.by_rule(urls.select("page_id", U.host_of(F.col("url")).alias("host"), U.path_of(F.col("url")).alias("path")))
    nodes = U.leaves(at.withColumns({"leaf": U.segments(F.col("path")), "bad": F.lit(None).cast("boolean")})).withColumn("template", F.col("leaf"))
    top = U._level(nodes, 1)
    assert top.select("template").filter(F.size("template") > 2).isEmpty()
    done = U._level(top, 2)
    assert [tuple(r.template) for r in done.select("template").distinct().collect()] == [("wiki", "*")]
