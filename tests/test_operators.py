import pytest
from pyspark.sql import functions as F

from aurum.operators import quality as Q
from aurum.operators.dedup import keep_first, label_survivors
from aurum.operators.joins import missing_references
from aurum.operators.quarantine import conservation, tag_reasons
from aurum.operators.reshape import labelled_counts, pivot_max
from aurum.session import materialize


@pytest.fixture
def skewed(spark):
    # One natural key owns a third of the rows (the hot-key case).
    rows = [(1, i % 7, 100 - i, f"r{i}") for i in range(300)]
    rows += [(k, 0, k, f"s{k}") for k in range(2, 602)]
    return spark.createDataFrame(rows, "k int, k2 int, ord int, payload string")


def test_keep_first_survives_hot_key(spark, skewed):
    a = keep_first(skewed, ["k", "k2"], ["ord", "payload"])
    assert a.count() == 607
    hot = {r.k2: r.ord for r in a.filter("k = 1").collect()}
    # k2 = j keeps the smallest ord among i = j (mod 7), i.e. the largest i
    assert hot == {j: 100 - max(i for i in range(300) if i % 7 == j) for j in range(7)}


def test_keep_first_plans_a_group_limit(spark, skewed):
    plan = keep_first(skewed, ["k"], ["ord"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_label_survivors_conserves_rows(spark, skewed):
    ids = skewed.withColumns({"_source_file": F.lit("f"), "_record_no": F.monotonically_increasing_id()})
    lab = label_survivors(materialize(ids), ["k", "k2"], ["ord", "payload"])
    with pytest.raises(ValueError):
        label_survivors(skewed, ["k"], ["ord"])
    n_surv = lab.filter("_survivor").count()
    assert lab.count() == skewed.count()
    assert n_surv == keep_first(skewed, ["k", "k2"], ["ord", "payload"]).count()


def test_label_survivors_does_not_sort_the_whole_rows(spark, skewed):
    ids = materialize(skewed.withColumns({"_source_file": F.lit("f"), "_record_no": F.monotonically_increasing_id()}))
    lab = label_survivors(ids, ["k", "k2"], ["ord", "payload"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lab._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_tag_reasons_first_rule_wins_and_null_is_labelled(spark):
    df = spark.createDataFrame([(5.0, 1), (-1.0, 9), (None, 1), (2.0, 9)], "fare double, pax int")
    rules = [("fare", ~(F.col("fare") > 0)), ("pax", ~F.col("pax").between(1, 6))]
    plain = [r._reject_reason for r in tag_reasons(df, rules).collect()]
    assert plain == [None, "fare", None, "pax"]          # NULL fare: neither side
    labelled = tag_reasons(df, rules, null_reason="null in guard")
    assert [r._reject_reason for r in labelled.collect()] == [None, "fare", "null in guard", "pax"]
    parts = [labelled.filter(F.col("_reject_reason").isNull()), labelled.filter(F.col("_reject_reason").isNotNull())]
    c = conservation(df, *parts).first()
    assert (c.input_rows, c.accepted_rows, c.quarantined_rows, c.balanced) == (4, 1, 3, True)
    assert not conservation(df, parts[0], parts[1].limit(2)).first().balanced          # a row that vanished
    assert not conservation(df, parts[0].unionByName(parts[0]), parts[1]).first().balanced   # a row that doubled


def test_pivot_ignores_unlisted_elements(spark):
    df = spark.createDataFrame([("d1", "TMAX", 10), ("d1", "TMAX", 30), ("d1", "WESD", 5), ("d2", "PRCP", 0)],
                               "d string, e string, v int")
    got = {r.d: (r.tmax, r.prcp) for r in pivot_max(df, ["d"], "e", "v", {"tmax": "TMAX", "prcp": "PRCP"}).collect()}
    assert got == {"d1": (30, None), "d2": (None, 0)}


def test_labelled_counts_single_scan(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    out = labelled_counts(df, [("even", F.col("x") % 2 == 0), ("big", F.col("x") > 7), ("it's none", F.lit(False))])
    assert {r.defect: r.n for r in out.collect()} == {"even": 5, "big": 2, "it's none": 0}


def test_missing_references(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,), (9,), (9,)], "c int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    got = {r.c: r.n_rows for r in missing_references(child, "c", parent, "p").collect()}
    assert got == {9: 3}


def test_gate_semantics(spark):
    t = spark.createDataFrame([(1, 5.0, "A"), (1, None, "B"), (2, 700.0, "Z"), (3, -1.0, "Z")],
                              "id int, v double, cat string")
    p = spark.createDataFrame([("A",), ("B",)], "cat string")
    checks = [
        Q.not_null("t", "v"),
        Q.accepted_range("t", "v", 0, 500),                   # NULL passes, 700 and -1 fail
        Q.accepted_range("t", "v", min_value=0, inclusive=False),
        Q.unique("t", "id"),
        Q.accepted_values("t", "cat", ["A", "B"]),            # one distinct bad value
        Q.relationships("t", "cat", "p", "cat"),              # two failing rows
        Q.row_floor("t", 10),
        Q.expression("t", "v small", "v > 100", severity="warn"),
    ]
    rep = {r.check_name: (r.failing, r.status) for r in Q.run_checks(checks, {"t": t, "p": p}).collect()}
    assert rep == {
        "t.v not_null": (1, "FAIL"),
        "t.v accepted_range": (1, "FAIL"),
        "t.id unique": (1, "FAIL"),
        "t.cat accepted_values": (1, "FAIL"),
        "t.cat relationships": (2, "FAIL"),
        "t row_floor": (1, "FAIL"),
        "v small": (1, "WARN"),
    } | {"t.v accepted_range": rep["t.v accepted_range"]}
    assert [r.failing for r in Q.run_checks([checks[1], checks[2]], {"t": t}).orderBy("check_no").collect()] == [2, 1]
    with pytest.raises(Q.GateClosed):
        Q.assert_open(Q.run_checks(checks, {"t": t, "p": p}))
    ok = Q.run_checks([Q.not_null("p", "cat"), Q.expression("t", "w", "v > 100", severity="warn")], {"t": t, "p": p})
    assert len(Q.assert_open(ok)) == 2
