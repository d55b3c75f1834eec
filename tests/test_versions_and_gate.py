import hashlib
import random

import pytest
from pyspark.sql import functions as F

from aurum.operators import experiment as X
from aurum.operators import quality as Q
from aurum.operators.hash_tree import differing_ranges, hash_tree
from aurum.session import materialize, scratch_path
from aurum.sources.footers import file_shapes, land_drifted_files


# ------------------------------------------------------------ versions
def trees(spark, a, b, width=10):
    schema = "k bigint, v string, x double"
    return [hash_tree(spark.createDataFrame(r, schema).repartition(3), "k", ["k", "v"], {"x": 2}, width=width) for r in (a, b)]


def test_one_changed_row_is_located_among_many_ranges(spark):
    rows = [(i, f"v{i % 7}", i / 4) for i in range(5000)]
    other = [(k, v, x + (0.01 if k == 3217 else 0)) for k, v, x in rows]
    random.Random(1).shuffle(other)
    old, new = trees(spark, rows, other)
    assert [tuple(r) for r in differing_ranges(old, new, width=10).collect()] == [(3210, 3220, 10, 10)]
    assert old.filter("level = 1 AND part = 20").first().n_rows == 160
    assert differing_ranges(old, old, width=10).isEmpty()


def test_rows_added_lost_repeated_and_without_a_key(spark):
    rows = [(1, "a", 1.0), (15, "b", 1.0), (15, "b", 1.0), (-3, "c", None), (None, "n", 1.0)]
    old, new = trees(spark, rows, rows[:2] + [(-3, "c", None), (None, "n", 1.0), (None, "n", 1.0), (407, "new", 0.0)])
    got = sorted((tuple(r) for r in differing_ranges(old, new, width=10).collect()), key=str)
    assert got == sorted([(10, 20, 2, 1), (400, 410, 0, 1), (None, None, 1, 2)], key=str)
    empty, some = trees(spark, [], rows)
    assert differing_ranges(empty, empty, width=10).isEmpty()
    assert sorted(r.n_new for r in differing_ranges(empty, some, width=10).collect()) == [1, 1, 1, 2]


# ------------------------------------------------------------ gate at write time
def test_checks_counted_by_the_write_equal_those_by_a_scan(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (2, 700.0), (3, -1.0)], "id int, v double").repartition(3)
    checks = [Q.not_null("t", "v"), Q.accepted_range("t", "v", 0, 500), Q.accepted_range("t", "v", min_value=0, inclusive=False),
              Q.unique("t", "id"), Q.row_floor("t", 5), Q.expression("t", "warned", "v > 100", severity="warn")]
    checked, seen = Q.observe_checks(df, "t", checks)
    written = materialize(checked)
    assert seen.get[Q.ROWS] == 4
    by_write = Q.run_checks(checks, {"t": written}, observed={"t": seen.get})
    plan = by_write._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1                        # uniqueness only
    assert sorted(map(tuple, by_write.collect())) == sorted(map(tuple, Q.run_checks(checks, {"t": written}).collect()))


def test_empty_table_at_write_time(spark):
    checks = [Q.not_null("t", "v"), Q.row_floor("t", 1)]
    checked, seen = Q.observe_checks(spark.createDataFrame([], "v int"), "t", checks)
    written = materialize(checked)
    got = Q.run_checks(checks, {"t": written}, observed={"t": seen.get}).orderBy("check_no").collect()
    assert [r.failing for r in got] == [0, 1]


# ------------------------------------------------------------ many files
def test_many_files_of_three_shapes_are_three_scans(spark):
    folder = scratch_path(spark, "drift")
    base = spark.range(120).select("id", (F.col("id") * 2).alias("n"))
    base.repartition(20).write.parquet(folder + "/a")
    base.withColumn("n", F.col("n").cast("int")).withColumn("id", F.col("id") + 1000).repartition(20).write.parquet(folder + "/b")
    base.withColumn("fee", F.lit(0.5)).withColumn("id", F.col("id") + 2000).repartition(20).write.parquet(folder + "/deep/c")
    assert file_shapes(spark, [folder]).groupBy("shape").count().count() == 3
    landed = land_drifted_files(spark, [folder], "feed")
    assert landed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 3
    assert dict(landed.dtypes)["n"] == "bigint"
    assert sorted((r.id, r.n, r.fee) for r in landed.collect()) == sorted(
        (i + 1000 * k, 2 * i, 0.5 if k == 2 else None) for i in range(120) for k in range(3))
    assert landed.select("_source_file", "_record_no").distinct().count() == 360
    with pytest.raises(FileNotFoundError):
        spark.range(0).write.mode("overwrite").csv(folder + "-none")
        land_drifted_files(spark, [folder + "-none"], "feed")


# ------------------------------------------------------------ interval of the lift
def test_interval_holds_zero_without_an_effect_and_not_with_one(spark):
    rnd = random.Random(5)
    rows = [(i, abs(rnd.gauss(0, 1)), abs(rnd.gauss(0, 1))) for i in range(1500)]
    noise = X.lift_interval(spark.createDataFrame(rows, "k int, b double, a double").repartition(4), ["k"], "b", "a").first()
    assert noise.holds_zero and noise.verdict == "CUT" and noise.lift_low < noise.lift_pct < noise.lift_high
    rows = [(i, b, b * 0.9) for i, b, _ in rows]
    real = X.lift_interval(spark.createDataFrame(rows, "k int, b double, a double"), ["k"], "b", "a").first()
    assert real.verdict == "KEEP" and not real.holds_zero and real.lift_low > 9.9
    none = X.lift_interval(spark.createDataFrame([], "k int, b double, a double"), ["k"], "b", "a").first()
    assert (none.n_test, none.lift_pct, none.verdict, none.holds_zero) == (0, None, "CUT", False)


def test_replicates_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, i % 5 + 0.25, i % 3 + 0.5) for i in range(200)], "k int, b double, a double")
    runs = [sorted(map(tuple, X.lift_replicates(df.repartition(p), ["k"], "b", "a", replicates=30).collect())) for p in (1, 6)]
    assert runs[0] == runs[1] and len(runs[0]) == 30 and len({x for _, x in runs[0]}) > 20


def test_replicates_are_the_plain_sums_and_make_a_row_for_four(spark):
    rows = [(i, i % 5 + 0.25, i % 3 + 0.5) for i in range(60)]
    out = X.lift_replicates(spark.createDataFrame(rows, "k int, b double, a double"), ["k"], "b", "a", replicates=6)
    want = {}
    for r in range(6):
        b = a = 0
        for k, x, y in rows:
            u = int(hashlib.md5(f"7|{k}|{r // 4}".encode()).hexdigest()[8 * (r % 4):8 * (r % 4) + 8], 16)
            w = sum(u >= s for s in X.POISSON_STEPS)
            b, a = b + w * int(x * 1e6 + 0.5), a + w * int(y * 1e6 + 0.5)
        want[r] = 100.0 * (b - a) / b
    assert {r.replicate: r.lift_pct for r in out.collect()} == pytest.approx(want)
    assert "conv(" not in out._jdf.queryExecution().toString()


def test_decision_and_apparatus_report_intervals(spark):
    rnd = random.Random(9)
    rows = [(i, float(rnd.randrange(1, 40)), float(rnd.choice([0, 0, 10, 20])), rnd.choice([0.0, 50.0])) for i in range(400)]
    df = spark.createDataFrame(rows, "order_key int, d double, precip_mm double, snow_mm double")
    few = {"maxIter": 8, "maxDepth": 4}
    wet = df.withColumn(X.TARGET, F.col("d") + F.col("precip_mm"))
    kept = X.feature_lift(wet, ["d"], ["precip_mm"], ["order_key"], few).first()
    assert kept.verdict == "KEEP" and kept.lift_low <= kept.lift_pct <= kept.lift_high and kept.n_test > 40
    dry = X.feature_lift(df.withColumn(X.TARGET, F.col("d") * 2), ["d"], ["snow_mm"], ["order_key"], few).first()
    assert dry.verdict == "CUT"
    a = X.apparatus_check(df.withColumn(X.TARGET, F.col("d") * 3), ["d"], ["precip_mm", "snow_mm"], ["order_key"], few).first()
    assert a.verdict == "PASS" and a.control_low_pct <= a.control_high_pct and a.treatment_low_pct > 0
