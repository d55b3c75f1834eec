import pytest
from pyspark.sql import functions as F

from aurum.operators import quality as Q
from aurum.plans import catalog, trips
from aurum.session import scratch_path
from aurum.sources import store
from aurum.streaming.incremental import land_available
from conftest import SF_SMALL


def test_versions_compaction_and_latest(spark):
    root = scratch_path(spark, "lake")
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    v1 = store.write_version(df, root, "silver", "t", files=10)
    v2 = store.compact(spark, root, "silver", "t")
    assert (v1["version"], v2["version"], v2["n_rows"]) == (1, 2, 100)
    assert len(spark.read.parquet(v1["path"]).inputFiles()) == 10 and len(spark.read.parquet(v2["path"]).inputFiles()) == 1
    v3 = store.compact(spark, root, "silver", "t", target_bytes=400)
    assert len(spark.read.parquet(v3["path"]).inputFiles()) > 1
    assert spark.read.parquet(v1["path"]).count() == 100                 # history stays
    assert store.latest_version(spark, root, "silver", "t").first().version == 3


def test_concurrent_writers_keep_both_versions(spark):
    from concurrent.futures import ThreadPoolExecutor
    root = scratch_path(spark, "lake")
    store.write_version(spark.range(1), root, "silver", "t")
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda n: store.write_version(spark.range(n), root, "silver", "t"), (20, 30)))
    assert sorted(spark.read.parquet(d["path"]).count() for d in done) == [20, 30]
    assert store.versions(spark, root, "silver", "t").count() == 3
    assert store.read_latest(spark, root, "silver", "t").count() in (20, 30)


def test_a_failing_log_read_is_not_an_empty_log(spark):
    root = scratch_path(spark, "lake")
    info = store.write_version(spark.range(7), root, "silver", "t")
    spark.range(1).select(F.lit("broken").alias("value")).write.text(f"{root}/silver/t/_log/commit-broken")
    with pytest.raises(Exception):
        store.write_version(spark.range(9), root, "silver", "t")
    assert spark.read.parquet(info["path"]).count() == 7


def test_latest_rows_are_the_written_rows(spark):
    root = scratch_path(spark, "lake")
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    store.write_version(df, root, "silver", "t")
    assert sorted(store.read_latest(spark, root, "silver", "t").collect()) == sorted(df.collect())


def test_overwrite_is_idempotent(spark):
    path = scratch_path(spark, "ow")
    df = spark.range(5)
    store.overwrite(df, path)
    store.overwrite(df, path)
    assert spark.read.parquet(path).count() == 5


def test_fingerprint_stable_and_sensitive(spark):
    a = spark.createDataFrame([(1.25,), (2.5,)], "m double")
    b = spark.createDataFrame([(2.5,), (1.25,)], "m double")
    c = spark.createDataFrame([(2.5,), (1.26,)], "m double")
    fa, fb, fc = (store.fingerprint(x, "m").first().data_version for x in (a, b, c))
    assert fa == fb and fa != fc
    strong = lambda *v: store.content_hash(spark.createDataFrame([(x,) for x in v], "m int"), ["m"]).first().content_hash
    assert strong(1, 1, 5) == strong(5, 1, 1) != strong(2, 2, 5)


def test_gold_hash_notices_a_change_in_any_column(spark):
    gold = catalog._gold(spark, SF_SMALL).orderBy("order_key", "line_no").limit(3).localCheckpoint()
    change = {"string": lambda c: F.concat(F.coalesce(c, F.lit("")), F.lit("x")),
              "timestamp": lambda c: c + F.expr("interval 1 day"), "timestamp_ntz": lambda c: c + F.expr("interval 1 day")}
    kinds = dict(gold.dtypes)
    whole = lambda df: catalog._whole_gold_hash(df).first().content_hash
    plain = whole(gold)
    assert plain == whole(gold.orderBy(F.desc("order_key"), F.desc("line_no")))
    for c in gold.columns:
        to = change.get(kinds[c], lambda x: F.coalesce(x, F.lit(0)) + 1)
        assert whole(gold.withColumn(c, to(F.col(c)).cast(kinds[c]))) != plain, c


def test_incremental_landing_picks_up_only_new_files(spark):
    src = scratch_path(spark, "landing")
    target, ckpt = scratch_path(spark, "t"), scratch_path(spark, "c")
    spark.range(0, 10).write.parquet(src + "/part-a")
    schema = spark.range(1).schema
    out = land_available(spark, src + "/*", schema, target, ckpt)
    assert out.count() == 10
    spark.range(10, 15).write.parquet(src + "/part-b")
    out = land_available(spark, src + "/*", schema, target, ckpt)
    assert sorted(r.id for r in out.collect()) == list(range(15))


def test_defect_drill_catches_injected_tips(spark):
    row = catalog.QUERIES["defect_drill"](spark, SF_SMALL).first()
    assert row.silver_after == row.silver_before                        # a copy takes its original's place
    assert row.tip_fail_before == 0 < row.tip_fail_after
    assert row.quarantine_delta == row.tip_fail_after                   # every surviving copy is stopped
    assert (row.gate_after, row.offline_gate_after) == ("OPEN", "CLOSED")


def test_offline_gate_closes_on_injected_defect(spark):
    """Offline path: gold has no tip guard, so the gate's tip check must fail."""
    from aurum.sources import adapters as A
    from aurum.sources.tables import Tables
    b = A.raw_trips(Tables(spark, SF_SMALL))
    bad = catalog._inject(spark, SF_SMALL)
    bad = bad.withColumn("_source_file", F.lit("a-corrupt-file"))        # sorts before the clean file
    silver = trips.silver(b.unionByName(bad, allowMissingColumns=True))
    gold = trips.gold_offline(silver)
    checks = [c for c in catalog.promotion_gate(row_floor=1) if c.name == "fct_trips.tip_rate accepted_range"]
    rep = Q.run_checks(checks, {"fct_trips": gold})
    with pytest.raises(Q.GateClosed):
        Q.assert_open(rep)
    clean = Q.run_checks(checks, {"fct_trips": trips.gold_offline(trips.silver(b))})
    assert Q.assert_open(clean)[0].status == "PASS"


def test_conservation_on_testdata(spark):
    c = catalog.QUERIES["conservation"](spark, SF_SMALL).first()
    assert c.balanced and c.input_rows == c.accepted_rows + c.quarantined_rows
    assert c.accepted_rows == catalog.QUERIES["silver_fact"](spark, SF_SMALL).count()


def test_layered_build_writes_every_layer_consistently(spark):
    from aurum.plans.build import run
    root = scratch_path(spark, "layers")
    written, report = run(spark, SF_SMALL, root)
    n = {(r.layer, r.table_name): r.n_rows for r in written.collect()}
    assert n[("bronze", "raw_trips")] == n[("silver", "trips")] + n[("silver", "trips_quarantine")]
    assert n[("silver", "trips")] == n[("gold", "fct_trips")] + n[("gold", "fct_trips_quarantine")]
    assert n[("bronze", "raw_app_log")] == n[("silver", "app_events")] + n[("silver", "app_log_quarantine")]
    assert report.count() == 9
    # tables are readable as the newest committed version
    assert store.read_latest(spark, root, "gold", "fct_trips").count() == n[("gold", "fct_trips")]
