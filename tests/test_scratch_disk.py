"""What merges and landings hold on disk while they run: shuffles as narrow, as few and as short-lived as the job allows."""
import os
import time

from pyspark.sql import functions as F

from aurum.plans import trips
from aurum.session import scratch_path, settings, write_parquet
from aurum.sources import store
from aurum.streaming import silver as S


def shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


def left_behind(spark, before):
    for _ in range(20):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def feed(spark, n=4000):
    """Trips of six months and of none; keys come up to three times, every seventh of them in two months."""
    i = F.col("id")
    key = (i % (n // 2)).alias("order_key")
    month = F.pmod(F.when(i % 7 == 0, i).otherwise(i % (n // 2)), F.lit(6))
    pickup = F.when(i % 11 != 0, F.timestamp_add("DAY", F.lit(31) * month.cast("int"), F.lit("1995-01-05 08:00:00").cast("timestamp_ntz")))
    return spark.range(n).select(
        F.when(i % 13 != 0, key).alias("order_key"), (i % 3 % 2).cast("int").alias("line_no"), (i % 5).alias("part_key"),
        (i % 4).alias("vendor_id"), pickup.alias("pickup_datetime"),
        F.timestamp_add("MINUTE", (i % 40).cast("int"), pickup).alias("dropoff_datetime"), (i % 8).cast("int").alias("passenger_count"),
        (i % 50).cast("double").alias("trip_distance"), F.lit(1).alias("pu_location_id"), F.lit(2).alias("do_location_id"),
        F.lit("1").alias("payment_type"), (i % 9).cast("double").alias("fare_amount"), F.lit(0.5).alias("tip_amount"),
        (i % 9 + 1).cast("double").alias("total_amount"), F.lit(None).cast("double").alias("late_fee"))


def stamped(df, source_file):
    return df.select(F.lit("trips").alias("_source"), F.lit(source_file).alias("_source_file"),
                     F.lit("2020-01-01").cast("timestamp_ntz").alias("_ingested_at"),
                     F.monotonically_increasing_id().alias("_record_no"), *df.columns)


def bronze(spark, root):
    return spark.read.parquet(S._paths(root)[0])


def contents(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


def test_writes_leave_no_shuffle_files(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("p"))
    before = shuffle_files(spark)
    store.reload_partitions(df, scratch_path(spark, "parts"), ["p"])
    assert not left_behind(spark, before)
    write_parquet(df.groupBy("p").count(), scratch_path(spark, "counts"))
    assert not left_behind(spark, before)


def test_settings_are_put_back(spark):
    key, other = "spark.sql.shuffle.partitions", "aurum.test.unset"
    old = spark.conf.get(key)
    try:
        with settings(spark, {key: "3", other: "x"}):
            assert (spark.conf.get(key), spark.conf.get(other)) == ("3", "x")
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(key) == old and spark.conf.get(other, None) is None


def test_months_in_many_jobs_give_the_batch_build(spark, monkeypatch):
    """Few rows a job and a slot: keys of two months still have one survivor, also when the second batch takes keys over."""
    monkeypatch.setattr(S, "JOB_ROWS", 700)
    monkeypatch.setattr(S, "SLOT_ROWS", 60)
    root, rows = scratch_path(spark, "silver"), feed(spark)
    first = stamped(rows.filter("vendor_id < 2"), "b/late")
    second = stamped(rows.filter("vendor_id >= 2"), "a/early").union(stamped(rows.filter("part_key = 1"), "c/again"))
    S.merge_batch(first, 0, root)
    S.merge_batch(second, 1, root)
    batch = trips.tag_typed(trips.typed(bronze(spark, root), keep=["_source", "_ingested_at"]))
    accepted, rejected = S.read_silver(spark, root, provenance=True), S.read_quarantine(spark, root)
    assert contents(accepted) == contents(batch.filter("_reject_reason IS NULL").select(*accepted.columns)) != []
    assert contents(rejected) == contents(batch.filter("_reject_reason IS NOT NULL").select(*rejected.columns))
    two = batch.groupBy("order_key", "line_no").agg(F.count_distinct(F.month("pickup_at")).alias("months"))
    assert two.filter("months > 1").count() > 10
    assert len(S._jobs({r[0]: r[1] for r in bronze(spark, root).groupBy(S.MONTH).count().collect()})) > 3


def test_jobs_take_whole_months_up_to_a_bound(monkeypatch):
    monkeypatch.setattr(S, "JOB_ROWS", 10)
    assert S._jobs({3: 4, 1: 6, 2: 1, 4: 30, 5: 1}) == [{1: 6, 2: 1}, {3: 4}, {4: 30}, {5: 1}]


def test_rows_are_dealt_once_for_match_back_and_write(spark, monkeypatch):
    monkeypatch.setattr(S, "SLOT_ROWS", 60)
    root = scratch_path(spark, "silver")
    S.merge_batch(stamped(feed(spark), "a/one"), 0, root)
    landed = bronze(spark, root)
    won = landed.select(S.MONTH, "_source_file", "_record_no").filter("_record_no % 2 = 0")
    counts = dict(landed.groupBy(S.MONTH).count().collect())
    with settings(spark, S.DEALT_ONCE):
        plan = S._tag_months(landed, won, counts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "ShuffledHashJoin" in plan


def nodes(plan, name):
    found = [plan] if plan.nodeName() == name else []
    return found + [n for i in range(plan.children().size()) for n in nodes(plan.children().apply(i), name)]


def columns(node):
    return {node.output().apply(i).name() for i in range(node.output().size())}


def test_counts_shuffle_verdicts_and_not_what_the_rules_read(spark):
    path = scratch_path(spark, "landed")
    stamped(feed(spark), "a/one").write.parquet(path)
    landed = spark.read.parquet(path)
    verdicts = trips.tag_typed(trips.typed(landed)).groupBy("_reject_reason").count()
    join, = nodes(verdicts._jdf.queryExecution().optimizedPlan(), "Join")
    assert columns(join.left()) == {"_source_file", "_record_no", "_reject_reason"}
    silver = trips.silver(landed).agg(F.count(F.lit(1)).alias("n"))
    window, = nodes(silver._jdf.queryExecution().optimizedPlan(), "Window")
    assert not columns(window) & {"fare_amount", "total_amount", "trip_distance_mi", "passenger_count", "trip_duration_s"}
