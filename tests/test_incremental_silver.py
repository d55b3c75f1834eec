import os

import pytest
from pyspark.sql import functions as F

from aurum.plans import trips
from aurum.session import scratch_path
from aurum.sources import adapters as A
from aurum.sources import landing as L
from aurum.sources import store
from aurum.sources.tables import Tables
from aurum.streaming import silver as S
from conftest import SF_SMALL


def local(path):
    return path.replace("file://", "")


def contents(df):
    cols = sorted(c for c in df.columns if c != "_ingested_at")
    return sorted(str(tuple(r[c] for c in cols)) for r in df.collect())


@pytest.fixture(scope="module")
def feed(spark):
    """A few months of trips, some of them twice, as two deliveries of files."""
    src = scratch_path(spark, "deliveries")
    b = A.raw_trips(Tables(spark, SF_SMALL)).drop("_source_file", "_record_no")
    b = b.filter(F.col("pickup_datetime").isNull() | (F.col("pickup_datetime") < "1995-05-01"))
    odd = F.col("part_key") % 2 == 1
    b.filter(odd).coalesce(1).write.parquet(src + "/delivery-0")
    again = b.filter(F.col("vendor_id") % 3 == 0)
    b.filter(~odd).unionByName(again).coalesce(1).write.parquet(src + "/delivery-1")
    return src, b.schema


def land(spark, feed, root, ckpt, upto):
    src, schema = feed
    for k in range(upto):
        S.land_silver(spark, f"{src}/delivery-[0-{k}]", schema, root, ckpt)


def test_deliveries_equal_the_batch_build_and_replay_changes_nothing(spark, feed):
    root, ckpt = scratch_path(spark, "silver"), scratch_path(spark, "offsets")
    land(spark, feed, root, ckpt, 2)
    accepted, rejected = S.read_silver(spark, root, provenance=True), S.read_quarantine(spark, root)
    landed = L.land_parquet_files(spark, [f"{feed[0]}/delivery-{k}" for k in range(2)], "trips")
    batch = trips.tag_typed(trips.typed(landed, keep=L.PROVENANCE))
    assert contents(accepted) == contents(batch.filter("_reject_reason IS NULL").select(*accepted.columns))
    assert contents(rejected) == contents(batch.filter("_reject_reason IS NOT NULL").select(*rejected.columns))
    assert rejected.filter(F.col("_reject_reason") == trips.R_DUPLICATE).count() > 0
    assert accepted.filter("_source_file IS NULL OR _record_no IS NULL OR _ingested_at IS NULL").isEmpty()
    log = {r.batch_id: r.n_rows for r in S.batches(spark, root).collect()}
    assert sorted(log) == [0, 1] and sum(log.values()) == landed.count()

    before = contents(accepted), contents(rejected)
    commits = os.path.join(local(ckpt), "commits")               # a crash before the stream's own commit
    for name in ("1", ".1.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    land(spark, feed, root, ckpt, 2)
    assert (contents(S.read_silver(spark, root, provenance=True)), contents(S.read_quarantine(spark, root))) == before
    assert {r.batch_id: r.n_rows for r in S.batches(spark, root).collect()} == log


def test_reload_of_one_partition_leaves_the_others(spark):
    path = scratch_path(spark, "parts")
    df = spark.range(60).select("id", (F.col("id") % 3).alias("p"))
    store.reload_partitions(df, path, ["p"])

    def files(p):
        folder = f"{local(path)}/p={p}"
        return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}
    before = {p: files(p) for p in range(3)}
    store.reload_partitions(df.filter("p = 1").withColumn("id", F.col("id") + 1000), path, ["p"])
    assert files(0) == before[0] and files(2) == before[2] and files(1).keys() != before[1].keys()
    got = sorted((r.p, r.id) for r in spark.read.parquet(path).collect())
    assert got == sorted((i % 3, i + 1000 * (i % 3 == 1)) for i in range(60))


def test_failed_reload_leaves_the_old_partition(spark):
    path = scratch_path(spark, "parts")
    df = spark.range(40).select("id", (F.col("id") % 2).alias("p"))
    store.reload_partitions(df, path, ["p"])
    broken = df.filter("p = 1").withColumn("id", F.when(F.col("id") == 39, F.raise_error(F.lit("bad cell"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="bad cell"):
        store.reload_partitions(broken, path, ["p"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(40))
