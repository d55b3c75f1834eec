"""A key owning a third of the rows: AQE splits the join, the window gets one row per key and task."""
from pyspark.sql import functions as F

from aurum.operators.dedup import keep_first


def test_hot_key_join_is_split_and_groups_are_limited(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997 + 1000).alias("k"),
            (F.col("id") % 5).alias("line"), F.col("id").alias("ord"))
        dim = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") % 25).alias("nation"))
        joined = fact.join(dim, "k", "left")
        out = keep_first(joined, ["k", "line"], ["ord"])
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan                 # the hot partition was split
        assert plan.count("WindowGroupLimit") >= 2   # before and after the shuffle
        hot = sorted((r.line, r.ord) for r in rows if r.k == 7)
        assert hot == [(line, min(i for i in range(0, n, 3) if i % 5 == line)) for line in range(5)]
        assert len(rows) == fact.select("k", "line").distinct().count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
