import random

from pyspark.sql import functions as F

from aurum.operators.numbering import numbered


def test_numbers_are_dense_in_order_and_do_not_depend_on_partitions(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot", "hot", "hot", "b", "c"]), rnd.choice([None, *range(40)]), i) for i in range(500)]
    want = {}
    for g in ("hot", "b", "c"):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want.update({r[2]: (k, len(mine)) for k, r in enumerate(mine)})
    df = spark.createDataFrame(rows, "g string, v int, row int")
    for parts in (1, 7):
        out = numbered(df.repartition(parts), [F.col("g"), F.col("v").isNotNull(), F.col("v"), F.col("row")], group="g", size="n")
        assert out.columns == ["g", "v", "row", "number", "n"]
        assert {r.row: (r.number, r.n) for r in out.collect()} == want


def test_hot_group_is_spread_over_tasks(spark):
    df = spark.range(4000).select(F.lit("one").alias("g"), "id")
    out = numbered(df, [F.col("g"), F.col("id")], group="g")
    assert out.filter("number <> id").isEmpty()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


def test_whole_table_empty_and_clashing_names(spark):
    df = spark.createDataFrame([(3, 1), (1, 2), (2, 3)], "_at int, _row int")
    assert sorted(tuple(r) for r in numbered(df, [F.col("_at")]).collect()) == [(1, 2, 0), (2, 3, 1), (3, 1, 2)]
    assert numbered(df.limit(0), [F.col("_at")], size="n").columns == ["_at", "_row", "number", "n"]
    assert numbered(df.limit(0), [F.col("_at")]).count() == 0
