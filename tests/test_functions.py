import datetime

from pyspark.sql import functions as F

from aurum.functions import clean as C


def _one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col.alias("r")).first().r


def test_json_valid_shapes(spark):
    cases = {'{"k": [1, null]}': True, ' [2] ': True, '7.5': True, '"q"': True, 'null': True,
             '{"k":1} tail': False, '{"k":1} {"k":2}': False, '[1] [2]': False, '"x" "y"': False, '1,2': False,
             '1],[2': False, '{"k":1}],[{"k":2}': False, '1,"end-of-value"': False, '{"k":': False, 'words': False, '': False, None: False}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.ok for r in df.select("v", C.json_valid("v").alias("ok")).collect()}
    assert got == cases


def test_json_paths_and_unstable_types(spark):
    df = spark.createDataFrame([('{"id": 7, "ctx": {"lat": 40.5}}',), ('{"id": "8"}',), ('{"x": 1}',), ("junk",)], "v string")
    rows = df.select(C.json_typed("v", "$.id", "bigint").alias("id"),
                     C.json_typed("v", "$.ctx.lat", "double").alias("lat")).collect()
    assert [(r.id, r.lat) for r in rows] == [(7, 40.5), (8, None), (None, None), (None, None)]


def test_blank_sentinels_and_thousands(spark):
    df = spark.createDataFrame([("\t2,500,000 ",), ("  ",), ("none",), ("2024-02",), ("-8",)], "v string")
    rows = df.select(C.blank_to_null("v", "none").alias("b"), C.tolerant_int("v").alias("i")).collect()
    assert [r.i for r in rows][1:] == [None, None, None, -8]
    assert [r.b for r in rows][1:] == [None, None, "2024-02", "-8"]


def test_smart_quote_repair(spark):
    assert _one(spark, C.repair_smart_quote("v"), "five o\u0092clock") == "five o'clock"


def test_multi_format_dates(spark):
    fmts = ["yyyy-MM-dd", "M/d/yyyy", "dd-MM-yyyy"]
    df = spark.createDataFrame([("2025-01-14",), ("1/4/2025",), ("14-01-2025",), ("2025/01/14",)], "v string")
    got = [r.d for r in df.select(C.parse_date_any("v", fmts).alias("d")).collect()]
    assert got == [datetime.date(2025, 1, 14), datetime.date(2025, 1, 4), datetime.date(2025, 1, 14), None]


def test_iso_dow_and_weekend(spark):
    # 2025-01-04 is a Saturday, 2025-01-06 a Monday
    df = spark.createDataFrame([(datetime.datetime(2025, 1, 4),), (datetime.datetime(2025, 1, 6),)], "v timestamp_ntz")
    rows = df.select(C.iso_dow("v").alias("d"), C.weekend_flag("v").alias("w")).collect()
    assert [(r.d, r.w) for r in rows] == [(6, 1), (1, 0)]


def test_word_and_char_counts(spark):
    df = spark.createDataFrame([("",), ("  two  words ",), ("line\nbreak",), ("ñandú \U0001F426",)], "v string")
    rows = df.select(C.char_count("v").alias("c"), C.word_count("v").alias("w")).collect()
    assert [r.w for r in rows] == [1, 2, 2, 2]
    assert [r.c for r in rows] == [0, 13, 10, 7]


def test_round_half_up_and_safe_ratio(spark):
    df = spark.createDataFrame([(2.675, 0.0), (1.005, 2.0)], "a double, b double")
    rows = df.select(C.round_half_up("a", 2).alias("r"), C.safe_ratio("a", "b").alias("q")).collect()
    assert rows[0].q is None and rows[1].q == 1.005 / 2.0
    assert rows[0].r in (2.67, 2.68)


def test_elapsed_seconds_negative_and_whole(spark):
    df = spark.createDataFrame([(datetime.datetime(2025, 1, 1, 0, 0, 0), datetime.datetime(2025, 1, 1, 0, 1, 30)),
                                (datetime.datetime(2025, 1, 1, 0, 5), datetime.datetime(2025, 1, 1, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r.s for r in df.select(C.elapsed_seconds("a", "b").alias("s")).collect()] == [90, -240]


def test_file_basename(spark):
    assert _one(spark, C.file_basename("v"), "s3://bucket/raw/trips-2025-01.parquet") == "trips-2025-01.parquet"
