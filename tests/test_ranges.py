import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from aurum.session import scratch_path
from aurum.sources import ranges as R


def put(spark, texts):
    """Files of exactly these bytes in the shared folder."""
    import os
    folder = scratch_path(spark, "ranges").replace("file://", "")
    os.makedirs(folder)
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as f:
            f.write(text)
    return folder


@pytest.fixture
def split_size(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in keys}

    def use(n):
        for k in keys:
            spark.conf.set(k, str(n))
    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def corpus(seed, n):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        cell = lambda: rnd.choice(["", "a", "x y", "né", 'q"q', "a,b", "l1\nl2", "\n", "5\" pipe", '"', "l1\r\nl2", "long\n" * 9, "''"])
        rows.append([str(i), cell(), cell(), cell()])
    out = io.StringIO()
    csv.writer(out, lineterminator=rnd.choice(["\n", "\r\n"])).writerows([["id", "a", "b", "c"], *rows])
    return rows, out.getvalue()


@pytest.mark.parametrize("size", [40, 170, 1 << 20])
def test_records_do_not_depend_on_splits(spark, split_size, size):
    texts = {f"f{k}.csv": corpus(k, 60) for k in range(3)}
    folder = put(spark, {f: t for f, (_, t) in texts.items()})
    split_size(size)
    got = R.quoted_cells(R.quoted_records(spark, folder), "id string, a string, b string, c string").collect()
    have = sorted((r._file.rsplit("/", 1)[1], r._record_no, r.id, r.a or "", r.b or "", r.c or "", r._corrupt_record) for r in got)
    assert have == sorted((f, i + 1, *row, None) for f, (rows, _) in texts.items() for i, row in enumerate(rows))
    if size == 40:
        assert R._lines(spark, folder).select("_file", "_block").distinct().count() > 20


def test_equal_to_the_one_task_reader(spark, split_size):
    text = 'id,a\n1,"x\ny"\n2,5" pipe\n3,"he said ""no"""\n\n4\n5,a,extra\n6,"last"'
    folder = put(spark, {"m.csv": text})
    schema = "id string, a string, _corrupt_record string"
    one = (spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
                .option("columnNameOfCorruptRecord", "_corrupt_record").csv(folder))
    want = sorted((r.id, r.a) for r in one.collect())
    split_size(9)
    got = R.quoted_cells(R.quoted_records(spark, folder), "id string, a string").collect()
    assert sorted((r.id, r.a) for r in got) == want
    assert {r.id: r._corrupt_record for r in got if r._corrupt_record} == {"4": "4", "5": "5,a,extra"}


def test_unclosed_quote_empty_file_and_other_delimiter(spark, split_size):
    folder = put(spark, {"a.csv": 'k;v\n1;"never closed\nmore\nand more\n', "b.csv": "", "c.csv": "k;v\n7;\"x;\ny\"\n"})
    split_size(8)
    got = R.quoted_records(spark, folder, delimiter=";").collect()
    assert sorted((r._file[-5:], r._record_no, r._raw) for r in got) == [
        ("a.csv", 0, "k;v"), ("a.csv", 1, '1;"never closed\nmore\nand more'), ("c.csv", 0, "k;v"), ("c.csv", 1, '7;"x;\ny"')]


@pytest.mark.parametrize("size", [16, 100, 1 << 20])
def test_line_numbers_are_dense_and_do_not_depend_on_splits(spark, split_size, size):
    rnd = random.Random(1)
    texts = {f"l{k}.txt": [f"{k}-{i}" + "x" * rnd.randrange(20) for i in range(80)] for k in range(2)}
    folder = put(spark, {f: "\n".join(v) + "\n" for f, v in texts.items()})
    split_size(size)
    got = R.numbered_lines(spark, folder)
    assert sorted((r._file.rsplit("/", 1)[1], r._line_no, r._raw) for r in got.collect()) == sorted(
        (f, i, x) for f, v in texts.items() for i, x in enumerate(v))
    assert got.filter(F.col("_line_no") == 0).count() == 2


def test_many_splits_are_put_in_order_again(spark, split_size, monkeypatch):
    monkeypatch.setattr(R, "SPLITS", 3)
    rows, text = corpus(9, 80)
    folder = put(spark, {"one.csv": text})
    split_size(50)
    got = R.quoted_cells(R.quoted_records(spark, folder), "id string, a string, b string, c string").collect()
    assert sorted((r._record_no, r.id, r.a or "") for r in got) == [(i + 1, r[0], r[1]) for i, r in enumerate(rows)]
