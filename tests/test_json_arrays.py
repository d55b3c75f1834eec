import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aurum.session import scratch_path
from aurum.sources import json_arrays as J


def line(items):
    return "[" + ",".join(items) + "]"


@pytest.mark.parametrize("text,pieces", [
    ('[{"a":1},{"a":2]', ['{"a":1}', '{"a":2']),
    ('[{"a":1,{"a":2},{"a":3}]', ['{"a":1', '{"a":2}', '{"a":3}']),
    ('[{"a":"x},{"a":"y, [z"},{"a":3}]', ['{"a":"x}', '{"a":"y, [z"}', '{"a":3}']),
    ('[{"a":1}},{"a":2}]', ['{"a":1}}', '{"a":2}']),
    ('[{"a":[{"b":1},{"b":2}], oops},{"a":2}]', ['{"a":[{"b":1},{"b":2}], oops}', '{"a":2}']),
    ('[{"a":1},{"a":2}', ['{"a":1}', '{"a":2}']),
    ('[1, "two, three", nope, null, [4,5], {"a":6}]', ["1", '"two, three"', "nope", "null", "[4,5]", '{"a":6}']),
    ('[{"a":"\\"},{"},<html>,{"a":"]"}]', ['{"a":"\\"},{"}', "<html>", '{"a":"]"}']),
    ("not an array", ["not an array"]), ("[", []), ("[,]", [""]),
])
def test_split_elements(text, pieces):
    assert J.split_elements(text) == pieces


def test_every_single_break_costs_one_element(spark):
    """Elements broken in one of several ways; all others come through, in order, and counts agree."""
    rnd = random.Random(3)
    lines, want = [], []
    for n in range(60):
        items, hurt = [], rnd.randrange(1, 8)
        for k in range(8):
            whole = json.dumps({"id": 100 * n + k, "t": rnd.choice(["plain", "a, b", "{brace", "]", 'q"q', "\\", "né"]),
                                "kids": [{"x": 1}, {"y": [2, 3]}][:rnd.randrange(3)]})
            bad = {0: whole[:-1], 1: whole.replace('"t": "', '"t": ', 1), 2: "<html>", 3: whole + "}", 4: "nul"}[rnd.randrange(5)]
            items.append(bad if k == hurt else whole)
            want.append((n, k, None if k == hurt else 100 * n + k))
        lines.append(line(items) if rnd.random() < 0.8 else line(items)[:-1])
    path = scratch_path(spark, "arrays")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    got = J.land_json_arrays(spark, path).collect()
    seen = sorted((r._line_no, r._element_no, None if r._reject_reason else json.loads(r._raw)["id"]) for r in got)
    assert seen == want
    assert {r._reject_reason for r in got} == {None, J.R_ELEMENT}


def test_lines_that_are_no_arrays_nulls_and_blanks(spark):
    lines = ["[]", "", "  ", "service down", '{"a":1}', "[null,1]", '[1][2]', "[{\"a\":1}] tail"]
    path = scratch_path(spark, "arrays")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    got = sorted((r._line_no, r._element_no, r._raw, r._reject_reason) for r in J.land_json_arrays(spark, path).collect())
    assert got[:4] == [(3, 0, "service down", J.R_LINE), (4, 0, '{"a":1}', J.R_LINE), (5, 0, "null", None), (5, 1, "1", None)]
    assert {g[0] for g in got[4:]} == {6, 7} and any(g[3] == J.R_ELEMENT for g in got[4:])


def test_empty_file(spark):
    path = scratch_path(spark, "arrays")
    spark.createDataFrame([], "value string").write.text(path)
    assert J.land_json_arrays(spark, path).count() == 0


def test_python_gets_lines_in_batches_bounded_in_bytes(spark, monkeypatch):
    """Ten megabytes of broken lines in one split: every batch stays near the bound."""
    path = scratch_path(spark, "arrays")
    broken = F.concat(F.lit('[{"a":"'), F.repeat(F.lit("x"), 100_000), F.lit('"]'))
    spark.range(0, 100, 1, 1).select(broken.alias("value")).write.text(path)

    @F.pandas_udf("array<string>")
    def size(lines: pd.Series) -> pd.Series:
        return pd.Series([[str(lines.str.len().sum())]] * len(lines))
    monkeypatch.setattr(J, "_split", size)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    try:
        sizes = [int(r._raw) for r in J.land_json_arrays(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(sizes) == 100 and max(sizes) <= J.BATCH_BYTES + 200_000
