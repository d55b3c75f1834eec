"""Property tests: one survivor per key whatever the rows, quarantine conserves rows."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aurum.operators.dedup import keep_first, label_survivors
from aurum.operators.quarantine import conservation, tag_reasons

MAYBE = st.one_of(st.none(), st.integers(0, 2))
ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), MAYBE, MAYBE,
                          st.one_of(st.none(), st.floats(-10, 10, allow_nan=False))), max_size=30)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(ROWS)
def test_every_key_has_exactly_one_survivor(spark, rows):
    """Exact copies, NULL keys and NULL order values included."""
    landed = [(*r, "f", i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(landed, "k int, t int, o int, v double, _source_file string, _record_no bigint")
    lab = label_survivors(df, ["k"], ["t", "o"]).collect()
    low = lambda x: (x is not None, x or 0)  # noqa: E731 - NULLs first
    want = {}
    for r in landed:
        want[r[0]] = min(want.get(r[0], r), r, key=lambda x: (low(x[1]), low(x[2]), x[5]))
    assert len(lab) == len(rows)
    assert sorted(r._record_no for r in lab if r._survivor) == sorted(r[5] for r in want.values())
    assert keep_first(df, ["k"], ["t", "o", "_record_no"]).count() == len(want)


@SETTINGS
@given(ROWS)
def test_quarantine_conserves_rows(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, o int, v double")
    tagged = tag_reasons(df, [("neg", F.col("v") < 0), ("big", F.col("v") > 5)], null_reason="null")
    reason = F.col("_reject_reason")
    c = conservation(df, tagged.filter(reason.isNull()), tagged.filter(reason.isNotNull())).first()
    assert c.balanced and c.input_rows == len(rows)
    assert c.quarantined_rows == sum(1 for r in rows if r[3] is None or r[3] < 0 or r[3] > 5)
