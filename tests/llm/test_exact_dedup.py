import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aurum.llm import exact_dedup as X

SCHEMA = "doc_id bigint, text string"


def brute(rows):
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, i, d))
    out = []
    for k, members in groups.items():
        best = min(members)
        for m in members:
            out.append((m[4], best[4], len(members), m[3] == best[3], hashlib.sha256(k.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    return sorted((tuple(r) for r in X.exact_dedup(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()), key=str)


def test_nulls_white_space_ties_and_repeats(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "a\x0bb"), (3, "a  b"), (4, None), (5, ""), (6, " "), (None, "x"), (None, "x"),
            (7, "A b"), (8, "é x"), (9, "éx"), (10, "a b")]
    have = got(spark, rows)
    want = brute(rows)
    assert [r[:3] + r[4:] for r in have] == [r[:3] + r[4:] for r in want]
    assert sum(r[3] for r in have) == sum(r[3] for r in want) == 6


def test_hot_group_is_a_verified_heavy_hitter(spark):
    rows = [(i, "hot copy") for i in range(900)] + [(1000 + i, f"t{i}") for i in range(1800)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    heavy = X.heavy_winners(X.digests(df)).collect()
    assert [r.group_size for r in heavy] == [900] and heavy[0].keep.doc_id == 0
    assert X.exact_dedup(df).filter("kept").count() == 1801


def test_empty_long_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert X.exact_dedup(empty).count() == 0 and X.drop_duplicates(empty).count() == 0
    long = "word " * 200_000
    df = spark.createDataFrame([(1, long, 7, "k"), (2, long.strip(), 8, "l"), (3, None, 9, None)],
                               "doc_id bigint, text string, digest int, n string")
    out = X.drop_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.digest, r.n) for r in out.collect()) == [(1, 7, "k"), (3, 9, None)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.text("ab \n", max_size=4))), max_size=25))
def test_kept_rows_agree_with_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    kept = X.drop_duplicates(df).collect()
    keys = [re.sub(r"[ \n]", "", r.text or "") for r in kept]
    assert len(keys) == len(set(keys)) == len({re.sub(r"[ \n]", "", t or "") for _, t in rows})
    want = {(r[1], r[4]) for r in brute(rows)}
    assert {(r.doc_id, hashlib.sha256(k.encode()).hexdigest()) for r, k in zip(kept, keys)} == want
