import math
import random
import re

import pytest

from aurum.llm import quality_rules as Q

SCHEMA = "doc_id bigint, text string"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def brute_counts(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at, covered = {}, set()
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    for starts in at.values():
        if len(starts) > 1:
            covered.update(i + o for i in starts for o in range(3))
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_capitals": sum("A" <= c <= "Z" for c in t), "n_distinct": len(set(w)), "n_ends": sum(c in ".!?" for c in t)}


def brute_votes(c):
    def holds(sql):
        return eval(sql.replace(" AND ", " and ").replace(" OR ", " or ").replace(" = ", " == "), {}, c)
    return tuple(-1 if holds(bad) else 1 if holds(good) else 0 for good, bad in Q.RULES.values())


def brute(rows):
    """(doc_id, base_failed, kept) by an EM over documents, not patterns."""
    cs = [brute_counts(t) for _, t in rows]
    vs = [brute_votes(c) for c in cs]
    failed = [c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"] for c in cs]
    k = len(Q.RULES)
    prior, good, bad = Q.START_PRIOR, [Q.START_ACCURACY] * k, [Q.START_ACCURACY] * k

    def odds(v):
        return math.log(prior / (1 - prior)) + sum(
            math.log(good[i] / (1 - bad[i])) if x == 1 else math.log((1 - good[i]) / bad[i]) if x == -1 else 0
            for i, x in enumerate(v))

    def clip(x, b):
        return min(b[1], max(b[0], x))
    fit = [v for v, f in zip(vs, failed) if not f]
    for _ in range(Q.ITERATIONS):
        g = [1 / (1 + math.exp(-odds(v))) for v in fit]
        prior = clip((sum(g) + 1) / (len(fit) + 2), Q.PRIOR)
        rate = lambda share, i, s: clip((sum(x for x, v in zip(share, fit) if v[i] == s) + 1)
                                        / (sum(x for x, v in zip(share, fit) if v[i]) + 2), Q.ACCURACY)
        h = [1 - x for x in g]
        good, bad = [rate(g, i, 1) for i in range(k)], [rate(h, i, -1) for i in range(k)]
    return [(d, f, not f and odds(v) >= 0) for (d, _), v, f in zip(rows, vs, failed)], (prior, good, bad)


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 160))]
        kind = rnd.randrange(8)
        if kind == 0:
            w = [x + "###" for x in w]
        elif kind == 1:
            w = [y for x in w for y in (x, "|")]
        elif kind == 2:
            w = [x.upper() + "!!" for x in w]
        elif kind == 3:
            w = w[:10] * 8
        else:
            w = [x + "." if j % 9 == 8 else x for j, x in enumerate(w)]
        rows.append((i, "".join(x + ("\n" if j % 13 == 12 else " ") for j, x in enumerate(w))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_votes_and_em_agree_with_brute_force(spark, seed):
    rows = corpus(seed)
    want, (prior, good, bad) = brute(rows)
    got = {r.doc_id: r for r in Q.quality(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert [(r.doc_id, r.base_failed, r.kept) for r in sorted(got.values(), key=lambda r: r.doc_id)] == want
    assert all(got[d][c] == brute_counts(t)[c] for d, t in rows for c in Q.COUNTS)
    trust = Q.learn(Q._counted(spark.createDataFrame(rows, SCHEMA).select(Q._once(Q.counts(Q.F.col("text"))))))
    assert trust.prior == pytest.approx(prior) and list(trust.good) == pytest.approx(good) and list(trust.bad) == pytest.approx(bad)
    assert 0 < sum(k for _, f, k in want) < sum(not f for _, f, _ in want)


def test_windows_that_overlap_themselves_count_every_word_once(spark):
    texts = ["a a a a", "a a a", "a b c x a b c", "a b c a b c a b c", "a b a b a", "x a b c d e a b c d y", "", None, "a\x0bb\x0cc\ta b c"]
    got = Q.quality(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert {r.doc_id: r.n_repeat_words for r in got} == {i: brute_counts(t)["n_repeat_words"] for i, t in enumerate(texts)}


def test_nulls_repeats_empty_long_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Q.quality(empty).count() == 0 and Q.filter_quality(empty).count() == 0
    rnd = random.Random(3)
    long = " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(60)) + ("." if i % 11 == 0 else "") for i in range(120_000))
    clean = corpus(5, 40)
    rows = [(None, None, 1, "a"), (None, "", 2, "b"), (7, long, 3, "c"), (7, long, 3, "c")]
    rows += [(10 + d, t, d, None) for d, t in clean]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, counts int, vote_0 string")
    out = Q.quality(df).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[None].n_words == 0 and by[None].base_failed and not by[None].kept
    assert {c: by[7][c] for c in Q.COUNTS} == brute_counts(long)
    kept = Q.filter_quality(df)
    assert kept.columns == df.columns
    assert sorted(r.counts for r in kept.collect()) == sorted(
        r[2] for r, (_, _, k) in zip(rows, brute([(r[0], r[1]) for r in rows])[0]) if k)


def test_labelled_documents(spark):
    """Junk goes and clean documents stay, judged by labels that the method never sees."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality IS NOT NULL")
    r = Q.quality(docs).join(labels, "doc_id").filter("NOT base_failed").groupBy("quality").agg(
        Q.F.avg(Q.F.col("kept").cast("int")).alias("kept")).collect()
    share = {x.quality: x.kept for x in r}
    assert share[1] >= 0.99 and share[0] <= 0.2
