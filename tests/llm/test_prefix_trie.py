import hashlib
import random
import zlib

import pytest

from aurum.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def turns_of(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


def brute(convs):
    members = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    kids, out = {}, []
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def sums(p):
        below = [sums(k) for k in kids.get(p, [])]
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        leaves, saved = sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)
        ends = sorted(c for c in members[p] if len(convs[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
        return leaves, saved
    if members:
        sums(())
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in T.prefix_trie(df, **kw).select(*T.NODE).collect()), key=str)


def corpus(seed, convs=90, alphabet=3, longest=12):
    rnd, rows = random.Random(seed), []
    for c in range(convs):
        seq = [(rnd.choice(["user", "assistant", None]), rnd.choice("ab é"[:alphabet])) for _ in range(rnd.randint(1, longest))]
        if rnd.random() < 0.5 and c:
            seq = [("system", "long shared prompt")] * 3 + seq[:2]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(seq)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,suffixes", [(1, 2), (2, 5), (3, 2000)])
def test_nodes_agree_with_brute_force(spark, seed, suffixes):
    rows = corpus(seed)
    assert got(spark, rows, suffixes=suffixes) == brute(turns_of(rows))


@pytest.mark.parametrize("segment", [1, 3])
def test_segments(spark, monkeypatch, segment):
    """Long conversations go through in segments: shared, alone, ending at a border."""
    monkeypatch.setattr(T, "SEGMENT", segment)
    rows = corpus(7, convs=30, alphabet=2, longest=9)
    rows += [(100 + c, i, "u", "same") for c in range(4) for i in range(11 + (c == 3))]
    assert got(spark, rows, suffixes=3) == brute(turns_of(rows))


def test_nulls_ties_repeats_negative_ids_and_lost_heads(spark):
    rows = [(None, 1, "u", "x"), (5, None, None, None), (5, 1, "u", "b"), (5, 1, "u", "b"), (5, 1, "u", "a"), (7, 2, "u", ""),
            (7, None, "u", None), (7, None, "", "z"), (-3, 1, "u", "q"), (-7, 0, "u", "q"), (-5, 0, "s", "t"), (0, 0, "s", "t"),
            (11, 0, "u", "only"), (12, 0, "u", "only"), (13, 0, "u", "only"), (14, 0, "u", "only")]
    assert got(spark, rows) == brute(turns_of(rows))


def test_empty_one_long_and_clashing_columns(spark):
    assert got(spark, []) == []
    rows = [(0, i, "u", f"turn {i}") for i in range(700)] + [(1, i, "u", f"turn {i}") for i in range(690)] + [(2, 0, "a", "w " * 200_000)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", pos int, key string, depth int")
    assert got(spark, df) == brute(turns_of(rows))


def test_hot_class_is_hashed_as_runs(spark, monkeypatch):
    monkeypatch.setattr(T, "RUN_IDS", 7)
    rows = [(5 * c, i, "u", "hot") for c in range(120) for i in range(2)] + [(5 * c + 1, i, "u", f"t{c}") for c in range(60) for i in range(12)]
    assert got(spark, rows, suffixes=10) == brute(turns_of(rows))
