"""N-gram Jaccard join with a token-group matrix.

Documents link when 100 * |A & B| >= 75 * |A | B| for their sets of 5-word
shingles; the result names each document's connected component and counts its links.
Links between different texts are never lost; equal sets are one *class* and are not
expanded into pairs.

1. **Sets and shared tokens.**  One pass over the whole texts makes the sets as
   64-bit hashes.  A class can only link when three quarters of its tokens occur
   in another class too, so the pass also ships every token once per task (tokens
   that already meet within the task as one flagged entry, so a token in a third
   of all documents does not land in one task) and counts, per class, the tokens
   that are shared.  Tokens travel as hash range and 32 more bits; a clash can
   only let a document through to the exact steps.  Most documents end here.
2. **Groups.**  The remaining classes write their sets.  Tokens are ordered
   ordinary-before-frequent, then by hash; with |A| - ceil(.75 |A|) + 1 first tokens
   (the prefix) two linked sets always share one.  The order is the same for all, so
   any list of frequent tokens is right; the list holds at most ``HOT_TOKENS`` of the
   most frequent.
   A class joins the group of the prefix token that most classes have: similar
   documents come together.  Groups are cut into blocks of at most ``BLOCK`` classes, a large
   one in order of the distance to one of its classes (``families``): by the triangle
   inequality most pairs of a tight family are known to link without being looked at.
3. **Matrix.**  (token, block) rows say which blocks hold a prefix token.  Blocks of different
   groups that share one, and those of one group that the distances leave open, are
   compared: in the task that holds both, the token union of a block
   gives an upper bound of every query class's overlap with *any* member,
   and only blocks whose bound qualifies are opened and counted exactly.  The task
   returns, per class, its place in a spanning forest of the links and the documents
   it links with, never the pairs.
4. **Components.**  The forests are contracted by alternating large-star and
   small-star steps until they are stars.

A document without words or text has an empty set and links with nothing; with
fewer than five words its whole sequence is one shingle.  component_id is the
smallest doc_id of the component, null only if no member has a doc_id.  n_links is the
number of other rows that a row links with: the copies of every class its class links
with, and the other copies of its own.  Repeated rows are copies.  Only doc_id and text are read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.ngram_sets import shingle_sets
from aurum.llm.session_tables import broadcast_if_small, packed, unpacked, written
from aurum.llm.textarrays import bounded_batches, release_memory
from aurum.operators.numbering import numbered

#: A link needs NUM * union <= 100 * intersection.
NUM, DEN = 75, 100
BLOCK = 256
#: A token in at least so many of the remaining classes counts as frequent ...
HOT_FROM = 32
#: ... and so many of the most frequent are ordered last (any choice is exact).
HOT_TOKENS = 200_000
#: Tokens of the sets that a task compares at a time, about.
CELLS = 400_000
#: Levels of the distance to a group's pivot; a quarter of them is the link distance.
LEVELS = 1024
#: Tokens that one hash range of the first pass holds, about, and bytes of text a token.
RANGE_TOKENS, TOKEN_BYTES = 2_000_000, 7
#: Tokens gathered by a task before they are sorted and shipped.
FLUSH = 1_500_000
#: Bytes of packed tokens that a task hands over at a time, about, and hash intervals that a
#: range is sorted by, one after the other.
HANDED_BYTES, INTERVALS = 2 << 20, 8
_MANY = 0xFFFF
_U = np.uint64
_LOW = _U((1 << 32) - 1)

_FIRST = pa.schema([("kind", pa.int8()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
                    ("fp", pa.binary()), ("cls", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])
_FIRST_SQL = "kind tinyint, slot int, doc_id bigint, text_key bigint, fp binary, cls bigint, n bigint, payload binary"
DOC, TOKENS, COUNT = 0, 1, 2


def least_overlap(n: int) -> int:
    """Tokens a set of n must share with a set it links with."""
    return -(-NUM * n // DEN)


def fingerprint(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _class_id(fp: bytes) -> int:
    return int.from_bytes(fp[:8], "little", signed=True)


# ------------------------------------------------- 1. sets and shared tokens
def _pack(tok: np.ndarray, idx: np.ndarray, classes: np.ndarray) -> bytes:
    used = idx[idx != _MANY]
    mine, inv = np.unique(used, return_inverse=True)
    local = np.full(len(idx), _MANY, np.uint16)
    local[idx != _MANY] = inv
    return b"".join((np.array([len(tok), len(mine)], np.uint32).tobytes(), classes[mine].tobytes(),
                     (tok & _LOW).astype(np.uint32).tobytes(), local.tobytes()))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, class, flag for more than one class) of a packed run of tokens."""
    m, k = np.frombuffer(blob, np.uint32, 2).tolist()
    at = 8
    classes = np.frombuffer(blob, np.int64, k, at)
    low = np.frombuffer(blob, np.uint32, m, at + 8 * k)
    local = np.frombuffer(blob, np.uint16, m, at + 8 * k + 4 * m)
    many = local == _MANY
    cls = np.zeros(m, np.int64)
    cls[~many] = classes[local[~many]]
    return low, cls, many


def _rows(**cols) -> pa.RecordBatch:
    size = len(next(iter(cols.values())))
    return pa.record_batch([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(size, f.type) for f in _FIRST],
                           schema=_FIRST)


class _Outbox:
    """Sets of one task, shipped as packed tokens by hash range."""

    def __init__(self, bits: int):
        self.bits, self.sets, self.fps, self.size = bits, [], {}, 0

    def add(self, fp: bytes, s: np.ndarray) -> None:
        if fp not in self.fps:
            self.fps[fp] = len(self.sets)
            self.sets.append(s)
            self.size += len(s)

    @property
    def ready(self) -> bool:
        return self.size >= FLUSH or len(self.sets) >= _MANY - 1

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.sets:
            return
        classes = np.array([_class_id(fp) for fp in self.fps], np.int64)
        tok = np.concatenate(self.sets)
        idx = np.repeat(np.arange(len(self.sets), dtype=np.uint16), [len(s) for s in self.sets])
        self.sets, self.fps, self.size = [], {}, 0
        order = np.argsort(tok)
        tok, idx = tok[order], idx[order]
        del order
        start = np.flatnonzero(np.concatenate(([True], tok[1:] != tok[:-1])))
        length = np.diff(np.append(start, len(tok)))
        # tokens that meet here: counted here, shipped once
        counts = np.bincount(idx[np.repeat(length > 1, length)], minlength=len(classes))
        hit = np.flatnonzero(counts)
        if len(hit):
            yield _rows(kind=np.full(len(hit), COUNT, np.int8), slot=(hit % (1 << self.bits)).astype(np.int32),
                        cls=classes[hit], n=counts[hit].astype(np.int64))
        one = np.where(length == 1, idx[start], np.uint16(_MANY)).astype(np.uint16)
        tok = tok[start]
        del start, length, idx
        edge = np.searchsorted(tok, np.arange(1 << self.bits, dtype=np.uint64) << _U(64 - self.bits))
        edge = np.append(edge, len(tok))
        slots, blobs, held = [], [], 0
        for b in np.flatnonzero(np.diff(edge)).tolist():
            slots.append(b)
            blobs.append(_pack(tok[edge[b]:edge[b + 1]], one[edge[b]:edge[b + 1]], classes))
            held += len(blobs[-1])
            if held >= HANDED_BYTES:
                yield _rows(kind=np.full(len(slots), TOKENS, np.int8), slot=slots, payload=blobs)
                slots, blobs, held = [], [], 0
        if slots:
            yield _rows(kind=np.full(len(slots), TOKENS, np.int8), slot=slots, payload=blobs)


def _first_pass(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, serial = _Outbox(bits), 0
        for batch in batches:
            fps, ns = [], []
            for s in shingle_sets(batch.column("text")):
                fp = fingerprint(s)
                fps.append(fp)
                ns.append(len(s))
                if len(s):
                    box.add(fp, s)
                if box.ready:
                    yield from box.flush()
            k = len(fps)
            if k:
                yield _rows(kind=np.zeros(k, np.int8), slot=((serial + np.arange(k)) % (1 << bits)).astype(np.int32),
                            doc_id=batch.column("doc_id"), text_key=batch.column("text_key"),
                            fp=fps, cls=[_class_id(x) for x in fps], n=ns)
            serial += k
        yield from box.flush()
        release_memory()
    return run


def _count_shared(table: pa.Table) -> pa.Table:
    """One hash range: passes document and count rows on, and counts for every
    class the tokens that another class has as well."""
    kind = table.column("kind").to_numpy()
    keep = table.filter(pa.array(kind != TOKENS)).drop_columns(["payload", "slot"])
    blobs = table.column("payload").filter(pa.array(kind == TOKENS))
    del table
    if not len(blobs):
        return keep
    at = np.cumsum([0] + [int(np.frombuffer(b.as_buffer(), np.uint32, 1)[0]) for b in blobs])
    tok, cls, many = np.empty(at[-1], np.uint32), np.empty(at[-1], np.int64), np.empty(at[-1], bool)
    for b, i, j in zip(blobs, at[:-1].tolist(), at[1:].tolist()):
        tok[i:j], cls[i:j], many[i:j] = _unpack(b.as_buffer())
    del blobs
    found = []
    for part in range(INTERVALS):                        # what a sort takes is several times its tokens
        inside = np.flatnonzero(tok // np.uint32((1 << 32) // INTERVALS) == part)
        found.append(_shared_classes(tok[inside], cls[inside], many[inside]))
    del tok, cls, many
    release_memory()
    ids, n = np.unique(np.concatenate(found), return_counts=True)
    nul = lambda t: pa.nulls(len(ids), t)
    counts = pa.table([pa.array(np.full(len(ids), COUNT, np.int8)), nul(pa.int64()), nul(pa.int64()),
                       nul(pa.binary()), pa.array(ids), pa.array(n.astype(np.int64))], schema=keep.schema)
    return pa.concat_tables([keep, counts])


def _shared_classes(tok: np.ndarray, cls: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The class of every token that another class has as well, once for each of its tokens."""
    if not len(tok):
        return cls
    order = np.argsort(tok)
    tok, cls, many = tok[order], cls[order], many[order]
    start = np.flatnonzero(np.concatenate(([True], tok[1:] != tok[:-1])))
    shared = np.logical_or.reduceat(many, start) | (
        np.minimum.reduceat(np.where(many, np.iinfo(np.int64).max, cls), start)
        < np.maximum.reduceat(np.where(many, np.iinfo(np.int64).min, cls), start))
    pick = np.repeat(shared, np.diff(np.append(start, len(tok)))) & ~many
    tok, cls = tok[pick], cls[pick]
    order = np.lexsort((tok, cls))
    tok, cls = tok[order], cls[order]
    first = np.ones(len(cls), bool)                     # copies in several tasks: one token once
    first[1:] = (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])
    return cls[first]


# ------------------------------------------------------------- 2. groups
def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[int, np.ndarray] = {}
        for s in shingle_sets(batch.column("text")):
            if len(s):
                seen.setdefault(_class_id(fingerprint(s)), s)
        if seen:
            sets = list(seen.values())
            offs = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            toks = pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.record_batch([pa.array(list(seen), pa.int64()), toks], names=["cls", "toks"])
    release_memory()


def _prefixes(hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = hot.value
        for batch in batches:
            lists = batch.column("toks")
            offs = lists.offsets.to_numpy()
            flat = lists.values.to_numpy().view(np.uint64)
            out, lens = [], []
            for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                s = flat[a:b]
                at = np.searchsorted(frequent, s)
                is_hot = frequent[np.minimum(at, len(frequent) - 1)] == s if len(frequent) else np.zeros(len(s), bool)
                p = len(s) - least_overlap(len(s)) + 1
                out.append(np.concatenate((s[~is_hot], s[is_hot]))[:p])
                lens.append(len(out[-1]))
            if out:
                yield pa.record_batch([pa.array(np.repeat(batch.column("cls").to_numpy(), lens)),
                                       pa.array(np.concatenate(out).view(np.int64))], names=["cls", "tok"])
    return run


# ------------------------------------------------------------- 3. matrix
class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


class _Block:
    """A block's members with its column of the matrix: the token union, and who has each."""

    def __init__(self, cls: list[int], sets: list[np.ndarray], copies: np.ndarray):
        self.cls, self.copies = cls, copies
        self.links = np.zeros(len(cls), np.int64)
        self.n = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        who = np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(flat, kind="stable")
        self.flat, self.who_flat, self.who = flat, who, who[order]
        self.union, self.at = np.unique(flat[order], return_index=True)
        self.at = np.append(self.at, len(flat))
        self.first = np.concatenate(([0], np.cumsum(self.n)))


def _open(a: _Block, b: _Block, forest: _Forest) -> None:
    """Links every class of ``a`` with those of ``b`` that it is similar to, and adds
    to both sides' ``links`` the copies of the classes found there."""
    at = np.minimum(np.searchsorted(b.union, a.flat), len(b.union) - 1)
    hit = b.union[at] == a.flat
    bound = np.bincount(a.who_flat[hit], minlength=len(a.cls))
    need = -(-NUM * np.maximum(a.n, b.n.min()) // DEN)      # a link shares 75 % of the larger set
    need = np.maximum(need, -(-NUM * (a.n + b.n.min()) // (DEN + NUM)))
    for q in np.flatnonzero(bound >= need).tolist():
        lo, hi = a.first[q], a.first[q + 1]
        cols = at[lo:hi][hit[lo:hi]]
        start, size = b.at[cols], b.at[cols + 1] - b.at[cols]
        take = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        both = np.bincount(b.who[take], minlength=len(b.cls))
        found = np.flatnonzero(DEN * both >= NUM * (a.n[q] + b.n - both))
        if a is b:                                          # every pair comes from both its ends
            found = found[found != q]
        else:
            b.links[found] += a.copies[q]
        a.links[q] += b.copies[found].sum()
        for m in found.tolist():
            forest.join(a.cls[q], b.cls[m])


def _open_pairs(table: pa.Table) -> pa.Table:
    """All block pairs of one task: (a, b, block, cls, toks, copies) rows; returns for
    every linked class (u, v, links): its root in the forest, the documents linked with here."""
    a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
    block, cls = table.column("block").to_numpy(), table.column("cls").to_numpy()
    copies = table.column("copies").to_numpy()
    lists = table.column("toks").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    offs, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
    sides: dict[tuple[int, int], dict[int, list[int]]] = {}
    for i, (x, y, k) in enumerate(zip(a.tolist(), b.tolist(), block.tolist())):
        sides.setdefault((x, y), {}).setdefault(k, []).append(i)

    forest, links = _Forest(), Counter()
    for x, y in sorted(sides):
        of = sides[x, y]
        if x in of and y in of:
            made = {k: _Block([int(cls[i]) for i in rows], [flat[offs[i]:offs[i + 1]] for i in rows], copies[rows])
                    for k, rows in of.items()}
            _open(made[x], made[y], forest)
            for side in made.values():
                links.update({side.cls[i]: int(side.links[i]) for i in np.flatnonzero(side.links)})
    release_memory()
    nodes = list(forest.up)
    return pa.table({"u": pa.array(nodes, pa.int64()), "v": pa.array([forest.root(x) for x in nodes], pa.int64()),
                     "links": pa.array([links[x] for x in nodes], pa.int64())})


# --------------------------------------------------------- 4. components
def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node with its component's smallest node, smallest nodes left out."""
    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                     .filter("u <> v").distinct(), "ngram-edges")
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now.c == 0 or (state is not None and tuple(now) == state):
            return e
        state = tuple(now)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = written(small, "ngram-edges")


def links(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """(u, v, links): per class and task a step of a spanning forest of the links between
    classes, and the documents of other classes that the class was found to link with."""
    spark = docs.sparkSession
    share = (seen.filter(F.col("kind") == COUNT).groupBy("cls").agg(F.sum("n").alias("shared")))
    classes = (seen.filter((F.col("kind") == DOC) & (F.col("n") > 0)).groupBy("cls")
                   .agg(F.first("n").alias("n"), F.min("text_key").alias("text_key"), F.count(F.lit(1)).alias("copies")))
    left = written(classes.join(share, "cls").filter(DEN * F.col("shared") >= NUM * F.col("n"))
                          .select("text_key", "cls", "n", "copies"), "ngram-left")
    lengths, copies = left.select("cls", "n"), left.select("cls", "copies")
    left = left.select("text_key").distinct()
    keyed = docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    sets = (keyed.join(broadcast_if_small(left, 2_000_000), "text_key", "left_semi").select("text")
                 .mapInArrow(_set_rows, "cls bigint, toks array<bigint>").dropDuplicates(["cls"]))
    sets = written(sets.join(copies, "cls"), "ngram-sets")

    df = written(sets.select(F.explode("toks").alias("tok")).groupBy("tok").count()
                     .filter(F.col("count") >= HOT_FROM), "ngram-frequent")
    # the steps of the count, from the top, that together hold at most HOT_TOKENS tokens
    step = F.floor(F.log2("count") * 8).cast("int")
    cut, held = None, 0
    for r in df.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("s")).toLocalIterator():
        held += r.c
        if held > HOT_TOKENS:
            break
        cut = r.s
    top = df.filter(step >= cut).select("tok") if cut is not None else df.select("tok").limit(0)
    hot = np.array([r.tok for r in top.toLocalIterator()], np.int64).view(np.uint64)      # at most HOT_TOKENS numbers
    hot = spark.sparkContext.broadcast(np.sort(hot))
    prefix = written(sets.mapInArrow(_prefixes(hot), "cls bigint, tok bigint"), "ngram-prefixes")

    common = prefix.groupBy("tok").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    at = written(prefix.join(common, "tok"), "ngram-shared")
    group = written(at.groupBy("cls").agg(F.max_by("tok", F.struct("c", "tok")).alias("g")), "ngram-groups")
    block, sure, inner = families(group, sets)
    held = written(at.join(block, "cls").select("tok", "cls", "block", "g"), "ngram-held")
    cells = written(inner.unionByName(across(held, block, lengths)), "ngram-cells")
    tokens = cells.join(lengths, "cls").agg(F.sum("n")).first()[0] or 0
    tasks = max(1, math.ceil(tokens / CELLS))
    rows = cells.withColumn("task", F.pmod(F.xxhash64("a", "b"), F.lit(tasks))).join(sets, "cls")
    opened = rows.groupBy("task").applyInArrow(_open_pairs, "u bigint, v bigint, links bigint")
    return written(opened.unionByName(sure), "ngram-links")


def _at_most(steps: str, level: Column, what: str) -> Column:
    """Of the running totals ``steps`` (level, what...), the one at the last level up to ``level``."""
    fit = F.filter(steps, lambda s: s["q"] <= level)
    return F.coalesce(F.get(fit, F.size(fit) - 1)[what], F.lit(0).cast("bigint"))


def families(group: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Blocks (cls, g, block) of the groups, the links that need no opening, and the cells
    (a, b, block, cls) of block pairs of one group that do.

    Jaccard distance is a metric.  A group of more than one block is laid out by the distance d to
    one of its classes: two classes surely link when their distances add up to .25, and
    surely do not when they differ by more.  Blocks are runs in that order, so the blocks that
    surely link with a block are the first ones, and those that may are the next: both ends
    come from running totals over at most ``LEVELS`` levels of the distance."""
    size = group.groupBy("g").agg(F.count(F.lit(1)).alias("members"), F.min("cls").alias("pivot"))
    grouped = written(group.join(size, "g"), "ngram-sized")
    large = grouped.filter(F.col("members") > BLOCK)
    pivots = (size.filter(F.col("members") > BLOCK).select("g", F.col("pivot").alias("cls"))
                  .join(sets.select("cls", F.col("toks").alias("p")), "cls").drop("cls"))
    far = sets.join(broadcast_if_small(large.select("cls", "g")), "cls").join(broadcast_if_small(written(pivots, "ngram-pivots"), 2000), "g")
    both = F.size(F.array_intersect("toks", "p"))
    union = F.size("toks") + F.size("p") - both
    q = F.ceil(F.lit(float(LEVELS)) * (union - both) / union).cast("int")
    far = far.select("cls", "g", "copies", q.alias("q"))
    placed = numbered(far, [F.col("g"), F.col("q"), F.col("cls")], group="g", number="pos")
    placed = written(placed.withColumn("i", F.floor(F.col("pos") / F.lit(BLOCK)).cast("bigint")), "ngram-placed")
    one = grouped.filter(F.col("members") <= BLOCK)
    block = one.select("cls", "g", F.xxhash64("g", F.lit(0).cast("bigint")).alias("block")).unionByName(
        placed.select("cls", "g", F.xxhash64("g", "i").alias("block")))
    block = written(block, "ngram-blocks")

    run = placed.groupBy("g", "i").agg(F.min("q").alias("low"), F.max("q").alias("high"), F.sum("copies").alias("copies"),
                                       F.min("cls").alias("first"))
    run = written(run, "ngram-runs")
    total = Window.partitionBy("g").orderBy("q")
    def steps(level: str) -> DataFrame:  # noqa: E306
        n = run.groupBy("g", F.col(level).alias("q")).agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"))
        n = n.select("g", F.struct("q", F.sum("n").over(total).alias("n"), F.sum("copies").over(total).alias("copies")).alias("s"))
        return n.groupBy("g").agg(F.sort_array(F.collect_list("s")).alias(f"by_{level}"))        # at most LEVELS + 1
    quarter = LEVELS // 4
    ends = run.join(steps("low"), "g").join(steps("high"), "g").select(
        "g", "i", _at_most("by_high", quarter - F.col("high"), "n").alias("sure"),
        _at_most("by_high", quarter - F.col("high"), "copies").alias("copies_there"),
        _at_most("by_low", quarter + F.col("high"), "n").alias("end"))
    ends = written(ends, "ngram-ends")
    heads = run.filter("i = 0").select("g", F.col("first").alias("v"))
    known = placed.join(broadcast_if_small(ends.filter("sure > 0").join(heads, "g")), ["g", "i"])
    sure = known.select(F.col("cls").alias("u"), "v", (
        F.col("copies_there") - F.when(F.col("i") < F.col("sure"), F.col("copies")).otherwise(0)).alias("links"))

    first = F.greatest("i", "sure")
    pairs = ends.filter(first < F.col("end")).select("g", "i", F.explode(F.sequence(first, F.col("end") - 1)).alias("j"))
    pairs = written(pairs.select(F.xxhash64("g", "i").alias("a"), F.xxhash64("g", "j").alias("b")), "ngram-pairs")
    sides = pairs.select("a", "b", F.col("a").alias("block")).unionByName(
        pairs.filter("a <> b").select("a", "b", F.col("b").alias("block")))
    alone = one.filter("members > 1").select(F.xxhash64("g", F.lit(0).cast("bigint")).alias("block"), "cls")
    inner = sides.join(block, "block").select("a", "b", "block", "cls").unionByName(
        alone.select(F.col("block").alias("a"), F.col("block").alias("b"), "block", "cls"))
    return block, sure, inner


def across(held: DataFrame, block: DataFrame, lengths: DataFrame) -> DataFrame:
    """Cells (a, b, block, cls) of block pairs of different groups that share a prefix token.

    Blocks meet first, as distinct (token, block) rows, and only where their lengths allow a
    link; then each side's classes that hold one of the tokens come in."""
    span = written(block.join(lengths, "cls").groupBy("block").agg(F.min("n").alias("least"), F.max("n").alias("most")), "ngram-spans")
    matrix = held.select("tok", "block", "g").distinct()
    wide = matrix.groupBy("tok").agg(F.count_distinct("g").alias("c")).filter("c > 1").select("tok")
    matrix = written(matrix.join(wide, "tok").join(span, "block"), "ngram-matrix")
    left = matrix.select("tok", F.col("block").alias("a"), F.col("g").alias("ga"), F.col("least").alias("la"), F.col("most").alias("ma"))
    right = matrix.select("tok", F.col("block").alias("b"), F.col("g").alias("gb"), F.col("least").alias("lb"), F.col("most").alias("mb"))
    met = left.join(right, "tok").filter((F.col("ga") != F.col("gb")) & (F.col("a") < F.col("b"))
                                         & (NUM * F.col("la") <= DEN * F.col("mb")) & (NUM * F.col("lb") <= DEN * F.col("ma")))
    met = written(met.select("tok", "a", "b", "la", "ma", "lb", "mb"), "ngram-met")
    sides = met.select("tok", "a", "b", F.col("a").alias("block"), F.col("lb").alias("least"), F.col("mb").alias("most")).unionByName(
        met.select("tok", "a", "b", F.col("b").alias("block"), F.col("la").alias("least"), F.col("ma").alias("most")))
    hits = held.select("tok", "cls", "block").join(sides, ["tok", "block"]).join(lengths, "cls").filter(
        (NUM * F.col("n") <= DEN * F.col("most")) & (NUM * F.col("least") <= DEN * F.col("n")))
    found = hits.select("a", "b", "block", "cls").distinct()
    # both sides must still have somebody
    alive = found.groupBy("a", "b").agg(F.count_distinct("block").alias("k")).filter("k = 2").select("a", "b")
    return found.join(alive, ["a", "b"])


def ngram_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links, text_key, kept: one row per document.

    ``kept`` marks the document that stands for its component (smallest doc_id,
    then smallest text key); rows that repeat it are marked as well."""
    spark = docs.sparkSession
    bounded_batches(spark)
    tokens = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / TOKEN_BYTES
    bits = min(24, max(6, math.ceil(math.log2(max(1, tokens / RANGE_TOKENS)))))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    seen = (keyed.mapInArrow(_first_pass(bits), _FIRST_SQL).groupBy("slot")
                 .applyInArrow(_count_shared, "kind tinyint, doc_id bigint, text_key bigint, fp binary, cls bigint, n bigint"))
    seen = written(seen, "ngram-seen")
    found = links(docs, seen)
    roots = components(found)
    linked = found.groupBy(F.col("u").alias("cls")).agg(F.sum("links").alias("linked"))

    docs_seen = seen.filter(F.col("kind") == DOC).select("doc_id", "text_key", "fp", "cls", "n")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("rep")
    classes = written(docs_seen.filter("n > 0").groupBy("fp").agg(
        F.first("cls").alias("cls"), first, F.count(F.lit(1)).alias("copies")), "ngram-classes")
    nodes = roots.select(F.col("u").alias("cls"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("cls"), F.col("v").alias("root")).distinct())
    of_comp = classes.join(nodes, "cls").groupBy("root").agg(F.min("rep").alias("comp"))
    named = nodes.join(of_comp, "root").join(linked, "cls").select("cls", "comp", "linked")
    # classes that say something new: copies, or links
    told = (classes.join(named, "cls", "left").filter((F.col("copies") > 1) | F.col("comp").isNotNull())
                   .select("fp", F.coalesce("comp", "rep").alias("comp"),
                           (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    told = written(told, "ngram-told")
    out = docs_seen.join(broadcast_if_small(told), "fp", "left")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_key"))
    comp = F.when((F.col("n") > 0) & F.col("comp").isNotNull(), F.col("comp")).otherwise(own)
    return out.withColumn("_c", comp).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("_c.doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), "text_key",
        (F.col("doc_id").eqNullSafe(F.col("_c.doc_id")) & (F.col("text_key") == F.col("_c.text_key"))).alias("kept"))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The documents that stand for their component, with all their columns.

    Documents without words have no component and all stay.  Rows that repeat a
    document that stays are thinned to one."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    made = written(ngram_join(docs), "ngram-result")
    lost = made.filter(~F.col("kept")).select(F.col("doc_id").alias("its_id"), F.col("text_key").alias("its_key"))
    lost = written(lost.distinct(), "ngram-lost")
    rows = packed(docs, id=F.col("doc_id"), text_key=key)
    on = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("text_key") == F.col("its_key"))
    stay = rows.join(broadcast_if_small(lost), on, "left_anti")
    again = (made.filter(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("doc_id", "text_key")
                 .agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
                 .select(F.col("doc_id").alias("its_id"), F.col("text_key").alias("its_key")))
    again = written(again, "ngram-repeated")
    if not again.isEmpty():
        twice = broadcast_if_small(again)
        stay = stay.join(twice, on, "left_anti").unionByName(
            stay.join(twice, on, "left_semi").dropDuplicates(["id", "text_key"]))
    return unpacked(stay)
