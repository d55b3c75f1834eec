"""Trie of conversation prefixes, built as a burst trie.

A turn's id is the MD5 of its role and text; a conversation is its sequence of turn ids.
Every distinct prefix is a node, from the empty root.

1. **Sequences.**  Turns are numbered per conversation without a task that sees a whole one,
   rebuilt (``rebuilt``: a shared head, then the conversation's own turns) and gathered into
   segments of at most ``SEGMENT`` turns, the only arrays that are ever made.
2. **Classes.**  Conversations with equal sequences are one class with a count; their ids
   are joined in order, as runs, and the runs of a class are hashed as a stream.
3. **Burst.**  A container holds the suffixes below one trie head.  All classes start below
   the root.  A container of more than ``SUFFIXES`` suffixes bursts: what all its suffixes have
   in common becomes a chain of nodes (found from the least and greatest suffix), and each
   next turn id heads a container of its own.
4. **Sweep.**  The remaining containers are dealt to shards, sorted, and swept: a stack
   holds the path of the suffix at hand; a node closes when the next suffix leaves it.  Sums
   over subtrees are made on the way; those of containers are then added up to burst heads.
5. **Long conversations.**  Classes that share a whole segment go on below the node at its
   end, one round per segment, the deepest round first.  Where only one class goes on, its
   nodes are a chain that needs no trie: every segment gives its own, however many there are.

Order of turns: by turn, null first, then by turn id (ties); rows that repeat are turns of their
own.  Null role or text is empty.  Rows without a conv_id belong to no conversation.  Texts are
hashed where they are read, so a very long text costs no shuffle.  A conversation without
rebuilt turns is a member of the root only.  An empty table has no conversation and no node.
Other columns are not read.  Work that needs rounds: one per burst level (every burst splits
its container) and one per segment that several classes share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.session_tables import broadcast_if_small, written
from aurum.operators.numbering import numbered

#: Suffixes that a container holds before it bursts.
SUFFIXES = 2000
#: Turns of a conversation in one row.
SEGMENT = 256
#: Conversation ids in one joined run.
RUN_IDS = 4096
#: A burst container's row has a chain of up to SEGMENT turns; so many may be broadcast.
SMALL = 1000
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = "root"

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ------------------------------------------------------------- 1. sequences
def turn_id(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, size, pos, len): turns by their place in the conversation, from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = written(conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", turn_id(role, text).alias("key"),
        F.octet_length(text).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("row")), "trie-turns")
    order = [F.col("conv_id"), F.col("turn").isNotNull(), F.col("turn"), F.col("key"), F.col("row")]
    return numbered(rows, order, group="conv_id", number="pos", size="len").drop("turn", "row")


def rebuilt(turns: DataFrame, every: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share heads: (c, d, key, size, total) rows, d from 1, and (c, total).

    Conversation c is the first h turns of conversation c - c % ``every`` (h = crc32 of the decimal
    c, modulo ``heads``), then its own after its first h."""
    turns = written(turns, "trie-numbered")
    convs = turns.filter("pos = 0").select(F.col("conv_id").alias("c"), F.col("len"))
    h = F.crc32(F.encode(F.col("c").cast("string"), "utf-8")) % heads
    plan = convs.select("c", "len", (F.col("c") - F.col("c") % every).alias("base"), h.alias("h"))
    base = convs.select(F.col("c").alias("base"), F.col("len").alias("base_len"))
    take = F.least("h", F.coalesce("base_len", F.lit(0)))
    plan = written(plan.join(base, "base", "left").select(
        "c", "base", "h", take.alias("take"), (take + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("total")), "trie-plan")
    own = turns.join(plan.withColumnRenamed("c", "conv_id"), "conv_id").filter("pos >= h").select(
        F.col("conv_id").alias("c"), (F.col("take") + F.col("pos") - F.col("h") + 1).alias("d"), "key", "size", "total")
    shared = turns.filter((F.col("pos") < heads - 1) & (F.col("conv_id") % every == 0)).drop("len")
    head = shared.join(plan, F.col("conv_id") == F.col("base")).filter("pos < h").select(
        "c", (F.col("pos") + 1).alias("d"), "key", "size", "total")
    return own.unionByName(head), plan.select("c", "total")


def segments(rows: DataFrame) -> DataFrame:
    """(c, total, seg, keys, sizes, digest, bytes): the turns of a conversation, at most SEGMENT a row."""
    seg = F.floor((F.col("d") - 1) / F.lit(SEGMENT)).cast("bigint")
    made = rows.groupBy("c", "total", seg.alias("seg")).agg(F.sort_array(F.collect_list(F.struct("d", "key", "size"))).alias("t"))
    return written(made.select(
        "c", "total", "seg", F.col("t.key").alias("keys"), F.col("t.size").alias("sizes"),
        F.md5(F.array_join("t.key", "")).alias("digest"),
        F.aggregate("t.size", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("bytes")), "trie-segments")


# --------------------------------------------------------------- 2. classes
_RUN = pa.schema([("total", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("part", pa.int64()), ("least", pa.int64()),
                  ("n", pa.int64()), ("ids", pa.string())])


def _id_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (total, x, y, part, c) rows to runs of joined ids."""
    key, ids, out = None, [], []

    def run() -> tuple:
        return (*key, ids[0], len(ids), ",".join(map(str, ids)))
    for batch in batches:
        for *k, c in zip(*(batch.column(n).to_pylist() for n in ("total", "x", "y", "part", "c"))):
            if k != key or len(ids) == RUN_IDS:
                if ids:
                    out.append(run())
                key, ids = k, []
            ids.append(c)
        if out:
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out), _RUN)], schema=_RUN)
            out = []
    if ids:
        yield pa.record_batch([pa.array([x], f.type) for x, f in zip(run(), _RUN)], schema=_RUN)


def _class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order to one row per class; the hash takes one run at a time."""
    key, m, least, digest, out = None, 0, None, None, []

    def made(rows: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x) for x in zip(*rows)], names=["c", "m", "total", "ends"])
    for batch in batches:
        for *k, first, n, ids in zip(*(batch.column(c).to_pylist() for c in ("total", "x", "y", "least", "n", "ids"))):
            if k != key:
                if key is not None:
                    out.append((least, m, key[0], digest.hexdigest()))
                key, m, least, digest = k, 0, first, hashlib.sha256()
            digest.update((("," if m else "") + ids).encode())
            m += n
        if out:
            yield made(out)
            out = []
    if key is not None:
        yield made([(least, m, key[0], digest.hexdigest())])


def classes(convs: DataFrame, segs: DataFrame) -> DataFrame:
    """(c, m, total, ends): the smallest id, number and hashed ids of the conversations with one sequence.

    A sequence is known by its length and 128 bits over its segments' digests, which
    add up in any order."""
    known = segs.groupBy("c").agg(F.expr("bit_xor(xxhash64(1, seg, digest))").alias("x"),
                                  F.expr("bit_xor(xxhash64(digest, seg, 2))").alias("y"))
    keyed = convs.join(known, "c", "left").select(
        "c", "total", F.coalesce("x", F.lit(0).cast("bigint")).alias("x"), F.coalesce("y", F.lit(0).cast("bigint")).alias("y"))
    ordered = keyed.repartitionByRange("total", "x", "y", "c").sortWithinPartitions("total", "x", "y", "c")
    runs = ordered.withColumn("part", F.spark_partition_id().cast("bigint")).mapInArrow(
        _id_runs, "total bigint, x bigint, y bigint, part bigint, least bigint, n bigint, ids string")
    runs = runs.repartition("total", "x", "y").sortWithinPartitions("total", "x", "y", "part", "least")
    return written(runs.mapInArrow(_class_rows, "c bigint, m bigint, total bigint, ends string"), "trie-classes")


# ----------------------------------------------------------------- 3. burst
_BELOW = "struct<n_children:bigint,n_leaves:bigint,saved:bigint>"
_STATE = ["box", "up", "up_conv", "base", "c", "m", "ends", "keys", "sizes", "below"]


def _common(a: Column, b: Column) -> Column:
    """Length of the common prefix of two arrays."""
    n = F.least(F.size(a), F.size(b))
    differs = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y), False)
    return F.when(n == 0, 0).when(differs > 0, differs.cast("int") - 1).otherwise(n)


def burst(rows: DataFrame, limit: int) -> tuple[list[DataFrame], DataFrame]:
    """Bursts containers of more than ``limit`` suffixes, level by level.

    Returns the burst containers of every level (box, up, up_conv, base, chain, conv, n, ended,
    below) and the remaining suffixes."""
    levels, done, state = [], [], rows
    while True:
        found = state.groupBy("box").agg(F.count(F.lit(1)).alias("held"), F.min(F.struct("keys", "sizes")).alias("a"),
                                         F.max("keys").alias("b"), F.min("c").alias("conv"), F.sum("m").alias("n"))
        over = written(found.filter(F.col("held") > limit).select(
            "box", _common(F.col("a.keys"), F.col("b")).alias("l"), F.col("a.sizes").alias("first_sizes"), "conv", "n"), "trie-over")
        if over.isEmpty():
            done.append(state)
            break
        small = broadcast_if_small(over, SMALL)
        done.append(state.join(broadcast_if_small(over.select("box"), 100 * SMALL), "box", "left_anti").select(*_STATE))
        hit = state.join(small, "box")
        at_head = F.size("keys") == F.col("l")
        heads = hit.groupBy("box").agg(
            F.first("up").alias("up"), F.first("up_conv").alias("up_conv"), F.first("base").alias("base"),
            F.first("conv").alias("conv"), F.first("n").alias("n"), F.first(F.expr("slice(first_sizes, 1, l)")).alias("chain"),
            F.max(F.when(at_head & F.col("below").isNull(), F.col("ends"))).alias("ended"),
            F.max(F.when(at_head, F.col("below"))).alias("below"))
        levels.append(written(heads, "trie-heads"))
        deeper = hit.filter(F.size("keys") > F.col("l")).select(
            F.md5(F.concat_ws(",", F.col("box"), F.expr("slice(keys, 1, l + 1)"))).alias("box"), F.col("box").alias("up"),
            F.col("conv").alias("up_conv"), (F.col("base") + F.col("l")).alias("base"), "c", "m", "ends",
            F.expr("slice(keys, l + 1, size(keys))").alias("keys"), F.expr("slice(sizes, l + 1, size(sizes))").alias("sizes"), "below")
        state = written(deeper, "trie-suffixes")
    out = done[0].select(*_STATE)
    for d in done[1:]:
        out = out.unionByName(d.select(*_STATE))
    return levels, out


# ----------------------------------------------------------------- 4. sweep
class _Node:
    __slots__ = ("key", "size", "conv", "n", "ends", "children", "below")

    def __init__(self, key: str | None, size: int):
        self.key, self.size = key, size
        self.conv, self.n, self.ends, self.children, self.below = None, 0, None, [], None

    def sums(self) -> tuple[int, int, int]:
        """Children, leaves and saved tokens below (without its own)."""
        kids, leaves, saved = (self.below if self.below else (0, 0, 0))
        kids += len(self.children)
        leaves += sum(c[3] for c in self.children)
        saved += sum(c[4] for c in self.children)
        return kids, leaves, saved

    def closed(self) -> tuple:
        kids, leaves, saved = self.sums()
        return (self.conv, self.n, kids, max(1, leaves), saved + (self.n - 1) * self.size, self.ends or NO_ENDS)


_SWEPT = pa.schema([("box", pa.string()), ("up", pa.string()), *[(c, pa.int64()) for c in NODE[:-1]], ("ends_sha256", pa.string())])
_SWEPT_SQL = "box string, up string, " + ", ".join(f"{c} bigint" for c in NODE[:-1]) + ", ends_sha256 string"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes in order of (box, keys) to nodes, and one row (depth null) of sums per container."""
    box, up, base, up_conv, stack, last, out = None, None, 0, None, [], [], []

    def pop() -> None:
        node, parent = stack.pop(), stack[-1]
        depth = base + len(stack) + 1                       # of its children
        for conv, n, kids, leaves, saved, ends in node.children:
            out.append((None, None, conv, depth, node.conv, n, kids, leaves, saved, ends))
        parent.children.append(node.closed())

    def close() -> None:
        while len(stack) > 1:
            pop()
        top = stack.pop()
        for conv, n, kids, leaves, saved, ends in top.children:
            out.append((None, None, conv, base + 1, up_conv, n, kids, leaves, saved, ends))
        kids, leaves, saved = top.sums()
        out.append((box, up, None, None, None, None, kids, leaves, saved, None))

    def batch_of() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _SWEPT)], schema=_SWEPT)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _STATE)):
            if row[0] != box:
                if stack:
                    close()
                (box, up, up_conv, base), stack, last = row[:4], [_Node(None, 0)], []
            c, m, ends, keys, sizes, below = row[4:]
            common = 0
            for a, b in zip(last, keys):
                if a != b:
                    break
                common += 1
            while len(stack) - 1 > common:
                pop()
            for k in range(common, len(keys)):
                stack.append(_Node(keys[k], sizes[k]))
            last = keys
            for node in stack[1:]:
                node.n += m
                node.conv = c if node.conv is None else min(node.conv, c)
            if below is None:
                stack[-1].ends = ends
            else:
                stack[-1].below = tuple(below.values())
        if out:
            yield batch_of()
            out.clear()
    if stack:
        close()
    if out:
        yield batch_of()


def build(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Nodes below the heads of ``rows`` (its boxes), and each head's (box, n_children, n_leaves, saved)."""
    levels, rest = burst(rows, limit)
    swept = written(rest.repartition("box").sortWithinPartitions("box", "keys").mapInArrow(_sweep, _SWEPT_SQL), "trie-swept")
    nodes = [swept.filter("depth IS NOT NULL").select(*NODE)]
    tops = swept.filter("depth IS NULL").select("box", "up", "n_children", "n_leaves", F.col("saved_tokens").alias("saved"))
    for heads in reversed(levels):
        under = tops.groupBy(F.col("up").alias("box")).agg(
            F.sum("n_children").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
        summed = written(heads.join(under, "box", "left").select(
            *heads.columns, (zero("kids") + zero("below.n_children")).alias("n_children"),
            F.greatest(F.lit(1), zero("leaves") + zero("below.n_leaves")).alias("n_leaves"),
            (zero("saved") + zero("below.saved")).alias("under")), "trie-summed")
        weight = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda t, x: t + x)
        last = F.col("i") == F.size("chain") - 1
        nodes.append(summed.select("*", F.posexplode("chain").alias("i", "own")).select(
            F.col("conv").alias("conv_id"), (F.col("base") + F.col("i") + 1).alias("depth"),
            F.when(F.col("i") == 0, F.col("up_conv")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.when(last, F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves",
            (F.col("under") + (F.col("n") - 1) * weight(F.expr("slice(chain, i + 1, size(chain))"))).alias("saved_tokens"),
            F.when(last & F.col("ended").isNotNull(), F.col("ended")).otherwise(NO_ENDS).alias("ends_sha256")))
        own = summed.select("box", "up", F.when(F.size("chain") > 0, F.lit(1)).otherwise(F.col("n_children")).alias("n_children"),
                            "n_leaves", (F.col("under") + (F.col("n") - 1) * weight(F.col("chain"))).alias("saved"))
        tops = tops.unionByName(own)
    out = nodes[0]
    for n in nodes[1:]:
        out = out.unionByName(n.select(*NODE))
    return out, tops.filter("up IS NULL").drop("up")


# ------------------------------------------------- 5. segments, and the whole
def _chains(lone: DataFrame, first: int) -> DataFrame:
    """Nodes of the segments (c, m, ends, total, seg, sizes, after, low) of classes that go on alone
    from segment ``first``; ``low`` is the smallest id at the node above it."""
    depth = F.col("seg") * SEGMENT + F.col("i") + 1
    rest = F.aggregate(F.expr("slice(sizes, i + 1, size(sizes))"), F.col("after"), lambda t, x: t + x)
    last = depth == F.col("total")
    return lone.select("*", F.posexplode("sizes").alias("i", "own")).select(
        F.col("c").alias("conv_id"), depth.alias("depth"),
        F.when((F.col("i") == 0) & (F.col("seg") == first), F.col("low")).otherwise(F.col("c")).alias("parent_conv_id"),
        F.col("m").alias("n_convs"), F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        ((F.col("m") - 1) * rest).alias("saved_tokens"), F.when(last, F.col("ends")).otherwise(NO_ENDS).alias("ends_sha256"))


def trie(rows: DataFrame, convs: DataFrame, suffixes: int = SUFFIXES) -> DataFrame:
    """Nodes of the trie of (c, d, key, size, total) rows; ``convs`` (c, total) names all conversations."""
    segs = segments(rows)
    kinds = classes(convs, segs)
    all_ = kinds.agg(F.min("c").alias("conv"), F.sum("m").alias("n"), F.max("total").alias("longest"),
                     F.max(F.when(F.col("total") == 0, F.col("ends"))).alias("ends")).first()
    whole = segs.join(kinds.select("c", "m", "ends"), "c")
    if (all_.longest or 0) > SEGMENT:
        later = Window.partitionBy("c").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
        whole = written(whole.withColumn("after", F.coalesce(F.sum("bytes").over(later), F.lit(0))), "trie-long")
    else:
        whole = whole.withColumn("after", F.lit(0).cast("bigint"))
    none = F.lit(None)
    state = whole.filter("seg = 0").withColumns({"head": F.lit(ROOT), "up_conv": F.lit(all_.conv).cast("bigint")})
    rounds, chains, s = [], [], 0
    while True:
        end = (s + 1) * SEGMENT                             # where the segments of this round end, if full
        state = state.withColumn("full", F.when(F.col("total") >= end, F.md5(F.concat("head", F.lit(","), "digest"))))
        state = written(state.withColumn("next", F.when(F.col("total") > end, F.col("full"))), "trie-round")
        rounds.append((s, state))
        if (all_.longest or 0) <= end:
            break
        on = state.filter("full IS NOT NULL").groupBy(F.col("full").alias("next")).agg(
            F.count("next").alias("k"), F.min("c").alias("low"))
        going = written(state.filter("next IS NOT NULL").select("c", "next").join(on, "next"), "trie-going")
        alone = going.filter("k = 1").select("c", "low")
        chains.append(_chains(whole.filter(F.col("seg") > s).join(alone, "c"), s + 1))
        many = going.filter("k > 1").select("c", F.col("next").alias("head"), F.col("low").alias("up_conv"))
        if many.isEmpty():
            break
        s += 1
        state = whole.filter(F.col("seg") == s).join(many, "c")
    parts, tops = chains, None
    for s, state in reversed(rounds):
        alone = F.struct(F.lit(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
                         ((F.col("m") - 1) * F.col("after")).alias("saved"))
        if tops is not None:
            found = F.struct("n_children", "n_leaves", "saved")
            state = state.join(tops.select(F.col("box").alias("next"), found.alias("found")), "next", "left")
        else:
            state = state.withColumn("found", none.cast(_BELOW))
        below = F.when(F.col("next").isNotNull(), F.coalesce("found", alone)).otherwise(none.cast(_BELOW))
        nodes, tops = build(state.select(F.col("head").alias("box"), none.cast("string").alias("up"), "up_conv",
                                         F.lit(s * SEGMENT).cast("bigint").alias("base"), "c", "m", "ends", "keys", "sizes",
                                         below.alias("below")), suffixes)
        parts.append(nodes)
        tops = written(tops, "trie-tops")
    spark = rows.sparkSession
    if all_.n is None:
        return spark.createDataFrame([], parts[-1].schema)
    root = tops.agg(F.coalesce(F.sum("n_children"), F.lit(0)).alias("n_children"),
                    F.greatest(F.lit(1), F.coalesce(F.sum("n_leaves"), F.lit(0))).alias("n_leaves"),
                    F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens")).select(
        F.lit(all_.conv).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"), none.cast("bigint").alias("parent_conv_id"),
        F.lit(all_.n).cast("bigint").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.lit(all_.ends or NO_ENDS).alias("ends_sha256"))
    out = root
    for p in parts:
        out = out.unionByName(p.select(*NODE))
    return out


def prefix_trie(conversations: DataFrame, suffixes: int = SUFFIXES) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node (``NODE``)."""
    rows, convs = rebuilt(numbered_turns(conversations))
    return trie(rows, convs, suffixes)
