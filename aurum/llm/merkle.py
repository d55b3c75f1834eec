"""Merkle manifest of a dataset, built by appending, with incremental witnesses.

Every row of ``documents`` is a leaf; the leaves of a source, in order, form a tree of
arity 3 (the last run of a level is shorter, even one node); the sources' roots form
the top tree in the same way.  H is the lowercase hex SHA-256 of its inputs' text.

**Witnesses.**  Nobody goes back over a finished tree to look up siblings.  ``Frontier``
takes nodes in order and holds only the open subtrees: up to two finished nodes a level.
When a sibling completes a run, the witnesses of all members below it are extended by the
digests that they were waiting for, and the run's digest is appended one level up.

**Distribution.**  Leaves are numbered per source (two passes over a range partitioning:
a source of any size is spread over tasks).  An aligned block of 3 ** ``LEVELS`` nodes is
appended in one task, as a stream; it yields its members' partial witnesses and one root.
Block roots are appended again in the next round, as further nodes, until one node is
left per source; then the subroots are appended in turn.  A member's witness is the
chain of its parts; parts of upper rounds are joined to blocks, not to leaves.  Rounds are
log(rows) / log(3 ** LEVELS); every round is written, so a lost executor costs one task.

Leaf: H of doc_id, source, lang, n_chars and text, each ``-`` if null, else UTF-8 byte
count, ``:``, value.  Sources order null first, then bytewise; leaves by doc_id, null
first, then by digest (so repeated ids have a fixed order; equal rows are equal leaves).
An empty text is ``0:``.  Long texts are hashed by Spark where they are read and never
shuffled.  A lone leaf is its source's root, a lone source's root is the root; both have empty
witnesses.  An empty table gives an empty result.  Columns other than the five are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.session_tables import broadcast_if_small, written
from aurum.operators.numbering import numbered

ARITY = 3
#: Levels that a task builds at a time: blocks of 3 ** 6 = 729 nodes.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A witness part is at most 64 bytes a level; so many rows of them may be broadcast.
SMALL = 10_000


def h(*parts: bytes) -> bytes:
    """Digest of the inputs' hex text, as 32 bytes."""
    return hashlib.sha256(b"".join([p.hex().encode() for p in parts])).digest()


# ------------------------------------------------------------------ append
class Frontier:
    """An append-only tree that keeps its open subtrees and its members' witnesses."""

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, int, int]]] = [[]]
        self.witness: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        self.witness.append([])
        n = len(self.witness)
        self._add(0, (digest, n - 1, n))

    def _add(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for i, (_, lo, hi) in enumerate(run):
            waited = [d for j, (d, _, _) in enumerate(run) if j != i]
            for member in self.witness[lo:hi]:
                member.extend(waited)
        self._add(level + 1, (h(*[d for d, _, _ in run]), run[0][1], run[-1][2]))

    def close(self, levels: int | None) -> bytes:
        """The root: of exactly ``levels`` levels, or at the first level with one node (None)."""
        level = 0
        while True:
            top = level == levels if levels is not None else (
                len(self.open[level]) == 1 and not any(self.open[level + 1:]))
            if top:
                return self.open[level][0][0]
            if self.open[level]:
                self._complete(level)
            level += 1


def fold(digest: bytes, pos: int, n: int, proof: bytes) -> bytes:
    """The root that a leaf digest at ``pos`` of ``n`` leads to by its siblings (32 bytes each, in order)."""
    at = 0
    while n > 1:
        size, place = min(ARITY, n - pos // ARITY * ARITY), pos % ARITY
        run = [proof[at + 32 * i:at + 32 * i + 32] for i in range(size - 1)]
        at += 32 * (size - 1)
        digest = h(*run[:place], digest, *run[place:])
        pos, n = pos // ARITY, -(-n // ARITY)
    if at != len(proof):
        raise ValueError("a proof of another tree")
    return digest


# ------------------------------------------------------------------ Spark
_OUT = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()),
                  ("digest", pa.binary()), ("carry", pa.binary()), ("head", pa.binary())])
_OUT_SQL = "tree string, block bigint, pos bigint, n bigint, digest binary, carry binary, head binary"


def _append_blocks(levels: int):
    """Rows in order of (tree, block, pos): members with their part of the witness, then
    the block's root as a row with pos null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, tree = None, [], Frontier()

        def closed() -> pa.RecordBatch:
            n = rows[0][1]
            root = tree.close(levels if n > ARITY ** levels else None)
            cols = [[key[0]] * (len(rows) + 1), [key[1]] * (len(rows) + 1), [r[0] for r in rows] + [None], [r[1] for r in rows] + [n],
                    [r[2] for r in rows] + [root], [r[3] for r in rows] + [None], [b"".join(w) for w in tree.witness] + [None]]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)

        for batch in batches:
            for t, block, *row in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "pos", "n", "digest", "carry"))):
                if (t, block) != key:
                    if rows:
                        yield closed()
                    key, rows, tree = (t, block), [], Frontier()
                rows.append(row)
                tree.append(row[2])
        if rows:
            yield closed()
    return run


def _round(nodes: DataFrame, levels: int) -> DataFrame:
    """One round of appends over (tree, pos, n, digest, carry) rows, written."""
    dealt = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(ARITY ** levels)).cast("bigint"))
    dealt = dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return written(dealt.select("tree", "block", "pos", "n", "digest", "carry").mapInArrow(_append_blocks(levels), _OUT_SQL), "merkle-round")


def grow(nodes: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Trees over (tree, pos, n, digest, carry) rows: the members (tree, block, pos, n, digest,
    carry, head) and, per (tree, block), the rest of the witness: (tree, block, tail, root)."""
    rounds = [_round(nodes, levels)]
    while True:
        made = rounds[-1].filter("pos IS NULL").select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / F.lit(ARITY ** levels)).cast("bigint").alias("n"),
            "digest", F.lit(None).cast("binary").alias("carry"))
        more = made.filter("n > 1")
        if more.isEmpty():
            break
        rounds.append(_round(more, levels))
    tails = None                                             # of the round above, per block
    for done in reversed(rounds):
        roots = done.filter("pos IS NULL").select(
            "tree", "block", F.col("digest").alias("root"), (F.col("n") <= F.lit(ARITY ** levels)).alias("last"))
        here = roots.filter("last").select("tree", "block", F.lit(b"").alias("tail"), "root")
        if tails is not None:
            above = tails.select("tree", F.col("block").alias("above"), F.col("tail").alias("upper"), F.col("root"))
            nodes_up = upper.filter("pos IS NOT NULL").select(
                "tree", F.col("pos").alias("block"), F.col("block").alias("above"), "head")
            here = here.unionByName(nodes_up.join(broadcast_if_small(above, SMALL), ["tree", "above"])
                                            .select("tree", "block", F.concat("head", "upper").alias("tail"), "root"))
        tails, upper = written(here, "merkle-tails"), done
    return rounds[0].filter("pos IS NOT NULL"), tails


def leaf_text(columns: dict[str, Column]) -> Column:
    """What a leaf hashes: every field as byte count, colon, value; ``-`` for null."""
    parts = []
    for c in columns.values():
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.concat(*parts)


def leaves(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, carry, row): one narrow row per document, written.  ``tree`` orders
    like the sources; ``carry`` is the digest with ``altered`` in the text's place."""
    fields = {c: F.col(c) for c in FIELDS}
    leaf = F.unhex(F.sha2(leaf_text(fields), 256))
    other = leaf if altered is None else F.unhex(F.sha2(leaf_text(fields | {"text": altered}), 256))
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    return written(docs.select(tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf.alias("leaf"),
                               other.alias("carry"), F.monotonically_increasing_id().alias("row")), "merkle-leaves")


def manifest(docs: DataFrame, altered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """The manifest with every document's whole witness: doc_id, source, pos, n (its place
    in the source), leaf, altered_leaf, subroot, top_pos, top_n, root, head, tail, top_proof.

    The witness is head, tail and top_proof, one after the other: 32 bytes a sibling."""
    made = leaves(docs, altered)
    order = [F.col("tree"), F.col("doc_id").isNotNull(), F.col("doc_id"), F.col("leaf"), F.col("row")]
    nodes = numbered(made, order, group="tree", number="pos", size="n")
    # the id travels with the digest of the altered row
    carry = F.concat("carry", F.coalesce(F.encode(F.col("doc_id").cast("string"), "utf-8"), F.lit(b"")))
    members, tails = grow(nodes.select("tree", "pos", "n", F.col("leaf").alias("digest"), carry.alias("carry")), levels)
    subroots = tails.filter("block = 0").select("tree", F.col("root").alias("digest"))
    top = numbered(subroots, [F.col("tree")], number="pos", size="n")
    top = top.select(F.lit("").alias("tree"), "pos", "n", "digest", F.encode("tree", "utf-8").alias("carry"))
    tops, top_tails = grow(top, levels)
    tops = tops.join(broadcast_if_small(top_tails.drop("tree"), SMALL), "block").select(
        F.decode("carry", "utf-8").alias("tree"), F.col("pos").alias("top_pos"), F.col("n").alias("top_n"),
        F.concat("head", "tail").alias("top_proof"), F.col("root").alias("top_root"))
    blocks = written(tails.join(broadcast_if_small(tops, SMALL), "tree"), "merkle-blocks")
    whole = members.join(broadcast_if_small(blocks, SMALL), ["tree", "block"])
    n_digest = 32
    return whole.select(
        F.when(F.octet_length("carry") > n_digest, F.decode(F.expr(f"substring(carry, {n_digest + 1})"), "utf-8")).cast("bigint").alias("doc_id"),
        F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source"), "pos", "n",
        F.col("digest").alias("leaf"), F.substring("carry", 1, n_digest).alias("altered_leaf"),
        F.col("root").alias("subroot"), "top_pos", "top_n", F.col("top_root").alias("root"), "head", "tail", "top_proof")


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        proofs, folded = [], []
        for leaf, pos, n, head, tail, top_pos, top_n, top in zip(*(cols[c] for c in (
                "altered_leaf", "pos", "n", "head", "tail", "top_pos", "top_n", "top_proof"))):
            proofs.append(hashlib.sha256((head + tail + top).hex().encode()).hexdigest())
            folded.append(fold(fold(leaf, pos, n, head + tail), top_pos, top_n, top).hex())
        as_hex = lambda c: [d.hex() for d in cols[c]]
        root = as_hex("root")
        yield pa.record_batch([batch.column("doc_id"), pa.array(as_hex("leaf"), pa.string()), pa.array(as_hex("subroot"), pa.string()),
                               pa.array(root, pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
                               pa.array([a == b for a, b in zip(folded, root)], pa.bool_())],
                              names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def without_line_feeds(doc_id: Column, text: Column) -> Column:
    """The tampering that the audit must notice: where 2 divides the id's CRC, the text
    loses its line feeds.  A null id is not tampered with."""
    hit = F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 2 == 0
    return F.when(F.coalesce(hit, F.lit(False)), F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def audit(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 of the untampered table; folded_root leads from
    the tampered leaf by the original siblings, verified says whether it is the root."""
    rows = manifest(docs, without_line_feeds(F.col("doc_id"), F.col("text")), levels)
    return rows.mapInArrow(_audit, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
                                   "folded_root string, verified boolean")
