"""Exact top-k inner-product search with KD-trees per shard.

Vectors are quantised to whole numbers, floor(256 * x), and scored by their inner
product.  The vectors are dealt into shards by a short top tree of median splits
(fitted on at most ``TOP_SAMPLE`` vectors; every vector is indexed), so a shard is
a region of space with a tight box; a shard with too many rows (copies of one
vector, say) is cut further by row number.  A shard's task builds its KD-tree:
median splits of the widest dimension, a tight box and the smallest vec_id per node.

A box bounds every score inside it: sum_i max(q_i * lo_i, q_i * hi_i).  The search
is best-first over the frontier of boxes; a node is skipped when its bound is under
the kth score found so far, or equal to it with no vec_id that would win the tie.
The kth score travels: a query first searches the shard it lies in, then goes, with its kth score,
only to the shards whose box can still beat it.  A shard's queries are searched in blocks
of about ``QUERY_ROWS``, each in a task with the shard's vectors.  A last step merges each query's
best rows by (score, smaller vec_id).

Vectors that are null or hold a null or non-finite component take no part.  Shorter
vectors count as padded with zeros.  A row's own row is never its candidate; another row with
the same vec_id is.  Null vec_ids are no queries and lose every tie.  Components and
scores saturate at the ends of a 64-bit number.  An empty table, or one without a query,
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.session_tables import written
from aurum.llm.training import first_by_hash

QUERY_EVERY = 50
K = 5
LEAF = 128
SHARD_ROWS = 8192
#: At most so many shards (their boxes are shared with every task); then shards grow.
MAX_SHARDS = 4096
TOP_SAMPLE = 20_000
#: Queries that meet a shard in one task, about; with more, the shard is sent to several tasks.
QUERY_ROWS = 16_384
#: Bounds (queries x nodes) that a search holds at a time ...
BOUND_CELLS = 1 << 20
#: ... and (queries x shards) that are sent on as one batch, at most (one query's at least).
SENT_ROWS = 16_384
_NO_ID = np.iinfo(np.int64).max
_TOP = np.iinfo(np.int64)


def quantised(embedding: Column) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("bigint"))


def takes_part(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(False))


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """A list column as a dense (rows, dim) array, short rows padded with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    offs = col.offsets.to_numpy().astype(np.int64)
    flat = col.values.to_numpy(zero_copy_only=False)
    size = np.diff(offs)
    out = np.zeros((len(col), dim), np.int64)
    if len(size) and (size == dim).all():
        out[:] = flat[offs[0]:offs[-1]].reshape(-1, dim)
    else:
        row = np.repeat(np.arange(len(size)), size)
        out[row, np.arange(len(row)) - np.repeat(offs[:-1] - offs[0], size)] = flat[offs[0]:offs[-1]]
    return out


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both arrays in a type in which their inner products have no rounding."""
    peak = max(1, a.shape[-1]) * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    kind = np.float64 if peak < 2 ** 52 else object
    return a.astype(kind), b.astype(kind)


def box_bounds(queries: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(queries, boxes): the highest inner product that a box allows."""
    q, _ = exact(queries, np.maximum(np.abs(lo), np.abs(hi)))
    return np.where(q > 0, q, 0) @ hi.astype(q.dtype).T + np.where(q < 0, q, 0) @ lo.astype(q.dtype).T


# ------------------------------------------------------------ one shard
class KdTree:
    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.lo, self.hi, self.low_id, self.span, self.kids = [], [], [], [], []
        order = np.arange(len(vectors))
        self._split(vectors, ids, order, 0, len(order))
        self.v, self.ids, self.rows = vectors[order], ids[order], rows[order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _split(self, v: np.ndarray, ids: np.ndarray, order: np.ndarray, a: int, b: int) -> int:
        part = order[a:b]
        lo, hi = v[part].min(axis=0), v[part].max(axis=0)
        me = len(self.span)
        self.lo.append(lo)
        self.hi.append(hi)
        self.low_id.append(int(ids[part].min()))
        self.span.append((a, b))
        self.kids.append(None)
        wide = hi - lo
        if b - a > LEAF and len(wide) and wide.max() > 0:
            mid = (b - a) // 2
            order[a:b] = part[np.argpartition(v[part, int(wide.argmax())], mid)]
            left = self._split(v, ids, order, a, a + mid)
            self.kids[me] = (left, self._split(v, ids, order, a + mid, b))
        return me

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(queries, nodes): no score inside a node's box is higher."""
        return box_bounds(q, self.lo, self.hi)

    def search(self, queries: np.ndarray, own: np.ndarray, kth: list[tuple | None], k: int):
        """Per query its best (score, vec_id, row), at most k; ``kth`` is the (score,
        vec_id) that k rows found elsewhere already reach, or None."""
        q, v = exact(queries, self.v)
        step = max(1, BOUND_CELLS // len(self.span))
        for a in range(0, len(queries), step):
            bound = self.bounds(queries[a:a + step])
            for i in range(a, min(a + step, len(queries))):
                yield self._best_first(q[i], v, bound[i - a], int(own[i]), kth[i], k)

    def _best_first(self, q, v, bound, own: int, kth, k: int) -> list[tuple[int, int, int]]:
        best: list[tuple[int, int, int]] = []                  # (-score, vec_id, row), sorted
        limit = None if kth is None else (-kth[0], kth[1])
        front = [(-bound[0], 0)]
        while front:
            near, node = heapq.heappop(front)
            if limit is not None and (near > limit[0] or near == limit[0] and self.low_id[node] > limit[1]):
                if near > limit[0]:
                    break
                continue
            if self.kids[node] is not None:
                for child in self.kids[node]:
                    heapq.heappush(front, (-bound[child], child))
                continue
            a, b = self.span[node]
            score = v[a:b] @ q
            ids, rows = self.ids[a:b], self.rows[a:b]
            able = rows != own
            if limit is not None:
                able &= (-score < limit[0]) | ((-score == limit[0]) & (ids <= limit[1]))
            pick = np.flatnonzero(able)
            if len(pick) > k:
                pick = pick[np.lexsort((rows[pick], ids[pick], -score[pick]))[:k]] if score.dtype != object else pick
            best = sorted(best + [(-int(score[j]), int(ids[j]), int(rows[j])) for j in pick])[:k]
            if len(best) == k and (limit is None or best[-1][:2] < limit):
                limit = best[-1][:2]
        return best


# ------------------------------------------------------------ top tree
class TopTree:
    """Median splits of a bounded sample; says which region a vector lies in."""

    def __init__(self, sample: np.ndarray, regions: int):
        self.cut: list[tuple[int, int, int, int] | None] = []
        self.leaf: dict[int, int] = {}
        self._grow(sample, max(0, math.ceil(math.log2(max(1, regions)))))

    def _grow(self, v: np.ndarray, depth: int) -> int:
        me = len(self.cut)
        self.cut.append(None)
        wide = v.max(axis=0) - v.min(axis=0) if len(v) and v.shape[1] else np.zeros(1, np.int64)
        if depth and len(v) > 1 and wide.max() > 0:
            axis = int(wide.argmax())
            at = int(np.sort(v[:, axis])[len(v) // 2])
            right = v[:, axis] >= at
            if right.any() and not right.all():
                a = self._grow(v[~right], depth - 1)
                self.cut[me] = (axis, at, a, self._grow(v[right], depth - 1))
                return me
        self.leaf[me] = len(self.leaf)
        return me

    def regions(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros(len(v), np.int32)
        todo = [(0, np.arange(len(v)))]
        while todo:
            node, rows = todo.pop()
            if self.cut[node] is None:
                out[rows] = self.leaf[node]
            else:
                axis, at, a, b = self.cut[node]
                right = v[rows, axis] >= at
                todo += [(a, rows[~right]), (b, rows[right])]
        return out


# ------------------------------------------------------------ Spark
_HITS = "q_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


def _search_groups(dim: int, k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        cols = {c: [] for c in ("q_row", "query_id", "row", "vec_id", "score")}
        if vectors.num_rows and queries.num_rows:
            ids = vectors.column("vec_id").fill_null(_NO_ID).to_numpy()
            tree = KdTree(matrix(vectors.column("e"), dim), ids, vectors.column("row").to_numpy())
            own, who = queries.column("row").to_numpy(), queries.column("vec_id").to_pylist()
            kth = [None if s is None else (s, i) for s, i in
                   zip(queries.column("kth").to_pylist(), queries.column("kth_id").to_pylist())]
            for j, found in enumerate(tree.search(matrix(queries.column("e"), dim), own, kth, k)):
                for neg, vec, row in found:
                    cols["q_row"].append(int(own[j]))
                    cols["query_id"].append(who[j])
                    cols["row"].append(row)
                    cols["vec_id"].append(None if vec == _NO_ID else vec)
                    cols["score"].append(max(_TOP.min, min(_TOP.max, -neg)))
        return pa.table({c: pa.array(x, pa.int64()) for c, x in cols.items()})
    return run


def _other_shards(boxes, dim: int, count: bool = False):
    """Sends a query, with its kth score, to the shards that can still beat it; with
    ``count``, says only how many queries each shard gets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, lo, hi = boxes.value
        total = np.zeros(len(shard), np.int64)
        step = max(1, SENT_ROWS // max(1, len(shard)))
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                able = shard != batch.column("home").to_numpy()[:, None]
                bound = box_bounds(matrix(batch.column("e"), dim), lo, hi)
                for i, kth in enumerate(batch.column("kth").to_pylist()):
                    if kth is not None:
                        able[i] &= bound[i] >= kth
                total += able.sum(axis=0)
                rows, to = np.nonzero(able)
                if len(rows) and not count:
                    sent = batch.take(pa.array(rows))
                    names = ["row", "vec_id", "e", "kth", "kth_id"]
                    yield pa.record_batch([*[sent.column(c) for c in names], pa.array(shard[to], pa.int64())], names=[*names, "shard"])
        if count:
            yield pa.record_batch([pa.array(shard[total > 0], pa.int64()), pa.array(total[total > 0], pa.int64())], names=["shard", "n"])
    return run


def topk(embeddings: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every row whose id ``every`` divides."""
    spark = embeddings.sparkSession
    e = F.col("embedding")
    able = written(embeddings.filter(takes_part(e)).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"),
        quantised(e).alias("e")), "topk-vectors")
    size = able.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("e")), F.lit(0)).alias("dim")).first()
    n, dim = int(size.n), int(size.dim)
    per_shard = max(SHARD_ROWS, -(-n // MAX_SHARDS))
    sample = first_by_hash(able, TOP_SAMPLE, "row").select("e").toArrow()                  # bounded
    tree = spark.sparkContext.broadcast(TopTree(matrix(sample.column("e"), dim) if sample.num_rows else np.zeros((0, dim), np.int64),
                                                -(-n // per_shard)))

    @F.arrow_udf("int")
    def region(col: pa.Array) -> pa.Array:
        return pa.array(tree.value.regions(matrix(col, dim)), pa.int32())

    placed = written(able.withColumn("region", region(F.col("e"))), "topk-regions")
    crowd = placed.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / F.lit(1.5 * per_shard)).cast("bigint").alias("parts"))
    vectors = (placed.join(F.broadcast(crowd), "region")                                   # at most MAX_SHARDS rows
                     .withColumn("shard", F.col("region").cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("row"), F.col("parts")))
                     .select("shard", "row", "vec_id", "e"))
    vectors = written(vectors, "topk-shards")
    box = written(vectors.select("shard", F.posexplode("e").alias("at", "x")).groupBy("shard", "at")
                         .agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("c"))
                         .join(vectors.groupBy("shard").agg(F.count(F.lit(1)).alias("m")), "shard"), "topk-boxes")
    shards = np.array(sorted(r.shard for r in vectors.select("shard").distinct().toLocalIterator()), np.int64)
    lo, hi = np.zeros((len(shards), dim), np.int64), np.zeros((len(shards), dim), np.int64)
    for r in box.toLocalIterator():                                                        # shards x dimensions
        i = int(np.searchsorted(shards, r.shard))
        lo[i, r["at"]], hi[i, r["at"]] = (r.lo, r.hi) if r.c == r.m else (min(r.lo, 0), max(r.hi, 0))
    boxes = spark.sparkContext.broadcast((shards, lo, hi))

    null = F.lit(None).cast("bigint")
    queries = vectors.filter(F.col("vec_id") % every == 0)
    search = _search_groups(dim, k)
    # at home a shard has no more queries than vectors
    first = written(vectors.groupBy("shard").cogroup(queries.withColumns({"kth": null, "kth_id": null}).groupBy("shard"))
                    .applyInArrow(search, _HITS), "topk-first")
    worst = (first.groupBy("q_row").agg(F.count(F.lit(1)).alias("c"),
                                        F.max(F.struct((-F.col("score")).alias("s"), F.coalesce("vec_id", F.lit(_NO_ID)).alias("i"))).alias("w"))
                  .filter(F.col("c") == k).select(F.col("q_row").alias("row"), (-F.col("w.s")).alias("kth"), F.col("w.i").alias("kth_id")))
    asked = written(queries.withColumnRenamed("shard", "home").join(worst, "row", "left"), "topk-asked")
    sizes = asked.mapInArrow(_other_shards(boxes, dim, count=True), "shard bigint, n bigint")
    blocks = written(sizes.groupBy("shard").agg(F.ceil(F.sum("n") / F.lit(float(QUERY_ROWS))).cast("bigint").alias("blocks")),
                     "topk-blocks")
    blocks = F.broadcast(blocks)                                                           # one row per shard
    sent = asked.mapInArrow(
        _other_shards(boxes, dim), "row bigint, vec_id bigint, e array<bigint>, kth bigint, kth_id bigint, shard bigint")
    sent = sent.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))).drop("blocks")
    again = (vectors.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
                    .drop("blocks"))
    rest = again.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInArrow(search, _HITS)
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
