"""Exact deduplication with a heavy-hitter split.

Two texts are equal when they are the same after deleting every character of
``[\\x20\\x09-\\x0D]``.  Of equal texts the row with the most code points in its
original text stays, then the smallest doc_id (a null doc_id comes last), then
-- among rows that repeat one doc_id -- exactly one of them.

A group of copies may hold a third of all rows, so groups are not simply
shuffled together:

1. Every row is reduced to (doc_id, digest, length) and written once.
2. A mergeable Misra-Gries summary (Spark's frequent-items sketch, the batched
   form of that algorithm) runs over the digests: per task first, then merged in
   blocks, then once.  With ``COUNTERS`` counters every digest that holds at
   least 1/``SHARE`` of the rows is in the summary, whatever the data.
3. The candidates' counts and winners are verified exactly (partial
   aggregation: one row per task and candidate), false ones are dropped.  At most
   ``SHARE`` digests can be that frequent, so the verified winners are a
   broadcast of bounded size and their rows are settled map-side, unshuffled.
4. All other digests (each under 1/``SHARE`` of the rows) go through an ordinary
   shuffle by digest.

Null texts count as empty.  An empty table gives an empty result.  Columns of
the input other than doc_id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.session_tables import broadcast_if_small, packed, unpacked, written

#: A digest with at least 1/SHARE of all rows is a heavy hitter.
SHARE = 2048
#: Counters of the summary: its error is below rows / SHARE.
COUNTERS = 8192
#: Summaries are merged in so many blocks before the last merge.
MERGE_BLOCKS = 64

_SPACE = " \t\n\x0b\x0c\r"


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without white space; null is empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), _SPACE, ""), 256)


def digests(docs: DataFrame) -> DataFrame:
    """(row, doc_id, digest, n): one narrow row per document, written once.

    ``row`` numbers the rows; it is fixed by the write."""
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id"),
        text_digest(F.col("text")).alias("digest"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint").alias("n"))
    return written(narrow, "dedup-digests")


def _first() -> Column:
    """Sorts before every other row of its group: longest, smallest id, first row."""
    return F.struct((-F.col("n")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))


def heavy_candidates(rows: DataFrame, column: str = "digest") -> DataFrame:
    """Misra-Gries summary of ``column``: at most ``2 * SHARE`` values, among them
    every value that holds 1/SHARE of the rows."""
    sketch = (rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_BLOCKS)).alias("block"))
                  .agg(F.expr(f"approx_top_k_accumulate({column}, {COUNTERS})").alias("s")))
    top = (sketch.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(s, {COUNTERS})").alias("s"))
                 .select(F.explode(F.expr(f"approx_top_k_estimate(s, {2 * SHARE})")).alias("t")))
    return top.select(F.col("t.item").alias(column))


def winners(rows: DataFrame) -> DataFrame:
    """(digest, keep, group_size) per digest; ``keep`` is the row that stays."""
    return rows.groupBy("digest").agg(F.min(_first()).alias("keep"), F.count(F.lit(1)).alias("group_size"))


def heavy_winners(rows: DataFrame) -> DataFrame:
    """The verified winners of the heavy digests: at most ``SHARE`` rows, written."""
    total = rows.count()
    floor = max(2, -(-total // SHARE))
    found = rows.join(F.broadcast(heavy_candidates(rows)), "digest")
    return written(winners(found).filter(F.col("group_size") >= floor), "dedup-heavy")


def decide(docs: DataFrame) -> DataFrame:
    """One row per document: row, doc_id, digest, keep (struct), group_size, kept."""
    rows = digests(docs)
    heavy = F.broadcast(heavy_winners(rows))              # at most SHARE rows
    kept = (F.col("row") == F.col("keep.row")).alias("kept")
    cols = ["row", "doc_id", "digest", "n", "keep", "group_size", kept]
    hot = rows.join(heavy, "digest").select(*cols)
    tail = rows.join(heavy, "digest", "left_anti")
    group = Window.partitionBy("digest")
    cold = (tail.withColumn("keep", F.min(_first()).over(group))
                .withColumn("group_size", F.count(F.lit(1)).over(group)).select(*cols))
    return hot.unionByName(cold)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Decisions for every row: doc_id, keep_id, group_size, kept, text_sha256."""
    return decide(docs).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("group_size").cast("bigint").alias("group_size"),
        "kept", F.col("digest").alias("text_sha256"))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    A row goes when its (doc_id, digest, length) is in the written table of
    losers.  Rows that agree with a winner in all three repeat it; those groups
    are thinned to one row by an aggregate.  Texts are shuffled only when the
    losers are too many to broadcast, and then by a key that is unique but for
    repeated rows.
    """
    lost = decide(docs).filter(~F.col("kept")).select(
        F.col("doc_id").alias("lost_id"), F.col("digest").alias("lost_digest"), F.col("n").alias("lost_n"),
        (F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("n") == -F.col("keep.shorter"))).alias("repeat"))
    lost = written(lost.distinct(), "dedup-lost")
    rows = packed(docs, id=F.col("doc_id"), digest=text_digest(F.col("text")),
                  n=F.length(F.coalesce(F.col("text"), F.lit(""))))
    on = F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("digest") == F.col("lost_digest")) & (F.col("n") == F.col("lost_n"))
    repeats = lost.filter("repeat")
    stay = rows.join(broadcast_if_small(lost.drop("repeat")), on, "left_anti")
    if not repeats.isEmpty():
        again = rows.join(broadcast_if_small(repeats.drop("repeat")), on, "left_semi").dropDuplicates(["digest"])
        stay = stay.unionByName(again)
    return unpacked(stay)
