"""Which key ranges differ between two versions of a table, without comparing their rows.

A version's tree has one node per key range: at level 0 ranges of ``width`` keys, above
them ranges ``FANOUT`` times as wide.  A node holds the rows of its range and the sum
of their hashes, so a node is the sum of its children and the order of rows does not
matter.  Trees are small tables (rows / rows per range) that are written beside their
version; two versions are compared from the top, and only children of nodes that differ are
looked at.  Rows are read only in the ranges that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.session import materialize
from aurum.sources.store import row_hash

FANOUT = 16
NODE = ["level", "part", "n_rows", "hash"]


def _part(key: str, width: int) -> Column:
    """Number of a key's range; NULL keys have a range of their own (NULL)."""
    return F.floor(F.col(key) / F.lit(width)).cast("bigint")


def hash_tree(df: DataFrame, key: str, exact: list[str], decimals: dict[str, int] | None = None, width: int = 1000) -> DataFrame:
    """(level, part, n_rows, hash) for every range that has rows, up to the one that holds all keys >= 0."""
    leaf = materialize(df.groupBy(_part(key, width).alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row_hash(exact, decimals)).alias("hash")))
    out = leaf.select(F.lit(0).alias("level"), "part", "n_rows", "hash")
    top = leaf.agg(F.max(F.abs("part"))).first()[0] or 0
    level = 0
    while top > 0:
        level, top = level + 1, top // FANOUT
        up = F.floor(F.col("part") / F.lit(FANOUT ** level)).cast("bigint")
        out = out.unionByName(leaf.groupBy(up.alias("part")).agg(F.sum("n_rows").alias("n_rows"), F.sum("hash").alias("hash"))
                                  .select(F.lit(level).alias("level"), "part", "n_rows", "hash"))
    return out


def differing_ranges(old: DataFrame, new: DataFrame, width: int = 1000) -> DataFrame:
    """(low, high, n_old, n_new): key ranges [low, high) whose rows differ; (NULL, NULL) for rows without a key."""
    top = max(t.agg(F.max("level")).first()[0] or 0 for t in (old, new))
    open_ = None
    for level in range(top, -1, -1):
        sides = [t.filter(F.col("level") == level).select("part", F.col("n_rows").alias(f"n_{s}"), F.col("hash").alias(f"h_{s}"))
                 for t, s in ((old, "old"), (new, "new"))]
        if open_ is not None:                                # children of nodes that differ
            up = F.floor(F.col("part") / F.lit(FANOUT)).cast("bigint")
            sides = [s.join(open_, up.eqNullSafe(F.col("parent")), "left_semi") for s in sides]
        a, b = sides[0].withColumnRenamed("part", "p"), sides[1]
        both = a.join(b, F.col("p").eqNullSafe(F.col("part")), "full")
        changed = both.filter(~(F.col("n_old").eqNullSafe(F.col("n_new")) & F.col("h_old").eqNullSafe(F.col("h_new"))))
        changed = changed.select(F.coalesce("p", "part").alias("parent"), "n_old", "n_new")
        open_ = materialize(changed)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return open_.select((F.col("parent") * width).alias("low"), ((F.col("parent") + 1) * width).alias("high"), zero("n_old"), zero("n_new"))
