"""Dimension lookups and referential checks.

No join is hinted: the planner's size estimate and AQE's runtime sizes choose
between broadcast and sort-merge, so a dimension that grows stops being broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, fact_key, dim_key: str, take: dict[str, str],
           how: str = "left") -> DataFrame:
    """Attach ``take`` (dim column -> output name) by key.

    Call once per role to join the same dimension under several roles
    (pickup / dropoff).  The dimension side has the same shape for every
    role (renaming happens after the join), so the planner reuses one
    exchange for all roles.
    """
    fk = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    # Fresh aliases (same names for every role): no attribute clashes when
    # the same dimension is joined twice, identical plans for exchange reuse.
    d = dim.select(F.col(dim_key).alias("_lookup_key"), *[F.col(c).alias(c) for c in take])
    j = fact.join(d, fk == d["_lookup_key"], how)
    return j.select(*[fact[c] for c in fact.columns], *[d[c].alias(o) for c, o in take.items()])


def missing_references(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                       count_col: str = "n_rows") -> DataFrame:
    """Non-null child values absent from the parent, with their row counts.

    The child is reduced to (value, count) with a partial aggregate before
    any shuffle, and the parent to its distinct keys; the anti join then
    moves distinct values only, however large or skewed the child is.
    """
    vals = (child.filter(F.col(child_col).isNotNull())
                 .groupBy(child_col).agg(F.count(F.lit(1)).alias(count_col)))
    keys = parent.select(F.col(parent_col).alias("_pk")).filter(F.col("_pk").isNotNull()).distinct()
    return vals.join(keys, vals[child_col] == keys["_pk"], "left_anti")
