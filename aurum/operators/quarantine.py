"""Rejected rows are set aside under the label of the first rule they break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "_reject_reason"


def tag_reasons(df: DataFrame, rules: list[tuple[str, Column]], null_reason: str | None = None,
                reason_col: str = REASON) -> DataFrame:
    """Add the first failing rule's label (NULL when the row passes).

    ``rules`` are (label, failure predicate).  A predicate that is NULL (its
    input is NULL) neither passes nor fails under SQL logic; with
    ``null_reason`` such rows are quarantined under that label instead of
    vanishing from both sides.
    """
    out = None
    for label, pred in rules:
        cond = pred.eqNullSafe(F.lit(True))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if null_reason is not None:
        undecided = None
        for _, pred in rules:
            u = pred.isNull()
            undecided = u if undecided is None else (undecided | u)
        out = out.when(undecided, F.lit(null_reason))
    return df.withColumn(reason_col, out.otherwise(F.lit(None).cast("string")))


def conservation(landed: DataFrame, accepted: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Counts of three independently built tables as one row, and whether they agree."""
    def n(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name)).withColumn("_k", F.lit(1))
    names = ["input_rows", "accepted_rows", "quarantined_rows"]
    parts = [n(df, name) for df, name in zip((landed, accepted, quarantined), names)]
    u = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    one = u.groupBy("_k").agg(*[F.max(c).alias(c) for c in names]).drop("_k")
    return one.withColumn("balanced", F.col("input_rows") == F.col("accepted_rows") + F.col("quarantined_rows"))
