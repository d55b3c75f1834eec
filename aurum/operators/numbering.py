"""Dense row numbers in a total order, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.session import materialize

#: monotonically_increasing_id keeps the partition above so many bits, the row's place in it below.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column], group: str | None = None,
             number: str = "number", size: str | None = None) -> DataFrame:
    """``df`` with ``number``: 0, 1, 2, ... in ``order`` within each value of ``group`` (all rows if None).

    ``order`` must start with the group's column.  Rows are range-partitioned by it, so a
    group of any size is spread over tasks; two passes number them: the rows of each
    (partition, group), then the rows before it.  Only those counts -- at most partitions
    plus groups -- meet in a window.  ``group`` must not hold nulls; give rows that may be
    equal a last order column that differs, or a hot row lands in one task.  ``size``
    names a further column with the rows of the group.  The numbered rows are written once
    before they are counted, so the numbers hold whatever is recomputed.
    """
    key = F.col(group) if group else F.lit(0)
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    placed = df.select(whole, key.alias("_group"), F.struct(*order).alias("_order"))
    placed = placed.repartitionByRange(F.col("_order")).sortWithinPartitions("_order")
    placed = materialize(placed.select("_row", "_group", F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", _PLACE_BITS)
    runs = placed.groupBy(part.alias("_part"), F.col("_group").alias("_of")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", "_of", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                       F.sum("_n").over(Window.partitionBy("_of")).alias("_size"))
    out = placed.withColumn("_in", part).join(runs, (F.col("_in") == F.col("_part")) & (F.col("_group") == F.col("_of")))
    extra = [F.col("_size").alias(size)] if size else []
    return out.select("_row.*", (F.col("_at") - F.col("_first") + F.col("_before")).alias(number), *extra)
