"""Long <-> wide reshaping and labelled-count profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_max(df: DataFrame, by: list[str], element_col: str, value_col: str,
              elements: dict[str, str]) -> DataFrame:
    """Long -> wide: one column per listed element, max value per group.

    ``elements`` maps output column -> element code.  The list is fixed, so
    elements not listed (sparse extras) are ignored and no distinct pass is
    needed to discover pivot values.  Conditional ``max`` is algebraic: the
    partial aggregate shrinks a hot group before the shuffle.
    """
    aggs = [F.max(F.when(F.col(element_col) == F.lit(code), F.col(value_col))).alias(out)
            for out, code in elements.items()]
    return df.groupBy(*by).agg(*aggs)


def labelled_counts(df: DataFrame, labels: list[tuple[str, Column]],
                    label_col: str = "defect", count_col: str = "n") -> DataFrame:
    """One row per label with the number of rows where its predicate holds.

    One scan: all predicates are summed in a single global aggregate and the
    one-row result is unpivoted with ``stack``.
    """
    sums = [F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(f"_c{i}")
            for i, (_, pred) in enumerate(labels)]
    wide = df.agg(*sums)
    parts = ", ".join(f"'{name.replace(chr(39), chr(39) * 2)}', _c{i}" for i, (name, _) in enumerate(labels))
    return wide.selectExpr(f"stack({len(labels)}, {parts}) as ({label_col}, {count_col})")


def count_by(df: DataFrame, cols: list[str], count_col: str = "n", descending: bool = True) -> DataFrame:
    out = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))
    order = [F.col(count_col).desc() if descending else F.col(count_col).asc()] + [F.col(c) for c in cols]
    return out.orderBy(*order)


def duplicate_groups(df: DataFrame, keys: list[str], count_col: str = "n") -> DataFrame:
    """``GROUP BY keys HAVING count(*) > 1``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))
