"""Keep one row per natural key.

Semantics: ``row_number() over (partition by keys order by order_cols) = 1``,
NULLs first, NULL keys forming a group like any other value.

The window form plans a ``WindowGroupLimit`` on both sides of the shuffle: every
task passes on one row per key, so a key that owns a third of the table does not
gather in one task, and only the columns a consumer asks for are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A landed row's identity: the file it came from and its place in that file.
ROW_ID = ["_source_file", "_record_no"]


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (ascending, NULLs first)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def survivors(df: DataFrame, keys: list[str], order: list[str], row_id: list[str] = ROW_ID,
              carry: list[str] = ()) -> DataFrame:
    """The identity (and the ``carry`` columns) of every key's one survivor.

    ``row_id`` names the columns that identify a row (never NULL).  It is the last
    tie-breaker, so exact copies and NULL order values have one survivor too.
    """
    missing = [c for c in row_id if c not in df.columns]
    if missing:
        raise ValueError(f"label_survivors needs the row identity columns {missing}")
    cols = list(dict.fromkeys([*keys, *order, *row_id, *carry]))
    return keep_first(df.select(*cols), keys, [*order, *row_id]).select(*carry, *row_id)


def match_back(df: DataFrame, won: DataFrame, on: list[str] = ROW_ID, flag: str = "_survivor") -> DataFrame:
    """Every row, with a boolean ``flag``: whether ``won`` has its identity (the columns ``on``).

    The match-back hashes the survivors' identities, so the whole rows pass it unsorted; spread
    evenly, they make tables of about one shuffle partition's size.
    """
    return (df.join(won.withColumn(flag, F.lit(True)).hint("shuffle_hash"), on=on, how="left")
              .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
              .select(*df.columns, flag))


def label_survivors(df: DataFrame, keys: list[str], order: list[str], row_id: list[str] = ROW_ID,
                    flag: str = "_survivor") -> DataFrame:
    """Every row, with a boolean ``flag``: True for its key's one survivor.

    The row identity is the only key of the match-back: unique per row, it spreads a hot
    natural key over all partitions.
    """
    return match_back(df, survivors(df, keys, order, row_id), row_id, flag)
