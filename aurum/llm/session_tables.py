"""Small helpers the operators share: a written cut of lineage, a size-checked join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.session import scratch_path

#: A side may be broadcast up to so many rows of a narrow (key plus a few numbers) table.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, read by
    every consumer with column pruning, and still there after an executor is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written, narrow table) marked for broadcast when its counted rows
    are at most ``rows``; beyond that it is left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """Every row as one struct ``_row`` beside the named keys, so that no column of
    the input can clash with a helper column."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("_row"), *[v.alias(k) for k, v in keys.items()])


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("_row.*")
