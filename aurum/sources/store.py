"""Layered, versioned Parquet tables in the shared folder.

A table is a folder ``<root>/<layer>/<name>/`` with one data folder per write and an
append-only commit log ``_log/``.  A data folder's name is never used twice and
never overwritten; it belongs to the table once a commit record names it, so a
failed, retried or concurrent write cannot harm a committed version.  Two
writers that start from the same version both commit; readers take the newest
record.  Row counts come from an ``Observation`` on the write, not a second scan.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from aurum.session import DROP_SHUFFLES, settings

LOG_SCHEMA = "version int, committed_at timestamp_ntz, n_rows bigint, note string, path string"
TARGET_FILE_BYTES = 128 << 20


def table_root(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def _log(spark: SparkSession, troot: str) -> DataFrame | None:
    """The log, or None when there is none yet; any other failure is raised."""
    try:
        return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).parquet(f"{troot}/_log")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def versions(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The commit log (one row per committed version)."""
    log = _log(spark, table_root(root, layer, name))
    return log if log is not None else spark.createDataFrame([], LOG_SCHEMA)


def latest_version(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """Newest commit: the highest version, of equal ones the last committed."""
    return (versions(spark, root, layer, name)
            .orderBy(F.col("version").desc(), F.col("committed_at").desc(), F.col("path").desc()).limit(1))


def write_version(df: DataFrame, root: str, layer: str, name: str, note: str = "",
                  files: int | None = None) -> dict:
    """Write ``df`` as the next version and append its commit record."""
    spark = df.sparkSession
    troot = table_root(root, layer, name)
    log = _log(spark, troot)
    prev = 0
    if log is not None:
        prev = log.agg(F.max("version")).first()[0] or 0   # one-row result
    version = prev + 1
    path = f"{troot}/v{version:06d}-{uuid.uuid4().hex[:12]}"
    obs = Observation(f"write_{layer}_{name}_{uuid.uuid4().hex[:8]}")
    out = df.repartition(files) if files else df
    # Observed in the write (result) stage, whose per-partition metrics are
    # counted once even when tasks are retried after an executor loss.
    out = out.observe(obs, F.count(F.lit(1)).alias("n_rows"))
    out.write.mode("errorifexists").parquet(path)
    n = obs.get["n_rows"]
    rec = spark.createDataFrame(
        [(version, datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None), int(n), note, path)],
        LOG_SCHEMA)
    # a folder of its own per commit: committers of one folder would remove each other's work
    rec.coalesce(1).write.mode("errorifexists").parquet(f"{troot}/_log/commit-{uuid.uuid4().hex[:12]}")
    return {"version": version, "path": path, "n_rows": int(n)}


def read_version(spark: SparkSession, info: dict) -> DataFrame:
    """The version that ``write_version`` returned."""
    return spark.read.parquet(info["path"])


def read_latest(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    v = latest_version(spark, root, layer, name).first()
    if v is None:
        raise FileNotFoundError(f"no committed version of {layer}.{name}")
    return spark.read.parquet(v.path)


def overwrite(df: DataFrame, path: str) -> None:
    """Idempotent reload of a scratch folder.  The old files go first, so a table that others
    read is reloaded by ``write_version`` or ``reload_partitions`` instead."""
    df.write.mode("overwrite").parquet(path)


def reload_partitions(df: DataFrame, path: str, by: list[str], dealt: bool = False) -> int:
    """Replace exactly the partitions of the table at ``path`` that ``df`` has rows of; returns
    the rows written.

    Rows are rebalanced by the partition columns (AQE splits a large partition over tasks and
    joins small ones), unless they are ``dealt`` out by them already.  Spark's dynamic
    overwrite stages the files and swaps partitions in when all tasks have succeeded:
    files of other partitions are not touched, a failed write changes nothing, and the
    same rows written again give the same table.  The shuffle files of the write go when it ends.
    """
    seen = Observation()
    out = (df if dealt else df.hint("rebalance", *by)).observe(seen, F.count(F.lit(1)).alias("n"))
    with settings(df.sparkSession, DROP_SHUFFLES):
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            .partitionBy(*by).parquet(path))
    return int(seen.get["n"])


def compact(spark: SparkSession, root: str, layer: str, name: str,
            target_bytes: int = TARGET_FILE_BYTES) -> dict:
    """Rewrite the newest version into files of about ``target_bytes`` as a new version.

    The number of files follows from the bytes on disk; ``repartition`` (a
    round-robin shuffle) evens their sizes.  The old version stays until expired.
    """
    cur = read_latest(spark, root, layer, name)
    size = (cur.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
               .groupBy("p").agg(F.max("s").alias("s")).agg(F.sum("s")).first()[0]) or 0
    files = max(1, -(-size // target_bytes))
    return write_version(cur, root, layer, name, note=f"compaction to {files} files", files=files)


def _cents(col: str, digits: int = 2):
    """A double as whole units of 10**-digits, rounded per row."""
    return F.floor(F.col(col) * F.lit(10.0 ** digits) + F.lit(0.5)).cast("decimal(38,0)")


def fingerprint(df: DataFrame, sum_col: str) -> DataFrame:
    """Content version: row count and column sum, hashed.

    The sum adds whole hundredths, rounded per row, so it does not depend on the
    order of the rows and is the same on any engine.
    """
    one = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.coalesce(F.sum(_cents(sum_col)), F.lit(0)).cast("bigint").alias("sum_cents"))
    text = F.concat_ws("|", F.col("n_rows").cast("string"), F.col("sum_cents").cast("string"))
    return one.select("n_rows", "sum_cents", F.substring(F.sha2(text, 256), 1, 16).alias("data_version"))


def row_hash(exact: list[str], decimals: dict[str, int] | None = None):
    """60 bits of the md5 of a row's text: the ``exact`` columns as they are, the ``decimals``
    columns as whole units."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in exact]
    parts += [F.coalesce(_cents(c, d).cast("string"), F.lit("~")) for c, d in (decimals or {}).items()]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("decimal(38,0)")


def content_hash(df: DataFrame, exact: list[str], decimals: dict[str, int] | None = None) -> DataFrame:
    """Order-free content hash: the sum of every row's ``row_hash``.  A sum, unlike XOR, also
    notices rows that occur an even number of times."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.coalesce(F.sum(row_hash(exact, decimals)), F.lit(0)).cast("string").alias("content_hash"))
