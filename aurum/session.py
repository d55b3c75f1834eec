"""Session factory and the shared-folder helpers every job uses.

The cluster owns ``spark.checkpoint.dir`` (a shared folder every executor can
reach).  Jobs read it from the session; only local runs and tests set one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job relies on.  AQE re-plans joins from runtime sizes (its own
# size-checked broadcast), coalesces small shuffle partitions and splits
# skewed join partitions.  UTC + NTZ keep timestamps engine-independent.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs a shuffle later:
    # the dedup after the fact join then runs its partial aggregate first.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.ansi.enabled": "true",
}

# Bytes that a task reads, of a table or of a shuffle: at most these.  The trip tables take some
# 20 bytes a row compressed and ten times that in a sort, so tasks of Spark's usual sizes
# (128 and 64 MB) would spill.  Lower settings of a session stay.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20,
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20}


def bound_tasks(spark: SparkSession) -> None:
    """Lowers the session's split and shuffle partition sizes to ``TASK_BYTES``."""
    units = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for key, most in TASK_BYTES.items():
        size = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get(key).strip().lower())
        if size is None or int(size[1]) * units.get(size[2], 1 << 40) > most:
            spark.conf.set(key, str(most))


def build_session(master: str | None = None, app: str = "aurum",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return (or reuse) a session with the engine's settings applied.

    On a cluster ``master`` is None and the launcher decides.  Locally the
    caller passes ``local[N]``; shuffle partitions then default to N (AQE
    coalesces further).  On a cluster, size ``spark.sql.shuffle.partitions``
    to the data (~128 MB per partition at the largest shuffle).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is None and master and master.startswith("local"):
        cores = master[master.find("[") + 1:master.find("]")]
        n = (os.cpu_count() or 8) if cores in ("*", "") else int(cores)
        shuffle_partitions = n
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # Checkpoint files of DataFrames that are gone are removed by the cleaner.
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    A cluster sets ``spark.checkpoint.dir``; it is used as is.  Only a local
    session (tests, single-machine runs) may fall back to a folder of its own;
    on a cluster an unset value is an error, because a machine-local folder
    would not survive the loss of the executor that wrote it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="aurum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that start inside; then the old ones hold again."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: The shuffle files of a write go when it ends.  Otherwise they stay until the driver happens to collect
#: its garbage, and several writes in a row hold all their shuffles on the executors' disks at once.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def write_parquet(df, path: str) -> None:
    """A new Parquet folder in the shared folder: small files, no shuffle files left."""
    with settings(df.sparkSession, DROP_SHUFFLES):
        df.write.option("compression", "zstd").parquet(path)


def materialize(df):
    """Cut lineage: write the rows once, as Parquet, into the shared folder.

    For an intermediate with several consumers: each of them prunes columns in the
    scan, and the files survive the loss of the executor that wrote them.  Never a
    local checkpoint.
    """
    path = scratch_path(df.sparkSession, "materialized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
