"""Landing of many Parquet files whose schemas drifted: one scan per distinct schema.

The files are listed once; their footers are read in tasks, in parallel, and boiled down to
a text of names and types.  Files are grouped by it, and every distinct schema becomes one scan
over all its files -- the plan grows with the number of shapes, not of files.  Names of
files reach the driver, where Spark keeps the list of a scan's files in any case.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.sources.landing import PROVENANCE, batch_timestamp, folder_and_file, record_number, union_by_name, with_provenance

#: Footers that a task reads, about.
FILES_PER_TASK = 64


def _shape(path: str) -> str | None:
    """Names and types of a file's columns; None for a store that only Spark opens."""
    uri = "file://" + path[len("file:"):] if path.startswith("file:/") and not path.startswith("file://") else path
    try:
        fs, at = pafs.FileSystem.from_uri(uri)
    except (ValueError, OSError):
        return None
    with fs.open_input_file(at) as f:
        schema = pq.ParquetFile(f).schema_arrow
    return "; ".join(f"{c.name}: {c.type}" for c in schema)


def _shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch.path, "shape": [_shape(p) for p in batch.path]})


def file_shapes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, shape): every Parquet file under ``paths`` with its columns' names and types."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
                  .load(paths).select("path"))
    n = files.count()
    return files.repartition(max(1, -(-n // FILES_PER_TASK)), "path").mapInPandas(_shapes, "path string, shape string")


def land_drifted_files(spark: SparkSession, paths: list[str], source: str,
                       ingested_at: datetime.datetime | None = None) -> DataFrame:
    """All files under ``paths`` as one bronze table by column name (missing columns are NULL,
    types widen), with provenance from each file's own scan."""
    ts = ingested_at or batch_timestamp()
    groups = file_shapes(spark, paths).groupBy("shape").agg(F.sort_array(F.collect_list("path")).alias("files")).orderBy("shape").collect()
    scans = []
    for g in groups:
        for files in [g.files] if g.shape is not None else [[f] for f in g.files]:
            df = spark.read.schema(spark.read.parquet(files[0]).schema).parquet(*files)
            df = df.select(*[c for c in df.columns if c not in PROVENANCE], folder_and_file().alias("_source_file"), record_number(True).alias("_record_no"))
            scans.append(with_provenance(df, source, ts))
    if not scans:
        raise FileNotFoundError(f"no parquet file under {paths}")
    return union_by_name(scans)
