"""Bronze landing: every source shape lands with the same provenance columns.

Bronze keeps arrival fidelity (text stays text, the raw payload is kept),
adds ``_source, _source_file, _ingested_at, _record_no`` and applies no cast
that can fail.  All readers declare their schema; nothing is inferred.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROVENANCE = ["_source", "_source_file", "_ingested_at", "_record_no"]


def batch_timestamp() -> datetime.datetime:
    """One landing time per run (UTC, whole seconds, no zone)."""
    return datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None, microsecond=0)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Columns aligned by name; a column missing from a source becomes NULL.

    Numeric types widen (int + bigint -> bigint), where ``mergeSchema`` on
    Parquet would refuse the file set.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_parquet_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Multi-file Parquet landing, one read per file shape, unioned by name."""
    return union_by_name([spark.read.parquet(p) for p in paths])


def folder_and_file(path: str = "_metadata.file_path") -> Column:
    """The last folder and the file name of a path: by its slashes, as a pattern that ends at the
    path's end is tried from every character of it, row by row."""
    return F.substring_index(F.col(path), "/", -2)


def land_parquet_files(spark: SparkSession, paths: list[str], source: str,
                       ingested_at: datetime.datetime | None = None) -> DataFrame:
    """Land several Parquet files/folders of one feed as one bronze table.

    Each path is read on its own (its own schema), stamped with provenance
    from its own scan -- landed folder and file, and the row's index in that
    file -- and the shapes are unioned by name (missing columns -> NULL).
    """
    ts = ingested_at or batch_timestamp()
    frames = []
    for p in paths:
        df = spark.read.parquet(p)
        df = df.drop(*[c for c in PROVENANCE if c in df.columns])
        frames.append(with_provenance(df, source, ts, source_file=folder_and_file(),
                                      record_no=record_number(parquet_scan=True)))
    return union_by_name(frames)


def record_number(parquet_scan: bool = False) -> Column:
    """Record number without a global sort.

    A Parquet scan exposes the row's position in its file
    (``_metadata.row_index``: unique per file, stable across re-reads); other
    sources use ``monotonically_increasing_id`` (unique, not dense).  Both
    are computed inside the scan task -- no single-partition window.
    """
    return F.col("_metadata.row_index") if parquet_scan else F.monotonically_increasing_id()


def with_provenance(df: DataFrame, source: str, ingested_at: datetime.datetime | None = None,
                    source_file: Column | None = None, record_no: Column | None = None) -> DataFrame:
    """The four provenance columns in front of the payload.  A frame that carries its
    row identity already (taken from the scan) keeps it."""
    ts = ingested_at or batch_timestamp()
    if source_file is None:
        source_file = F.col("_source_file" if "_source_file" in df.columns else "_metadata.file_name")
    if record_no is None:
        record_no = F.col("_record_no") if "_record_no" in df.columns else record_number()
    prov = [F.lit(source).alias("_source"), source_file.alias("_source_file"),
            F.lit(ts).cast("timestamp_ntz").alias("_ingested_at"), record_no.alias("_record_no")]
    return df.select(*prov, *[F.col(c) for c in df.columns if c not in PROVENANCE])


def year_filter(df: DataFrame, ymd_col: str, years: list[str]) -> DataFrame:
    """Landing-time window: keep rows whose yyyymmdd text starts with a year."""
    return df.filter(F.substring(F.col(ymd_col), 1, 4).isin(list(years)))


# ------------------------------------------------------------ text sources
def string_schema(names: list[str], corrupt: str | None = None) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType(), True))
    return T.StructType(fields)


def read_csv_strings(spark: SparkSession, path: str, columns: list[str], header: bool = True,
                     multiline: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """Delimited text, every column a string, ragged/bad rows kept.

    PERMISSIVE pads short rows with NULL and, for rows that do not fit, keeps
    the raw line in ``_corrupt_record``.  ``multiline`` (quoted newlines)
    makes a file unsplittable: one task per file, so only for small files; large
    ones are read by ``ranges.quoted_records``.
    """
    return (spark.read
            .schema(string_schema(columns, "_corrupt_record"))
            .option("header", header)
            .option("multiLine", multiline)
            .option("encoding", encoding)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw line landing: one string column ``_raw``, corrupt lines included."""
    return spark.read.text(path).withColumnRenamed("value", "_raw")


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """A JSON *array* document: one row per element, element kept as text.

    A whole-file read is one task per file; large feeds should arrive as JSON lines or as one
    array per line (``json_arrays.land_json_arrays``), which split.
    """
    doc = spark.read.text(path, wholetext=True)
    return doc.select(F.explode(F.from_json("value", "array<variant>")).alias("j")) \
              .select(F.to_json("j").alias("_raw"))
