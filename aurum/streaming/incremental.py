"""Incremental landing: new files in the landing folder are picked up once.

A Structured Streaming file source with ``trigger(availableNow=True)``
processes every file not yet recorded in the checkpoint, then stops -- the
batch job's result, without re-reading files already landed.  The sink is
Parquet in the shared folder (exactly-once via the checkpoint's commit log),
so an executor loss replays only the unfinished micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aurum.session import scratch_path


def land_available(spark: SparkSession, source_glob: str, schema: T.StructType,
                   target: str | None = None, checkpoint: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Land every not-yet-seen file matching ``source_glob``; return the table."""
    target = target or scratch_path(spark, "stream-target")
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.load(source_glob)
               .writeStream.format("parquet")
               .option("path", target)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
    return spark.read.schema(schema).parquet(target)
