"""Incremental silver: new trip files go through bronze into the tagged silver table, once.

Every micro-batch of a Structured Streaming file source is merged by ``foreachBatch``:

1. Its rows, stamped with provenance from their own scan, replace the bronze partitions of its
   batch id (dynamic partition overwrite).
2. Natural keys lie within a pickup month, so only the months that the batch brings rows
   for can change.  Their survivors and verdicts are made anew from bronze and replace their
   partitions of the tagged table: a late row may take a key over, and the row that had it
   becomes a quarantined duplicate.  One job takes months up to ``JOB_ROWS`` rows, so the
   whole rows that are in shuffle files at a time do not grow with the table; where the
   months need several jobs, the survivors of all of them are found and written first.
3. A commit record carries the batch id, rows and months.

Each step writes whole partitions that depend on nothing but the batch id and bronze, so a batch
that is run again after a crash -- Spark promises at least once -- gives the same tables.
Work per batch follows the months that it touches, not the table.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.operators.dedup import ROW_ID, match_back
from aurum.plans import trips
from aurum.session import settings
from aurum.sources.landing import PROVENANCE, folder_and_file, with_provenance
from aurum.sources.store import reload_partitions

MONTH = "pickup_month"
#: Rows that one job gives their verdicts; a month that has more is a job of its own.
JOB_ROWS = 24_000_000
#: Rows of one month that a task writes, about.
SLOT_ROWS = 250_000
#: The match-back's rows are dealt out by month and slot: not again by the other columns that it compares.
DEALT_ONCE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
LOG_SCHEMA = "batch_id bigint, committed_at timestamp_ntz, n_rows bigint, months array<int>"


def _paths(root: str) -> tuple[str, str, str, str]:
    return tuple(f"{root.rstrip('/')}/{n}" for n in ("bronze_trips", "tagged_trips", "batches", "survivors"))


def _month(pickup: str):
    """yyyymm of the pickup; 0 where there is none."""
    return F.coalesce(F.year(pickup) * 100 + F.month(pickup), F.lit(0))


def _jobs(counts: dict[int, int]) -> list[dict[int, int]]:
    """The months with their rows, in order, taken together up to ``JOB_ROWS``."""
    jobs: list[dict[int, int]] = []
    for month, n in sorted(counts.items()):
        if not jobs or sum(jobs[-1].values()) + n > JOB_ROWS:
            jobs.append({})
        jobs[-1][month] = n
    return jobs


def _tag_months(landed: DataFrame, won: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Verdicts of the bronze rows of some months, whose rows it counts.

    One shuffle serves the match-back and the write: rows and survivors are dealt out by month and,
    within it, by the row identity's hash over as many slots as the month needs."""
    slots = {m: -(-n // SLOT_ROWS) for m, n in counts.items()}
    width = F.lit(1)
    for w in set(slots.values()) - {1}:
        width = F.when(F.col(MONTH).isin([m for m in slots if slots[m] == w]), w).otherwise(width)
    slot = F.pmod(F.xxhash64(*ROW_ID), width).alias("_slot")
    here = F.col(MONTH).isin(list(counts))
    rows = trips.rules_tagged(trips.typed(landed.filter(here), keep=[*PROVENANCE, MONTH])).select("*", slot)
    n, usual = -(-sum(counts.values()) // SLOT_ROWS), int(landed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, MONTH, "_slot") if n > usual else rows.repartition(MONTH, "_slot")
    labelled = match_back(rows, won.filter(here).select("*", slot), [MONTH, "_slot", *ROW_ID])
    return trips.duplicates_tagged(labelled.drop("_slot"))


def merge_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """One micro-batch of bronze rows with provenance into the tables under ``root``."""
    spark = batch.sparkSession
    bronze, tagged, log, won = _paths(root)
    rows = batch.select("*", F.lit(batch_id).cast("bigint").alias("batch_id"), _month("pickup_datetime").alias(MONTH))
    n_rows = reload_partitions(rows, bronze, ["batch_id", MONTH])
    landed = spark.read.parquet(bronze)
    months = sorted(r[0] for r in landed.filter(F.col("batch_id") == batch_id).select(MONTH).distinct().collect())  # a calendar
    if months:
        touched = landed.filter(F.col(MONTH).isin(months))
        jobs = _jobs(dict(touched.groupBy(MONTH).count().collect()))     # a calendar
        survivors = trips.key_survivors(trips.typed(touched, keep=[MONTH]), [MONTH])
        if len(jobs) > 1:
            reload_partitions(survivors, won, [MONTH])
            survivors = spark.read.parquet(won)
        for counts in jobs:
            with settings(spark, DEALT_ONCE):
                reload_partitions(_tag_months(landed, survivors, counts), tagged, [MONTH], dealt=True)
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    record = spark.createDataFrame([(batch_id, now, n_rows, months)], LOG_SCHEMA)
    reload_partitions(record, log, ["batch_id"])


def land_silver(spark: SparkSession, source_glob: str, schema: T.StructType, root: str, checkpoint: str,
                source: str = "trips", max_files_per_trigger: int | None = None) -> None:
    """Merges every file of the feed that the checkpoint has not seen, then stops."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source_glob).select("*", folder_and_file().alias("_source_file"), F.col("_metadata.row_index").alias("_record_no"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(with_provenance(batch, source), batch_id, root)

    (rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())


def _tagged(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(_paths(root)[1])


def read_silver(spark: SparkSession, root: str, provenance: bool = False) -> DataFrame:
    accepted = _tagged(spark, root).filter(F.col("_reject_reason").isNull())
    return accepted.select(*(PROVENANCE if provenance else []), *trips.SILVER_COLUMNS)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rejected rows with reason and provenance."""
    rejected = _tagged(spark, root).filter(F.col("_reject_reason").isNotNull())
    return rejected.select(*PROVENANCE, *trips.SILVER_COLUMNS, "_reject_reason")


def batches(spark: SparkSession, root: str) -> DataFrame:
    """The commit records, one per batch."""
    return spark.read.parquet(_paths(root)[2])
