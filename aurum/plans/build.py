"""End-to-end run: land -> silver (+ quarantines) -> gold (+ quarantine) -> gate.

Each model is written as a new version of a table in its layer
(``<root>/<layer>/<name>/vNNNNNN``); downstream models read the written
upstream tables, so every layer boundary also cuts lineage, and a failure
re-runs from the last written layer, not from the raw feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.operators import quality as Q
from aurum.plans import dims, feeds, trips
from aurum.session import materialize, scratch_path
from aurum.sources import adapters as A
from aurum.sources import landing as L
from aurum.sources import store
from aurum.sources.tables import Tables

RUN_SCHEMA = "layer string, table_name string, version int, n_rows bigint"


def run(spark: SparkSession, sf_dir: str, root: str | None = None,
        checks: list | None = None, raise_on_closed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Build every layer once; returns (tables written, gate report)."""
    root = root or scratch_path(spark, "layers")
    t = Tables(spark, sf_dir)
    ts = L.batch_timestamp()
    written = []

    def put(df, layer, name, files=None):
        info = store.write_version(df, root, layer, name, files=files)
        written.append((layer, name, info["version"], info["n_rows"]))
        return spark.read.parquet(info["path"])

    # ---- bronze: verbatim + provenance, nothing that can fail
    b_trips = put(L.with_provenance(A.raw_trips(t), "trips", ts), "bronze", "raw_trips")
    b_zones = put(L.with_provenance(A.raw_zone_lookup(t), "zone_lookup", ts),
                  "bronze", "raw_zone_lookup")
    b_daily = put(L.with_provenance(A.raw_daily_long(t), "daily", ts), "bronze", "raw_daily")
    b_log = put(L.with_provenance(A.app_log_lines(t), "app_log", ts, F.col("_file"), F.col("_line_no")), "bronze", "raw_app_log")

    # ---- silver: verdicts computed once, split into accepted and quarantined
    tagged = materialize(trips.silver_tagged(b_trips))
    s_trips = put(tagged.filter(F.col("_reject_reason").isNull()).select(*trips.SILVER_COLUMNS), "silver", "trips")
    put(tagged.filter(F.col("_reject_reason").isNotNull()), "silver", "trips_quarantine")
    s_zones = put(dims.zone_silver(b_zones), "silver", "zones")
    put(dims.zone_quarantine(b_zones), "silver", "zones_quarantine")
    s_daily = put(dims.daily_wide(b_daily).orderBy("obs_date"), "silver", "daily")
    put(dims.qc_quarantine(b_daily), "silver", "daily_quarantine")
    put(feeds.app_events(b_log), "silver", "app_events")
    put(feeds.app_log_quarantine(b_log), "silver", "app_log_quarantine")

    # ---- gold
    g = put(trips.gold(s_trips, s_zones, s_daily), "gold", "fct_trips")
    put(trips.quarantine_fact(s_trips), "gold", "fct_trips_quarantine")

    # ---- gate on the written tables
    from aurum.plans.catalog import promotion_gate
    frames = {"stg_trips": s_trips, "stg_daily": s_daily, "stg_zones": s_zones, "fct_trips": g}
    report = put(Q.run_checks(checks or promotion_gate(), frames), "audit", "gate_report")
    if raise_on_closed:
        Q.assert_open(report)
    return spark.createDataFrame(written, RUN_SCHEMA), report
