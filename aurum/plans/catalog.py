"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Every query reads the given tables (or what Spark derives from them) in
full; nothing is sampled, capped or subset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.functions import clean as C
from aurum.operators import boosting
from aurum.operators import experiment as X
from aurum.operators import quality as Q
from aurum.operators.hash_tree import differing_ranges, hash_tree
from aurum.operators.joins import lookup, missing_references
from aurum.operators.quarantine import conservation as _conservation
from aurum.operators.quarantine import tag_reasons
from aurum.operators.reshape import count_by, duplicate_groups, labelled_counts
from aurum.plans import dims, feeds, trips
from aurum.plans.layers import Layers
from aurum.session import materialize, scratch_path, write_parquet
from aurum.sources import adapters as A
from aurum.sources import landing as L
from aurum.sources import store
from aurum.sources.footers import land_drifted_files
from aurum.sources.json_arrays import land_json_arrays
from aurum.sources.ranges import numbered_lines, quoted_cells, quoted_records
from aurum.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------ shared plans
def _bronze(spark, sf):
    return A.raw_trips(Tables(spark, sf))


def _silver(spark, sf):
    return trips.silver(_bronze(spark, sf))


def _zones(spark, sf):
    return dims.zone_silver(A.raw_zone_lookup(Tables(spark, sf)))


def _daily(spark, sf):
    return dims.daily_wide(A.raw_daily_long(Tables(spark, sf)))


def _gold(spark, sf):
    return trips.gold(_silver(spark, sf), _zones(spark, sf), _daily(spark, sf))


# ------------------------------------------------------------ slice 1
@query("bronze_rename")
def bronze_rename(spark, sf):
    return _bronze(spark, sf)


@query("silver_typed")
def silver_typed(spark, sf):
    return trips.typed(_bronze(spark, sf))


@query("dedup_row_number")
def dedup_row_number(spark, sf):
    return trips.deduplicated(_bronze(spark, sf))


@query("silver_fact")
def silver_fact(spark, sf):
    return _silver(spark, sf)


@query("gold_fact")
def gold_fact(spark, sf):
    return _gold(spark, sf)


# ------------------------------------------------------------ scans, sources


def _t(spark, sf):
    return Tables(spark, sf)


@query("bronze_union_by_name")
def bronze_union_by_name(spark, sf):
    """Two differently shaped party feeds aligned by column name.

    Suppliers have no market segment (NULL after the union); the supplier
    feed carries its nation key as bigint, customers' is int, and the union
    widens to bigint.
    """
    t = _t(spark, sf)
    cust = t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                             F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("acctbal"),
                             F.col("c_mktsegment").alias("mktsegment"), F.lit("customer").alias("party_type"))
    supp = t.supplier.select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                             F.col("s_nationkey").cast("bigint").alias("nation_key"),
                             F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("party_type"))
    return L.union_by_name([cust, supp])


@query("bronze_provenance")
def bronze_provenance(spark, sf):
    """Lineitem landed with its provenance (row index per file; the landing time, which
    differs from run to run, is left out of the result)."""
    li = _t(spark, sf).lineitem
    return L.with_provenance(li, "lineitem", record_no=L.record_number(parquet_scan=True)).drop("_ingested_at")


@query("record_no")
def record_no(spark, sf):
    """Record numbers are unique per (file, record): count == count distinct."""
    p = bronze_provenance(spark, sf).select("_source_file", "_record_no")
    return p.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("_source_file", "_record_no").alias("n_distinct"))


@query("file_basename")
def file_basename(spark, sf):
    p = _t(spark, sf).pages.select("page_id", "url")
    return p.select("page_id", C.file_basename("url").alias("basename"))


@query("landing_year_filter")
def landing_year_filter(spark, sf):
    """Landing keeps only the chosen years of a yyyymmdd text column."""
    o = _t(spark, sf).orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("ymd"))
    return L.year_filter(o, "ymd", ["1996", "1997"])


@query("idempotent_overwrite")
def idempotent_overwrite(spark, sf):
    """Reloading twice leaves exactly one copy (a new version each time, not an append); a reader
    sees the old one until the new one is committed."""
    root = scratch_path(spark, "reload")
    z = _zones(spark, sf)
    store.write_version(z, root, "silver", "zones")
    store.write_version(z, root, "silver", "zones")
    return store.read_latest(spark, root, "silver", "zones")


RELOADED_MONTH = 199603


def _monthly(trips_df):
    p = F.col("pickup_datetime")
    return trips_df.withColumn("month", F.coalesce(F.year(p) * 100 + F.month(p), F.lit(0)))


@query("partial_reload")
def partial_reload(spark, sf):
    """Trips partitioned by pickup month; one month was loaded with a fault and is loaded again.
    Per month: rows, fares, and whether its files are the ones of the first load."""
    path = scratch_path(spark, "monthly")
    good = _monthly(_bronze(spark, sf).select("order_key", "line_no", "pickup_datetime", "fare_amount"))
    here = F.col("month") == RELOADED_MONTH
    faulty = good.withColumn("fare_amount", F.when(here, F.lit(0.0)).otherwise(F.col("fare_amount")))
    store.reload_partitions(faulty, path, ["month"])
    def files(name):  # noqa: E306
        return (spark.read.parquet(path).select("month", F.col("_metadata.file_path").alias("f")).distinct()
                     .groupBy("month").agg(F.sort_array(F.collect_set("f")).alias(name)))     # a few names a month
    before = materialize(files("before"))
    store.reload_partitions(good.filter(here), path, ["month"])
    rows = spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"),
                                                        F.sum(store._cents("fare_amount")).cast("bigint").alias("fare_cents"))
    kept = before.join(files("after"), "month").select("month", (F.col("before") == F.col("after")).alias("files_kept"))
    return rows.join(kept, "month")


@query("training_frame")
def training_frame(spark, sf):
    return X.training_frame(_gold(spark, sf))


@query("compact_table")
def compact_table(spark, sf):
    """Version 1 written as many small files, compacted by size into version 2; rows unchanged."""
    root = scratch_path(spark, "lake")
    store.write_version(_silver(spark, sf), root, "silver", "trips", files=16)
    store.compact(spark, root, "silver", "trips")
    return store.read_latest(spark, root, "silver", "trips")


@query("latest_version")
def latest_version(spark, sf):
    root = scratch_path(spark, "lake")
    store.write_version(_zones(spark, sf), root, "silver", "zones")
    first = store.write_version(_silver(spark, sf), root, "silver", "zones_and_trips")
    store.write_version(spark.read.parquet(first["path"]), root, "silver", "zones_and_trips")
    return store.latest_version(spark, root, "silver", "zones_and_trips").select("version", "n_rows")


@query("incremental_landing")
def incremental_landing(spark, sf):
    from aurum.streaming.incremental import land_available  # streaming module loaded on demand
    return land_available(spark, f"{sf.rstrip('/')}/lineitem*.parquet",
                          _t(spark, sf).lineitem.schema)


# ------------------------------------------------------------ projections / predicates
@query("try_cast_ints")
def try_cast_ints(spark, sf):
    """Text keys, some with thousands separators: a tolerant cast NULLs those."""
    p = _t(spark, sf).part.select("p_partkey", F.format_number("p_partkey", 0).alias("key_text"))
    return p.select("p_partkey", "key_text", C.tolerant_cast("key_text", "int").alias("key_int"))


@query("repair_thousands")
def repair_thousands(spark, sf):
    p = _t(spark, sf).part.select("p_partkey", F.format_number("p_partkey", 0).alias("key_text"))
    return p.select("p_partkey", "key_text", C.tolerant_int("key_text").alias("key_int"))


@query("drift_default")
def drift_default(spark, sf):
    b = _bronze(spark, sf).select("order_key", "line_no", "part_key", "late_fee")
    return b.select("order_key", "line_no", "part_key",
                    C.default_if_null(F.col("late_fee").cast("double"), 0.0).alias("late_fee"))


def _messy_segment():
    """Market segment text with blanks, padding and sentinels (deterministic)."""
    s = F.col("c_mktsegment")
    return (F.when(s == "HOUSEHOLD", F.lit("N/A"))
             .when(s == "MACHINERY", F.lit("   "))
             .when(s == "BUILDING", F.lit("NULL"))
             .otherwise(F.concat(F.lit("  "), s, F.lit(" "))))


@query("null_sentinels")
def null_sentinels(spark, sf):
    c = _t(spark, sf).customer.select("c_custkey", _messy_segment().alias("segment_raw"))
    return c.select("c_custkey", "segment_raw", C.blank_to_null("segment_raw", "N/A", "NULL").alias("segment"))


@query("repair_quote")
def repair_quote(spark, sf):
    n = _t(spark, sf).nation.select("n_nationkey",
                                    F.replace(F.col("n_name"), F.lit("_"), F.lit("\u0092")).alias("zone_raw"))
    return n.select("n_nationkey", "zone_raw", C.repair_smart_quote("zone_raw").alias("zone"))


@query("range_filter")
def range_filter(spark, sf):
    """Silver's conjunctive range filter on typed rows (no dedup)."""
    t = trips.typed(_bronze(spark, sf))
    return t.filter(C.all_of([~p for _, p in trips.silver_rules()])).select(*trips.SILVER_COLUMNS)


@query("month_window")
def month_window(spark, sf):
    """Half-open window: the offline silver keeps one pickup month."""
    return trips.silver(_bronze(spark, sf), window=("1996-01-01", "1996-02-01"))


@query("domain_filter")
def domain_filter(spark, sf):
    z = A.raw_zone_lookup(_t(spark, sf))
    return z.filter(F.col("Borough").isin(A.ACCEPTED_BOROUGHS))


@query("not_null_filter")
def not_null_filter(spark, sf):
    """Trips whose both boroughs resolved (left-join NULLs rejected)."""
    e = trips.enriched(_silver(spark, sf), _zones(spark, sf), _daily(spark, sf))
    return (e.filter(F.col("pickup_borough").isNotNull() & F.col("dropoff_borough").isNotNull())
             .select("order_key", "line_no", "pickup_borough", "dropoff_borough"))


@query("negated_guard")
def negated_guard(spark, sf):
    return trips.negated_guard(_silver(spark, sf))


@query("reject_reason")
def reject_reason(spark, sf):
    """First failing silver rule per typed row (NULL = passes)."""
    t = trips.typed(_bronze(spark, sf))
    return tag_reasons(t, trips.silver_rules()).select("order_key", "line_no", "part_key", "_reject_reason")


@query("binary_flags")
def binary_flags(spark, sf):
    return _daily(spark, sf).select("obs_date", "is_wet_day", "is_snow_day")


@query("star_replace")
def star_replace(spark, sf):
    """``SELECT * REPLACE (fare_amount * 12 AS tip_amount)``."""
    b = _bronze(spark, sf)
    return b.withColumn("tip_amount", F.col("fare_amount") * F.lit(12.0))


@query("derived_filter")
def derived_filter(spark, sf):
    """Filter on a derived alias (offline gold: avg_speed_mph < 80)."""
    return trips.gold_offline(_silver(spark, sf))


@query("qc_exclude")
def qc_exclude(spark, sf):
    return dims.daily_valid(A.raw_daily_long(_t(spark, sf)))


@query("complete_cases")
def complete_cases(spark, sf):
    return X.complete_cases(X.training_frame(_gold(spark, sf)), X.WEATHER_FEATURES)


# ------------------------------------------------------------ joins
@query("role_playing_join")
def role_playing_join(spark, sf):
    s, z = _silver(spark, sf), _zones(spark, sf)
    f = lookup(s, z, "pickup_location_id", "location_id", {"borough": "pickup_borough"})
    f = lookup(f, z, "dropoff_location_id", "location_id", {"borough": "dropoff_borough"})
    return f.select("order_key", "line_no", "pickup_borough", "dropoff_borough")


@query("date_left_join")
def date_left_join(spark, sf):
    e = _t(spark, sf).events.select("event_id", "ts")
    f = lookup(e, _daily(spark, sf), F.to_date("ts"), "obs_date",
               {"obs_date": "obs_date", "precip_mm": "precip_mm", "tmax_c": "tmax_c"})
    return f.select("event_id", "obs_date", "precip_mm", "tmax_c")


def _lift_frame(spark, sf):
    """Offline gold inner-joined to the daily table (uncovered days drop)."""
    g = trips.gold_offline(_silver(spark, sf))
    d = _daily(spark, sf).select("obs_date", *trips.WEATHER_COLUMNS)
    j = g.join(d, trips.weather_key() == F.col("obs_date"), "inner")
    return j.select("order_key", "line_no", *X.BASE_FEATURES, X.TARGET, *trips.WEATHER_COLUMNS)


@query("date_inner_join")
def date_inner_join(spark, sf):
    return _lift_frame(spark, sf)


@query("relationships_check")
def relationships_check(spark, sf):
    """Silver pickup locations with no row in the zone dimension."""
    return missing_references(_silver(spark, sf), "pickup_location_id", _zones(spark, sf), "location_id")


# ------------------------------------------------------------ aggregations
@query("pivot_daily")
def pivot_daily(spark, sf):
    return dims.daily_pivot(A.raw_daily_long(_t(spark, sf)))


@query("daily_wide")
def daily_wide(spark, sf):
    return _daily(spark, sf).orderBy("obs_date")


@query("failed_qc_by_element")
def failed_qc_by_element(spark, sf):
    return dims.failed_qc_by_element(A.raw_daily_long(_t(spark, sf)))


def _defects():
    fare, d = F.col("fare_amount"), F.col("trip_distance_mi")
    p = F.col("pickup_at")
    lo, hi = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"), F.lit("1996-02-01 00:00:00").cast("timestamp_ntz")
    # ---- fixed defect labels ----
    return [
        ("negative fare", fare <= 0),
        ("dropoff before pickup", F.col("dropoff_at") < p),
        ("zero distance", d == 0),
        ("distance > 100mi", d > 100),
        ("passenger_count = 0", F.col("passenger_count") == 0),
        ("passenger_count null", F.col("passenger_count").isNull()),
        ("passenger_count > 6", F.col("passenger_count") > 6),
        ("pickup outside month", (p < lo) | (p >= hi)),
    ]


@query("defect_profile")
def defect_profile(spark, sf):
    """What bronze contains, one labelled count per defect, from ONE scan."""
    t = trips.typed(_bronze(spark, sf))
    return labelled_counts(t, _defects()).orderBy(F.col("n").desc(), F.col("defect"))


@query("gold_summary")
def gold_summary(spark, sf):
    g = _gold(spark, sf)
    return g.agg(F.count(F.lit(1)).alias("n_rows"),
                 C.round_half_up(F.avg("trip_duration_min"), 2).alias("avg_min"),
                 C.round_half_up(F.avg("avg_speed_mph"), 2).alias("avg_mph"),
                 C.round_half_up(F.avg("tip_rate"), 4).alias("avg_tip_rate"),
                 F.min("pickup_at").alias("min_pickup"), F.max("pickup_at").alias("max_pickup"))


@query("text_profile")
def text_profile(spark, sf):
    t = _t(spark, sf)
    return feeds.text_profile(t.documents.select("doc_id", "text"), t.labels.select("doc_id"))


@query("coverage_summary")
def coverage_summary(spark, sf):
    return dims.coverage_summary(_daily(spark, sf))


@query("duplicate_groups")
def duplicate_groups_q(spark, sf):
    li = _t(spark, sf).lineitem.select("l_orderkey", "l_linenumber")
    return duplicate_groups(li, ["l_orderkey", "l_linenumber"])


GOLD_ROW_FLOOR = 50000


@query("row_floor")
def row_floor(spark, sf):
    """``SELECT count(*) FROM gold HAVING count(*) < floor`` (0 or 1 row)."""
    g = _gold(spark, sf)
    return g.agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") < GOLD_ROW_FLOOR)


@query("reject_rollup")
def reject_rollup(spark, sf):
    """All quarantines rolled up by source and reason.

    The silver verdicts are materialized once; silver rejects and the gold
    guard's rejects both read them.
    """
    lay = Layers(spark, sf, materialize={"typed", "silver_tagged"})
    t = lay.t
    parts = [
        dims.zone_quarantine(A.raw_zone_lookup(t)).select(F.lit("zone_lookup").alias("src"), "_reject_reason"),
        feeds.app_log_quarantine(A.app_log_lines(t)).select(F.lit("app_log").alias("src"), "_reject_reason"),
        dims.qc_quarantine(A.raw_daily_long(t)).select(F.lit("daily").alias("src"), "_reject_reason"),
        lay.silver_tagged.filter(F.col("_reject_reason").isNotNull())
           .select(F.lit("trips_silver").alias("src"), "_reject_reason"),
        trips.quarantine_fact(lay.silver_accepted).select(F.lit("trips_gold").alias("src"), "_reject_reason"),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("src", "_reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("count_by_dim")
def count_by_dim(spark, sf):
    return count_by(_zones(spark, sf), ["borough"], "zones")


@query("layer_counts")
def layer_counts(spark, sf):
    """Rows per layer and the bronze->silver drop, as one row (no cross join).

    Bronze and silver counts come from one pass over the tagged rows; gold
    is built from the materialized accepted rows.
    """
    lay = Layers(spark, sf, materialize={"typed", "silver_tagged"})
    tagged = lay.silver_tagged
    bs = tagged.agg(F.count(F.lit(1)).alias("bronze"),
                    F.count(F.when(F.col("_reject_reason").isNull(), F.lit(1))).alias("silver"))
    g = trips.gold(lay.silver_accepted, lay.zones, lay.daily).agg(F.count(F.lit(1)).alias("gold"))
    u = (bs.select(F.lit(1).alias("_k"), "bronze", "silver")
           .unionByName(g.select(F.lit(1).alias("_k"), "gold"), allowMissingColumns=True)
           .groupBy("_k").agg(F.max("bronze").alias("bronze"), F.max("silver").alias("silver"),
                              F.max("gold").alias("gold")))
    drop = F.col("bronze") - F.col("silver")
    return u.select("bronze", "silver", "gold", drop.alias("dropped"),
                    C.round_half_up(F.lit(100.0) * drop / F.col("bronze"), 2).alias("dropped_pct"))


@query("data_version")
def data_version(spark, sf):
    return store.fingerprint(_gold(spark, sf), "trip_duration_min")


@query("data_fingerprint")
def data_fingerprint(spark, sf):
    """Order-free hash of eight gold columns only, as its SQL has them; ``gold_content_hash`` covers all."""
    return store.content_hash(_gold(spark, sf), ["order_key", "line_no", "vendor_id", "pickup_hour", "pickup_borough"],
                              {"trip_duration_min": 2, "avg_speed_mph": 2, "tip_rate": 4})


def _whole_gold_hash(gold):
    exact = [c for c in trips.GOLD_COLUMNS if c not in trips.GOLD_DOUBLES]
    return store.content_hash(gold, exact, {c: 6 for c in trips.GOLD_DOUBLES})


@query("gold_content_hash")
def gold_content_hash(spark, sf):
    """Order-free content hash of every gold column; doubles count to the sixth decimal."""
    return _whole_gold_hash(_gold(spark, sf))


@query("version_diff")
def version_diff(spark, sf):
    """Silver is written twice, some rows changed and some left out in between; the trees of hashes
    of the two versions name the key ranges that differ."""
    root = scratch_path(spark, "lake")
    k = F.col("order_key")
    old = store.read_version(spark, store.write_version(_silver(spark, sf), root, "silver", "trips"))
    changed = old.filter(k % 1499 != 7).withColumn("fare_amount", F.col("fare_amount") + F.when(k % 997 == 5, 0.01).otherwise(0.0))
    new = store.read_version(spark, store.write_version(changed, root, "silver", "trips"))
    cents = {c: 2 for c in ("trip_distance_mi", "fare_amount", "tip_amount", "total_amount", "late_fee")}
    exact = [c for c in trips.SILVER_COLUMNS if c not in cents]
    old_tree, new_tree = (materialize(hash_tree(v, "order_key", exact, cents)) for v in (old, new))
    return differing_ranges(old_tree, new_tree)


# ------------------------------------------------------------ sort / limit
#: Rows of the corrupt upstream file.
CORRUPT_ROWS = 900


@query("first_n")
def first_n(spark, sf):
    """First ``CORRUPT_ROWS`` eligible rows under a total order (repeatable ``LIMIT``)."""
    b = _bronze(spark, sf)
    elig = b.filter((F.col("fare_amount") > 5) & F.col("trip_distance").between(1, 5))
    return elig.orderBy("order_key", "line_no", "part_key").limit(CORRUPT_ROWS)


# ------------------------------------------------------------ scalar functions
@query("concat_reason")
def concat_reason(spark, sf):
    q = dims.qc_quarantine(A.raw_daily_long(_t(spark, sf)))
    return q.select("ymd", "element", "_reject_reason")


@query("text_describe")
def text_describe(spark, sf):
    return feeds.describe_text(_t(spark, sf).documents.select("doc_id", "text"))


@query("elapsed")
def elapsed(spark, sf):
    return trips.typed(_bronze(spark, sf)).select("order_key", "line_no", "part_key", "trip_duration_s")


@query("time_features")
def time_features(spark, sf):
    return trips.features(_silver(spark, sf)).select("order_key", "line_no", "pickup_hour", "pickup_dow",
                                                     "is_weekend")


@query("parse_compact_date")
def parse_compact_date(spark, sf):
    r = A.raw_daily_long(_t(spark, sf)).select("ymd")
    return r.select("ymd", C.parse_date("ymd", "yyyyMMdd", strict=True).alias("obs_date"),
                    C.parse_date(F.concat(F.col("ymd"), F.lit("x")), "yyyyMMdd").alias("bad_parse"))


# ---- fixed date formats (three inbound shapes) ----
DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "dd-MM-yyyy"]


@query("parse_multi_date")
def parse_multi_date(spark, sf):
    """Dates arriving in three formats (by order key mod 3); first parse wins."""
    o = _t(spark, sf).orders.select("o_orderkey", "o_orderdate")
    k = F.pmod(F.col("o_orderkey"), F.lit(3))
    text = (F.when(k == 0, F.date_format("o_orderdate", DATE_FORMATS[0]))
             .when(k == 1, F.date_format("o_orderdate", DATE_FORMATS[1]))
             .otherwise(F.date_format("o_orderdate", DATE_FORMATS[2])))
    s = o.select("o_orderkey", text.alias("submitted"))
    return s.select("o_orderkey", "submitted", C.parse_date_any("submitted", DATE_FORMATS).alias("submitted_on"))


@query("ratio_features")
def ratio_features(spark, sf):
    return trips.features(_silver(spark, sf)).select("order_key", "line_no", "trip_duration_min",
                                                     "avg_speed_mph", "tip_rate")


@query("json_extract")
def json_extract(spark, sf):
    ev = feeds.app_events(A.app_log_lines(_t(spark, sf)))
    return ev.select("_line_no", "level", "ctx_k", "ctx_lat")


@query("json_unstable_type")
def json_unstable_type(spark, sf):
    ev = feeds.app_events(A.app_log_lines(_t(spark, sf)))
    return ev.select("_line_no", "user_id", "value")


@query("json_split")
def json_split(spark, sf):
    """Lines that are not one JSON value, quarantined with a reason."""
    return feeds.app_log_quarantine(A.app_log_lines(_t(spark, sf))).select("_file", "_line_no", "_reject_reason")


@query("parse_iso_ts")
def parse_iso_ts(spark, sf):
    ev = feeds.app_events(A.app_log_lines(_t(spark, sf)))
    return ev.select("_line_no", "event_at")


# ------------------------------------------------------------ quality gate
def _gate_frames(spark, sf, shared=frozenset({"silver", "gold", "daily"})):
    """Layers the checks read more than once are materialized once."""
    return Layers(spark, sf, materialize=set(shared)).gate_frames()


def schema_tests(row_floor: int = GOLD_ROW_FLOOR) -> list:
    """The 23 published schema tests (16 silver, 7 gold)."""
    return [
        Q.not_null("stg_trips", "pickup_at"),
        Q.not_null("stg_trips", "vendor_id"),
        Q.not_null("stg_trips", "fare_amount"),
        Q.accepted_range("stg_trips", "fare_amount", min_value=0, inclusive=False),
        Q.not_null("stg_trips", "trip_duration_s"),
        Q.accepted_range("stg_trips", "trip_duration_s", 60, 10800),
        Q.accepted_range("stg_trips", "passenger_count", 1, 6),
        Q.unique("stg_trips", trips.NATURAL_KEY),
        Q.not_null("stg_daily", "obs_date"),
        Q.unique("stg_daily", "obs_date"),
        Q.accepted_range("stg_daily", "precip_mm", 0, 500),
        Q.accepted_range("stg_daily", "tmax_c", -40, 50),
        Q.not_null("stg_zones", "location_id"),
        Q.unique("stg_zones", "location_id"),
        Q.not_null("stg_zones", "borough"),
        Q.accepted_values("stg_zones", "borough", A.ACCEPTED_BOROUGHS),
        Q.not_null("fct_trips", "pickup_at"),
        Q.not_null("fct_trips", "trip_duration_min"),
        Q.accepted_range("fct_trips", "trip_duration_min", 1, 180),
        Q.accepted_range("fct_trips", "avg_speed_mph", 0, 80, inclusive=False),
        Q.accepted_range("fct_trips", "tip_rate", 0, 3),
        Q.accepted_range("fct_trips", "pickup_hour", 0, 23),
        Q.relationships("fct_trips", "pickup_borough", "stg_zones", "borough"),
    ]


#: Schema tests that are also part of the promotion gate.
GATE_TESTS = {"stg_trips.fare_amount accepted_range", "stg_trips.trip_duration_s accepted_range",
              "stg_trips.(order_key,line_no) unique_combination", "fct_trips.avg_speed_mph accepted_range",
              "fct_trips.tip_rate accepted_range", "fct_trips.pickup_hour accepted_range"}


def promotion_gate(row_floor: int = GOLD_ROW_FLOOR) -> list:
    """The promotion gate, 8 error checks and 1 warning: the schema tests that it shares, then its own."""
    return [t for t in schema_tests(row_floor) if t.name in GATE_TESTS] + [
        Q.row_floor("fct_trips", row_floor),
        Q.expression("stg_trips", "stg_trips.(pickup_at,vendor_id) not_null", "pickup_at IS NULL OR vendor_id IS NULL"),
        Q.expression("stg_trips", "stg_trips.total_amount covers fare_amount", "total_amount + 0.01 < fare_amount", severity="warn"),
    ]


def _single(check):
    def fn(spark, sf):
        # one check reads each layer once: nothing to share, nothing materialized
        return Q.run_checks([check], _gate_frames(spark, sf, set())).select("check_name", "failing", "status")
    return fn


QUERIES["check_not_null"] = _single(Q.not_null("fct_trips", "trip_duration_min"))
QUERIES["check_unique"] = _single(Q.unique("stg_daily", "obs_date"))
QUERIES["check_unique_combo"] = _single(Q.unique("stg_trips", trips.NATURAL_KEY))
QUERIES["check_range"] = _single(Q.accepted_range("fct_trips", "trip_duration_min", 1, 180))
QUERIES["check_accepted"] = _single(Q.accepted_values("stg_zones", "borough", A.ACCEPTED_BOROUGHS[:3]))
QUERIES["check_cross_column"] = _single(promotion_gate()[-1])


@query("gate_report")
def gate_report(spark, sf):
    # silver feeds the fused checks, the duplicate check and gold; gold feeds one aggregate
    return Q.run_checks(promotion_gate(), _gate_frames(spark, sf, {"silver"}))


@query("gate_at_write")
def gate_at_write(spark, sf):
    """The gate's report from the jobs that write silver and gold: their row checks are metrics of
    the write, and only the uniqueness check reads a table again."""
    checks = promotion_gate()
    lay = Layers(spark, sf)
    checked, seen_silver = Q.observe_checks(lay.silver, "stg_trips", checks)
    silver = materialize(checked)
    checked, seen_gold = Q.observe_checks(trips.gold(silver, lay.zones, lay.daily), "fct_trips", checks)
    gold = materialize(checked)
    return Q.run_checks(checks, {"stg_trips": silver, "fct_trips": gold},
                        observed={"stg_trips": seen_silver.get, "fct_trips": seen_gold.get})


@query("schema_tests_report")
def schema_tests_report(spark, sf):
    return Q.run_checks(schema_tests(), _gate_frames(spark, sf))


# ------------------------------------------------------------ quarantine
@query("quarantine_fact")
def quarantine_fact(spark, sf):
    return trips.quarantine_fact(_silver(spark, sf))


@query("quarantine_dim")
def quarantine_dim(spark, sf):
    return dims.zone_quarantine(A.raw_zone_lookup(_t(spark, sf)))


@query("quarantine_qc")
def quarantine_qc(spark, sf):
    return dims.qc_quarantine(A.raw_daily_long(_t(spark, sf)))


@query("quarantine_silver")
def quarantine_silver(spark, sf):
    tagged = trips.tag_typed(materialize(trips.typed(_bronze(spark, sf))))
    return (tagged.filter(F.col("_reject_reason").isNotNull())
                  .select("_source_file", "_record_no", "order_key", "line_no", "part_key", "_reject_reason"))


@query("conservation")
def conservation(spark, sf):
    """bronze = silver + quarantined: lineitem rows as landed, silver by its own plan,
    the quarantine by the tagging plan."""
    tagged = trips.tag_typed(materialize(trips.typed(_bronze(spark, sf))))
    return _conservation(_t(spark, sf).lineitem, _silver(spark, sf), tagged.filter(F.col("_reject_reason").isNotNull()))


def _verdicts(tagged):
    reason = F.coalesce("_reject_reason", F.lit("accepted")).alias("verdict")
    return tagged.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


@query("twice_landed_verdicts")
def twice_landed_verdicts(spark, sf):
    """The trip feed landed twice: silver does not grow, every second copy is a duplicate."""
    landing = scratch_path(spark, "landing")
    paths = [landing + "/first.parquet", landing + "/again.parquet"]
    write_parquet(_bronze(spark, sf).drop("_source_file", "_record_no"), paths[0])      # landing stamps its own
    write_parquet(spark.read.parquet(paths[0]), paths[1])
    landed = L.land_parquet_files(spark, paths, "trips")
    verdicts = scratch_path(spark, "verdicts")
    write_parquet(_verdicts(trips.tag_typed(trips.typed(landed))), verdicts)    # one row a verdict; its shuffles go before silver's come
    silver = trips.silver(landed)
    return spark.read.parquet(verdicts).unionByName(
        silver.agg(F.count(F.lit(1)).alias("n")).select(F.lit("silver").alias("verdict"), "n"))


@query("null_key_verdicts")
def null_key_verdicts(spark, sf):
    """Missing line numbers and vendors: NULLs group and sort like values, one row of each key survives."""
    b = _bronze(spark, sf)
    b = b.withColumns({"line_no": F.when(F.col("line_no") % 3 != 0, F.col("line_no")),
                       "vendor_id": F.when(F.col("vendor_id") % 10 != 0, F.col("vendor_id"))})
    tagged = trips.tag_typed(materialize(trips.typed(b)))
    return tagged.select("_record_no", "order_key", "line_no", "vendor_id", "_reject_reason")


@query("quarantine_traced")
def quarantine_traced(spark, sf):
    """Every quarantined row leads back to exactly one landed row."""
    q = quarantine_silver(spark, sf)
    landed = _bronze(spark, sf).select("_source_file", "_record_no", F.col("part_key").alias("landed_part"))
    hit = q.join(landed, ["_source_file", "_record_no"], "left")
    return hit.agg(F.count(F.lit(1)).alias("n_rows"), F.count("landed_part").alias("n_found"),
                   F.count(F.when(F.col("part_key") == F.col("landed_part"), 1)).alias("n_same"))


# ------------------------------------------------------------ defect drill
def _corrupt(b):
    """The corrupt upstream file: 12x tip on the first ``CORRUPT_ROWS`` otherwise-valid rows."""
    elig = b.filter((F.col("fare_amount") > 5) & F.col("trip_distance").between(1, 5))
    return (elig.withColumn("tip_amount", F.col("fare_amount") * F.lit(12.0))
                .orderBy("order_key", "line_no", "part_key").limit(CORRUPT_ROWS))


def _inject(spark, sf):
    return _corrupt(_bronze(spark, sf))


@query("inject_defect")
def inject_defect(spark, sf):
    """Written as a new file in the landing folder, then read back."""
    path = scratch_path(spark, "landing") + "/trips-CORRUPT.parquet"
    _inject(spark, sf).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _gate_state(silver, gold):
    """OPEN or CLOSED from the promotion gate (without the row floor, which is about size)."""
    closed = F.max((F.col("status") == "FAIL").cast("int")) == 1
    report = Q.run_checks(promotion_gate(row_floor=1), {"stg_trips": silver, "fct_trips": gold})
    return report.agg(F.when(closed, F.lit("CLOSED")).otherwise(F.lit("OPEN"))).first()[0]      # one row


@query("defect_drill")
def defect_drill(spark, sf):
    """Land the corrupt file beside the clean one, reload, rebuild, run both gates.

    The copies carry the keys of their originals and tie with them in every
    column of the survivor order, so the row identity decides: the file name
    ``trips-CORRUPT`` sorts before ``trips-clean`` and the corrupt copy of a surviving
    row takes its place.  The 12x tip passes every silver rule; the production path
    stops it in gold's guard (gate stays open), the offline path in its gate.
    """
    landing = scratch_path(spark, "landing")
    clean, corrupt = landing + "/trips-clean.parquet", landing + "/trips-CORRUPT.parquet"
    _bronze(spark, sf).write.parquet(clean)
    _corrupt(spark.read.parquet(clean)).write.parquet(corrupt)

    def measures(paths, tag):
        s = materialize(trips.silver(L.land_parquet_files(spark, paths, "trips")))
        q = trips.gold_tagged(s)
        return s, q.agg(
            F.count(F.lit(1)).alias(f"silver_{tag}"),
            F.count(F.when(F.col("_reject_reason").isNotNull(), 1)).alias(f"quarantine_{tag}"),
            F.count(F.when(F.col("_reject_reason") == trips.R_TIP, 1)).alias(f"tip_fail_{tag}"))
    _, before = measures([clean], "before")
    s, after = measures([clean, corrupt], "after")
    # Two one-row aggregates folded into one row by a global max (no cross join).
    u = (before.select(F.lit(1).alias("_k"), "*").unionByName(after.select(F.lit(1).alias("_k"), "*"),
                                                               allowMissingColumns=True))
    cols = ["silver_before", "quarantine_before", "tip_fail_before", "silver_after", "quarantine_after", "tip_fail_after"]
    w = u.groupBy("_k").agg(*[F.max(c).alias(c) for c in cols]).drop("_k")
    return w.select(*cols, (F.col("quarantine_after") - F.col("quarantine_before")).alias("quarantine_delta"),
                    F.lit(_gate_state(s, trips.gold(s, _zones(spark, sf), _daily(spark, sf)))).alias("gate_after"),
                    F.lit(_gate_state(s, trips.gold_offline(s))).alias("offline_gate_after"))


# ------------------------------------------------------------ experiment
@query("train_test_split")
def train_test_split(spark, sf):
    f = X.hash_split(X.training_frame(_gold(spark, sf)), ["order_key", "line_no"])
    return f.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("train_gbt")
def train_gbt(spark, sf):
    f = materialize(X.hash_split(X.training_frame(_gold(spark, sf), X.BASE_FEATURES), ["order_key", "line_no"]))
    model = X.fit_gbt(f.filter(F.col("split") == "train"), X.BASE_FEATURES)
    return X.regression_metrics(model.transform(f.filter(F.col("split") == "test")))


@query("regression_metrics")
def regression_metrics(spark, sf):
    """MAE / R^2 of a given prediction column (distance at 20 mph + 5 min)."""
    g = _gold(spark, sf).select("trip_distance_mi", X.TARGET)
    p = g.withColumn("prediction", F.col("trip_distance_mi") * F.lit(3.0) + F.lit(5.0))
    return X.regression_metrics(p)


@query("feature_lift")
def feature_lift(spark, sf):
    return X.feature_lift(X.training_frame(_gold(spark, sf)), X.BASE_FEATURES, X.WEATHER_FEATURES,
                          ["order_key", "line_no"])


def _response(spark, sf):
    """Gold with a response that its features determine: minutes at 20 mph, a start-up time, and
    two minutes for every passenger."""
    minutes = F.col("trip_distance_mi") * F.lit(3.0) + F.lit(5.0) + F.lit(2.0) * F.col("passenger_count")
    return X.training_frame(_gold(spark, sf), X.BASE_FEATURES).withColumn(X.TARGET, minutes)


@query("first_tree")
def first_tree(spark, sf):
    """The splits of the first histogram tree on that response, two levels."""
    return boosting.first_tree(_response(spark, sf), X.BASE_FEATURES, X.TARGET)


@query("boosted_trees")
def boosted_trees(spark, sf):
    """Histogram boosting on the train rows; error on the test rows beside that of the train mean."""
    f = materialize(X.hash_split(_response(spark, sf), ["order_key", "line_no"]))
    train, test = f.filter("split = 'train'"), f.filter("split = 'test'")
    model = boosting.fit(train, X.BASE_FEATURES, X.TARGET, rounds=10)
    scored = model.predict(test).withColumn("mean", F.lit(model.start / boosting.UNIT))
    fitted = X.regression_metrics(scored)
    plain = X.regression_metrics(scored, prediction="mean").select(F.col("mae").alias("mae_of_mean"), F.col("n_test").alias("_n"))
    return fitted.join(plain, F.col("n_test") == F.col("_n")).drop("_n")


@query("inject_effect")
def inject_effect(spark, sf):
    """Known multiplicative weather effect (strength 0.35, noise off)."""
    return X.inject_effect(_lift_frame(spark, sf), 0.35).select("order_key", "line_no", X.TARGET)


@query("run_record")
def run_record(spark, sf):
    """A training run appended to the runs table; the columns that every rerun repeats."""
    g = materialize(X.hash_split(X.training_frame(_gold(spark, sf), X.BASE_FEATURES), ["order_key", "line_no"]))
    ver = store.fingerprint(g, X.TARGET).first()
    model = X.fit_gbt(g.filter(F.col("split") == "train"), X.BASE_FEATURES)
    m = X.regression_metrics(model.transform(g.filter(F.col("split") == "test"))).first()
    rec = X.run_record(spark, X.GBT_PARAMS, ver.n_rows, ver.data_version, {"mae": m.mae, "r2": m.r2}, "gold.fct_trips")
    runs = scratch_path(spark, "runs")
    rec.write.mode("append").parquet(runs)
    return spark.read.parquet(runs).select("source_table", "data_version", "n_rows", "params")


@query("run_history")
def run_history(spark, sf):
    """Two runs on the same data (given predictions) appended to the runs table, and how the second
    differs from the first."""
    g = materialize(_gold(spark, sf).select("trip_distance_mi", X.TARGET))
    ver, runs = store.fingerprint(g, X.TARGET).first(), scratch_path(spark, "runs")
    for name, p in (("distance", F.col("trip_distance_mi") * F.lit(3.0) + F.lit(5.0)), ("constant", F.lit(60.0))):
        m = X.regression_metrics(g.withColumn("prediction", p)).first()
        X.run_record(spark, {"model": name}, ver.n_rows, ver.data_version, {"mae": m.mae, "r2": m.r2}, "gold.fct_trips") \
            .write.mode("append").parquet(runs)
    return X.compare_runs(spark.read.parquet(runs)).drop("run_at")


# ------------------------------------------------------------ text landing round trips
@query("csv_landing")
def csv_landing(spark, sf):
    """Zone rows written as headered CSV text, landed back as all-string bronze."""
    path = scratch_path(spark, "landing") + "/zone_lookup_csv"
    zones = A.raw_zone_lookup(_t(spark, sf)).select("LocationID", "Borough", "Zone", "service_zone")
    zones.write.mode("overwrite").option("header", True).csv(path)
    raw = L.read_csv_strings(spark, path, ["LocationID", "Borough", "Zone", "service_zone"], multiline=True)
    return dims.zone_silver(raw)


@query("json_lines_landing")
def json_lines_landing(spark, sf):
    """App log written as text lines, landed raw, split into events/quarantine."""
    path = scratch_path(spark, "landing") + "/app_log"
    A.app_log_lines(_t(spark, sf)).select(F.regexp_replace("_raw", "[\\r\\n]+", " ").alias("value")) \
        .write.mode("overwrite").text(path)
    lines = numbered_lines(spark, path)
    return feeds.log_counts(lines)


@query("incremental_silver")
def incremental_silver(spark, sf):
    """Trips land in three deliveries that share natural keys; each stream run merges what is
    new into silver.  The result is the batch build's."""
    from aurum.streaming.silver import land_silver, read_silver
    src, root, ckpt = (scratch_path(spark, x) for x in ("deliveries", "silver", "offsets"))
    b = _bronze(spark, sf).drop("_source_file", "_record_no")
    part = F.pmod(F.xxhash64("order_key", "part_key", "vendor_id"), F.lit(3))
    for k in range(3):
        write_parquet(b.filter(part == k), f"{src}/delivery-{k}")
        land_silver(spark, f"{src}/*", b.schema, root, ckpt)
    return read_silver(spark, root)


# ------------------------------------------------------------ end to end
@query("layered_build")
def layered_build(spark, sf):
    """Land, build and gate every layer as versioned tables; one row per table."""
    from aurum.plans.build import run
    written, _ = run(spark, sf)
    return written


OFFLINE_WINDOW = ("1996-01-01", "1996-02-01")


@query("offline_gate_report")
def offline_gate_report(spark, sf):
    """The offline twin: month-window silver, tip-unguarded gold, same gate."""
    s = materialize(trips.silver(_bronze(spark, sf), window=OFFLINE_WINDOW))
    g = trips.gold_offline(s)
    return Q.run_checks(promotion_gate(), {"stg_trips": s, "fct_trips": g})


@query("lift_interval")
def lift_interval(spark, sf):
    """Bootstrap interval of the lift of two given predictions on the test rows (the decision's
    arithmetic; ``feature_lift`` gives it fitted ones)."""
    g = X.hash_split(_gold(spark, sf), ["order_key", "line_no"]).filter("split = 'test'")
    y = F.col(X.TARGET)
    errors = g.select("order_key", "line_no", F.abs(y - F.lit(60.0)).alias("b"),
                      F.abs(y - (F.lit(60.0) + F.lit(4.0) * F.col("is_wet_day"))).alias("a"))
    return X.lift_interval(errors, ["order_key", "line_no"], "b", "a")


@query("lift_replicates")
def lift_replicates(spark, sf):
    """The lift in each bootstrap replicate, of the same two predictions."""
    g = X.hash_split(_gold(spark, sf), ["order_key", "line_no"]).filter("split = 'test'")
    y = F.col(X.TARGET)
    errors = g.select("order_key", "line_no", F.abs(y - F.lit(60.0)).alias("b"),
                      F.abs(y - (F.lit(60.0) + F.lit(4.0) * F.col("is_wet_day"))).alias("a"))
    return X.lift_replicates(errors, ["order_key", "line_no"], "b", "a")


@query("apparatus_check")
def apparatus_check(spark, sf):
    """Control (no effect) vs treatment (known weather effect) lift.

    The lag between order and ship date is noise to every feature, so the check uses a
    response that the base features do determine (minutes at 20 mph plus five): what
    it measures is the apparatus, not the binding."""
    frame = _lift_frame(spark, sf).withColumn(X.TARGET, F.col("trip_distance_mi") * F.lit(3.0) + F.lit(5.0))
    return X.apparatus_check(frame, X.BASE_FEATURES, X.WEATHER_FEATURES, ["order_key", "line_no"])


@query("csv_headerless_landing")
def csv_headerless_landing(spark, sf):
    """Daily rows written as headerless CSV, landed with a declared all-string
    schema and a landing-time year filter, then pivoted and rescaled."""
    path = scratch_path(spark, "landing") + "/station_csv"
    cols = ["station_id", "ymd", "element", "value", "m_flag", "q_flag", "s_flag", "obs_time"]
    A.raw_daily_long(_t(spark, sf)).select(*cols).write.mode("overwrite").option("header", False).csv(path)
    raw = L.read_csv_strings(spark, path, cols, header=False)
    return dims.daily_wide(L.year_filter(raw, "ymd", ["2024"]))


@query("multi_file_landing")
def multi_file_landing(spark, sf):
    """The trip feed arrives as two files whose schemas drifted (the early one
    has no late-fee column); both land as one bronze table by column name and
    silver resolves the drift with a default."""
    landing = scratch_path(spark, "landing")
    b = _bronze(spark, sf)
    early = F.coalesce(F.year("pickup_datetime") <= 1997, F.lit(False))
    b.filter(early).drop("late_fee").write.mode("overwrite").parquet(landing + "/trips-early.parquet")
    b.filter(~early).write.mode("overwrite").parquet(landing + "/trips-late.parquet")
    landed = L.land_parquet_files(spark, [landing + "/trips-early.parquet", landing + "/trips-late.parquet"],
                                  "trips")
    return (trips.typed(landed).drop("_record_no")
                 .withColumn("_source_file", F.regexp_extract("_source_file", "^[^/]+", 0)))


@query("drifted_files_landing")
def drifted_files_landing(spark, sf):
    """The trip feed as many files of three shapes: the earliest have no late fee, the next write
    passengers as a shorter number.  Footers are read in tasks; the plan has a scan per shape."""
    landing = scratch_path(spark, "landing")
    b = _bronze(spark, sf).drop("_source_file", "_record_no").withColumn("year", F.coalesce(F.year("pickup_datetime"), F.lit(0)))
    def put(df, name):  # noqa: E306
        df.repartition(12, "order_key").drop("year").write.parquet(f"{landing}/{name}")
    put(b.filter("year <= 1994").drop("late_fee"), "a")
    put(b.filter("year BETWEEN 1995 AND 1996").withColumn("passenger_count", F.col("passenger_count").cast("int")), "b")
    put(b.filter("year > 1996"), "c")
    return trips.typed(land_drifted_files(spark, [landing], "trips")).drop("_source_file", "_record_no")


@query("landing_stamp")
def landing_stamp(spark, sf):
    """Provenance of three feeds landed in one run: rows, landing times, and rows without identity."""
    t, ts = _t(spark, sf), L.batch_timestamp()
    feeds_ = {"trips": A.raw_trips(t), "zones": A.raw_zone_lookup(t), "daily": A.raw_daily_long(t)}
    parts = [L.with_provenance(df, name, ts).select(*L.PROVENANCE) for name, df in feeds_.items()]
    lost = F.col("_source_file").isNull() | F.col("_record_no").isNull() | F.col("_ingested_at").isNull()
    return L.union_by_name(parts).groupBy("_source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_ingested_at").alias("landing_times"),
        F.count(F.when(lost, 1)).alias("without_identity"))


@query("csv_corrupt_kept")
def csv_corrupt_kept(spark, sf):
    """Lines with one cell too many (an unquoted separator in the key) keep their landed text."""
    path = scratch_path(spark, "landing") + "/orders_csv"
    o = _t(spark, sf).orders
    key = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("1,"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))) \
           .otherwise(F.col("o_orderkey").cast("string"))
    line = F.concat_ws(",", key, F.col("o_orderpriority"), F.col("o_custkey").cast("string"))
    o.select(line.alias("value")).write.text(path)
    return L.read_csv_strings(spark, path, ["key", "priority", "customer"], header=False)


@query("quoted_csv_landing")
def quoted_csv_landing(spark, sf):
    """Documents as CSV with quoted line feeds, read by byte ranges: as many tasks as the files
    have splits, every record whole, and records counted from each file's start."""
    path = scratch_path(spark, "landing") + "/documents_csv"
    cols = ["doc_id", "source", "text", "lang"]
    docs = _t(spark, sf).documents.select(*cols)
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    cells = quoted_cells(quoted_records(spark, path), "doc_id string, source string, text string, lang string")
    return cells.select(F.col("doc_id").try_cast("bigint").alias("doc_id"), "source", "lang",
                        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
                        F.col("_corrupt_record").isNotNull().alias("ragged"))


@query("line_numbers")
def line_numbers(spark, sf):
    """Turns written as text files, landed with dense numbers per file: per file the numbers
    are 0 to n - 1 and their order is the order of the file."""
    path = scratch_path(spark, "landing") + "/turns"
    turns = _t(spark, sf).conversations.select("conv_id", "turn")
    part = F.pmod(F.col("conv_id"), F.lit(7))
    lines = turns.withColumn("feed", part).repartition(7, "feed").sortWithinPartitions("feed", "conv_id", "turn")
    lines.select("feed", F.concat_ws(" ", "conv_id", "turn").alias("value")).write.partitionBy("feed").text(path)
    landed = numbered_lines(spark, path).withColumn("feed", F.regexp_extract("_file", "feed=([0-9]+)", 1).cast("int"))
    return landed.select("feed", "_line_no", "_raw")


@query("json_array_documents")
def json_array_documents(spark, sf):
    """Documents delivered as JSON arrays (50 to a line), landed one element per row,
    typed, and described; dates come in three shapes and some in none."""
    path = scratch_path(spark, "landing") + "/documents_json"
    feeds.document_arrays(_t(spark, sf).documents, 50).write.text(path)
    typed = feeds.typed_documents(land_json_arrays(spark, path), DATE_FORMATS)
    return typed.drop("_file", "_line_no", "_element_no")


def _damaged_landing(spark, sf):
    path = scratch_path(spark, "landing") + "/damaged_json"
    feeds.damaged_arrays(_t(spark, sf).documents, 50).write.text(path)
    return land_json_arrays(spark, path)


@query("json_array_recovery")
def json_array_recovery(spark, sf):
    """Arrays with broken elements, missing brackets and stray lines: whole elements are typed,
    the others are kept under a reason; no element takes its neighbours with it."""
    landed = materialize(_damaged_landing(spark, sf))
    good = feeds.typed_documents(landed, DATE_FORMATS).drop("_file", "_line_no", "_element_no")
    bad = landed.filter(F.col("_reject_reason").isNotNull()).select("_reject_reason")
    return good.unionByName(bad, allowMissingColumns=True)


@query("json_array_conservation")
def json_array_conservation(spark, sf):
    """Elements written = elements accepted + elements and lines quarantined."""
    landed = materialize(_damaged_landing(spark, sf))
    docs = _t(spark, sf).documents.select(F.col("doc_id"))
    chunks = docs.select(F.floor(F.col("doc_id") / F.lit(50)).alias("c")).distinct().filter(F.pmod("c", F.lit(13)) == feeds.STRAY)
    written = docs.select(F.lit(1).alias("one")).unionByName(chunks.select(F.lit(1).alias("one")))
    sound = F.col("_reject_reason").isNull()
    return _conservation(written, landed.filter(sound), landed.filter(~sound))


@query("document_profile")
def document_profile(spark, sf):
    """Corpus profile of the landed documents, dates that no format reads included."""
    d = json_array_documents(spark, sf)
    return d.agg(F.count(F.lit(1)).alias("docs"), F.count(F.when(F.col("body_chars") == 0, 1)).alias("empty_docs"),
                 F.count(F.when(F.col("rating").isNull(), 1)).alias("missing_rating"),
                 F.count(F.when(F.col("submitted_on").isNull(), 1)).alias("unparsed_dates"),
                 F.max("body_chars").cast("bigint").alias("max_chars"))


@query("second_landing")
def second_landing(spark, sf):
    """A file dropped in after the first load is picked up by the next one; nothing is read twice."""
    from aurum.streaming.incremental import land_available
    src, target, ckpt = (scratch_path(spark, x) for x in ("incoming", "landed", "offsets"))
    o = _t(spark, sf).orders.select("o_orderkey", "o_custkey")
    odd = F.col("o_orderkey") % 2 == 1
    o.filter(odd).write.parquet(src + "/first")
    land_available(spark, src + "/*", o.schema, target, ckpt)
    o.filter(F.coalesce(~odd, F.lit(True))).write.parquet(src + "/second")
    return land_available(spark, src + "/*", o.schema, target, ckpt)
