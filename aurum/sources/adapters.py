"""Source adapters: the given tables presented in the shapes the pipeline lands.

The pipeline was designed for four feeds -- a trip fact, a zone dimension
delivered as text, a long/narrow daily measurement file and an application
log.  Each adapter derives one of them from the TPC-H-style tables, with
every column a deterministic expression of the inputs, so the work grows
with the data and an independent SQL engine can derive the same rows.

Binding (fixed once; the oracle SQL uses the same definitions):

trips   lineitem x orders x customer x supplier, one row per lineitem row.
        vendor = l_suppkey, pickup = o_orderdate, dropoff = pickup plus one
        minute per day between order and ship date, passengers =
        l_linenumber, distance = l_quantity, pickup location = customer
        nation, dropoff location = supplier nation, payment type = digit of
        o_orderpriority, fare = l_extendedprice, tip = fare * l_discount,
        total = fare * (1 - l_discount) * (1 + l_tax), late fee column =
        l_tax with 0 absent (NULL).  Natural key (order_key, line_no).
zones   nation x region as all-text CSV-like rows: LocationID, Borough
        (region name), Zone (nation name), service_zone (region key).
daily   events as long/narrow text rows: ymd of ts, element = event_type,
        value = whole units of ``value`` times a factor of the day
        (((day * 7) mod 10) + 1) / 10, q_flag 'G' (gross-limit failure)
        for values >= 300.
app log events as JSON lines, plus conversation turns as stray non-JSON
        lines.  ``user`` is written as a JSON string for signup events
        (a type-unstable key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.sources.tables import Tables

# ---- fixed binding values ----
ACCEPTED_BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]   # MIDDLE EAST is off-domain
QC_GROSS_LIMIT = 300.0
WEATHER_ELEMENTS = {  # daily measure -> element code in the long file
    "tmax": "click", "tmin": "view", "prcp": "purchase", "snow": "signup", "awnd": "error",
}
WEATHER_YEAR, WEATHER_MONTH = 2024, 1   # calendar the daily feed covers


def scan_identity() -> list:
    """Where a row was read from: file name and row position, from the Parquet scan
    itself, so the pair is the same on every read and retry."""
    return [F.col("_metadata.file_name").alias("_source_file"), F.col("_metadata.row_index").alias("_record_no")]


def raw_trips(t: Tables) -> DataFrame:
    """The trip feed, in the landing contract's snake-case names.  A line without
    an order keeps NULLs and is quarantined by silver."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                           "l_extendedprice", "l_discount", "l_tax", "l_shipdate", *scan_identity())
    od = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = t.customer.select("c_custkey", "c_nationkey")
    su = t.supplier.select("s_suppkey", "s_nationkey")
    # Join order keeps the largest shuffle on l_orderkey last, so its output
    # stays hash-partitioned on the natural key's leading column.
    orders_c = od.join(cu, od.o_custkey == cu.c_custkey, "left")
    lines_s = li.join(su, li.l_suppkey == su.s_suppkey, "left")
    j = lines_s.join(orders_c, lines_s.l_orderkey == orders_c.o_orderkey, "left")
    lag_days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    fare = F.col("l_extendedprice")
    return j.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.timestamp_add("MINUTE", lag_days, F.col("o_orderdate")).alias("dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("c_nationkey").alias("pu_location_id"),
        F.col("s_nationkey").alias("do_location_id"),
        F.substring("o_orderpriority", 1, 1).alias("payment_type"),
        fare.alias("fare_amount"),
        (fare * F.col("l_discount")).alias("tip_amount"),
        (fare * (F.lit(1.0) - F.col("l_discount")) * (F.lit(1.0) + F.col("l_tax"))).alias("total_amount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("late_fee"),
        "_source_file", "_record_no",
    )


def raw_zone_lookup(t: Tables) -> DataFrame:
    """The zone dimension as the text feed delivers it (all strings)."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey", *scan_identity())
    r = t.region.select("r_regionkey", "r_name")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return j.select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("n_regionkey").cast("string").alias("service_zone"),
        "_source_file", "_record_no",
    )


def raw_daily_long(t: Tables) -> DataFrame:
    """Long/narrow measurement rows, all text, as the station file has them."""
    e = t.events.select("ts", "event_type", "value", *scan_identity())
    seasonal = (F.dayofmonth("ts") * 7) % 10 + 1             # days differ, as weather does
    return e.select(
        F.lit("EVENTS").alias("station_id"),
        F.date_format("ts", "yyyyMMdd").alias("ymd"),
        F.col("event_type").alias("element"),
        F.floor(F.col("value") * seasonal / F.lit(10.0) + F.lit(0.5)).cast("bigint").cast("string").alias("value"),
        F.lit("").alias("m_flag"),
        F.when(F.col("value") >= F.lit(QC_GROSS_LIMIT), F.lit("G")).otherwise(F.lit("")).alias("q_flag"),
        F.lit("").alias("s_flag"),
        F.date_format("ts", "HHmm").alias("obs_time"),
        "_source_file", "_record_no",
    )


def app_log_lines(t: Tables) -> DataFrame:
    """Raw log lines: JSON records from events, stray text from conversations."""
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    user = F.when(F.col("event_type") == "signup",
                  F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('"'))) \
            .otherwise(F.col("user_id").cast("string"))
    line = F.concat(
        F.lit('{"ts":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit('","level":"'), F.col("event_type"),
        F.lit('","user":'), user,
        F.lit(',"value":'), F.col("value").cast("string"),
        F.lit(',"ctx":'), F.col("props"),
        F.lit("}"),
    )
    good = e.select(F.lit("events").alias("_file"), F.col("event_id").alias("_line_no"), line.alias("_raw"))
    c = t.conversations.select("conv_id", "turn", "text")
    stray = c.select(F.lit("conversations").alias("_file"),
                     (F.col("conv_id") * F.lit(1000) + F.col("turn")).alias("_line_no"),
                     F.col("text").alias("_raw"))
    return good.unionByName(stray)
