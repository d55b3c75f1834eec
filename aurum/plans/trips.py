"""Trip fact: bronze -> silver (typed, deduplicated, filtered) -> gold.

Silver: hard casts to fixed types, then one survivor per natural key, then the
row rules.  As the survivor is chosen first, it may itself fail a rule; its
copies are then labelled duplicates all the same (``quarantine_silver``), and
every row that is not in silver carries a reason.

Gold: derived features, borough and daily-measure enrichment, plausibility
guard.  Guard failures go to ``quarantine_fact`` with a reason.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.functions import clean as C
from aurum.operators.dedup import ROW_ID, keep_first, label_survivors, survivors
from aurum.operators.joins import lookup
from aurum.operators.quarantine import REASON, tag_reasons
from aurum.sources.adapters import WEATHER_MONTH, WEATHER_YEAR

NATURAL_KEY = ["order_key", "line_no"]
# Total order inside a key: first dropoff, then part and vendor break ties,
# so the survivor is the same on every run and every engine.
SURVIVOR_ORDER = ["dropoff_at", "part_key", "vendor_id"]

SILVER_COLUMNS = ["order_key", "line_no", "vendor_id", "pickup_at", "dropoff_at", "passenger_count",
                  "trip_distance_mi", "pickup_location_id", "dropoff_location_id", "payment_type",
                  "fare_amount", "tip_amount", "total_amount", "late_fee", "trip_duration_s"]

# ---- fixed rule labels and bounds ----
R_DUPLICATE = "duplicate of natural key"
R_DURATION = "trip_duration_s outside [60, 10800]"
R_DISTANCE = "trip_distance_mi outside (0, 100)"
R_FARE = "fare_amount not positive"
R_TOTAL = "total_amount not positive"
R_PASSENGERS = "passenger_count outside [1, 6]"
R_WINDOW = "pickup outside month window"
R_NULL = "null in guard"
R_SPEED = "avg_speed_mph outside (0, 80) -- physically implausible"
R_TIP = "tip_rate outside [0, 3] -- tip more than 3x the fare"


def typed(bronze: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Hard casts to the silver types, plus elapsed seconds.  The row identity
    passes through where bronze has it (``keep``: further bronze columns)."""
    keep = [*[c for c in ROW_ID if c in bronze.columns and c not in keep], *keep]
    pickup = F.col("pickup_datetime").cast("timestamp_ntz")
    dropoff = F.col("dropoff_datetime").cast("timestamp_ntz")
    return bronze.select(
        *[F.col(c) for c in keep],
        F.col("order_key").cast("bigint").alias("order_key"),
        F.col("line_no").cast("int").alias("line_no"),
        F.col("part_key").cast("bigint").alias("part_key"),
        F.col("vendor_id").cast("int").alias("vendor_id"),
        pickup.alias("pickup_at"),
        dropoff.alias("dropoff_at"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance_mi"),
        F.col("pu_location_id").cast("int").alias("pickup_location_id"),
        F.col("do_location_id").cast("int").alias("dropoff_location_id"),
        F.col("payment_type").cast("int").alias("payment_type"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("tip_amount").cast("double").alias("tip_amount"),
        F.col("total_amount").cast("double").alias("total_amount"),
        C.default_if_null(F.col("late_fee").cast("double"), 0.0).alias("late_fee"),
        C.elapsed_seconds(pickup, dropoff).alias("trip_duration_s"),
    )


def deduplicated(bronze: DataFrame) -> DataFrame:
    """One row per natural key (survivor = smallest by SURVIVOR_ORDER)."""
    return _first_of_key(typed(bronze))


def _first_of_key(t: DataFrame) -> DataFrame:
    return keep_first(t, NATURAL_KEY, SURVIVOR_ORDER + [c for c in ROW_ID if c in t.columns])


def silver_rules(window: tuple[str, str] | None = None) -> list[tuple[str, object]]:
    """(label, failure predicate) in the order reasons are assigned."""
    d, m = F.col("trip_duration_s"), F.col("trip_distance_mi")
    rules = [
        (R_DURATION, ~d.between(60, 10800)),
        (R_DISTANCE, ~((m > 0) & (m < 100))),
        (R_FARE, ~(F.col("fare_amount") > 0)),
        (R_TOTAL, ~(F.col("total_amount") > 0)),
        (R_PASSENGERS, ~F.col("passenger_count").between(1, 6)),
    ]
    if window:
        lo, hi = (datetime.datetime.fromisoformat(w) for w in window)
        p = F.col("pickup_at")
        rules.append((R_WINDOW, ~((p >= F.lit(lo).cast("timestamp_ntz")) & (p < F.lit(hi).cast("timestamp_ntz")))))
    return rules


def silver(bronze: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """Typed, deduplicated, filtered trips (dedup first, then the filters).

    The rules are judged before the dedup's shuffle, which then has a flag instead of the
    columns that they read, where nobody else asks for those.
    """
    passes = C.all_of([~pred for _, pred in silver_rules(window)])
    return _first_of_key(typed(bronze).withColumn("_passes", passes)).filter(F.col("_passes")).select(*SILVER_COLUMNS)


def silver_tagged(bronze: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """Every typed row with its silver verdict: NULL = accepted.

    The label is ``duplicate`` for rows that lost their key, then the first rule a
    row breaks, then ``null in guard`` when a rule cannot be decided.
    """
    return tag_typed(typed(bronze), window)


def tag_typed(typed_df: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """``silver_tagged`` on already typed rows.

    The survivor match-back reads its input twice; pass a materialized (written, landed
    or checkpointed) input so the bronze joins run once.  The rules are judged before the
    match-back, whose shuffle then has their label instead of the columns that they
    read, where nobody else asks for those.
    """
    return duplicates_tagged(label_survivors(rules_tagged(typed_df, window), NATURAL_KEY, SURVIVOR_ORDER))


def rules_tagged(typed_df: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """Typed rows with the first rule that they break, whether they survive or not."""
    return tag_reasons(typed_df, silver_rules(window), null_reason=R_NULL)


def duplicates_tagged(labelled: DataFrame) -> DataFrame:
    """The verdicts of ``rules_tagged`` rows with their survivor flag: losing the key comes first."""
    verdict = F.when(~F.col("_survivor"), F.lit(R_DUPLICATE)).otherwise(F.col(REASON))
    return labelled.withColumn(REASON, verdict).drop("_survivor")


def key_survivors(typed_df: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Identity (and ``carry`` columns) of the one row that each natural key keeps."""
    return survivors(typed_df, NATURAL_KEY, SURVIVOR_ORDER, carry=carry)


# ------------------------------------------------------------------ gold
def weather_key(pickup: str = "pickup_at"):
    """Daily-feed calendar key for a trip: same day of month in the feed's month."""
    return F.make_date(F.lit(WEATHER_YEAR), F.lit(WEATHER_MONTH), F.dayofmonth(pickup))


def features(s: DataFrame) -> DataFrame:
    """Derived trip features (computed once, here)."""
    d = F.col("trip_duration_s")
    return s.select(
        "*",
        C.round_half_up(d / F.lit(60.0), 2).alias("trip_duration_min"),
        C.round_half_up(F.col("trip_distance_mi") / (d / F.lit(3600.0)), 2).alias("avg_speed_mph"),
        C.round_half_up(C.safe_ratio("tip_amount", "fare_amount"), 4).alias("tip_rate"),
        F.hour("pickup_at").alias("pickup_hour"),
        C.iso_dow("pickup_at").alias("pickup_dow"),
        C.weekend_flag("pickup_at").alias("is_weekend"),
    )


def speed_ok():
    v = F.col("avg_speed_mph")
    return (v > 0) & (v < 80)


def tip_ok():
    v = F.col("tip_rate")
    return (v >= 0) & (v <= 3)


GOLD_COLUMNS = ["order_key", "line_no", "vendor_id", "pickup_at", "dropoff_at", "pickup_location_id",
                "dropoff_location_id", "payment_type", "passenger_count", "trip_distance_mi",
                "trip_duration_s", "fare_amount", "tip_amount", "total_amount", "trip_duration_min",
                "avg_speed_mph", "tip_rate", "pickup_hour", "pickup_dow", "is_weekend",
                "pickup_borough", "dropoff_borough", "precip_mm", "snow_mm", "tmax_c", "avg_wind_ms",
                "is_wet_day", "is_snow_day"]

#: The gold columns a content hash reads as whole millionths; it reads the others as their exact text.
GOLD_DOUBLES = ["trip_distance_mi", "fare_amount", "tip_amount", "total_amount", "trip_duration_min",
                "avg_speed_mph", "tip_rate", "precip_mm", "snow_mm", "tmax_c", "avg_wind_ms"]

WEATHER_COLUMNS = ["precip_mm", "snow_mm", "tmax_c", "avg_wind_ms", "is_wet_day", "is_snow_day"]


def enriched(silver_df: DataFrame, zones: DataFrame, daily: DataFrame) -> DataFrame:
    """Features + boroughs (pickup and dropoff roles) + daily measures.

    Both dimensions are small (zones one row per nation, daily one per calendar
    day); the planner broadcasts them as long as their sizes allow it.
    """
    f = features(silver_df)
    f = lookup(f, zones, "pickup_location_id", "location_id", {"borough": "pickup_borough"})
    f = lookup(f, zones, "dropoff_location_id", "location_id", {"borough": "dropoff_borough"})
    f = lookup(f, daily, weather_key(), "obs_date", {c: c for c in WEATHER_COLUMNS})
    return f.select(*GOLD_COLUMNS)


def gold(silver_df: DataFrame, zones: DataFrame, daily: DataFrame) -> DataFrame:
    """Model-ready fact: enriched rows passing the plausibility guard."""
    return enriched(silver_df, zones, daily).filter(speed_ok() & tip_ok())


def gold_offline(silver_df: DataFrame) -> DataFrame:
    """The offline variant: features only, guard is ``avg_speed_mph < 80``."""
    cols = [c for c in GOLD_COLUMNS if c not in WEATHER_COLUMNS + ["pickup_borough", "dropoff_borough"]]
    return features(silver_df).filter(F.col("avg_speed_mph") < 80).select(*cols)


QUARANTINE_COLUMNS = ["order_key", "line_no", "vendor_id", "pickup_at", "dropoff_at", "pickup_location_id",
                      "dropoff_location_id", "trip_distance_mi", "trip_duration_s", "fare_amount",
                      "tip_amount", "total_amount", "avg_speed_mph", "tip_rate", "_reject_reason"]


def gold_tagged(silver_df: DataFrame) -> DataFrame:
    f = features(silver_df)
    return tag_reasons(f, [(R_SPEED, ~speed_ok()), (R_TIP, ~tip_ok())], null_reason=R_NULL)


def quarantine_fact(silver_df: DataFrame) -> DataFrame:
    """Guard failures with reasons; an undecidable guard (NULL) is labelled too."""
    return gold_tagged(silver_df).filter(F.col("_reject_reason").isNotNull()).select(*QUARANTINE_COLUMNS)


def negated_guard(silver_df: DataFrame) -> DataFrame:
    """Literal SQL form: ``WHERE NOT (speed ok) OR NOT (tip ok)``.

    Under three-valued logic a NULL guard puts the row in neither gold nor
    this result; kept to show the difference from ``quarantine_fact``.
    """
    f = features(silver_df)
    reason = F.when(~speed_ok(), F.lit(R_SPEED)).otherwise(F.lit(R_TIP))
    return f.filter(~speed_ok() | ~tip_ok()).select("order_key", "line_no", reason.alias("_reject_reason"))
