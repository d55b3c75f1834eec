"""Model experiment on the gold table: features, split, fit, metrics, lift.

Training is distributed (``pyspark.ml``): the frame is never pulled to the
driver.  The split is a hash of the natural key, so it is repeatable under
any partitioning (``randomSplit`` is not).
"""

from __future__ import annotations

import datetime
import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aurum.session import materialize

# ---- fixed feature lists and decision rule ----
BASE_FEATURES = ["trip_distance_mi", "pickup_hour", "pickup_dow", "is_weekend",
                 "passenger_count", "pickup_location_id", "dropoff_location_id"]
WEATHER_FEATURES = ["precip_mm", "snow_mm", "tmax_c", "avg_wind_ms", "is_wet_day", "is_snow_day"]
TARGET = "trip_duration_min"
LIFT_THRESHOLD_PCT = 2.0
GBT_PARAMS = {"maxDepth": 6, "stepSize": 0.1, "maxIter": 200}


def training_frame(gold: DataFrame, features: list[str] = BASE_FEATURES + WEATHER_FEATURES,
                   keys: list[str] = ("order_key", "line_no")) -> DataFrame:
    """Column-pruned frame: keys + features + target (the scan reads only these)."""
    return gold.select(*keys, *features, TARGET)


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def hash_split(df: DataFrame, keys: list[str], train_pct: int = 80, seed: int = 42,
               col: str = "split") -> DataFrame:
    """'train' / 'test' by a seeded hash of the key.

    The bucket is the first 32 bits of md5("seed|key..."), mod 100: a
    portable hash, so any engine reproduces the same split, under any
    partitioning (``randomSplit`` depends on partitioning).
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(100)
    return df.withColumn(col, F.when(bucket < train_pct, F.lit("train")).otherwise(F.lit("test")))


def fit_gbt(train: DataFrame, features: list[str], params: dict | None = None):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    p = dict(GBT_PARAMS, **(params or {}))
    asm = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="_features", labelCol=TARGET, predictionCol="prediction",
                       maxDepth=p["maxDepth"], stepSize=p["stepSize"], maxIter=p["maxIter"], seed=42)
    # some 1,400 jobs, each with a task per partition: no more of them than keep the cores busy
    train = train.coalesce(2 * train.sparkSession.sparkContext.defaultParallelism)
    return Pipeline(stages=[asm, gbt]).fit(train)


def regression_metrics(pred: DataFrame, label: str = TARGET, prediction: str = "prediction",
                       digits: int = 4) -> DataFrame:
    """MAE and R^2 as one aggregate (sum of squares about the mean)."""
    y, p = F.col(label), F.col(prediction)
    from aurum.functions.clean import round_half_up
    agg = pred.agg(F.count(F.lit(1)).alias("n"),
                   F.avg(F.abs(y - p)).alias("_mae"),
                   F.sum((y - p) * (y - p)).alias("_sse"),
                   F.var_pop(y).alias("_var"))
    # Empty or constant targets give NULL, not a division error (ANSI).
    sst = F.col("_var") * F.col("n")
    return agg.select(F.col("n").alias("n_test"),
                      round_half_up(F.col("_mae"), digits).alias("mae"),
                      round_half_up(F.lit(1.0) - F.col("_sse") / F.nullif(sst, F.lit(0.0)), digits).alias("r2"))


def paired_errors(frame: DataFrame, base: list[str], added: list[str], params: dict | None = None) -> DataFrame:
    """The test rows with the absolute errors of two models, fitted side by side on the train rows:
    ``_base`` without and ``_added`` with the added features."""
    train, test = (frame.filter(F.col("split") == part) for part in ("train", "test"))
    with ThreadPoolExecutor(max_workers=2) as pool:
        models = list(pool.map(lambda cols: fit_gbt(train, cols, params), (base, base + added)))
    for model, name in zip(models, ("_base", "_added")):
        test = model.transform(test).withColumn(name, F.abs(F.col(TARGET) - F.col("prediction"))) \
                    .withColumnRenamed("prediction", f"{name}_prediction").drop("_features")
    return test


def feature_lift(frame: DataFrame, base: list[str], added: list[str], keys: list[str],
                 params: dict | None = None, threshold_pct: float = LIFT_THRESHOLD_PCT) -> DataFrame:
    """Lift % of test MAE from adding features, with its bootstrap interval; KEEP only if the whole
    interval reaches the threshold, so a verdict does not rest on noise.  No test rows: CUT."""
    cc = materialize(hash_split(complete_cases(frame, added), keys))
    test = materialize(paired_errors(cc, base, added, params))
    b, w = (regression_metrics(test, prediction=f"{n}_prediction").first() for n in ("_base", "_added"))
    i = lift_interval(test, list(keys), "_base", "_added", threshold_pct).first()
    return frame.sparkSession.createDataFrame(
        [(b.n_test, b.mae, b.r2, w.mae, w.r2, i.lift_pct, i.lift_low, i.lift_high, threshold_pct, i.verdict)],
        "n_test long, mae_base double, r2_base double, mae_with double, r2_with double, "
        "lift_pct double, lift_low double, lift_high double, threshold_pct double, verdict string")


# ---- bootstrap of the lift ----
REPLICATES = 200
INTERVAL = 0.95
#: 2 ** 32 times the Poisson(1) distribution function at 0, 1, 2, ...
POISSON_STEPS = [round(2 ** 32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(12)]


def lift_replicates(errors: DataFrame, keys: list[str], base: str, added: str, replicates: int = REPLICATES,
                    seed: int = 7) -> DataFrame:
    """(replicate, lift_pct): the lift of mean absolute error in paired bootstrap samples.

    Every row stands in a replicate as often as a Poisson(1) number that its key's hash gives: the
    sample is the same on any partitioning or engine, and all replicates come from one
    pass with a partial aggregate of ``replicates`` rows per task.  ``base`` and ``added``
    are the absolute errors without and with the added features; they are summed as
    whole millionths, so the sums are exact."""
    whole = lambda c: F.floor(F.col(c) * F.lit(1e6) + F.lit(0.5)).cast("bigint")
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    rows = errors.select(text.alias("t"), whole(base).alias("b"), whole(added).alias("a"))
    rows = rows.filter("b IS NOT NULL AND a IS NOT NULL")
    four = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(-(-replicates // 4) - 1))).alias("g"))
    four = four.select("b", "a", "g", F.md5(F.concat_ws("|", F.col("t"), F.col("g").cast("string"))).alias("h"))
    four = four.select("b", "a", "g", *[F.substring("h", 8 * i + 1, 8).alias(f"u{i}") for i in range(4)])

    def weight(u: str):
        """The Poisson number: hexadecimal texts of one length are ordered as their numbers are."""
        w = F.when(F.col(u) < F.lit(f"{POISSON_STEPS[0]:08x}"), 0)
        for k, s in enumerate(POISSON_STEPS[1:], start=1):
            w = w.when(F.col(u) < F.lit(f"{s:08x}"), k) if s < 2 ** 32 else w
        return w.otherwise(sum(s < 2 ** 32 for s in POISSON_STEPS))
    four = four.select("b", "a", "g", *[weight(f"u{i}").alias(f"w{i}") for i in range(4)])
    sums = four.groupBy("g").agg(*[F.sum(F.col(f"w{i}") * F.col(x)).alias(f"{x}{i}") for i in range(4) for x in "ba"])
    each = F.explode(F.array(*[F.struct((4 * F.col("g") + i).alias("replicate"), F.col(f"b{i}").alias("b"), F.col(f"a{i}").alias("a"))
                               for i in range(4)])).alias("r")
    total = sums.select(each).select("r.*").filter(F.col("replicate") < replicates)
    return total.select("replicate", (F.lit(100.0) * (F.col("b") - F.col("a")) / F.nullif(F.col("b"), F.lit(0).cast("bigint"))).alias("lift_pct"))


def lift_interval(errors: DataFrame, keys: list[str], base: str, added: str, threshold_pct: float = LIFT_THRESHOLD_PCT,
                  replicates: int = REPLICATES, seed: int = 7) -> DataFrame:
    """One row: the lift, its bootstrap interval and the verdict.

    KEEP only if the whole interval reaches the threshold; ``holds_zero`` says whether no
    effect at all is among the values it holds."""
    whole = lambda c: F.floor(F.col(c) * F.lit(1e6) + F.lit(0.5)).cast("bigint")
    one = errors.select(whole(base).alias("b"), whole(added).alias("a")).filter("b IS NOT NULL AND a IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n_test"), F.sum("b").alias("b"), F.sum("a").alias("a"))
    one = one.select("n_test", (F.lit(100.0) * (F.col("b") - F.col("a")) / F.nullif(F.col("b"), F.lit(0).cast("bigint"))).alias("lift_pct"))
    drop = int(replicates * (1 - INTERVAL) / 2)
    lifts = lift_replicates(errors, keys, base, added, replicates, seed).agg(F.sort_array(F.collect_list("lift_pct")).alias("l"))
    ends = lifts.select(F.get("l", F.lit(drop)).alias("lift_low"), F.get("l", F.size("l") - 1 - drop).alias("lift_high"))
    row, end = one.first(), ends.first()                      # one row each
    low, high = end.lift_low, end.lift_high
    known = row.lift_pct is not None and low is not None
    return errors.sparkSession.createDataFrame(
        [(row.n_test, row.lift_pct, low, high, threshold_pct, "KEEP" if known and low >= threshold_pct else "CUT",
          known and low <= 0 <= high)],
        "n_test long, lift_pct double, lift_low double, lift_high double, threshold_pct double, verdict string, holds_zero boolean")


def inject_effect(df: DataFrame, strength: float, noise_seed: int | None = None,
                  keys: list[str] | None = None) -> DataFrame:
    """Multiply the target by a known weather effect (optionally with ~2% noise).

    slowdown = 1 + s * clip(precip/20, 0, 1.5) + 1.6 * s * clip(snow/100, 0, 1.5)

    With ``keys`` the noise is a seeded hash of the row key (uniform, same
    spread as N(1, 0.02)), identical under any partitioning or re-evaluation;
    without keys it is ``randn(seed)``.
    """
    def clip(c):
        return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.5))
    s = F.lit(float(strength))
    slow = (F.lit(1.0) + s * clip(F.col("precip_mm") / F.lit(20.0))
            + F.lit(1.6) * s * clip(F.col("snow_mm") / F.lit(100.0)))
    y = F.col(TARGET) * slow
    if noise_seed is not None and keys:
        u = F.pmod(F.xxhash64(F.lit(noise_seed), *[F.col(k) for k in keys]), F.lit(1000003)) / F.lit(1000003.0)
        y = y * (F.lit(1.0) + F.lit(0.02 * 12 ** 0.5) * (u - F.lit(0.5)))
    elif noise_seed is not None:
        y = y * (F.lit(1.0) + F.lit(0.02) * F.randn(noise_seed))
    return df.withColumn(TARGET, y)


def run_record(spark, params: dict, n_rows: int, data_version: str, metrics: dict,
               source_table: str) -> DataFrame:
    """One row describing a training run (appended to a runs table)."""
    return spark.createDataFrame(
        [(datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None), source_table, data_version,
          int(n_rows), str(sorted(params.items())), float(metrics["mae"]), float(metrics["r2"]))],
        "run_at timestamp_ntz, source_table string, data_version string, n_rows long, params string, "
        "mae double, r2 double")


def compare_runs(runs: DataFrame) -> DataFrame:
    """Every run with its number and how it differs from the run before on the same table: change of
    MAE and R^2, and whether data and parameters are the same (NULL for the first run)."""
    from aurum.functions.clean import round_half_up
    order = Window.partitionBy("source_table").orderBy("run_at", "params")
    before = lambda c: F.lag(c).over(order)
    return runs.select(
        "source_table", F.row_number().over(order).alias("run_no"), "run_at", "data_version", "n_rows", "params", "mae", "r2",
        round_half_up(F.col("mae") - before("mae"), 4).alias("mae_change"), round_half_up(F.col("r2") - before("r2"), 4).alias("r2_change"),
        (F.col("data_version") == before("data_version")).alias("same_data"), (F.col("params") == before("params")).alias("same_params"))


# ---- fixed apparatus thresholds (minutes of MAE) ----
CONTROL_MAX_ABS_LIFT = 0.15
TREATMENT_MIN_LIFT = 0.30


def apparatus_check(frame: DataFrame, base: list[str], added: list[str], keys: list[str],
                    params: dict | None = None, control: float = 0.0, treatment: float = 0.35,
                    noise_seed: int = 3) -> DataFrame:
    """Validate the experiment itself: a known injected effect must show up.

    The target is multiplied by a weather effect of ``control`` (none) and
    ``treatment`` strength (with 2% seeded noise); the MAE lift from adding
    the weather features must be ~0 for the control and clearly positive for
    the treatment.  The bootstrap intervals of both lifts are reported beside them.
    """
    cc = complete_cases(frame, added)

    def run(strength: float):
        f = materialize(hash_split(inject_effect(cc, strength, noise_seed, keys), keys))
        test = materialize(paired_errors(f, base, added, params))
        mae = test.agg(F.avg("_base").alias("b"), F.avg("_added").alias("a")).first()
        i = lift_interval(test, list(keys), "_base", "_added").first()
        return round(mae.b, 4) - round(mae.a, 4), i.lift_low, i.lift_high
    with ThreadPoolExecutor(max_workers=2) as pool:
        (c, c_low, c_high), (t, t_low, t_high) = pool.map(run, (control, treatment))
    ok = abs(c) < CONTROL_MAX_ABS_LIFT and t > TREATMENT_MIN_LIFT
    return frame.sparkSession.createDataFrame(
        [(control, c, c_low, c_high, treatment, t, t_low, t_high, "PASS" if ok else "FAIL")],
        "control_strength double, control_lift_min double, control_low_pct double, control_high_pct double, "
        "treatment_strength double, treatment_lift_min double, treatment_low_pct double, treatment_high_pct double, verdict string")
