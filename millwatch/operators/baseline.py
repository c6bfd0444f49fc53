"""Baselines estimated from a calibration slice of healthy running readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.functions.columns import clean_error, mean_of, scaled
from millwatch.sources.tables import DATE

# (input column, digits after the point, name of the estimated baseline)
SENSORS = (
    ("temperature_c", 2, "temp"),
    ("vibration_mm_s", 3, "vibration"),
    ("pressure_bar", 2, "pressure"),
    ("power_kw", 2, "power"),
)
_WHOLE = "decimal(38,0)"


def calm_readings(readings: DataFrame) -> DataFrame:
    """RUNNING, error-free readings."""
    return readings.filter((F.col("operating_mode") == "RUNNING") & clean_error().isNull())


def baseline_sums(calm: DataFrame, *keys: str, more: list[Column] = ()) -> DataFrame:
    """Exact counts, sums and sums of squares per machine (and further keys), which add up; and ``more``."""
    sums = [F.count("*").alias("readings"), *more]
    for column, places, name in SENSORS:
        value = scaled(column, places).cast("decimal(12,0)")
        sums += [
            F.count(column).alias(f"_{name}_n"),
            F.sum(value).cast(_WHOLE).alias(f"_{name}_s"),
            F.sum(value * value).cast(_WHOLE).alias(f"_{name}_q"),
        ]
    return calm.groupBy("machine_id", *keys).agg(*sums)


def baselines_of(sums: DataFrame) -> DataFrame:
    """Mean and sample standard deviation from sums of one row per machine."""
    results = ["machine_id", "readings"]
    for _, places, name in SENSORS:
        n, s, q = (F.col(f"_{name}_{part}") for part in "nsq")
        spread = (n * q).cast(_WHOLE) - (s * s).cast(_WHOLE)
        variance = F.try_divide(spread.cast("double"), (n * (n - 1)).cast("double"))
        results += [
            mean_of(s, n, places).alias(f"mean_{name}"),
            (F.sqrt(variance) / F.lit(float(10**places))).alias(f"stddev_{name}"),
        ]
    return sums.select(*results)


def estimate_baselines(
    readings: DataFrame, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Mean and sample standard deviation per machine over RUNNING, error-free readings.

    Sums and sums of squares are exact, so the result does not depend on row order.
    """
    calm = calm_readings(readings)
    if start is not None:
        calm = calm.filter(F.col("reading_ts") >= start)
    if end is not None:
        calm = calm.filter(F.col("reading_ts") < end)
    return baselines_of(baseline_sums(calm))


# States per machine and date -----------------------------------------------------------------------

# Relative rank error of a quantile sketch of this size is about 1.3 percent.
SKETCH_K = 200


def refresh_baseline_states(readings: DataFrame, path: str, dates: set[dt.date] | None = None) -> None:
    """Restate the given dates of a stored telemetry table (all if None): sums and quantile sketches.

    A state row has a bounded size, so a date costs one row per machine that reported. Other
    dates are neither read nor written; a retry restates the same dates.
    """
    rows = readings.withColumn(DATE, F.to_date("reading_ts")) if DATE not in readings.columns else readings
    rows = calm_readings(rows if dates is None else rows.filter(F.col(DATE).isin(sorted(dates))))
    sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), SKETCH_K).alias(f"_{name}_k") for c, _, name in SENSORS]
    states = baseline_sums(rows, DATE, more=sketches)
    writer = states.repartition(DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DATE).parquet(path)


def stored_baselines(
    spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """As ``estimate_baselines``, exactly, from the states of some dates (first and last included)."""
    added = [F.sum("readings").alias("readings")]
    for _, _, name in SENSORS:
        added.append(F.sum(f"_{name}_n").alias(f"_{name}_n"))
        added += [F.sum(f"_{name}_{part}").cast(_WHOLE).alias(f"_{name}_{part}") for part in "sq"]
    return baselines_of(_dated(spark, path, start, end).groupBy("machine_id").agg(*added))


def stored_quantiles(
    spark: SparkSession, path: str, share: float, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """A quantile of each sensor per machine, from merged sketches: right to some 1.3 percent in rank."""
    merged = _dated(spark, path, start, end).groupBy("machine_id").agg(
        *[F.kll_merge_agg_double(f"_{name}_k").alias(f"_{name}_k") for _, _, name in SENSORS],
        *[F.sum(f"_{name}_n").alias(f"_{name}_n") for _, _, name in SENSORS],
    )
    asked = lambda name: F.kll_sketch_get_quantile_double(f"_{name}_k", F.lit(share))
    return merged.select(
        "machine_id", *[F.when(F.col(f"_{name}_n") > 0, asked(name)).alias(f"quantile_{name}") for _, _, name in SENSORS]
    )


def _dated(spark: SparkSession, path: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    rows = spark.read.parquet(path)
    if start is not None:
        rows = rows.filter(F.col(DATE) >= F.lit(start))
    return rows if end is None else rows.filter(F.col(DATE) <= F.lit(end))
