"""Unsupervised signs of trouble beside the rule: drift of the trailing mean, robust deviation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch.operators.joins import attach
from millwatch.operators.sizing import row_count

# Fixed value: makes the median absolute deviation comparable to a standard deviation.
MAD_TO_SIGMA = 1.4826


def mean_drift(feature_rows: DataFrame, *, at_least: float = 2.0) -> DataFrame:
    """Readings whose trailing 24-hour mean has left the baseline by ``at_least`` deviations."""

    def drift(mean: str, baseline: str, spread: str):
        return F.try_divide(
            F.col(mean) - F.col(baseline).cast("double"), F.col(spread).cast("double")
        )

    drifted = feature_rows.select(
        *[c for c in ("reading_id",) if c in feature_rows.columns],
        "machine_id",
        "reading_ts",
        drift("rolling_avg_temp_24h", "baseline_temp_c", "baseline_stddev_temp").alias(
            "temperature_drift"
        ),
        drift(
            "rolling_avg_vibration_24h", "baseline_vibration", "baseline_stddev_vibration"
        ).alias("vibration_drift"),
    )
    return drifted.filter(
        (F.abs("temperature_drift") >= at_least) | (F.abs("vibration_drift") >= at_least)
    )


def _lower_median(counts: DataFrame, value: str, name: str) -> DataFrame:
    """Per machine the smallest value that half of the counted values do not exceed.

    ``counts`` holds one row per machine and distinct value, so a window task sees the
    distinct values of a declared decimal, however many readings a machine has.
    """
    upto = Window.partitionBy("machine_id").orderBy(value)
    seen = F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    placed = counts.withColumn("_half", seen * 2 >= total)
    return placed.filter("_half").groupBy("machine_id").agg(F.min(value).alias(name))


def robust_profile(readings: DataFrame, column: str, machines: int) -> DataFrame:
    """Median and median absolute deviation of a sensor per machine; ``machines`` bounds the rows."""
    # A missing value counts zero times, which keeps machines that never report the sensor.
    counts = readings.groupBy("machine_id", F.col(column).alias("_v")).agg(
        F.count(column).alias("_n")
    )
    median = _lower_median(counts, "_v", f"{column}_median")
    gaps = (
        attach(counts, median, dim_rows=machines, skewed=False)
        .groupBy("machine_id", F.abs(F.col("_v") - F.col(f"{column}_median")).alias("_gap"))
        .agg(F.sum("_n").alias("_n"))
    )
    spread = _lower_median(gaps, "_gap", f"{column}_mad")
    return median.join(spread, "machine_id")


def robust_deviation(readings: DataFrame, registry: DataFrame, columns: list[str]) -> DataFrame:
    """Each reading's distance from its machine's median in robust deviations.

    NULL where the sensor is missing or more than half of its values are equal.
    """
    machines = row_count(registry)
    scored = readings
    for column in columns:
        scored = attach(scored, robust_profile(readings, column, machines), dim_rows=machines)
    kept = [c for c in ("reading_id", "machine_id", "reading_ts", *columns) if c in readings.columns]
    return scored.select(
        *kept,
        *[
            F.try_divide(
                (F.col(c) - F.col(f"{c}_median")).cast("double"),
                F.col(f"{c}_mad").cast("double") * F.lit(MAD_TO_SIGMA),
            ).alias(f"{c}_robust_z")
            for c in columns
        ],
    )
