"""Readings with their machine's baselines and derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.config import SLICE_ROWS
from millwatch.functions.columns import seconds_between
from millwatch.operators.joins import attach
from millwatch.operators.sizing import row_count
from millwatch.operators.trailing import trailing_means

READING = (
    "machine_id",
    "reading_ts",
    "temperature_c",
    "vibration_mm_s",
    "pressure_bar",
    "runtime_hours",
    "power_kw",
    "operating_mode",
    "error_code",
)

MACHINE = (
    "service_interval_hours",
    "baseline_temp_c",
    "baseline_vibration",
    "baseline_pressure_bar",
    "baseline_power_kw",
    "baseline_stddev_temp",
    "baseline_stddev_vibration",
    "criticality_class",
    "plant_id",
    "machine_type",
)

ROLLING = {
    "rolling_avg_temp_24h": ("temperature_c", 2),
    "rolling_avg_vibration_24h": ("vibration_mm_s", 3),
}


def z_score(value: str, baseline: str, spread: str):
    """Deviation in standard deviations; NULL where the spread is zero."""
    top = F.col(value).cast("double") - F.col(baseline).cast("double")
    return F.try_divide(top, F.col(spread).cast("double"))


def features(
    telemetry: DataFrame,
    registry: DataFrame,
    *,
    rolling: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per reading of a known machine.

    ``rolling=False`` leaves the trailing means out; scoring does not read them, and
    without them the plan has no shuffle.
    """
    carried = [c for c in ("reading_id",) if c in telemetry.columns]
    readings = telemetry.select(*READING, *carried)
    means = []
    if rolling:
        readings = trailing_means(readings, ROLLING, slice_rows=slice_rows)
        means = list(ROLLING)
    machines = registry.select("machine_id", *MACHINE, "last_service_ts")
    return attach(readings, machines, dim_rows=row_count(registry)).select(
        *READING,
        *carried,
        z_score("temperature_c", "baseline_temp_c", "baseline_stddev_temp").alias("z_temp"),
        z_score("vibration_mm_s", "baseline_vibration", "baseline_stddev_vibration").alias(
            "z_vibration"
        ),
        *means,
        (seconds_between("last_service_ts", "reading_ts") / 3600).alias("hours_since_service"),
        *MACHINE,
    )
