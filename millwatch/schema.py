"""Declared tables: column names, types, nullability, length and value rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    """One declared table. ``key`` is the natural key, never a storage-ordered id."""

    name: str
    key: tuple[str, ...]
    columns: tuple[Column, ...]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self, *, enforce_nulls: bool = False) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.type, not (enforce_nulls and c.required)) for c in self.columns]
        )


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


_TEXT, _NTZ = T.StringType(), T.TimestampNTZType()

REGISTRY = Contract(
    "machine_registry",
    ("machine_id",),
    (
        Column("machine_id", _TEXT, True, 20),
        Column("plant_id", _TEXT, True, 10),
        Column("machine_type", _TEXT, True, 50),
        Column("install_date", T.DateType(), True),
        Column("baseline_temp_c", _dec(6, 2), True),
        Column("baseline_vibration", _dec(6, 3), True),
        Column("baseline_pressure_bar", _dec(6, 2), True),
        Column("baseline_power_kw", _dec(8, 2), True),
        Column("baseline_stddev_temp", _dec(6, 3), True),
        Column("baseline_stddev_vibration", _dec(6, 3), True),
        Column("service_interval_hours", _dec(8, 1), True),
        Column("last_service_ts", _NTZ, True),
        Column("location_zone", _TEXT, False, 20),
        Column("criticality_class", _TEXT, False, 10),
    ),
)

# Modes that machines are known to report; others are legal and merely counted.
KNOWN_MODES = ("RUNNING", "IDLE", "MAINTENANCE", "STARTUP", "NORMAL", "HIGH_LOAD")

TELEMETRY = Contract(
    "machine_telemetry",
    ("machine_id", "reading_ts"),
    (
        Column("machine_id", _TEXT, True, 20),
        Column("reading_ts", _NTZ, True),
        Column("temperature_c", _dec(7, 2)),
        Column("vibration_mm_s", _dec(7, 3)),
        Column("pressure_bar", _dec(7, 2)),
        Column("runtime_hours", _dec(10, 1)),
        Column("power_kw", _dec(8, 2)),
        # Free text; only MAINTENANCE means something to the rule.
        Column("operating_mode", _TEXT, False, 20),
        Column("error_code", _TEXT, False, 10),
        Column("load_ts", T.TimestampType()),
    ),
)

SCORED = Contract(
    "scored_telemetry_results",
    ("machine_id", "reading_ts"),
    (
        Column("machine_id", _TEXT, True, 20),
        Column("reading_ts", _NTZ, True),
        Column("risk_score", _dec(5, 4), True),
        Column("risk_tier", _TEXT, True, 10),
        Column("top_signal", _TEXT, False, 50),
        Column("recommended_action", _TEXT, False, 200),
        Column("model_version", _TEXT, False, 20),
        Column("scored_at", T.TimestampType()),
    ),
)
