"""Tunable values of the risk rule and the size limits used when planning."""

from __future__ import annotations

from dataclasses import dataclass, field

# Tier names, signal names and operator-facing texts are part of
# the result contract and must not be reworded.
TIERS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
DATA_LOSS = "DATA_LOSS"

SIGNALS = (
    "VIBRATION",
    "TEMPERATURE",
    "PRESSURE",
    "SERVICE_OVERDUE",
    "POWER",
    "ERROR_CODE_E5XX",
)

ACTIONS = {
    "DATA_LOSS": "DATA LOSS — investigate telemetry connectivity / sensor health immediately",
    "CRITICAL": "IMMEDIATE SHUTDOWN — schedule emergency maintenance within 4 hours",
    "HIGH": "URGENT — schedule maintenance within 24 hours; increase monitoring frequency",
    # MEDIUM names the leading signal between these two parts.
    "MEDIUM": ("MONITOR — plan maintenance within 7 days; review ", " readings"),
    "LOW": "NORMAL — continue standard monitoring schedule",
}

REASONS = {
    "VIBRATION": "Elevated vibration relative to baseline (Z-score)",
    "TEMPERATURE": "Elevated temperature relative to baseline (Z-score)",
    "PRESSURE": "Pressure deviation from baseline",
    "POWER": "Power draw anomaly relative to baseline",
    "SERVICE_OVERDUE": "Approaching or past scheduled service interval",
    "ERROR_CODE_E5XX": "Critical error code observed (E5xx)",
    "DATA_LOSS": "Telemetry or sensor data missing - investigate connectivity",
}


@dataclass(frozen=True)
class Weights:
    """Share of each component in the score; the defaults sum to one."""

    vibration: float = 0.30
    temperature: float = 0.25
    pressure: float = 0.20
    service: float = 0.15
    power: float = 0.10


@dataclass(frozen=True)
class RiskRule:
    weights: Weights = Weights()
    # Overrides by machine type, e.g. {"PUMP": Weights(pressure=0.4, ...)}.
    type_weights: dict[str, Weights] = field(default_factory=dict)
    # (z from, score there, slope) for each piece of the z curve.
    curve: tuple[tuple[float, float, float], ...] = (
        (0.0, 0.0, 0.15),
        (1.0, 0.15, 0.30),
        (2.0, 0.45, 0.35),
        (3.0, 0.80, 0.10),
    )
    pressure_gain: float = 3.0
    power_gain: float = 2.5
    service_start: float = 0.8
    service_ramp: float = 0.2
    default_interval_hours: float = 2000.0
    critical_error_prefix: str = "E5"
    error_premium: float = 0.25
    critical: float = 0.80
    high: float = 0.60
    medium: float = 0.35
    version: str = "RULE_V1"

    def thresholds(self) -> tuple[tuple[str, float], ...]:
        return (("CRITICAL", self.critical), ("HIGH", self.high), ("MEDIUM", self.medium))


DEFAULT_RULE = RiskRule()

# A registry row is under 300 bytes (all columns have a declared length), so this
# many rows is at most about 150 MB on each executor when broadcast.
BROADCAST_ROWS = 500_000

# A key with more fact rows than this is joined without a shuffle when the
# dimension is too large to broadcast.
HOT_KEY_ROWS = 5_000_000

# Most rows of one machine and time slice that a single window task should hold.
SLICE_ROWS = 4_000_000

# Histories are not cut into slices while no machine has more rows than this.
UNCUT_ROWS = 100_000
