"""Rules as data: stored rule rows with a validity, joined to readings by reading time.

A rule table has one row per version, machine type and parameter: (version, valid_from,
machine_type, name, value). ``name`` is a number of ``RiskRule`` (critical, high, error_premium,
...) or a weight (vibration, temperature, ...); with a machine type, the weight holds for that
type only. What a version does not name keeps its default. A version holds from its
``valid_from`` until the next one's; each reading is scored by the version of its own time, so
a full rescore after a change of thresholds keeps the verdicts of older versions.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.config import DEFAULT_RULE, RiskRule, Weights
from millwatch.plans.scoring import score_readings
from millwatch.sources.tables import DATE

# Rule rows are settings: more of them than this are refused rather than collected.
MOST_ROWS = 10_000
RULE_ROW = "version STRING, valid_from TIMESTAMP_NTZ, machine_type STRING, name STRING, value DOUBLE"

_NUMBERS = {f.name for f in fields(RiskRule) if f.type == "float"}
_WEIGHTS = {f.name for f in fields(Weights)}


@dataclass(frozen=True)
class Validity:
    rule: RiskRule
    start: dt.datetime
    end: dt.datetime | None

    def holds(self, columns: list[str]) -> Column:
        """Readings of this version's time, by date folder too where the table has them."""
        kept = F.col("reading_ts") >= F.lit(self.start)
        if DATE in columns:
            kept &= F.col(DATE) >= F.lit(self.start.date())
        if self.end is not None:
            kept &= F.col("reading_ts") < F.lit(self.end)
            if DATE in columns:
                kept &= F.col(DATE) <= F.lit(self.end.date())
        return kept


def read_rules(rows: DataFrame) -> list[Validity]:
    """The versions of a rule table in order of time.

    Refused are: unknown names, missing values or times, two values for one parameter of a
    version, a version with two starts, and two versions with one start.
    """
    found = rows.select("version", "valid_from", "machine_type", "name", "value").limit(MOST_ROWS + 1).collect()
    if len(found) > MOST_ROWS:
        raise ValueError(f"a rule table has at most {MOST_ROWS} rows")
    starts: dict[str, dt.datetime] = {}
    values: dict[str, dict[tuple[str | None, str], float]] = {}
    for version, start, kind, name, value in found:
        if version is None or start is None or value is None:
            raise ValueError("a rule row needs a version, a start and a value")
        if starts.setdefault(version, start) != start:
            raise ValueError(f"{version} has two starts")
        if name not in _WEIGHTS and (kind is not None or name not in _NUMBERS):
            raise ValueError(f"{version}: unknown parameter {name}")
        if (kind, name) in values.setdefault(version, {}):
            raise ValueError(f"{version}: {name} is given twice")
        values[version][kind, name] = value
    order = sorted(starts, key=starts.get)
    if len(set(starts.values())) < len(order):
        raise ValueError("two versions have one start")
    ends = [starts[v] for v in order[1:]] + [None]
    return [Validity(_rule_of(v, values[v]), starts[v], end) for v, end in zip(order, ends)]


def _rule_of(version: str, values: dict[tuple[str | None, str], float]) -> RiskRule:
    numbers = {name: x for (kind, name), x in values.items() if kind is None and name in _NUMBERS}
    common = replace(
        DEFAULT_RULE.weights, **{name: x for (kind, name), x in values.items() if kind is None and name in _WEIGHTS}
    )
    by_type: dict[str, dict[str, float]] = {}
    for (kind, name), x in values.items():
        if kind is not None:
            by_type.setdefault(kind, {})[name] = x
    types = {kind: replace(common, **some) for kind, some in by_type.items()}
    return replace(DEFAULT_RULE, **numbers, weights=common, type_weights=types, version=version)


def score_by_rules(telemetry: DataFrame, registry: DataFrame, rules: DataFrame, **how) -> DataFrame:
    """Every reading scored by the version of its own time; readings before the first have no score.

    One scan per version, of that version's time only: the condition is on readings and reaches the files.
    """
    versions = read_rules(rules)
    if not versions:
        raise ValueError("the rule table is empty")
    parts = [
        score_readings(telemetry, registry, v.rule, where=v.holds(telemetry.columns), **how) for v in versions
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
