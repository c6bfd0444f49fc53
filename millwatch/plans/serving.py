"""The queries behind an operator's screen. Filters are values, never query text."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.config import DEFAULT_RULE, TIERS, RiskRule
from millwatch.functions.columns import (
    derived_tier,
    in_choices,
    mean_score,
    minute_text,
    tier_ranges,
)
from millwatch.operators.joins import attach
from millwatch.operators.ranking import newest_order
from millwatch.operators.sizing import row_count


@dataclass(frozen=True)
class Selection:
    """What the user ticked. ``None`` means no filter; an empty choice selects nothing."""

    plants: Iterable[str] | None = None
    tiers: Iterable[str] | None = None
    machine_types: Iterable[str] | None = None

    def machines(self) -> Column:
        """Condition on registry columns."""
        condition = F.lit(True)
        if self.plants is not None:
            condition = condition & in_choices("plant_id", self.plants)
        if self.machine_types is not None:
            condition = condition & in_choices("machine_type", self.machine_types)
        return condition

    def scores(self, rule: RiskRule = DEFAULT_RULE) -> Column:
        """Condition on the stored score, as ranges that a scan can skip files by."""
        return F.lit(True) if self.tiers is None else tier_ranges(self.tiers, rule=rule)


EVERYTHING = Selection()


class UnknownMachine(ValueError):
    """The chosen machine is not in the registry."""


def distinct_plants(registry: DataFrame) -> DataFrame:
    return registry.filter("plant_id IS NOT NULL").select("plant_id").distinct().orderBy("plant_id")


def distinct_tiers(latest: DataFrame, rule: RiskRule = DEFAULT_RULE) -> DataFrame:
    return latest.select(derived_tier(rule=rule).alias("risk_tier")).distinct().orderBy("risk_tier")


def machine_list(registry: DataFrame) -> DataFrame:
    return registry.select("machine_id").orderBy("machine_id")


def check_machine(registry: DataFrame, machine_id: str) -> str:
    """The cleaned id of a registered machine, or ``UnknownMachine``."""
    wanted = str(machine_id).strip()
    if registry.filter(F.col("machine_id") == wanted).isEmpty():
        raise UnknownMachine(wanted)
    return wanted


def selected(
    latest: DataFrame, selection: Selection = EVERYTHING, rule: RiskRule = DEFAULT_RULE
) -> DataFrame:
    return latest.filter(selection.machines() & selection.scores(rule))


def kpi_by_tier(
    latest: DataFrame, selection: Selection = EVERYTHING, rule: RiskRule = DEFAULT_RULE
) -> DataFrame:
    """Machines and mean score per derived tier, worst first, with the share of all machines."""
    tiers = (
        selected(latest, selection, rule)
        .groupBy(derived_tier(rule=rule).alias("risk_tier"))
        .agg(
            F.count("*").alias("machine_count"),  # one row per machine
            mean_score().alias("avg_score"),
            F.max("risk_score").alias("_worst"),
        )
    )
    # At most four rows are left here.
    everything = Window.partitionBy()
    return (
        tiers.withColumn("share", F.col("machine_count") / F.sum("machine_count").over(everything))
        .orderBy(F.desc("_worst"))
        .drop("_worst")
    )


def kpi_cards(
    latest: DataFrame, selection: Selection = EVERYTHING, rule: RiskRule = DEFAULT_RULE
) -> DataFrame:
    """One row: machines per tier, zero where a tier is empty, and their total."""
    per_tier = (
        selected(latest, selection, rule)
        .groupBy(derived_tier(rule=rule).alias("_tier"))
        .agg(F.count("*").alias("_n"))
    )
    # At most four rows are left to be turned into columns.
    cards = [f"coalesce(sum(CASE WHEN _tier = '{t}' THEN _n END), 0) AS {t.lower()}" for t in TIERS]
    counts = per_tier.agg(*[F.expr(card) for card in cards])
    return counts.withColumn("machines", F.expr(" + ".join(t.lower() for t in TIERS)))


def overview(
    latest: DataFrame, selection: Selection = EVERYTHING, rule: RiskRule = DEFAULT_RULE
) -> DataFrame:
    """One line per machine, riskiest first."""
    return (
        selected(latest, selection, rule)
        .orderBy(F.desc("risk_score"), "machine_id")
        .select(
            F.col("machine_id").alias("machine"),
            F.col("plant_id").alias("plant"),
            "machine_type",
            "location_zone",
            "criticality_class",
            derived_tier(rule=rule).alias("risk_tier"),
            F.round("risk_score", 4).alias("score"),
            "top_signal",
            "recommended_action",
            minute_text("reading_ts").alias("last_reading"),
        )
    )


def top_actionable(
    queue: DataFrame,
    selection: Selection = EVERYTHING,
    rule: RiskRule = DEFAULT_RULE,
    *,
    n: int = 5,
) -> DataFrame:
    """The first ``n`` of the ranked queue that pass the filters; ranks stay fleet-wide."""
    return (
        queue.filter(selection.machines() & selection.scores(rule))
        .orderBy("priority_rank")
        .limit(n)
        .select(
            F.col("machine_id").alias("machine"),
            F.col("plant_id").alias("plant"),
            "machine_type",
            minute_text("reading_ts").alias("last_reading"),
            F.round("risk_score", 4).alias("score"),
            "risk_tier",
            "reason",
            "action",
            "priority_rank",
        )
    )


def full_trend(
    scored: DataFrame,
    registry: DataFrame,
    selection: Selection = EVERYTHING,
    rule: RiskRule = DEFAULT_RULE,
) -> DataFrame:
    """All scored readings that pass the filters, oldest first."""
    machines = registry.filter(selection.machines()).select("machine_id", "plant_id")
    joined = attach(
        scored.filter(selection.scores(rule)), machines, dim_rows=row_count(registry)
    )
    ties = [c for c in ("reading_id",) if c in scored.columns]
    return joined.orderBy("reading_ts", "machine_id", *ties).select(
        F.col("machine_id").alias("machine"),
        F.col("plant_id").alias("plant"),
        "reading_ts",
        "risk_score",
        derived_tier(rule=rule).alias("risk_tier"),
        "top_signal",
    )


def trend_machines(trend: DataFrame) -> DataFrame:
    return trend.agg(F.countDistinct("machine").alias("machines"))


def last_readings(telemetry: DataFrame, machine_id: str, *, n: int = 72) -> DataFrame:
    """The newest sensor readings of one machine."""
    ties = [F.desc(c) for c in ("reading_id",) if c in telemetry.columns]
    return (
        telemetry.filter(F.col("machine_id") == machine_id)
        .orderBy(F.desc("reading_ts"), *ties)
        .limit(n)
        .select(
            minute_text("reading_ts").alias("reading_time"),
            F.col("temperature_c").alias("temp_c"),
            F.col("vibration_mm_s").alias("vib_mm_s"),
            F.col("pressure_bar").alias("pres_bar"),
            "power_kw",
            "operating_mode",
            "error_code",
        )
    )


def score_history(scored: DataFrame, machine_id: str, rule: RiskRule = DEFAULT_RULE) -> DataFrame:
    """All scores of one machine, oldest first."""
    ties = [c for c in ("reading_id",) if c in scored.columns]
    return (
        scored.filter(F.col("machine_id") == machine_id)
        .orderBy("reading_ts", *ties)
        .select("reading_ts", "risk_score", derived_tier(rule=rule).alias("tier"), "top_signal")
    )


def latest_recommendation(
    scored: DataFrame, machine_id: str, rule: RiskRule = DEFAULT_RULE
) -> DataFrame:
    """The newest verdict on one machine; only its rows are read."""
    mine = scored.filter(F.col("machine_id") == machine_id)
    return (
        mine.orderBy(*newest_order(scored.columns))
        .limit(1)
        .select(
            derived_tier(rule=rule).alias("risk_tier"),
            F.round("risk_score", 4).alias("risk_score"),
            "top_signal",
            "recommended_action",
        )
    )


def error_groups(
    telemetry: DataFrame, registry: DataFrame, selection: Selection = EVERYTHING
) -> DataFrame:
    """Error readings per machine and code. The fact is aggregated before the join."""
    counted = (
        telemetry.filter("error_code IS NOT NULL AND trim(error_code) <> ''")
        .groupBy("machine_id", "error_code")
        .agg(
            F.count("*").alias("occurrences"),
            F.min("reading_ts").alias("first_seen"),
            F.max("reading_ts").alias("last_seen"),
        )
    )
    machines = registry.filter(selection.machines()).select("machine_id", "plant_id")
    return attach(counted, machines, dim_rows=row_count(registry), skewed=False)


def error_frequency(
    telemetry: DataFrame, registry: DataFrame, selection: Selection = EVERYTHING, *, n: int = 50
) -> DataFrame:
    """The most frequent (machine, code) pairs."""
    return (
        error_groups(telemetry, registry, selection)
        .orderBy(F.desc("occurrences"), "machine_id", "error_code")
        .limit(n)
        .select(
            F.col("machine_id").alias("machine"),
            F.col("plant_id").alias("plant"),
            "error_code",
            "occurrences",
            minute_text("first_seen").alias("first_seen"),
            minute_text("last_seen").alias("last_seen"),
        )
    )


def error_bars(
    frequency: DataFrame, codes: list[str] | None = None, group: Column | None = None
) -> DataFrame:
    """Stacked-bar data: a row per machine, a column per code or per ``group`` of codes.

    The input is the bounded list of ``error_frequency``, which bounds the columns too.
    """
    labelled = frequency.withColumn("_code", F.col("error_code") if group is None else group)
    pivoted = labelled.groupBy("machine").pivot("_code", codes)
    return pivoted.agg(F.sum("occurrences")).na.fill(0)
