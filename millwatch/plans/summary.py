"""Per-machine and per-tier summaries of scored readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.config import BROADCAST_ROWS, DATA_LOSS, DEFAULT_RULE, RiskRule
from millwatch.functions.columns import derived_tier, hours, mean_score, newest_time, reason
from millwatch.operators.joins import attach
from millwatch.operators.ranking import first_per_key, newest_order, ranked
from millwatch.operators.sizing import row_count
from millwatch.sources.tables import since_date

ATTRIBUTES = ("plant_id", "machine_type", "location_zone", "criticality_class")
VERDICT = ("risk_score", "risk_tier", "top_signal", "recommended_action", "model_version")


def with_attributes(rows: DataFrame, registry: DataFrame, *, per_machine: bool) -> DataFrame:
    """Add registry attributes; ``per_machine`` says that rows are one per machine already."""
    return attach(
        rows,
        registry.select("machine_id", *ATTRIBUTES),
        dim_rows=row_count(registry),
        skewed=not per_machine,
    )


def latest_scores(scored: DataFrame) -> DataFrame:
    return first_per_key(scored, ["machine_id"], newest_order(scored.columns))


def latest_risk(scored: DataFrame, registry: DataFrame) -> DataFrame:
    """The newest scored reading of each machine; machines without one are absent."""
    return with_attributes(latest_scores(scored), registry, per_machine=True).select(
        "machine_id", *ATTRIBUTES, "reading_ts", *VERDICT
    )


def merge_latest(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Bring a stored latest-per-machine table up to date with new scores."""
    return latest_scores(stored.unionByName(fresh.select(*stored.columns)))


def worst_recent_risk(
    scored: DataFrame, registry: DataFrame, as_of=None, *, within_hours: int = 144
) -> DataFrame:
    """The highest score of each machine in the last hours; the newer reading wins a tie."""
    recent = since_date(scored, newest_time(scored, as_of) - hours(within_hours))
    order = [F.desc("risk_score"), F.desc("reading_ts"), F.asc("top_signal")]
    if "reading_id" in scored.columns:
        order.append(F.desc("reading_id"))
    worst = first_per_key(recent, ["machine_id"], order)
    return with_attributes(worst, registry, per_machine=True).select(
        "machine_id", *ATTRIBUTES, "reading_ts", *VERDICT
    )


def risk_trend(
    scored: DataFrame, registry: DataFrame, as_of=None, *, within_hours: int = 24
) -> DataFrame:
    """Scored readings of the last hours, one row each."""
    recent = since_date(scored, newest_time(scored, as_of) - hours(within_hours))
    return with_attributes(recent, registry, per_machine=False).select(
        "machine_id", "plant_id", "machine_type", "reading_ts", "risk_score", "risk_tier", "top_signal"
    )


def actionable_queue(
    latest: DataFrame, registry: DataFrame, *, single_task_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Latest state of each machine, ranked over the fleet. ``latest`` has one row per machine."""
    return ranked(
        latest,
        "priority_rank",
        [F.desc("risk_score"), F.asc("machine_id")],
        at_most=row_count(registry),
        single_task_rows=single_task_rows,
    ).select(
        "machine_id",
        *ATTRIBUTES,
        "reading_ts",
        "risk_score",
        "risk_tier",
        "top_signal",
        F.col("recommended_action").alias("action"),
        reason().alias("reason"),
        "priority_rank",
        (F.col("priority_rank") <= 5).alias("is_top_5"),
    )


def tier_distribution(scored: DataFrame) -> DataFrame:
    """Stored tiers over all scored readings, worst first."""
    return (
        scored.groupBy("risk_tier")
        .agg(
            F.count("*").alias("reading_count"),
            F.countDistinct("machine_id").alias("machine_count"),
            mean_score().alias("avg_score"),
            F.round(F.min("risk_score"), 4).alias("min_score"),
            F.round(F.max("risk_score"), 4).alias("max_score"),
        )
        .orderBy(F.desc("max_score"), "risk_tier")
    )


def tier_machine_list(
    latest: DataFrame,
    registry: DataFrame,
    *,
    page_size: int = 1000,
    single_task_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Machines of each tier as text, with the tier's machine count and mean score.

    A tier of more than ``page_size`` machines takes several rows, so that no row holds
    an unbounded list; every machine is on exactly one page.
    """
    paged = ranked(
        latest,
        "_place",
        [F.asc("machine_id")],
        within=["risk_tier"],
        at_most=row_count(registry),
        single_task_rows=single_task_rows,
    ).withColumn("page", F.expr(f"(_place - 1) DIV {page_size}"))
    lists = paged.groupBy("risk_tier", "page").agg(
        F.expr("listagg(machine_id, ', ') WITHIN GROUP (ORDER BY machine_id)").alias("machine_ids")
    )
    tiers = latest.groupBy("risk_tier").agg(
        # One row per machine, so rows are machines.
        F.count("*").alias("machines"),
        mean_score().alias("avg_score"),
        F.max("risk_score").alias("_worst"),
    )
    # Five tiers at most.
    return (
        lists.join(F.broadcast(tiers), "risk_tier")
        .orderBy(F.desc("_worst"), "risk_tier", "page")
        .select(
            "risk_tier",
            "page",
            "machines",
            "avg_score",
            "machine_ids",
            F.expr("repeat('#', CAST(avg_score * 20 AS INT))").alias("bar"),
        )
    )


def tier_mismatch(scored: DataFrame, rule: RiskRule = DEFAULT_RULE) -> DataFrame:
    """Readings whose stored tier is not the one read back from the stored score."""
    return (
        scored.withColumn("derived_tier", derived_tier(rule=rule))
        .filter("derived_tier <> risk_tier")
        .select("machine_id", "reading_ts", "risk_score", "risk_tier", "derived_tier")
    )


def data_loss_machines(latest: DataFrame) -> DataFrame:
    """Machines whose newest reading lacks a required sensor; they rank last in the queue."""
    return latest.filter(F.col("risk_tier") == DATA_LOSS).select(
        "machine_id", *ATTRIBUTES, "reading_ts", reason().alias("reason")
    )


def silent_machines(registry: DataFrame, scored: DataFrame) -> DataFrame:
    """Registered machines without any scored reading."""
    seen = scored.select("machine_id").distinct()
    return registry.join(seen, "machine_id", "left_anti").select("machine_id", *ATTRIBUTES)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
