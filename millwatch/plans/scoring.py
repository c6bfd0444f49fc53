"""Every scorable reading through the risk rule."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.config import DEFAULT_RULE, RiskRule
from millwatch.functions.columns import clean_error, hours, newest_time
from millwatch.functions.rule import COMPONENTS, apply_rule, stored_score
from millwatch.plans.features import features
from millwatch.sources.tables import DATE


# Maintenance readings and readings of unknown mode have no score.
SCORABLE = "operating_mode <> 'MAINTENANCE'"


def score_features(
    rows: DataFrame, rule: RiskRule = DEFAULT_RULE, *, keep_components: bool = False
) -> DataFrame:
    """Score feature rows; maintenance rows and rows of unknown mode are skipped.

    The result reports its row count as an observed metric. That node also keeps the optimizer
    from copying the whole rule into filters on the score, which would evaluate it twice per
    row and makes planning take half a minute. Filter on machine or time before scoring, or
    filter the stored table, where every predicate reaches the files.
    """
    open_rows = rows.filter(SCORABLE)
    judged = apply_rule(
        open_rows.withColumn("error_code", clean_error()), rule, keep_components=keep_components
    )
    scored = judged.select(
        "machine_id",
        "reading_ts",
        *[c for c in ("reading_id",) if c in rows.columns],
        F.expr(stored_score("rule_score")).alias("risk_score"),
        "risk_tier",
        "top_signal",
        "recommended_action",
        F.lit(rule.version).alias("model_version"),
        *(COMPONENTS if keep_components else ()),
    )
    return scored.observe(f"scored-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def score_readings(
    telemetry: DataFrame,
    registry: DataFrame,
    rule: RiskRule = DEFAULT_RULE,
    *,
    keep_components: bool = False,
    where: Column | None = None,
) -> DataFrame:
    """Telemetry to scores in one pass; with a registry small enough to broadcast, no shuffle.

    ``where`` is a condition on readings (machine, time); it is applied before the rule and
    so reaches the scan.
    """
    if where is not None:
        telemetry = telemetry.filter(where)
    rows = features(telemetry, registry, rolling=False)
    return score_features(rows, rule, keep_components=keep_components)


def newest_scorable(telemetry: DataFrame, as_of=None) -> Column:
    """"Now" without scoring anything: the newest reading that the rule scores."""
    return newest_time(telemetry.filter(SCORABLE), as_of)


def recent_scores(
    telemetry: DataFrame,
    registry: DataFrame,
    within_hours: float,
    as_of=None,
    rule: RiskRule = DEFAULT_RULE,
) -> DataFrame:
    """Scores of the last hours, where scores are not stored: only those readings are scored."""
    since = newest_scorable(telemetry, as_of) - hours(within_hours)
    where = F.col("reading_ts") >= since
    if DATE in telemetry.columns:
        where = where & (F.col(DATE) >= F.to_date(since))
    return score_readings(telemetry, registry, rule, where=where)


def stamped(scored: DataFrame) -> DataFrame:
    """Scores as stored, with the time of scoring."""
    return scored.withColumn("scored_at", F.current_timestamp())
