"""False alarms and missed failures against labelled failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.config import SLICE_ROWS
from millwatch.functions.columns import hours
from millwatch.operators.history import carry_last
from millwatch.operators.sizing import slice_seconds


def alert_quality(
    alerts: DataFrame, failures: DataFrame, *, horizon_hours: float = 24, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One row with precision and recall.

    An alert is right when its machine fails within the horizon after it; a failure is
    caught when its machine was alerted within the horizon before it.
    """
    at = F.col("reading_ts")
    is_alert, is_failure = F.col("_kind") == "alert", F.col("_kind") == "failure"
    marks = (
        alerts.select("machine_id", "reading_ts")
        .withColumn("_kind", F.lit("alert"))
        .unionByName(
            failures.select("machine_id", "reading_ts").withColumn("_kind", F.lit("failure"))
        )
        .distinct()
    )
    seconds = slice_seconds(marks, "machine_id", "reading_ts", slice_rows)
    through = {"order": ["reading_ts"], "inclusive": True, "seconds": seconds}
    before = carry_last(marks, {"_alert": F.when(is_alert, at)}, **through)
    both = carry_last(before, {"_failure": F.when(is_failure, at)}, backwards=True, **through)
    reach = hours(horizon_hours)
    counted = both.agg(
        F.count(F.when(is_alert, 1)).alias("alerts"),
        F.count(F.when(is_alert & (F.col("_failure") <= at + reach), 1)).alias("right_alerts"),
        F.count(F.when(is_failure, 1)).alias("failures"),
        F.count(F.when(is_failure & (F.col("_alert") >= at - reach), 1)).alias("caught_failures"),
    )
    return counted.select(
        "*",
        F.try_divide("right_alerts", "alerts").alias("precision"),
        F.try_divide("caught_failures", "failures").alias("recall"),
    )
