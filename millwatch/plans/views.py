"""The declared tables and views as temporary views for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millwatch.functions.columns import upper_names
from millwatch.functions.rule import register_sql_function, register_table_function
from millwatch.plans.features import features
from millwatch.plans.summary import actionable_queue, latest_risk, risk_trend


def register_views(
    spark: SparkSession, telemetry: DataFrame, registry: DataFrame, scored: DataFrame, as_of=None
) -> None:
    """Name tables, views and the scoring functions so that plain SQL finds them."""
    latest = latest_risk(scored, registry)
    for name, df in {
        "machine_registry": registry,
        "machine_telemetry": telemetry,
        "scored_telemetry_results": scored,
        "v_telemetry_features": features(telemetry, registry),
        "v_latest_risk_summary": latest,
        "v_risk_trend_24h": risk_trend(scored, registry, as_of),
        "v_actionable_risk": actionable_queue(latest, registry),
    }.items():
        df.createOrReplaceTempView(name)
    register_sql_function(spark)
    register_table_function(spark)


def query(spark: SparkSession, sql: str, args: dict | list | None = None) -> DataFrame:
    """A parameterised query with upper-cased result names."""
    return upper_names(spark.sql(sql, args=args))


def query_value(spark: SparkSession, sql: str, args: dict | list | None = None):
    """The single value of a one-row query; None when there is no row."""
    row = spark.sql(sql, args=args).first()
    return None if row is None else row[0]
