"""Registry and telemetry derived from the star-schema test tables.

Every customer is a machine and every event is a reading. Values are chosen by key
arithmetic so that each tier, signal and special case of the rule occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.operators.joins import attach
from millwatch.operators.sizing import row_count


# Declared, so that opening a table runs no job to look into its files.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def machine_key(column: str) -> str:
    return f"concat('MCH_', lpad(CAST({column} AS STRING), 6, '0'))"


def registry(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = (table(spark, folder, n) for n in ("nation", "region"))
    # 25 nations and 5 regions at every scale of these tables.
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = table(spark, folder, "customer")
    placed = customer.join(F.broadcast(places), customer.c_nationkey == places.n_nationkey)
    return placed.selectExpr(
        f"{machine_key('c_custkey')} AS machine_id",
        "r_name AS plant_id",
        "CASE c_custkey % 5 WHEN 0 THEN 'COMPRESSOR' WHEN 1 THEN 'PUMP' WHEN 2 THEN 'TURBINE' "
        "WHEN 3 THEN 'CONVEYOR' ELSE 'MIXER' END AS machine_type",
        "DATE'2020-01-01' AS install_date",
        "CAST(40 + 15 * (c_custkey % 5) AS DECIMAL(6,2)) AS baseline_temp_c",
        "CAST(1 + 0.5BD * (c_custkey % 5) AS DECIMAL(6,3)) AS baseline_vibration",
        "CAST(4 + 3 * (c_custkey % 5) AS DECIMAL(6,2)) AS baseline_pressure_bar",
        "CAST(40 + 60 * (c_custkey % 5) AS DECIMAL(8,2)) AS baseline_power_kw",
        "CAST(CASE WHEN c_custkey % 13 = 7 THEN 0 ELSE 2 + 0.5BD * (c_custkey % 3) END "
        "AS DECIMAL(6,3)) AS baseline_stddev_temp",
        "CAST(0.2BD + 0.1BD * (c_custkey % 3) AS DECIMAL(6,3)) AS baseline_stddev_vibration",
        "CAST(600 + 200 * (c_custkey % 4) AS DECIMAL(8,1)) AS service_interval_hours",
        "TIMESTAMP_NTZ'2023-12-20 00:00:00' AS last_service_ts",
        "CASE c_custkey % 3 WHEN 0 THEN 'ZONE_A' WHEN 1 THEN 'ZONE_B' ELSE 'ZONE_C' END "
        "AS location_zone",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'CRITICAL' ELSE 'STANDARD' END "
        "AS criticality_class",
    )


def telemetry(events: DataFrame, machines: DataFrame) -> DataFrame:
    """Readings from event rows, batch or streaming; ``reading_id`` orders equal times."""
    keyed = events.withColumn("machine_id", F.expr(machine_key("user_id")))
    baselines = machines.select(
        "machine_id", "baseline_temp_c", "baseline_vibration", "baseline_pressure_bar"
    )
    joined = attach(keyed, baselines, dim_rows=row_count(machines))
    return joined.selectExpr(
        "event_id AS reading_id",
        "machine_id",
        "ts AS reading_ts",
        "CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(baseline_temp_c + "
        "((event_id * 37) % 101 - 30) * 0.1BD AS DECIMAL(7,2)) END AS temperature_c",
        "CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST(baseline_vibration + "
        "((event_id * 61) % 113 - 30) * 0.02BD AS DECIMAL(7,3)) END AS vibration_mm_s",
        "CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(baseline_pressure_bar * "
        "(70 + (event_id * 29) % 61) * 0.01BD AS DECIMAL(7,2)) END AS pressure_bar",
        "CAST(NULL AS DECIMAL(10,1)) AS runtime_hours",
        "CAST(value AS DECIMAL(8,2)) AS power_kw",
        "CASE WHEN event_id % 41 = 0 THEN 'MAINTENANCE' WHEN event_id % 211 = 0 THEN NULL "
        "WHEN event_type = 'signup' THEN 'STARTUP' WHEN event_type = 'view' THEN 'IDLE' "
        "ELSE 'RUNNING' END AS operating_mode",
        "CASE WHEN event_type <> 'error' THEN NULL "
        "WHEN event_id % 4 = 0 THEN concat('E5', CAST(10 + event_id % 90 AS STRING)) "
        "WHEN event_id % 4 = 1 THEN 'E101' WHEN event_id % 4 = 2 THEN ' E512 ' ELSE '' END "
        "AS error_code",
    )
