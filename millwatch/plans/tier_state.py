"""Tier distribution from a state per date that merges exactly.

Counts, sums and extremes of a date add up; distinct machines do not, so the state holds them
as bitmaps over dense machine numbers, which are united. A date's state is some rows of at most
4 KB per tier and 32,768 machines, whatever the number of readings; an increment reads its own
dates only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.config import BROADCAST_ROWS
from millwatch.operators.joins import attach
from millwatch.operators.ranking import ranked
from millwatch.operators.sizing import row_count
from millwatch.sources.tables import DATE, table_exists
from millwatch.streaming.incremental import on_dates


def number_machines(machines: DataFrame, path: str) -> DataFrame:
    """The stored dense numbers (machine_id, number) after giving one to each new machine.

    Numbers count from 1 and never change. A call writes one folder; a retry of a call that
    did not end finds no marker there and overwrites it. Two calls must not run at once.
    """
    spark = machines.sparkSession
    known, parts = None, 0
    while table_exists(spark, f"{path}/part={parts}/_SUCCESS"):
        parts += 1
    if parts:
        known = spark.read.parquet(*[f"{path}/part={n}" for n in range(parts)])
    new = machines.select("machine_id").filter("machine_id IS NOT NULL").distinct()
    start = 0
    if known is not None:
        start = known.agg(F.max("number")).first()[0] or 0
        new = new.join(known, "machine_id", "left_anti")
    count = new.count()
    if count or known is None:
        placed = ranked(new, "number", [F.asc("machine_id")], at_most=count, single_task_rows=BROADCAST_ROWS)
        placed = placed.select("machine_id", (F.col("number") + F.lit(start)).cast("bigint").alias("number"))
        placed.write.mode("overwrite").parquet(f"{path}/part={parts}")
        parts += 1
    return spark.read.parquet(*[f"{path}/part={n}" for n in range(parts)])


def tier_states(scored: DataFrame, numbers: DataFrame) -> DataFrame:
    """One row per date, tier and 32,768 machine numbers; ``scored`` has the date column."""
    # Machine numbers are attached to one row per date, tier and machine, not to readings.
    score = F.col("risk_score")
    cells = scored.groupBy(DATE, "risk_tier", "machine_id").agg(
        F.count("*").alias("readings"),
        F.sum((score * 10000).cast("bigint")).alias("total"),
        F.count("risk_score").alias("scores"),
        F.min("risk_score").alias("least"),
        F.max("risk_score").alias("most"),
    )
    numbered = attach(cells, numbers, dim_rows=row_count(numbers))
    return numbered.groupBy(DATE, "risk_tier", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("machines"),
        F.sum("readings").alias("readings"),
        F.sum("total").alias("total"),
        F.sum("scores").alias("scores"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )


def refresh_tier_states(scored: DataFrame, numbers_path: str, state_path: str, dates: set[dt.date] | None = None) -> None:
    """Restate the given dates of a stored scored table (all of them if None); other dates are not read."""
    rows = scored if dates is None else on_dates(scored, dates)
    numbers = number_machines(rows, numbers_path)
    states = tier_states(rows, numbers)
    writer = states.repartition(DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DATE).parquet(state_path)


def tier_distribution(spark: SparkSession, state_path: str) -> DataFrame:
    """As ``summary.tier_distribution``, from the states of all dates."""
    merged = spark.read.parquet(state_path).groupBy("risk_tier", "bucket").agg(
        F.bitmap_or_agg("machines").alias("machines"),
        *[F.sum(c).alias(c) for c in ("readings", "total", "scores")],
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    mean = "CAST((2 * sum(total) + sum(scores)) DIV nullif(2 * sum(scores), 0) AS DECIMAL(9,0)) * 0.0001BD"
    return (
        merged.groupBy("risk_tier")
        .agg(
            F.sum("readings").alias("reading_count"),
            F.sum(F.bitmap_count("machines")).alias("machine_count"),
            F.expr(mean).alias("avg_score"),
            F.round(F.min("least"), 4).alias("min_score"),
            F.round(F.max("most"), 4).alias("max_score"),
        )
        .orderBy(F.desc("max_score"), "risk_tier")
    )


def machine_count(spark: SparkSession, state_path: str) -> int:
    """Machines that have scores at all, from the same bitmaps."""
    united = spark.read.parquet(state_path).groupBy("bucket").agg(F.bitmap_or_agg("machines").alias("m"))
    return united.agg(F.sum(F.bitmap_count("m"))).first()[0] or 0
