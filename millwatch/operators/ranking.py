"""Newest row per key and ranks over a whole set, without a single-task sort of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.config import BROADCAST_ROWS
from millwatch.session import reliable_checkpoint


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key. Each map task keeps its own first row, so a hot key stays small."""
    pick = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(pick)).filter("_n = 1").drop("_n")


def newest_order(columns: list[str]) -> list[Column]:
    """Total order for "latest": time, then score, then signal, then a source id if any."""
    order = [F.desc("reading_ts"), F.desc("risk_score"), F.asc("top_signal")]
    return order + ([F.desc("reading_id")] if "reading_id" in columns else [])


def ranked(
    df: DataFrame,
    name: str,
    order: list[Column],
    *,
    within: list[str] = (),
    at_most: int,
    single_task_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add a dense 1..n row number under a total ``order``, optionally inside groups.

    ``at_most`` is a proven bound on the rows. Small sets are numbered by one window.
    Larger ones are sorted across tasks once into reliable storage; every task's rows
    are then numbered from the counts of the tasks before it.
    """
    within = list(within)
    if at_most <= single_task_rows:
        window = Window.partitionBy(*within).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))

    placed = reliable_checkpoint(
        df.orderBy(*[F.asc(c) for c in within], *order).withColumn(
            "_pos", F.monotonically_increasing_id()
        )
    )
    # The id holds the task in its upper bits and the row inside the task in the lower 33.
    placed = placed.withColumn("_task", F.shiftright("_pos", 33)).withColumn(
        "_row", F.col("_pos").bitwiseAND((1 << 33) - 1)
    )
    # One row per task (and group), however many rows were sorted.
    blocks = placed.groupBy("_task", *within).agg(
        F.count("*").alias("_n"), F.min("_row").alias("_start")
    )
    before = Window.partitionBy(*within).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_task",
        *within,
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start")).alias("_offset"),
    )
    numbered = placed.join(F.broadcast(offsets), ["_task", *within])
    return numbered.withColumn(name, F.col("_row") + F.col("_offset") + 1).drop(
        "_pos", "_task", "_row", "_offset"
    ).select(*df.columns, name)
