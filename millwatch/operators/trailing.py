"""Trailing means over a time range, per machine.

A native ``RANGE BETWEEN INTERVAL`` frame needs a whole machine history in one task
and re-reads the frame for every row. Here time is cut into slices, each reading
enters its own slice as an addition and the slice one window later as a removal,
and a plain running sum over (machine, slice) gives the exact trailing sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch.config import HOT_KEY_ROWS, SLICE_ROWS
from millwatch.functions.columns import hours as hours_of
from millwatch.functions.columns import mean_of, scaled, time_slice
from millwatch.operators.joins import attach
from millwatch.operators.sizing import UNBOUNDED, largest_slice

# Width of the inner slices used when one (machine, window) slice is too large.
FINE_SECONDS = 60



def trailing_means(
    df: DataFrame,
    means: dict[str, tuple[str, int]],
    *,
    hours: int = 24,
    key: str = "machine_id",
    ts: str = "reading_ts",
    slice_rows: int = SLICE_ROWS,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Add the mean of each column over ``[ts - hours, ts]``, rows of equal time included.

    ``means`` maps an output name to (decimal column, its digits after the point).
    """
    parts = {f"_v{i}": scaled(col, places) for i, (col, places) in enumerate(means.values())}
    if largest_slice(df, key, ts, hours * 3600) <= slice_rows:
        summed = _one_pass(df, means, parts, hours, key, ts)
    else:
        summed = _by_instant(df, parts, hours, key, ts, hot_rows)
    return summed.select(
        *df.columns,
        *[
            mean_of(F.col(f"_v{i}_sum"), F.col(f"_v{i}_n"), places).alias(name)
            for i, (name, (_, places)) in enumerate(means.items())
        ],
    )


def _leaves(at: str, hours: int):
    """The first instant at which a reading is out of the window."""
    return F.col(at) + hours_of(hours) + F.expr("INTERVAL '0.000001' SECOND")


def _running(window: Window, added, carried):
    """Running sum of signed values on top of what the slice starts with."""
    run = window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(F.sum(added).over(run), F.lit(0)) + F.coalesce(
        F.sum(carried).over(whole), F.lit(0)
    )


def _one_pass(
    df: DataFrame, means: dict, parts: dict, hours: int, key: str, ts: str
) -> DataFrame:
    """One shuffle: slices are as long as the window, so the slice before holds the rest."""
    needed = {key} | {col for col, _ in means.values()}
    later = F.col("_later")
    copies = df.withColumn("_later", F.explode(F.array(F.lit(False), F.lit(True))))
    slices = time_slice(ts, hours * 3600)
    # Shuffled before the window asks for it, so that the signed values are formed afterwards;
    # a removal carries no more than the values it takes away.
    rows = copies.select(
        *[F.col(c) if c in needed else F.when(~later, F.col(c)).alias(c) for c in df.columns],
        F.when(later, slices + 1).otherwise(slices).alias("_slice"),
        F.when(later, _leaves(ts, hours)).otherwise(F.col(ts)).alias("_at"),
        "_later",
    ).repartition(key, "_slice")
    window = Window.partitionBy(key, "_slice").orderBy("_at")
    sums = []
    for v, expr in parts.items():
        for suffix, value in (("sum", expr), ("n", F.when(expr.isNotNull(), 1))):
            added, carried = F.when(later, -value).otherwise(value), F.when(later, value)
            sums.append(_running(window, added, carried).alias(f"{v}_{suffix}"))
    return rows.select(*df.columns, "_later", *sums).filter(~later).drop("_later")


def _by_instant(
    df: DataFrame, parts: dict, hours: int, key: str, ts: str, hot_rows: int
) -> DataFrame:
    """For slices too large for one task: sums per instant first, then minute slices.

    A window task then holds one minute of one machine, and equal instants are
    collapsed on the map side, so no number of readings makes it larger.
    """
    per_window = hours * 3600 // FINE_SECONDS
    measures = [f"{v}_{s}" for v in parts for s in ("sum", "n")]
    instants = (
        df.groupBy(F.col(key).alias("_key"), F.col(ts).alias("_at"))
        .agg(
            *[
                agg.alias(f"{v}_{s}")
                for v, expr in parts.items()
                for s, agg in (("sum", F.coalesce(F.sum(expr), F.lit(0))), ("n", F.count(expr)))
            ],
            F.count("*").alias("_rows"),
        )
        .withColumn("_slice", time_slice("_at", FINE_SECONDS))
    )

    # What each minute starts with: the totals of the minutes one window back.
    totals = instants.groupBy("_key", "_slice").agg(*[F.sum(m).alias(m) for m in measures])
    block = F.expr(f"_slice DIV {per_window}")
    spread = totals.withColumn("_later", F.explode(F.array(F.lit(False), F.lit(True))))
    later = F.col("_later")
    spread = spread.select(
        "_key",
        "_slice",
        "_later",
        F.when(later, block + 1).otherwise(block).alias("_block"),
        F.when(later, F.col("_slice") + per_window + 1).otherwise(F.col("_slice")).alias("_when"),
        *[F.when(later, -F.col(m)).otherwise(F.col(m)).alias(m) for m in measures],
        *[F.when(later, F.col(m)).alias(f"{m}_carry") for m in measures],
    )
    day = Window.partitionBy("_key", "_block").orderBy("_when")
    carried = (
        spread.select(
            "_key",
            "_slice",
            "_later",
            *[(_running(day, m, f"{m}_carry") - F.col(m)).alias(f"{m}_carry") for m in measures],
        )
        .filter(~F.col("_later"))
        .drop("_later")
    )

    zero = [F.lit(0).cast("bigint").alias(f"{m}_carry") for m in measures]
    additions = instants.select("_key", "_slice", "_at", F.lit(0).alias("_kind"), *measures, *zero)
    removals = instants.select(
        "_key",
        (F.col("_slice") + per_window).alias("_slice"),
        _leaves("_at", hours).alias("_at"),
        F.lit(1).alias("_kind"),
        *[(-F.col(m)).alias(m) for m in measures],
        *zero,
    )
    starts = carried.select(
        "_key",
        "_slice",
        F.lit(None).cast("timestamp_ntz").alias("_at"),
        F.lit(2).alias("_kind"),
        *[F.lit(0).cast("bigint").alias(m) for m in measures],
        *[f"{m}_carry" for m in measures],
    )
    window = Window.partitionBy("_key", "_slice").orderBy("_at")
    result = (
        additions.unionByName(removals)
        .unionByName(starts)
        .select(
            F.col("_key").alias(key),
            F.col("_at").alias(ts),
            "_kind",
            *[_running(window, m, f"{m}_carry").alias(m) for m in measures],
        )
        .filter("_kind = 0")
        .drop("_kind")
    )
    hot = instants.filter(F.col("_rows") > hot_rows).select(
        F.col("_key").alias(key), F.col("_at").alias(ts)
    )
    return attach(df, result, [key, ts], hot_rows=hot_rows, hot=hot, dim_rows=UNBOUNDED)
