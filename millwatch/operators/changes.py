"""Change points: is a machine getting worse or better?

A cumulative sum adds what a score lies above (or below) its reference and never falls under
zero: s' = max(0, s + x). One step is a function s -> max(a, s + b), and such functions compose
into one of the same form, so a slice of time is summed up by two numbers whatever its length:
its total b, and the sum a that it ends with if it starts at zero. A scan over the slices of a
machine gives what each slice starts with; inside slices everything is a running sum and a
running minimum. No history has to lie in one task, and all numbers are integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch.config import SLICE_ROWS
from millwatch.functions.columns import scaled, time_slice
from millwatch.operators.sizing import slice_seconds

# Scores are held as ten-thousandths.
_UNIT = 10_000


def cumulative_sums(
    steps: DataFrame, keys: list[str], *, order: tuple[str, ...] = ("reading_ts",), seconds: int
) -> DataFrame:
    """``steps`` (keys, order, a whole number x and more) with ``before`` and ``after``: the sum before and after each row.

    ``order`` is the order inside a key; it starts with ``reading_ts`` and has to be total.
    """
    place = Window.partitionBy(*keys, "_slice").orderBy(*order)
    inside = place.rowsBetween(Window.unboundedPreceding, 0)
    dealt = steps.withColumn("_slice", time_slice("reading_ts", seconds)).repartition(*keys, "_slice")
    run = dealt.withColumn("_p", F.sum("x").over(inside)).withColumn("_low", F.min("_p").over(inside))
    # (a, b) of each slice, and what the slices before it leave.
    ends = run.groupBy(*keys, "_slice").agg(F.sum("x").alias("_b"), F.min("_p").alias("_least"))
    ends = ends.withColumn("_a", F.col("_b") - F.col("_least"))
    slices = Window.partitionBy(*keys).orderBy("_slice")
    upto, past = slices.rowsBetween(Window.unboundedPreceding, 0), slices.rowsBetween(Window.unboundedPreceding, -1)
    totals = ends.withColumn("_all", F.sum("_b").over(upto))
    rise = F.greatest(F.max(F.col("_a") - F.col("_all")).over(past), F.lit(0).cast("bigint"))
    starts = totals.select(
        *keys, "_slice", F.coalesce(rise + F.sum("_b").over(past), F.lit(0)).cast("bigint").alias("_start")
    )
    after = F.greatest(F.col("_p") - F.col("_low"), F.col("_start") + F.col("_p"))
    summed = run.join(starts, [*keys, "_slice"]).withColumn("after", after)
    before = F.coalesce(F.lag("after").over(place), F.col("_start"))
    return summed.select(*steps.columns, before.alias("before"), "after")


def change_points(
    scored: DataFrame,
    *,
    slack: float = 0.02,
    alarm: float = 0.5,
    order: tuple[str, ...] = ("reading_ts",),
    seconds: int | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Readings at which a machine's score has drifted up (worse) or down (better) by ``alarm`` in sum.

    The reference is the machine's mean score, rounded down to four places; what lies within
    ``slack`` of it does not count. A row is given where the sum reaches the alarm, once each
    time. ``order`` has to be total inside a machine; the slice width is measured unless given.
    """
    kept = list(dict.fromkeys(["machine_id", "reading_ts", *order]))
    points = scored.select(*kept, scaled("risk_score", 4).alias("_v")).filter("_v IS NOT NULL")
    means = points.groupBy("machine_id").agg(F.expr("sum(_v) DIV count(_v)").alias("_mean"))
    seconds = seconds or slice_seconds(points, "machine_id", "reading_ts", slice_rows // 2)
    off, spare = F.col("_v") - F.col("_mean"), round(slack * _UNIT)
    ways = F.array(
        F.struct(F.lit("WORSE").alias("direction"), (off - spare).cast("bigint").alias("x")),
        F.struct(F.lit("BETTER").alias("direction"), (-off - spare).cast("bigint").alias("x")),
    )
    steps = points.join(means, "machine_id").select(*kept, F.inline(ways))
    sums = cumulative_sums(steps, ["machine_id", "direction"], order=order, seconds=seconds)
    bar = round(alarm * _UNIT)
    return sums.filter((F.col("after") >= bar) & (F.col("before") < bar)).select(
        *kept, "direction", (F.col("after").cast("double") / F.lit(float(_UNIT))).alias("drift")
    )
