"""Operators over a machine's own past: repeats, gaps, tier changes, trends, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.config import SLICE_ROWS, UNCUT_ROWS
from millwatch.functions.columns import (
    hour_of,
    hours,
    mean_of,
    scaled,
    seconds_between,
    severity,
    time_slice,
)
from millwatch.operators.ranking import first_per_key
from millwatch.operators.sizing import largest_group, slice_seconds

DAY_SECONDS = 86_400


def repeat_order(columns: list[str]) -> list[Column]:
    """Total order of repeats: first loaded, then the most complete, then by every value."""
    sensors = [c for c in ("temperature_c", "vibration_mm_s", "pressure_bar", "power_kw") if c in columns]
    missing = sum((F.col(c).isNull().cast("int") for c in sensors), F.lit(0))
    loaded = [F.asc_nulls_last("load_ts")] if "load_ts" in columns else []
    rest = sorted(c for c in columns if c not in ("machine_id", "reading_ts", "load_ts"))
    rest.sort(key=lambda c: c != "reading_id")
    return [*loaded, missing, *[F.asc_nulls_last(c) for c in rest]]


def drop_repeats(pings: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Keep one ping per (machine_id, reading_ts): the first loaded unless told otherwise."""
    return first_per_key(pings, ["machine_id", "reading_ts"], order or repeat_order(pings.columns))


def carry_last(
    df: DataFrame,
    items: dict[str, Column],
    *,
    order: list[str],
    key: str = "machine_id",
    ts: str = "reading_ts",
    inclusive: bool = False,
    backwards: bool = False,
    seconds: int | None = None,
    slice_rows: int = SLICE_ROWS,
    most: int | None = None,
) -> DataFrame:
    """Add, per item, its last non-NULL value among earlier rows of the same key.

    ``order`` is the order inside a key and starts with ``ts``. ``inclusive`` also looks at
    the row itself and rows that tie with it; ``backwards`` looks at later rows instead.
    A key is cut into time slices; each slice starts with the value the slices before it
    end with, so no task needs a whole history. The slice width is measured unless given;
    keys that all have few rows are not cut at all. ``most`` is a bound on the rows of a
    key, where the caller knows one.
    """
    direction = F.desc if backwards else F.asc

    def along(*parts: str) -> Window:
        window = Window.partitionBy(*parts).orderBy(*[direction(c) for c in order])
        if inclusive:
            return window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return window.rowsBetween(Window.unboundedPreceding, -1)

    if seconds is None:
        few = min(slice_rows, UNCUT_ROWS)
        if (largest_group(df, key) if most is None else most) <= few:
            window = along(key)
            carried = [F.last(item, ignorenulls=True).over(window).alias(name) for name, item in items.items()]
            return df.select(*df.columns, *carried)
        seconds = slice_seconds(df, key, ts, slice_rows)
    slots = [f"_slot{n}" for n in range(len(items))]
    # Dealt out once: the slices' ends and the rows themselves are taken from the same shuffle.
    dealt = df.withColumn("_slice", time_slice(ts, seconds)).repartition(key, "_slice")

    # One row per (key, slice): the value each slice ends with, then what its follower starts with.
    newest = F.min if backwards else F.max
    place = F.struct(*order)
    ends = dealt.groupBy(F.col(key), "_slice").agg(
        *[
            newest(F.when(item.isNotNull(), F.struct(place.alias("at"), item.alias("v"))))
            .getField("v")
            .alias(slot)
            for slot, item in zip(slots, items.values())
        ]
    )
    starts = _slice_starts(
        ends.select(F.col(key).alias("_key"), F.col("_slice"), *slots), slots, seconds, backwards
    ).withColumnRenamed("_key", key)

    window = along(key, "_slice")
    return dealt.join(starts, [key, "_slice"], "left").select(
        *df.columns,
        *[
            F.coalesce(F.last(item, ignorenulls=True).over(window), F.col(slot)).alias(name)
            for slot, (name, item) in zip(slots, items.items())
        ],
    )


def _slice_starts(ends: DataFrame, slots: list[str], seconds: int, backwards: bool) -> DataFrame:
    """Per (key, slice) the last value any slice before it ended with.

    Slices shorter than a day are grouped by day first, so a task sees one row per day of
    a key, or one per slice of a day, whatever the length of the history.
    """
    direction, newest = (F.desc, F.min) if backwards else (F.asc, F.max)

    def before(window: Window) -> list[Column]:
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        return [F.last(s, ignorenulls=True).over(window).alias(s) for s in slots]

    per_day = DAY_SECONDS // seconds
    if per_day <= 1:
        window = Window.partitionBy("_key").orderBy(direction("_slice"))
        return ends.select("_key", "_slice", *before(window))
    slices = ends.withColumn("_day", F.expr(f"_slice DIV {per_day}"))
    days = slices.groupBy("_key", "_day").agg(
        *[
            newest(F.when(F.col(s).isNotNull(), F.struct("_slice", F.col(s).alias("v"))))
            .getField("v")
            .alias(s)
            for s in slots
        ]
    )
    window = Window.partitionBy("_key").orderBy(direction("_day"))
    day_starts = days.select("_key", "_day", F.lit(0).alias("_kind"), *before(window))
    window = Window.partitionBy("_key", "_day").orderBy("_kind", direction("_slice"))
    return (
        slices.withColumn("_kind", F.lit(1))
        .unionByName(day_starts, allowMissingColumns=True)
        .select("_key", "_slice", "_kind", *before(window))
        .filter("_kind = 1")
        .drop("_kind")
    )


def fill_gaps(
    readings: DataFrame,
    columns: list[str],
    *,
    max_hours: float = 6,
    order: tuple[str, ...] = ("reading_ts",),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Fill a missing sensor with its last known value when that is at most ``max_hours`` old."""
    known = {
        f"_last_{c}": F.when(
            F.col(c).isNotNull(), F.struct(F.col("reading_ts").alias("at"), F.col(c).alias("v"))
        )
        for c in columns
    }
    carried = carry_last(
        readings, known, order=list(order), inclusive=True, slice_rows=slice_rows
    )
    oldest = F.col("reading_ts") - hours(max_hours)
    filled = {
        c: F.coalesce(
            F.col(c), F.when(F.col(f"_last_{c}.at") >= oldest, F.col(f"_last_{c}.v"))
        )
        for c in columns
    }
    return carried.select(
        *[filled[c].alias(c) if c in filled else F.col(c) for c in readings.columns],
        *[
            (F.col(c).isNull() & filled[c].isNotNull()).alias(f"{c}_filled")
            for c in columns
        ],
    )


def tier_changes(
    scored: DataFrame,
    *,
    order: tuple[str, ...] = ("reading_ts",),
    slice_rows: int = SLICE_ROWS,
    most: int | None = None,
) -> DataFrame:
    """Readings whose stored tier differs from the machine's reading before.

    ``escalated`` is NULL when either side is DATA_LOSS, which has no severity. ``most`` is a
    bound on a machine's rows, where the caller knows one.
    """
    previous = F.struct(
        F.col("risk_tier").alias("tier"),
        F.col("reading_ts").alias("at"),
        F.col("risk_score").alias("score"),
    )
    rows = scored.select(
        "machine_id", *dict.fromkeys([*order, "reading_ts", "risk_score", "risk_tier"])
    )
    carried = carry_last(rows, {"_before": previous}, order=list(order), slice_rows=slice_rows, most=most)
    return (
        carried.withColumn("previous_tier", F.col("_before.tier"))
        .filter("previous_tier <> risk_tier")
        .select(
            "machine_id",
            "reading_ts",
            F.col("_before.at").alias("previous_ts"),
            "previous_tier",
            "risk_tier",
            F.col("_before.score").alias("previous_score"),
            "risk_score",
            (severity("risk_tier") > severity("previous_tier")).alias("escalated"),
        )
    )


def revised_changes(
    scored: DataFrame, *, order: tuple[str, ...] = ("reading_ts",), slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The state of alert of each late reading (``_late``) and of the reading after it.

    As ``tier_changes``, with ``revision`` set and ``withdrawn`` where the tier does not differ.
    """
    previous = F.struct(
        F.col("risk_tier").alias("tier"),
        F.col("reading_ts").alias("at"),
        F.col("risk_score").alias("score"),
        F.col("_late").alias("late"),
    )
    rows = scored.select("machine_id", *dict.fromkeys([*order, "reading_ts", "risk_score", "risk_tier", "_late"]))
    carried = carry_last(rows, {"_before": previous}, order=list(order), slice_rows=slice_rows)
    tier, before = F.col("risk_tier"), F.col("_before.tier")
    return carried.filter(F.col("_late") | F.coalesce("_before.late", F.lit(False))).select(
        "machine_id",
        "reading_ts",
        F.col("_before.at").alias("previous_ts"),
        before.alias("previous_tier"),
        "risk_tier",
        F.col("_before.score").alias("previous_score"),
        "risk_score",
        (severity("risk_tier") > severity("_before.tier")).alias("escalated"),
        F.coalesce(tier == before, F.lit(True)).alias("withdrawn"),
        F.lit(True).alias("revision"),
    )


def risk_slope(scored: DataFrame, as_of: Column, *, within_hours: int = 168) -> DataFrame:
    """Least-squares slope of the score per day over each machine's last hours.

    The sums are exact integers, so the result does not depend on how rows are split.
    """
    recent = scored.filter(
        (F.col("reading_ts") >= as_of - hours(within_hours)) & (F.col("reading_ts") <= as_of)
    )
    points = recent.withColumn("_as_of", as_of).select(
        "machine_id",
        F.floor(seconds_between("_as_of", "reading_ts")).cast("decimal(12,0)").alias("x"),
        scaled("risk_score", 4).cast("decimal(6,0)").alias("y"),
    )
    whole = "decimal(38,0)"
    sums = points.groupBy("machine_id").agg(
        F.count("*").alias("n"),
        F.sum("x").cast(whole).alias("sx"),
        F.sum("y").cast(whole).alias("sy"),
        F.sum(F.col("x") * F.col("y")).cast(whole).alias("sxy"),
        F.sum(F.col("x") * F.col("x")).cast(whole).alias("sxx"),
    )
    top = (F.col("n") * F.col("sxy")).cast(whole) - (F.col("sx") * F.col("sy")).cast(whole)
    bottom = (F.col("n") * F.col("sxx")).cast(whole) - (F.col("sx") * F.col("sx")).cast(whole)
    per_day = F.try_divide(top.cast("double"), bottom.cast("double")) * F.lit(86_400 / 10_000)
    return sums.select(
        "machine_id",
        F.col("n").alias("readings"),
        per_day.alias("slope_per_day"),
    )


def hour_measures() -> list[Column]:
    """Exact sums, counts and maxima of readings, which add up over batches."""
    return [
        F.count("*").alias("readings"),
        F.sum(scaled("temperature_c", 2)).alias("_t"),
        F.count("temperature_c").alias("_tn"),
        F.max("temperature_c").alias("max_temperature_c"),
        F.sum(scaled("vibration_mm_s", 3)).alias("_v"),
        F.count("vibration_mm_s").alias("_vn"),
        F.max("vibration_mm_s").alias("max_vibration_mm_s"),
        F.count(F.when(F.trim("error_code") != "", 1)).alias("errors"),
    ]


def hourly_sums(readings: DataFrame) -> DataFrame:
    """The measures per machine and hour."""
    return readings.groupBy("machine_id", hour_of("reading_ts").alias("hour_start")).agg(*hour_measures())


def added_sums(parts: DataFrame) -> DataFrame:
    """Hourly sums of several batches as one row per machine and hour."""
    most = ("max_temperature_c", "max_vibration_mm_s")
    added = [c for c in parts.columns if c not in ("machine_id", "hour_start", *most)]
    return parts.groupBy("machine_id", "hour_start").agg(
        *[F.sum(c).alias(c) for c in added], *[F.max(c).alias(c) for c in most]
    )


def hourly_means(sums: DataFrame) -> DataFrame:
    return sums.select(
        "machine_id",
        "hour_start",
        "readings",
        mean_of(F.col("_t"), F.col("_tn"), 2).alias("avg_temperature_c"),
        "max_temperature_c",
        mean_of(F.col("_v"), F.col("_vn"), 3).alias("avg_vibration_mm_s"),
        "max_vibration_mm_s",
        "errors",
    )


def hourly_rollup(readings: DataFrame) -> DataFrame:
    """Tumbling hourly summary; partial sums are formed before the shuffle."""
    return hourly_means(hourly_sums(readings))


def retained(readings: DataFrame, as_of: Column, *, days: int) -> DataFrame:
    """Readings young enough to keep."""
    return readings.filter(F.col("reading_ts") >= as_of - hours(24 * days))
