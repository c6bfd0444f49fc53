"""Anomaly scores from a forest of half-space trees over all readings, in native expressions.

Each tree halves two sensors' fixed ranges a few times, after a shift of its own, so a
reading's leaf follows from integer arithmetic alone. A leaf's mass is the count of all
readings in it; readings that share their leaves with few others are unusual. Nothing is
sampled, no row is left out, and what is broadcast is bounded by trees and depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A sensor's deviation is a whole number from 0 to SPAN - 1; its baseline is in the middle.
SPAN = 8192
SENSORS = 4


def positions() -> list[Column]:
    """Deviation of temperature (0.01 units), vibration (0.001 units), pressure and power (share
    of the baseline) as whole numbers in the fixed range; NULL where a value is missing."""

    def apart(value: str, baseline: str, scale: int) -> str:
        return f"CAST(({value} - {baseline}) * {scale} AS BIGINT) + {SPAN // 2}"

    def share(value: str, baseline: str) -> str:
        return (
            f"CAST({value} * 100 AS BIGINT) * {SPAN // 2} DIV nullif(CAST({baseline} * 100 AS BIGINT), 0)"
        )

    raw = [
        apart("temperature_c", "baseline_temp_c", 100),
        apart("vibration_mm_s", "baseline_vibration", 1000),
        share("pressure_bar", "baseline_pressure_bar"),
        share("power_kw", "baseline_power_kw"),
    ]
    # greatest and least skip NULLs, so a missing value has to be let through by name.
    return [F.expr(f"CASE WHEN ({r}) IS NOT NULL THEN greatest(0, least({SPAN - 1}, {r})) END") for r in raw]


def tree_shape(tree: int, depth: int) -> tuple[int, int, int, int, int, int]:
    """(first sensor, second sensor, halvings of each, shift of each) of a tree."""
    first = tree % SENSORS
    second = (first + 1 + tree // SENSORS % (SENSORS - 1)) % SENSORS
    halvings = depth // 2 - 1 + tree % 3
    shifts = [(tree * 7919 + k * 104729 + 12345) % SPAN for k in (1, 2)]
    return first, second, halvings, depth - halvings, *shifts


def leaves(trees: int, depth: int) -> Column:
    """The leaf of each tree, numbered over the whole forest; NULL if the tree asks a missing sensor."""

    def half_space(sensor: int, halvings: int, shift: int) -> str:
        return f"(_at{sensor} + {shift}) * {1 << halvings} DIV {2 * SPAN}"

    found = []
    for tree in range(trees):
        first, second, k1, k2, s1, s2 = tree_shape(tree, depth)
        inside = f"({half_space(first, k1, s1)}) * {1 << k2} + {half_space(second, k2, s2)}"
        found.append(F.expr(f"CAST({tree << depth} + {inside} AS INT)"))
    return F.array(*found)


def bit_length(count: str) -> Column:
    return F.length(F.bin(F.col(count).cast("bigint")))


def anomaly_scores(feature_rows: DataFrame, *, trees: int = 36, depth: int = 6) -> DataFrame:
    """``anomaly_score`` of every reading, from 0 (like all others) towards 1 (alone in each leaf).

    Deviations from the baselines make machines comparable, so one forest serves the
    fleet. A reading is judged by the trees whose sensors it has; with fewer than two
    sensors no tree fits and the score is NULL. The score is one minus the mean bit
    length of the leaf masses, as a share of the bit length of the number of readings.
    """
    key = [c for c in ("reading_id", "machine_id", "reading_ts") if c in feature_rows.columns]
    at = [f"_at{n}" for n in range(SENSORS)]
    placed = feature_rows.select(*key, *[p.alias(n) for n, p in zip(at, positions())])
    rows = placed.select(*key, F.filter(leaves(trees, depth), lambda x: x.isNotNull()).alias("_leaves"))

    # At most trees * 2**depth groups, summed where the rows are before they are sent.
    masses = rows.select(F.explode("_leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n"))
    every = feature_rows.sparkSession.range(trees << depth).select(F.col("id").cast("int").alias("leaf"))
    ordered = F.array_sort(F.collect_list(F.struct("leaf", F.coalesce(bit_length("n"), F.lit(0)).alias("bits"))))
    table = every.join(masses, "leaf", "left").agg(F.transform(ordered, lambda s: s["bits"]).alias("bits"))
    most = placed.agg(F.count("*").alias("n")).select(bit_length("n"))
    total = F.aggregate("_leaves", F.lit(0), lambda acc, leaf: acc + F.get(F.col("_bits"), leaf))
    return rows.withColumn("_bits", table.scalar()).select(
        *key,
        (F.lit(1.0) - F.try_divide(total.cast("double"), F.size("_leaves") * most.scalar())).alias("anomaly_score"),
    )
