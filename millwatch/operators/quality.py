"""Declared rules checked as data: counts of breaches and a quarantine split."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.operators.joins import keys_missing, rows_with_keys
from millwatch.schema import Column as Declared
from millwatch.schema import KNOWN_MODES, Contract


def _long_counts(df: DataFrame, checks: dict[tuple[str, str], Column]) -> DataFrame:
    """(column_name, rule, violations) from one pass over ``df``."""
    counted = df.agg(*[F.count(F.when(c, 1)).alias(f"_{i}") for i, c in enumerate(checks.values())])
    rows = [
        F.struct(F.lit(col).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations"))
        for i, (col, rule) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def null_violations(
    df: DataFrame, contract: Contract, required: list[str] | None = None
) -> DataFrame:
    """NULLs per required column; ``required`` may demand more than the contract does."""
    names = required or [c.name for c in contract.columns if c.required and c.name in df.columns]
    return _long_counts(df, {(name, "required"): F.col(name).isNull() for name in names})


def key_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Natural keys that occur more than once."""
    return df.groupBy(*contract.key).count().filter("count > 1").withColumnRenamed("count", "copies")


def orphan_readings(readings: DataFrame, registry: DataFrame) -> DataFrame:
    """Readings of machines the registry does not know."""
    return rows_with_keys(readings, keys_missing(readings, registry))


def _type_name(c: Declared) -> str:
    return c.type.simpleString()


def _breaches(c: Declared) -> dict[str, Column]:
    """Rules of one column on raw text."""
    raw = F.col(c.name)
    found: dict[str, Column] = {}
    if _type_name(c) != "string":
        found["type"] = raw.isNotNull() & F.expr(f"try_cast({c.name} AS {_type_name(c)}) IS NULL")
    if c.max_length is not None:
        found["length"] = F.length(raw) > c.max_length
    if c.allowed:
        found["value"] = ~raw.isin(*c.allowed)
    return found


def domain_violations(raw: DataFrame, contract: Contract) -> DataFrame:
    """Type, length and value breaches per column of an all-text frame."""
    checks = {
        (c.name, rule): breach
        for c in contract.columns
        if c.name in raw.columns
        for rule, breach in _breaches(c).items()
    }
    return _long_counts(raw, checks)


def unknown_modes(readings: DataFrame) -> DataFrame:
    """Warning, not a fault: how often each mode occurs that is not a known one."""
    mode = F.col("operating_mode")
    return readings.filter(~mode.isin(*KNOWN_MODES)).groupBy("operating_mode").agg(F.count("*").alias("readings"))


def split_valid(
    raw: DataFrame, contract: Contract, *, unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Typed rows that keep the contract, and the raw rest with the names of broken columns.

    ``unique`` also rejects every row whose key occurs more than once: none of them can be
    told to be the right one, and each would double the facts that join it.
    """
    present = [c for c in contract.columns if c.name in raw.columns]
    faults = [
        F.when(breach, F.lit(f"{c.name}:{rule}"))
        for c in present
        for rule, breach in _breaches(c).items()
    ] + [F.when(F.col(c.name).isNull(), F.lit(f"{c.name}:required")) for c in present if c.required]
    if unique:
        # Counted first, so that neither rows without key nor copies of a key meet in one task.
        whole = reduce(and_, [F.col(k).isNotNull() for k in contract.key])
        copies = raw.filter(whole).groupBy(*contract.key).agg(F.count("*").alias("_copies")).filter("_copies > 1")
        raw = raw.join(copies, list(contract.key), "left").select(*raw.columns, "_copies")
        faults.append(F.when(F.col("_copies") > 1, F.lit(f"{contract.key[0]}:repeated")))
    checked = raw.withColumn("faults", F.concat_ws(",", *faults)).drop("_copies")
    typed = checked.filter("faults = ''").select(
        *[F.expr(f"try_cast({c.name} AS {_type_name(c)})").alias(c.name) for c in present]
    )
    return typed, checked.filter("faults <> ''")


def sensor_gaps(readings: DataFrame) -> DataFrame:
    """How often a sensor the rule cannot do without is missing, per machine."""
    lost = F.col("temperature_c").isNull() | F.col("vibration_mm_s").isNull()
    return (
        readings.groupBy("machine_id")
        .agg(F.count("*").alias("readings"), F.count(F.when(lost, 1)).alias("missing_required"))
        .withColumn("missing_rate", F.col("missing_required") / F.col("readings"))
    )
