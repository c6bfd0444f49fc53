"""Delimited text in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.operators.quality import split_valid
from millwatch.schema import REGISTRY, TELEMETRY, Contract


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV as text columns; empty fields are NULL, a byte-order mark is dropped.

    Columns are bound by header name. A declared schema would bind them by position
    and turn reordered files into NULLs without an error. A missing path raises.
    """
    raw = (
        spark.read.option("header", True)
        .option("sep", ",")
        .option("nullValue", "")
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])


def with_defaults(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared columns in declared order; absent ones take their defaults or NULL."""
    filled = df
    for column in contract.columns:
        if column.name not in df.columns:
            filled = filled.withColumn(column.name, F.lit(None).cast(column.type))
    if "criticality_class" in contract.names:
        filled = filled.withColumn(
            "criticality_class", F.coalesce("criticality_class", F.lit("STANDARD"))
        )
    if "load_ts" in contract.names:
        filled = filled.withColumn("load_ts", F.coalesce("load_ts", F.current_timestamp()))
    return filled.select(*contract.names)


def load_csv(
    spark: SparkSession, path: str, contract: Contract, *, unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(typed rows with defaults, quarantined raw rows with their faults).

    Header names match without regard to case, so upper-cased exports load as well.
    """
    raw = read_raw(spark, path)
    declared = {name.lower(): name for name in contract.names}
    raw = raw.toDF(*[declared.get(c.lower(), c) for c in raw.columns])
    known = raw.select(*[c for c in contract.names if c in raw.columns])
    missing = [c.name for c in contract.columns if c.required and c.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: required columns not in the header: {', '.join(missing)}")
    typed, quarantined = split_valid(known, contract, unique=unique)
    return with_defaults(typed, contract), quarantined


def load_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A machine listed twice is quarantined, since it would double its readings."""
    return load_csv(spark, path, REGISTRY, unique=True)


def load_telemetry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return load_csv(spark, path, TELEMETRY)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
