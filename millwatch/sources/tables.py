"""Columnar tables: date-partitioned facts, idempotent overwrite, appends of new keys."""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millwatch.operators.ranking import first_per_key
from millwatch.schema import Contract

DATE = "reading_date"


def by_date(df: DataFrame) -> DataFrame:
    """Add the partition column and lay rows out for writing.

    The rebalance hint lets adaptive execution split a heavy date over many files and merge
    light ones; files are sorted so that their statistics prune on machine and time.
    """
    dated = df.withColumn(DATE, F.to_date("reading_ts"))
    return dated.hint("rebalance", DATE).sortWithinPartitions(DATE, "machine_id", "reading_ts")


def observed(metrics: Observation, name: str):
    """What was observed on the way; None where adaptive execution found no rows and dropped the node."""
    try:
        return metrics.get[name]
    except Py4JJavaError:
        return None


def _counted_write(df: DataFrame, path: str, mode: str, **options: str) -> int:
    """Write by date and return the rows written, counted on the way."""
    rows = Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    by_date(counted).write.mode(mode).options(**options).partitionBy(DATE).parquet(path)
    return observed(rows, "rows") or 0


def write_fact(df: DataFrame, path: str) -> int:
    """Replace the whole table; running it twice gives the same table."""
    return _counted_write(df, path, "overwrite")


def replace_dates(df: DataFrame, path: str) -> int:
    """Replace only the dates present in ``df``."""
    return _counted_write(df, path, "overwrite", partitionOverwriteMode="dynamic")


def stored_rows(df: DataFrame, path: str) -> DataFrame | None:
    """Rows the table holds on the dates of ``df``, with its columns; None where there is no table or date.

    At most one entry per calendar day is listed; a late reading adds its day, not the days between.
    """
    spark = df.sparkSession
    if not table_exists(spark, path):
        return None
    dated = df.withColumn(DATE, F.to_date("reading_ts"))
    dates = [r[0] for r in dated.select(DATE).distinct().collect()]
    if not dates:
        return None
    return spark.read.schema(dated.schema).parquet(path).filter(F.col(DATE).isin(dates))


def append_new(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = ("machine_id", "reading_ts"),
    *,
    matched: bool = False,
) -> int:
    """Append rows whose key the table does not hold yet; returns how many.

    Of rows of one call that share a key one is appended, the same whichever way the rows
    are cut or ordered. A retry finds the rows already there and adds none. ``matched`` says
    that the caller knows the table to hold none of the keys, so that it is not read again.
    """
    rest = [F.asc_nulls_last(c) for c in df.columns if c not in keys]
    rows = first_per_key(df, list(keys), rest) if rest else df.distinct()
    stored = None if matched else stored_rows(df, path)
    if stored is not None:
        rows = rows.join(stored.select(*keys), list(keys), "left_anti")
    return _counted_write(rows, path, "append")


def create_empty(spark: SparkSession, contract: Contract, path: str) -> None:
    """Drop and recreate a declared table without rows; facts are laid out by date."""
    empty = spark.createDataFrame([], contract.struct())
    if "reading_ts" in contract.names:
        by_date(empty).write.mode("overwrite").partitionBy(DATE).parquet(path)
    else:
        empty.write.mode("overwrite").parquet(path)


def read_fact(spark: SparkSession, path: str, contract: Contract | None = None) -> DataFrame:
    """A stored fact; with its contract also while it holds no rows yet."""
    if contract is None:
        return spark.read.parquet(path)
    return spark.read.schema(contract.struct().add(DATE, "date")).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def write_dimension(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def since_date(df: DataFrame, bound) -> DataFrame:
    """Time filter that also names the partition column where the table has one."""
    kept = df.filter(F.col("reading_ts") >= bound)
    return kept.filter(F.col(DATE) >= F.to_date(bound)) if DATE in df.columns else kept


def drop_old_dates(spark: SparkSession, path: str, as_of, *, days: int) -> int:
    """Retention: remove the date folders that are older than ``days``; no file is rewritten.

    Returns how many dates were removed. A table that is not laid out by date is refused.
    """
    oldest = dt.datetime.fromisoformat(str(as_of)).date() - dt.timedelta(days=days)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {s.getPath().getName(): s.getPath() for s in fs.listStatus(folder) if s.isDirectory()}
    dates = {n.removeprefix(f"{DATE}="): at for n, at in found.items() if n.startswith(f"{DATE}=")}
    if len(dates) < len([n for n in found if not n.startswith(("_", "."))]) or not dates:
        raise ValueError(f"{path} is not partitioned by {DATE}")
    old = [at for day, at in dates.items() if day != "__HIVE_DEFAULT_PARTITION__" and dt.date.fromisoformat(day) < oldest]
    for at in old:
        fs.delete(at, True)
    return len(old)
