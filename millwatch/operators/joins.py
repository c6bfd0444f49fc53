"""Joins of a large fact to a dimension keyed uniquely by the join columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.config import BROADCAST_ROWS, HOT_KEY_ROWS
from millwatch.operators.sizing import UNBOUNDED, row_count
from millwatch.session import reliable_checkpoint

# Parts a hot key is dealt into when hot keys are too many to broadcast.
SALTS = 64


def attach(
    fact: DataFrame,
    dim: DataFrame,
    on: str | list[str] = "machine_id",
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_KEY_ROWS,
    hot: DataFrame | None = None,
    dim_rows: int | None = None,
    skewed: bool = True,
) -> DataFrame:
    """Inner join that never sends one heavy key to one task.

    A dimension of counted size up to ``broadcast_rows`` is broadcast. Beyond that,
    keys with more than ``hot_rows`` fact rows (at most |fact| / hot_rows of them)
    are joined by broadcasting just their dimension rows, and the rest is shuffled. If even
    those are too many to broadcast, they are salted.
    ``hot`` gives the heavy keys where the caller knows them already, and
    ``dim_rows`` a bound on the dimension's rows (``UNBOUNDED`` if it grows with the fact).
    ``skewed=False`` says that the fact has few rows per key, so no heavy keys are sought.
    """
    keys = [on] if isinstance(on, str) else on
    if (row_count(dim) if dim_rows is None else dim_rows) <= broadcast_rows:
        return fact.join(F.broadcast(dim), keys)
    if fact.isStreaming or not skewed:
        return fact.join(dim, keys)
    if hot is None:
        # At most |fact| / hot_rows keys, stored so that the fact is aggregated once.
        hot = reliable_checkpoint(
            fact.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys)
        )
    n_hot = row_count(hot)
    if n_hot == 0:
        return fact.join(dim, keys)
    if n_hot > broadcast_rows:
        return _salted(fact, dim, hot, keys)
    heavy_dim = dim.join(F.broadcast(hot), keys, "left_semi")
    heavy = fact.join(F.broadcast(heavy_dim), keys)
    light = fact.join(F.broadcast(hot), keys, "left_anti").join(dim, keys)
    return heavy.unionByName(light)


def _salted(fact: DataFrame, dim: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Join where hot keys are too many to broadcast: their rows are dealt over SALTS tasks
    each, and their dimension rows are copied as often; other keys keep one salt."""
    marked = dim.join(hot.withColumn("_hot", F.lit(True)), keys, "left")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = marked.withColumn("_salt", F.explode(salts)).drop("_hot")
    draw = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(SALTS)).cast("int")
    hot_rows = fact.withColumn("_salt", draw).join(hot, keys, "left_semi")
    cold_rows = fact.join(hot, keys, "left_anti").withColumn("_salt", F.lit(0))
    return hot_rows.unionByName(cold_rows).join(copied, [*keys, "_salt"]).drop("_salt")


def keys_missing(
    fact: DataFrame, dim: DataFrame, on: str = "machine_id", *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Distinct fact keys absent from ``dim``; the fact is reduced to keys before the join."""
    known = dim.select(on)
    if row_count(dim) <= broadcast_rows:
        known = F.broadcast(known)
    return fact.select(on).distinct().join(known, on, "left_anti")


def rows_with_keys(
    fact: DataFrame, keys: DataFrame, on: str = "machine_id", *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Fact rows whose key is in the distinct ``keys``."""
    if row_count(keys) <= broadcast_rows:
        return fact.join(F.broadcast(keys), on, "left_semi")
    return attach(fact, keys, on, broadcast_rows=broadcast_rows, dim_rows=UNBOUNDED)
