"""Measured sizes that planning decisions rest on."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.config import SLICE_ROWS
from millwatch.functions.columns import time_slice

_counts: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()

# Row bound of a frame that grows with the facts.
UNBOUNDED = 1 << 62

# Slice widths to try, widest first.
SLICE_SECONDS = (86_400, 3_600, 60, 1)


def row_count(df: DataFrame) -> int:
    """Rows of ``df``, counted once per frame. Only map-side counts are shuffled."""
    if df not in _counts:
        _counts[df] = df.count()
    return _counts[df]


def largest_group(df: DataFrame, key: str) -> int:
    """Most rows that share a key (a pre-aggregated scan of one column)."""
    return df.groupBy(key).count().agg(F.max("count")).first()[0] or 0


def largest_slice(df: DataFrame, key: str, ts: str, seconds: int) -> int:
    """Most rows that share a key and a time slice (a pre-aggregated scan of two columns)."""
    sizes = df.groupBy(key, time_slice(ts, seconds).alias("_slice")).count()
    return sizes.agg(F.max("count")).first()[0] or 0


def slice_seconds(df: DataFrame, key: str, ts: str, limit: int = SLICE_ROWS) -> int:
    """The widest slice whose largest group one window task can hold."""
    for seconds in SLICE_SECONDS[:-1]:
        if largest_slice(df, key, ts, seconds) <= limit:
            return seconds
    return SLICE_SECONDS[-1]
