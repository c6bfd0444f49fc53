"""Trailing means kept live: per machine a ring of exact sums per instant, expired by event time.

Every reading gets its mean when it arrives. A reading that arrives late, but within the
delay, also revises the readings after it whose windows it belongs to. Sums are integers, so
the last word on a reading equals the batch result exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millwatch.functions.columns import mean_of, scaled
from millwatch.operators.ranking import first_per_key

HOUR = 3_600_000_000
_SUMS = "t_sum bigint, t_n bigint, v_sum bigint, v_n bigint"
_OUT = f"machine_id string, at bigint, {_SUMS}, too_late boolean"


def _by_instant(at: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row per instant, ascending, with added sums."""
    order = np.argsort(at, kind="stable")
    at, sums = at[order], sums[order]
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return at[starts], np.add.reduceat(sums, starts, axis=0)


def step(
    ring: np.ndarray, newest: int | None, fresh: np.ndarray, window: int, delay: int
) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """One batch of one machine: (ring, newest, said, too late).

    Rows are (instant, four sums). What is said are the trailing sums of all instants that
    are new or whose window holds something new. An instant more than ``delay`` before the
    newest one of the batches before is too late: its window is no longer held.
    """
    at, sums = _by_instant(fresh[:, 0], fresh[:, 1:])
    bound = at[0] if newest is None else newest - delay
    held_from = at[0] if newest is None else newest - delay - window
    late = at[at < bound]
    kept = at >= held_from
    at, sums = at[kept], sums[kept]
    if len(ring):
        whole_at, whole = _by_instant(np.append(ring[:, 0], at), np.concatenate([ring[:, 1:], sums]))
    else:
        whole_at, whole = at, sums
    if not len(whole_at):
        return ring, newest, np.empty((0, 5), np.int64), late
    first = np.searchsorted(whole_at, whole_at - window)
    running = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(whole, axis=0)])
    trailing = running[1:] - running[first]
    news = np.append(0, np.cumsum(np.isin(whole_at, at)))
    touched = news[1:] > news[first]
    # Instants between the ring's start and the bound are revised by a recompute, like late ones.
    late = np.union1d(late, whole_at[touched & (whole_at < bound)])
    said = touched & (whole_at >= bound)
    newest = int(max(whole_at[-1], newest if newest is not None else whole_at[-1]))
    rest = whole_at >= newest - delay - window
    return (
        np.column_stack([whole_at[rest], whole[rest]]), newest,
        np.column_stack([whole_at[said], trailing[said]]), late,
    )


def _keeper(window: int, delay: int):
    def keep(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        newest, ring = None, np.empty((0, 5), np.int64)
        if state.exists:
            newest, held = state.get
            ring = np.frombuffer(held, np.int64).reshape(-1, 5)
        fresh = np.concatenate([f[["at", "t_sum", "t_n", "v_sum", "v_n"]].to_numpy(np.int64) for f in frames])
        ring, newest, said, late = step(ring, newest, fresh, window, delay)
        state.update((newest, ring.astype(np.int64).tobytes()))
        # Both are in milliseconds; the watermark lags by the same span.
        state.setTimeoutTimestamp(max((newest + window + delay) // 1000, state.getCurrentWatermarkMs() + 1))
        out = pd.DataFrame(said, columns=["at", "t_sum", "t_n", "v_sum", "v_n"])
        gone = pd.DataFrame({"at": late, **{c: 0 for c in ("t_sum", "t_n", "v_sum", "v_n")}})
        out["too_late"], gone["too_late"] = False, True
        both = pd.concat([out, gone], ignore_index=True)
        both.insert(0, "machine_id", key[0])
        if len(both):
            yield both

    return keep


def rolling_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    window_hours: int = 24,
    delay_hours: int = 6,
    every: str | None = None,
) -> StreamingQuery:
    """Write what each micro-batch says about trailing means, in a folder that a retry overwrites.

    Readings of one instant are summed before they are shuffled, so a task's input and state
    hold instants, not readings. The state of a machine spans the window and the delay, and goes
    when the watermark has left it behind. Readings without machine or time are not used.
    """
    window, delay = window_hours * HOUR, delay_hours * HOUR
    timed = stream.filter("machine_id IS NOT NULL AND reading_ts IS NOT NULL").select(
        "machine_id",
        F.col("reading_ts").cast(T.TimestampType()).alias("_event_time"),
        F.coalesce(scaled("temperature_c", 2), F.lit(0)).alias("t_sum"),
        F.col("temperature_c").isNotNull().cast("bigint").alias("t_n"),
        F.coalesce(scaled("vibration_mm_s", 3), F.lit(0)).alias("v_sum"),
        F.col("vibration_mm_s").isNotNull().cast("bigint").alias("v_n"),
    )
    marked = timed.withWatermark("_event_time", f"{window_hours + delay_hours} hours").withColumn(
        "at", F.unix_micros("_event_time")
    )
    said = marked.groupBy("machine_id").applyInPandasWithState(
        _keeper(window, delay), _OUT, "newest bigint, ring binary", "update", GroupStateTimeout.EventTimeTimeout
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = said.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_rolling(spark: SparkSession, path: str) -> DataFrame:
    """The last word on each machine and instant: both means, and whether a recompute is due.

    Where ``too_late`` is set the means are NULL; ``incremental.refresh_features`` restates such dates.
    """
    log = spark.read.parquet(path)
    last = first_per_key(log, ["machine_id", "at"], [F.desc("batch"), F.desc("too_late")])
    due = F.col("too_late")
    return last.select(
        "machine_id",
        F.timestamp_micros("at").cast("timestamp_ntz").alias("reading_ts"),
        F.when(~due, mean_of(F.col("t_sum"), F.col("t_n"), 2)).alias("rolling_avg_temp_24h"),
        F.when(~due, mean_of(F.col("v_sum"), F.col("v_n"), 3)).alias("rolling_avg_vibration_24h"),
        "too_late",
    )
