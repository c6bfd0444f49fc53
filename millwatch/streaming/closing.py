"""Hourly roll-up of a stream that closes hours once and corrects them where readings come late.

Spark's state store holds the running sums of every machine and hour that the watermark has
not left behind (``keep``). An hour is closed when the newest event time lies ``delay`` beyond
its end; then its row is emitted, once. A reading for a closed hour states the hour anew in the
corrections. Each batch writes folders of its own, which a retry overwrites.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millwatch.operators.history import hour_measures, hourly_means
from millwatch.operators.ranking import first_per_key
from millwatch.sources.tables import table_exists

KEYS = ["machine_id", "hour_start"]


@dataclass(frozen=True)
class HourTables:
    """Closed hours, corrections, the open hours and the newest time as each batch left them."""

    base: str

    def at(self, name: str, batch: int) -> str:
        return f"{self.base}/{name}/batch={batch}"

    def _before(self, spark: SparkSession, name: str, batch: int) -> DataFrame | None:
        """What the batch before left; batch numbers have no gaps."""
        path = self.at(name, batch - 1)
        return spark.read.parquet(path) if batch and table_exists(spark, path) else None

    def read(self, spark: SparkSession) -> DataFrame:
        """The hourly summary with ``state``: closed, corrected or open."""
        parts = []
        for rank, (name, state) in enumerate((("closed", "closed"), ("corrections", "corrected"))):
            if table_exists(spark, f"{self.base}/{name}"):
                said = spark.read.parquet(f"{self.base}/{name}")
                parts.append(said.withColumns({"state": F.lit(state), "_rank": F.lit(rank)}))
        batches = spark.read.parquet(f"{self.base}/newest").agg(F.max("batch")).first()[0]
        standing = spark.read.parquet(self.at("open", batches))
        rows = standing.withColumns({"state": F.lit("open"), "_rank": F.lit(0), "batch": F.lit(batches)})
        for part in parts:
            rows = rows.unionByName(part)
        # A correction states its hour whole; of several the last one holds.
        last = first_per_key(rows, KEYS, [F.desc("_rank"), F.desc("batch")])
        means = hourly_means(last)
        return last.select(*KEYS, "state").join(means, KEYS)


def _closed_by(newest: Column, delay: str) -> Column:
    """Whether an hour lies wholly ``delay`` before the newest time; NULL means that nothing was seen."""
    end = F.col("hour_start") + F.expr("INTERVAL 1 HOUR")
    return F.coalesce(end <= newest - F.expr(f"INTERVAL {delay}"), F.lit(False))


def closing_rollup_stream(
    stream: DataFrame,
    tables: HourTables,
    checkpoint: str,
    *,
    delay: str = "2 hours",
    keep: str = "7 days",
    every: str | None = None,
) -> StreamingQuery:
    """Start the roll-up. Readings more than ``keep`` behind the newest one are dropped by the watermark
    (the query's progress counts them); all others end up in exactly one state."""
    marked = stream.withColumn("_event_time", F.col("reading_ts").cast(T.TimestampType())).withWatermark("_event_time", keep)
    hours = marked.groupBy("machine_id", F.window("_event_time", "1 hour").alias("hour")).agg(
        *hour_measures(), F.max("reading_ts").alias("_newest")
    )
    sums = hours.withColumn("hour_start", F.col("hour.start").cast("timestamp_ntz")).drop("hour")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = tables._before(spark, "newest", batch_id)
        seen = before.first()[0] if before is not None else None
        updated = batch.persist()
        try:
            now = updated.agg(F.max("_newest")).first()[0]
            newest = max((t for t in (seen, now) if t is not None), default=None)
            was, becomes = (F.lit(t).cast("timestamp_ntz") for t in (seen, newest))
            rows = updated.drop("_newest")
            late = _closed_by(was, delay)
            rows.filter(late).write.mode("overwrite").parquet(tables.at("corrections", batch_id))
            standing = tables._before(spark, "open", batch_id)
            current = rows.filter(~late)
            if standing is not None:
                current = current.unionByName(standing.join(current.select(*KEYS), KEYS, "left_anti"))
            current.filter(_closed_by(becomes, delay)).write.mode("overwrite").parquet(tables.at("closed", batch_id))
            current.filter(~_closed_by(becomes, delay)).write.mode("overwrite").parquet(tables.at("open", batch_id))
            spark.range(1).select(becomes.alias("newest")).write.mode("overwrite").parquet(tables.at("newest", batch_id))
        finally:
            updated.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = sums.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
