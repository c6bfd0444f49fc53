"""Streaming sources, repeat removal, roll-up and exactly-once file sinks.

Watermarks need an instant with a zone, so ``reading_ts`` is cast at this edge only;
the session time zone must be UTC for that cast to keep the clock reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millwatch.operators.history import added_sums, hourly_means, hourly_sums
from millwatch.operators.quality import split_valid
from millwatch.schema import Contract

# How late a reading may arrive and still be matched with its repeats.
DELAY = "2 hours"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, *, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files under ``path`` (a folder or a glob) as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def log_stream(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, **options: str
) -> DataFrame:
    """JSON readings from a log broker; needs Spark's Kafka connector on the class path."""
    return decode_json(raw_log(spark, servers, topic, **options), schema)


def raw_log(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The broker's records as they are, for ``ingest_records``."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )


def decode_json(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Broker records (binary ``value``) to typed readings; those without machine or time are left out.

    ``ingest_records`` keeps what is left out, with the reason.
    """
    parsed = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r"))
    return parsed.select("r.*").filter("machine_id IS NOT NULL AND reading_ts IS NOT NULL")


def sort_records(raw: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Typed readings that keep the contract, and the other records as they came, with their faults.

    Every record is in exactly one of the two. What is not a JSON object has the one fault
    ``value:json``; fields that the contract does not name are ignored.
    """
    fields = [T.StructField(c, T.StringType()) for c in contract.names]
    schema = T.StructType([*fields, T.StructField("_corrupt", T.StringType())])
    text = F.col("value").cast("string")
    read = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    records = raw.withColumn("_read", read)
    unread = F.coalesce(F.col("_read._corrupt").isNotNull(), F.lit(True)) | ~F.coalesce(F.ltrim(text).startswith("{"), F.lit(False))
    broken = records.filter(unread).select("value", F.lit("value:json").alias("faults"))
    good, bad = split_valid(records.filter(~unread).select("value", "_read.*").drop("_corrupt"), contract)
    return good, broken.unionByName(bad.select("value", "faults"))


def ingest_records(
    raw: DataFrame, contract: Contract, path: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Keep what a broker sends: readings in ``accepted``, the rest in ``rejected`` with its faults.

    Both come from the same micro-batch and go to folders of the batch that a retry overwrites,
    so accepted and rejected records add up to those received.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        records = batch.persist()
        try:
            good, bad = sort_records(records, contract)
            good.write.mode("overwrite").parquet(f"{path}/accepted/batch={batch_id}")
            bad.write.mode("overwrite").parquet(f"{path}/rejected/batch={batch_id}")
        finally:
            records.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _with_event_time(stream: DataFrame, delay: str) -> DataFrame:
    return stream.withColumn("_event_time", F.col("reading_ts").cast(T.TimestampType())).withWatermark(
        "_event_time", delay
    )


def drop_repeats_stream(stream: DataFrame, *, delay: str = DELAY) -> DataFrame:
    """Drop sensor pings repeated within the delay, with state bounded by the watermark."""
    marked = _with_event_time(stream, delay)
    return marked.dropDuplicatesWithinWatermark(["machine_id", "reading_ts"]).drop("_event_time")


def rollup_stream(
    stream: DataFrame, path: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Keep hourly sums of a stream: every reading counts when it arrives, late ones included.

    A micro-batch adds one row per machine and hour it touches, in a folder of its own that a
    retry overwrites; ``read_rollup`` adds them up.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        hourly_sums(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The hourly summary of all batches so far, open hours included."""
    return hourly_means(added_sums(spark.read.parquet(path).drop("batch")))


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Append to a Parquet table exactly once; without ``every`` drain what is there and stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start(path)
