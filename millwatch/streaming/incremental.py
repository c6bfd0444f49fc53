"""Incremental upkeep of scores, latest states, tier alerts and trailing means."""

from __future__ import annotations

import datetime as dt
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwatch.config import BROADCAST_ROWS, DEFAULT_RULE, RiskRule
from millwatch.functions.columns import hours
from millwatch.operators.history import drop_repeats, revised_changes, tier_changes
from millwatch.operators.ranking import first_per_key
from millwatch.operators.sizing import row_count
from millwatch.plans.features import features
from millwatch.plans.scoring import score_readings, stamped
from millwatch.plans.summary import latest_scores, merge_latest
from millwatch.sources.tables import DATE, append_new, observed, replace_dates, stored_rows, table_exists


def score_new(
    telemetry: DataFrame, registry: DataFrame, scored_path: str, rule: RiskRule = DEFAULT_RULE
) -> int:
    """Score readings and append those the scored table lacks; safe to repeat."""
    return append_new(stamped(score_readings(telemetry, registry, rule)), scored_path)


def affected_dates(fresh: DataFrame, *, window_hours: int = 24) -> DataFrame:
    """Dates whose trailing means change when ``fresh`` readings arrive, late ones included."""
    touched = F.sequence(
        F.to_date("reading_ts"), F.to_date(F.col("reading_ts") + hours(window_hours))
    )
    return fresh.select(F.explode(touched).alias("reading_date")).distinct()


def on_dates(rows: DataFrame, dates: set[dt.date]) -> DataFrame:
    """Rows of some dates; prunes partitions where the table has the date column."""
    day = F.col(DATE) if DATE in rows.columns else F.to_date("reading_ts")
    return rows.filter(day.isin(sorted(dates)))


def refresh_features(
    telemetry: DataFrame, registry: DataFrame, fresh: DataFrame, features_path: str
) -> int:
    """Recompute the feature dates touched by ``fresh`` from the telemetry and replace them.

    ``telemetry`` holds ``fresh`` already. Only the touched dates and the day before each are
    read, so a reading that is a year late costs four dates, not a year.
    """
    dates = [r[0] for r in affected_dates(fresh).collect()]  # a handful of calendar dates
    if not dates:
        return 0
    needed = on_dates(telemetry, {d - dt.timedelta(days=n) for d in dates for n in (0, 1)})
    rows = features(needed, registry).filter(F.to_date("reading_ts").isin(dates))
    return replace_dates(rows, features_path)


# Buckets of the latest-state table; a batch rewrites those of its machines only.
LATEST_BUCKETS = 64


@dataclass(frozen=True)
class LiveTables:
    """Where one live run keeps its tables.

    The latest states are hashed into buckets by machine. A batch writes the buckets it
    touches into a folder of its own; the state of a bucket is its newest version in a
    complete folder. So a batch costs what it touches, not the fleet, and a retry finds the
    versions before it untouched.
    """

    base: str
    buckets: int = LATEST_BUCKETS

    @property
    def scored(self) -> str:
        return f"{self.base}/scored"

    @property
    def seen(self) -> str:
        """Log of all accepted readings, scored or not, by date."""
        return f"{self.base}/seen"

    def latest(self, batch: int) -> str:
        return f"{self.base}/latest/batch={batch}"

    def alerts(self, batch: int) -> str:
        return f"{self.base}/alerts/batch={batch}"

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/checkpoint"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("machine_id"), F.lit(self.buckets)).cast("int")

    def versions(self, spark: SparkSession) -> dict[int, list[int]]:
        """Per bucket the batches that wrote it and are complete, oldest first; at most a few are kept."""
        found: dict[int, list[int]] = {}
        for batch in sorted(int(name) for name in _entries(spark, f"{self.base}/latest", "batch=")):
            if table_exists(spark, f"{self.latest(batch)}/_SUCCESS"):
                for name in _entries(spark, self.latest(batch), "bucket="):
                    found.setdefault(int(name), []).append(batch)
        return found

    def read_latest(
        self, spark: SparkSession, before: int = 1 << 62, buckets: set[int] | None = None
    ) -> DataFrame | None:
        """The latest-per-machine states as batches below ``before`` left them, all buckets or some."""
        paths = []
        for bucket, batches in sorted(self.versions(spark).items()):
            older = [b for b in batches if b < before]
            if older and (buckets is None or bucket in buckets):
                paths.append(f"{self.latest(older[-1])}/bucket={bucket}")
        return spark.read.parquet(*paths) if paths else None

    def write_latest(self, spark: SparkSession, states: DataFrame, batch_id: int) -> None:
        """Write the given buckets whole and remove versions that no retry of this batch needs."""
        placed = states.withColumn("bucket", self.bucket()).repartition(self.buckets, "bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(self.latest(batch_id))
        needed: dict[int, list[int]] = {}
        old: dict[int, list[int]] = {}
        for bucket, batches in self.versions(spark).items():
            older = [b for b in batches if b < batch_id]
            for batch in older:
                (needed if batch == older[-1] else old).setdefault(batch, []).append(bucket)
        for batch in sorted(int(name) for name in _entries(spark, f"{self.base}/latest", "batch=")):
            if batch in needed:
                for bucket in old.get(batch, []):
                    _remove(spark, f"{self.latest(batch)}/bucket={bucket}")
            elif batch < batch_id and (batch in old or not _entries(spark, self.latest(batch), "bucket=")):
                _remove(spark, self.latest(batch))

    def read_alert_log(self, spark: SparkSession) -> DataFrame:
        """Every alert and revision as it was raised."""
        return spark.read.parquet(f"{self.base}/alerts")

    def read_alerts(self, spark: SparkSession) -> DataFrame:
        """Alerts that stand: the last word on each reading, without withdrawn ones."""
        log = self.read_alert_log(spark)
        last = first_per_key(log, ["machine_id", "reading_ts"], [F.desc("batch"), F.desc("revision")])
        return last.filter("NOT withdrawn").drop("withdrawn", "revision")


def _entries(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names below a folder that start with ``prefix``, without it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _keep(kept: ExitStack, df: DataFrame) -> DataFrame:
    """``df``, computed once for all that is derived from it until ``kept`` closes."""
    kept.callback(df.unpersist)
    return df.persist()


def accept(batch: DataFrame, batch_id: int, seen_path: str, kept: ExitStack) -> tuple[DataFrame, bool]:
    """Readings of a batch that no other batch brought before, logged as seen; and whether this
    batch may have logged some of them already.

    Repeats inside the batch leave the most complete reading. The log holds every accepted
    reading, also those that are never scored, with its batch, by which a retry knows its own.
    Readings are matched with the log once: what it lacks is logged, and that or what it has
    from this batch is accepted.
    """
    key = ["machine_id", "reading_ts"]
    own = F.lit(batch_id).cast("bigint").alias("batch_id")
    readings = _keep(kept, drop_repeats(batch))
    held = stored_rows(readings.select(*key, own), seen_path)
    if held is None:
        append_new(readings.select(*key, own), seen_path, matched=True)
        return readings, False
    by = held.groupBy(*key).agg(F.min("batch_id").alias("_by"))
    marked, logged = readings.join(by, key, "left"), Observation()
    known = F.coalesce(F.col("_by") == batch_id, F.lit(False))
    watched = marked.observe(logged, F.max(known).alias("again"))
    append_new(watched.filter("_by IS NULL").select(*key, own), seen_path, matched=True)
    # Writing to a table drops what was kept of plans that read it, so the match is not kept.
    mine = F.col("_by").isNull() | (F.col("_by") == batch_id)
    return marked.filter(mine).drop("_by"), observed(logged, "again") is not False


def keep_current(
    batch: DataFrame, batch_id: int, registry: DataFrame, tables: LiveTables, rule: RiskRule
) -> None:
    """One micro-batch: new scores, tier alerts, latest states, all from the same rows.

    Readings that an earlier batch brought are dropped once, before anything is derived,
    whether they were scored or not. So the tables always tell the same story: that of the
    reading seen first. Scores and the log of seen readings carry their batch id, by which a
    retry knows its own rows; alerts and latest states go to a folder of the batch that it
    overwrites.
    """
    spark = batch.sparkSession
    own = F.lit(batch_id).cast("bigint").alias("batch_id")
    with ExitStack() as kept:
        accepted, again = accept(batch, batch_id, tables.seen, kept)
        fresh = _keep(kept, score_readings(accepted, registry, rule))
        machines = fresh.groupBy("machine_id").agg(F.count("*").alias("_rows"))
        # At most as many buckets as there are.
        most, touched = machines.agg(F.max("_rows"), F.collect_set(tables.bucket())).first()
        # Readings are logged before they are scored: what the log lacked has no score either.
        append_new(stamped(fresh).select("*", own), tables.scored, matched=not again)
        previous = tables.read_latest(spark, before=batch_id, buckets=set(touched))
        if previous is not None:
            previous = _keep(kept, previous)
        alerts = _alerts(fresh, previous, registry, tables, batch_id, most or 0, kept)
        alerts.write.mode("overwrite").parquet(tables.alerts(batch_id))
        current = latest_scores(fresh) if previous is None else merge_latest(previous, fresh)
        tables.write_latest(spark, current, batch_id)


def _alerts(
    fresh: DataFrame,
    previous: DataFrame | None,
    registry: DataFrame,
    tables: LiveTables,
    batch_id: int,
    most: int,
    kept: ExitStack,
) -> DataFrame:
    """Tier changes that the fresh readings bring, and revisions where they arrive late.

    A reading newer than its machine's state is compared with that state, for which only the
    states of the batch's machines are read. A late one stands between two stored readings:
    its own change and that of its successor are stated anew from the machine's stored
    scores around it; a successor that no longer differs has its alert withdrawn.
    ``most`` is the most fresh readings of a machine.
    """
    spark = fresh.sparkSession
    flags = [F.lit(False).alias("withdrawn"), F.lit(False).alias("revision")]
    if previous is None:
        return tier_changes(fresh, most=most).select("*", *flags)
    machines = fresh.select("machine_id").distinct()
    few = row_count(registry) <= BROADCAST_ROWS  # at most one row per registered machine
    known = _keep(kept, previous.join(F.broadcast(machines) if few else machines, "machine_id", "left_semi"))
    since = known.select("machine_id", F.col("reading_ts").alias("_since"))
    since = F.broadcast(since) if few else since
    placed = fresh.join(since, "machine_id", "left")
    in_order = placed.filter("_since IS NULL OR reading_ts > _since").drop("_since")
    late = _keep(kept, placed.filter("reading_ts <= _since").select("machine_id", "reading_ts"))
    on_time = tier_changes(known.unionByName(in_order.select(*known.columns)), most=most + 1).select("*", *flags)
    if late.isEmpty():
        return on_time
    stored = spark.read.parquet(tables.scored)
    dates = sorted(dt.date.fromisoformat(d) for d in _entries(spark, tables.scored, f"{DATE}=") if not d.startswith("__"))
    # Readings newer than the old state are alerted on above; of the others, the batch's own are the late ones.
    upto = _around(stored, late, few, dates).join(since, "machine_id").filter("reading_ts <= _since")
    own = (F.col("batch_id") == batch_id).alias("_late")
    history = _keep(kept, upto.select("machine_id", "reading_ts", "risk_score", "risk_tier", own))
    return on_time.unionByName(revised_changes(history))


def _around(scored: DataFrame, late: DataFrame, few: bool, stored: list[dt.date] | None = None) -> DataFrame:
    """Stored scores of the late readings' machines on enough dates to hold the neighbours of each.

    The days around a late reading are widened until a score lies on either side of it, or
    the table ends; so a fleet that reports daily costs three dates a late one, not its history.
    ``stored`` are the calendar dates of the table, where the caller has listed them.
    """
    machines = late.select("machine_id").distinct()
    mine = scored.join(F.broadcast(machines) if few else machines, "machine_id", "left_semi")
    stored = stored or sorted(r[0] for r in scored.select(DATE).distinct().collect())
    wanted: set[dt.date] = set()
    # The first and last late reading of a day have a neighbour if all of that day have one.
    ends = F.min("reading_ts").alias("_first"), F.max("reading_ts").alias("_last")
    missing, days = late.groupBy("machine_id", F.to_date("reading_ts").alias("_day")).agg(*ends), 1
    while True:
        asked = [r[0] for r in missing.select("_day").distinct().collect()]
        wanted |= {d for d in stored if any(abs((d - a).days) <= days for a in asked)}
        rows = on_dates(mine, wanted)
        if len(wanted) == len(stored):
            return rows
        spans = rows.groupBy("machine_id", F.to_date("reading_ts").alias("_on")).agg(
            F.min("reading_ts").alias("_from"), F.max("reading_ts").alias("_to")
        )
        near = missing.join(spans, "machine_id").filter(F.abs(F.datediff("_on", "_day")) <= days)
        sides = near.groupBy("machine_id", "_day", "_first", "_last").agg(
            F.max(F.col("_from") < F.col("_first")).alias("_before"), F.max(F.col("_to") > F.col("_last")).alias("_after")
        )
        open_before = ~F.col("_before") & (F.date_sub("_day", days) > F.lit(stored[0]))
        open_after = ~F.col("_after") & (F.date_add("_day", days) < F.lit(stored[-1]))
        missing = sides.filter(open_before | open_after).drop("_before", "_after")
        if missing.isEmpty():
            return rows
        days *= 4


def run_live(
    stream: DataFrame,
    registry: DataFrame,
    tables: LiveTables,
    rule: RiskRule = DEFAULT_RULE,
    *,
    every: str | None = "5 minutes",
) -> StreamingQuery:
    """Keep the tables current; ``every=None`` drains what is there and stops."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: keep_current(batch, batch_id, registry, tables, rule)
        )
        .option("checkpointLocation", tables.checkpoint)
        .trigger(**trigger)
        .start()
    )
