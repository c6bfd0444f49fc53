"""Streams over several micro-batches equal the batch result; retries and late rows are safe."""

from __future__ import annotations

import datetime as dt

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from millwatch.operators import history
from millwatch.plans import features, scoring, summary
from millwatch.sources import driver_tables, tables
from millwatch.streaming import incremental, ingest


@pytest.fixture(scope="module")
def event_files(spark, tmp_path_factory):
    """The events as several files in time order."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = driver_tables.table(spark, "/root/testdata/sf0.001", "events")
    cuts = [0, 400, 700, 10**9]
    for low, high in zip(cuts, cuts[1:]):
        part = events.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream_of(spark, event_files, fleet):
    events = ingest.file_stream(spark, event_files, driver_tables.SCHEMAS["events"], files_per_batch=1)
    return driver_tables.telemetry(events, fleet.registry)


def test_stream_scores_equal_batch_scores(spark, event_files, fleet, tmp_path):
    scored = scoring.score_readings(stream_of(spark, event_files, fleet), fleet.registry)
    query = ingest.write_stream(scored, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    assert spark_rows(spark.read.parquet(str(tmp_path / "out"))) == spark_rows(fleet.scored)


def test_stream_drops_repeats(spark, event_files, fleet, tmp_path):
    stream = stream_of(spark, event_files, fleet)
    doubled = stream.unionByName(stream_of(spark, event_files, fleet).filter("error_code IS NOT NULL"))
    query = ingest.write_stream(ingest.drop_repeats_stream(doubled), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == fleet.telemetry.count()


def test_live_tables_follow_the_stream_and_survive_a_retry(spark, event_files, fleet, tmp_path):
    live = incremental.LiveTables(str(tmp_path / "live"))
    incremental.run_live(stream_of(spark, event_files, fleet), fleet.registry, live, every=None).awaitTermination()
    assert spark_rows(tables.read_fact(spark, live.scored).select(*fleet.scored.columns)) == spark_rows(fleet.scored)
    latest = live.read_latest(spark)
    expected = summary.latest_scores(fleet.scored)
    assert spark_rows(latest.select(*expected.columns)) == spark_rows(expected)
    alerts = history.tier_changes(fleet.scored, order=("reading_ts", "reading_id"))
    assert spark_rows(live.read_alerts(spark).select(*alerts.columns)) == spark_rows(alerts)

    # Run the last batch again, as after a crash between its writes and its commit.
    last = fleet.telemetry.filter("reading_id >= 700")
    incremental.keep_current(last, 2, fleet.registry, live, incremental.DEFAULT_RULE)
    assert tables.read_fact(spark, live.scored).count() == fleet.scored.count()
    assert spark_rows(live.read_latest(spark).select(*expected.columns)) == spark_rows(expected)
    assert live.read_alerts(spark).count() == alerts.count()


def test_late_readings_revise_the_alerts(spark, fleet, tmp_path):
    live = incremental.LiveTables(str(tmp_path / "late"))
    parts = ["reading_id % 10 NOT IN (3, 6)", "reading_id % 10 = 3", "reading_id % 10 = 6"]
    for batch_id, condition in [*enumerate(parts), (2, parts[2])]:  # the last one is run again
        batch = fleet.telemetry.filter(condition)
        incremental.keep_current(batch, batch_id, fleet.registry, live, incremental.DEFAULT_RULE)
    assert tables.read_fact(spark, live.scored).count() == fleet.scored.count()
    expected = summary.latest_scores(fleet.scored)
    assert spark_rows(live.read_latest(spark).select(*expected.columns)) == spark_rows(expected)
    alerts = history.tier_changes(fleet.scored, order=("reading_ts", "reading_id"))
    assert spark_rows(live.read_alerts(spark).select(*alerts.columns)) == spark_rows(alerts)
    assert not live.read_alert_log(spark).filter("revision").isEmpty()
    # At most two versions of a bucket are kept: the newest one and the one that a retry would start from.
    assert all(len(batches) <= 2 for batches in live.versions(spark).values())


def test_a_reading_sent_again_with_other_values_changes_nothing(spark, fleet, tmp_path):
    live = incremental.LiveTables(str(tmp_path / "again"))
    some = fleet.telemetry.filter("reading_id < 60 AND temperature_c IS NOT NULL").drop("reading_id")
    worse = some.withColumn("temperature_c", F.expr("CAST(temperature_c + 500 AS DECIMAL(7,2))"))
    for batch_id, batch in enumerate([some, worse]):
        incremental.keep_current(batch, batch_id, fleet.registry, live, incremental.DEFAULT_RULE)
    stored = tables.read_fact(spark, live.scored)
    expected = scoring.score_readings(some, fleet.registry)
    assert spark_rows(stored.select(*expected.columns)) == spark_rows(expected)
    newest = summary.latest_scores(expected)
    assert spark_rows(live.read_latest(spark).select(*newest.columns)) == spark_rows(newest)


def test_an_unscored_reading_is_seen_too(spark, fleet, tmp_path):
    """A repeat of a reading in maintenance, sent as a running one, must not become the latest state."""
    live = incremental.LiveTables(str(tmp_path / "unscored"))
    some = fleet.telemetry.filter("machine_id IN ('MCH_000001', 'MCH_000002')").drop("reading_id")
    newest = some.agg(F.max("reading_ts")).first()[0] + dt.timedelta(hours=1)
    later = some.limit(1).withColumn("reading_ts", F.lit(newest))
    service = later.withColumn("operating_mode", F.lit("MAINTENANCE"))
    for batch_id, batch in enumerate([some, service, later.withColumn("operating_mode", F.lit("RUNNING"))]):
        incremental.keep_current(batch, batch_id, fleet.registry, live, incremental.DEFAULT_RULE)
    expected = summary.latest_scores(scoring.score_readings(some, fleet.registry))
    assert spark_rows(live.read_latest(spark).select(*expected.columns)) == spark_rows(expected)
    assert spark.read.parquet(live.seen).count() == some.count() + 1


def test_a_batch_leaves_the_buckets_of_other_machines_alone(spark, fleet, tmp_path):
    live = incremental.LiveTables(str(tmp_path / "buckets"))
    old = fleet.telemetry.filter("reading_id < 500")
    mine = fleet.telemetry.filter("reading_id >= 500 AND machine_id = 'MCH_000007'")
    incremental.keep_current(old, 0, fleet.registry, live, incremental.DEFAULT_RULE)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "buckets" / "latest").glob("*/bucket=*/*.parquet")}
    incremental.keep_current(mine, 1, fleet.registry, live, incremental.DEFAULT_RULE)
    bucket = mine.select(live.bucket()).first()[0]
    versions = live.versions(spark)
    assert len(versions) > 5 and {b for b, batches in versions.items() if 1 in batches} == {bucket}
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "buckets" / "latest").glob("*/bucket=*/*.parquet")}
    assert before.items() <= after.items()
    expected = summary.latest_scores(scoring.score_readings(old.unionByName(mine), fleet.registry))
    assert spark_rows(live.read_latest(spark).select(*expected.columns)) == spark_rows(expected)


def test_neighbours_of_a_late_reading_are_found_across_gaps(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(days=d)) for d in (0, 40, 80)] + [("B", start + dt.timedelta(days=d)) for d in range(81)]
    scored = spark.createDataFrame(rows, "machine_id STRING, reading_ts TIMESTAMP_NTZ")
    tables.write_fact(scored, str(tmp_path / "scored"))
    stored = tables.read_fact(spark, str(tmp_path / "scored"))
    around = lambda late: incremental._around(stored, spark.createDataFrame(late, scored.schema), True)
    assert {r["reading_ts"].day for r in around([rows[13]]).collect()} == {rows[k][1].day for k in (12, 13, 14)}
    assert around([rows[1]]).filter("machine_id = 'A'").count() == 3


def test_of_two_pings_in_one_batch_the_complete_one_counts(spark, fleet, tmp_path):
    live = incremental.LiveTables(str(tmp_path / "pings"))
    some = fleet.telemetry.filter("reading_id < 60 AND temperature_c IS NOT NULL AND vibration_mm_s IS NOT NULL").drop("reading_id")
    torn = some.withColumn("temperature_c", F.lit(None).cast("decimal(7,2)"))
    incremental.keep_current(torn.unionByName(some), 0, fleet.registry, live, incremental.DEFAULT_RULE)
    assert tables.read_fact(spark, live.scored).filter("risk_tier = 'DATA_LOSS'").isEmpty()


def test_incremental_scores_equal_a_full_run(spark, fleet, tmp_path):
    path = str(tmp_path / "scored")
    for share in ("reading_id < 300", "reading_id < 800", "true"):
        incremental.score_new(fleet.telemetry.filter(share), fleet.registry, path)
    got = tables.read_fact(spark, path)
    assert "scored_at" in got.columns
    assert spark_rows(got.select(*fleet.scored.columns)) == spark_rows(fleet.scored)


def test_late_readings_refresh_only_the_dates_they_touch(spark, fleet, tmp_path):
    path = str(tmp_path / "features")
    late = (F.to_date("reading_ts") == dt.date(2024, 1, 12)) & (F.col("reading_id") % 2 == 0)
    early = fleet.telemetry.filter(~late)
    tables.write_fact(features.features(early, fleet.registry), path)
    before = {p.name for p in (tmp_path / "features").glob("reading_date=*/*")}
    incremental.refresh_features(fleet.telemetry, fleet.registry, fleet.telemetry.filter(late), path)
    full = features.features(fleet.telemetry, fleet.registry)
    got = tables.read_fact(spark, path)
    assert spark_rows(got.select(*full.columns)) == spark_rows(full)
    after = {p.name for p in (tmp_path / "features").glob("reading_date=*/*")}
    changed = {p.parent.name for p in (tmp_path / "features").glob("reading_date=*/*.parquet") if p.name not in before}
    assert changed == {"reading_date=2024-01-12", "reading_date=2024-01-13"} and before & after


def test_rollup_stream_has_every_hour(spark, event_files, fleet, tmp_path):
    path = str(tmp_path / "sums")
    query = ingest.rollup_stream(stream_of(spark, event_files, fleet), path, str(tmp_path / "cp"))
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    assert spark_rows(ingest.read_rollup(spark, path)) == spark_rows(history.hourly_rollup(fleet.telemetry))


def test_broker_records_are_decoded(spark):
    raw = spark.createDataFrame(
        [(b'{"machine_id": "M1", "reading_ts": "2024-01-01 00:00:00", "temperature_c": 40.5}',), (b"junk",)],
        "value BINARY",
    )
    schema = "machine_id STRING, reading_ts TIMESTAMP_NTZ, temperature_c DECIMAL(7,2)"
    rows = ingest.decode_json(raw, schema).collect()
    assert len(rows) == 1 and str(rows[0]["temperature_c"]) == "40.50"


def test_a_batch_is_matched_with_the_log_once(spark, fleet, tmp_path, monkeypatch):
    live = incremental.LiveTables(str(tmp_path / "once"))
    read = []
    whole = tables.stored_rows
    for module in (tables, incremental):
        monkeypatch.setattr(module, "stored_rows", lambda df, path: read.append(path) or whole(df, path))
    for batch_id, condition in enumerate(["reading_id % 10 < 5", "reading_id % 10 >= 5"]):
        incremental.keep_current(fleet.telemetry.filter(condition), batch_id, fleet.registry, live, incremental.DEFAULT_RULE)
    assert read == [live.seen] * 2
    assert tables.read_fact(spark, live.scored).count() == fleet.scored.count()
    assert spark.read.parquet(live.seen).count() == fleet.telemetry.count()


def test_a_batch_with_late_readings_takes_few_jobs(spark, fleet, tmp_path):
    """Readings are matched and scored once, and short histories are read without slices."""
    live = incremental.LiveTables(str(tmp_path / "few"))
    for batch_id, condition in enumerate(["reading_id % 10 < 4", "reading_id % 10 IN (4, 5)", "reading_id % 10 > 5"]):
        spark.sparkContext.setJobGroup(f"live-{batch_id}", "live")
        incremental.keep_current(fleet.telemetry.filter(condition), batch_id, fleet.registry, live, incremental.DEFAULT_RULE)
    spark.sparkContext.setJobGroup("", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("live-2")) <= 60
    alerts = history.tier_changes(fleet.scored, order=("reading_ts", "reading_id"))
    assert spark_rows(live.read_alerts(spark).select(*alerts.columns)) == spark_rows(alerts)
