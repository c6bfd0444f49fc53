"""Live rolling means, closing roll-ups, dead letters, mergeable tier states and the table function."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from millwatch.operators import history
from millwatch.plans import features, summary, tier_state, views
from millwatch.schema import TELEMETRY
from millwatch.sources import tables
from millwatch.streaming import closing, ingest, rolling

START = dt.datetime(2024, 1, 1)


def test_rolling_step_equals_brute_force():
    """Batches out of order within the delay; instants tie, within batches and over them."""
    rng = np.random.default_rng(1)
    window, delay = 100, 40
    for _ in range(30):
        at = np.sort(rng.integers(0, 600, 120))
        rows = np.column_stack([at, rng.integers(-9, 9, 120), rng.integers(0, 2, 120), rng.integers(0, 9, 120), np.ones(120, int)])
        arrival = np.argsort(at + rng.integers(0, delay, 120), kind="stable")
        ring, newest, last = np.empty((0, 5), np.int64), None, {}
        for batch in np.array_split(rows[arrival], 7):
            ring, newest, said, late = rolling.step(ring, newest, batch.astype(np.int64), window, delay)
            assert not len(late)
            assert len(ring) <= window + delay + 1 and ring[0, 0] >= newest - window - delay
            last |= {int(r[0]): r[1:].tolist() for r in said}
        want = {int(t): rows[(at >= t - window) & (at <= t), 1:].sum(axis=0).tolist() for t in at}
        assert last == want


def test_rolling_step_says_what_is_too_late():
    first = np.array([[t, 1, 1, 1, 1] for t in (0, 100, 200, 300)], np.int64)
    ring, newest, _, _ = rolling.step(np.empty((0, 5), np.int64), None, first, 100, 40)
    _, _, said, late = rolling.step(ring, newest, np.array([[10, 1, 1, 1, 1], [250, 1, 1, 1, 1], [270, 1, 1, 1, 1]], np.int64), 100, 40)
    assert late.tolist() == [10, 250] and said[:, 0].tolist() == [270, 300]
    assert said[:, 2].tolist() == [3, 4]


def slices(fleet, tmp_path, conditions, start):
    for condition in conditions:
        fleet.table("events").filter(condition).write.mode("append").parquet(str(tmp_path / "events"))
        from millwatch.sources import driver_tables

        stream = ingest.file_stream(fleet.spark, str(tmp_path / "events"), driver_tables.SCHEMAS["events"])
        query = start(driver_tables.telemetry(stream, fleet.registry))
        query.awaitTermination()
    return query


def test_closed_hours_are_said_once_and_state_is_dropped(spark, fleet, tmp_path):
    hours = closing.HourTables(str(tmp_path / "hours"))
    low, high = fleet.telemetry.agg(F.min("reading_ts"), F.max("reading_ts")).first()
    middle = low + (high - low) / 2
    early = f"ts < TIMESTAMP_NTZ'{middle}'"
    conditions = [f"{early} AND event_id % 3 > 0", f"{early} AND event_id % 3 = 0", f"NOT {early}"]
    query = slices(
        fleet, tmp_path, conditions,
        lambda s: closing.closing_rollup_stream(s, hours, str(tmp_path / "cp"), keep="400 days"),
    )
    got = hours.read(spark)
    assert spark_rows(got.drop("state")) == spark_rows(history.hourly_rollup(fleet.telemetry))
    states = {r["state"]: r["count"] for r in got.groupBy("state").count().collect()}
    assert set(states) == {"closed", "corrected", "open"}
    closed = spark.read.parquet(f"{hours.base}/closed")
    assert closed.groupBy("machine_id", "hour_start").count().filter("count > 1").isEmpty()
    newest_start = high.replace(minute=0, second=0, microsecond=0) - dt.timedelta(hours=2)
    assert got.filter("state = 'open'").agg(F.min("hour_start")).first()[0] >= newest_start
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == got.count()

    # The state store forgets hours that lie further back than it is asked to keep.
    query = slices(
        fleet, tmp_path / "short", [early, f"NOT {early}"],
        lambda s: closing.closing_rollup_stream(s, closing.HourTables(str(tmp_path / "few")), str(tmp_path / "cp2"), keep="6 hours"),
    )
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < got.count() / 10


def test_live_means_equal_the_batch_and_expire(spark, fleet, tmp_path):
    low, high = fleet.telemetry.agg(F.min("reading_ts"), F.max("reading_ts")).first()
    middle = low + (high - low) / 2
    cut = f"ts < TIMESTAMP_NTZ'{middle}'"
    tail = f"ts >= TIMESTAMP_NTZ'{middle - dt.timedelta(hours=5)}' AND event_id % 2 = 0"
    # Half of the last five hours comes with the second slice.
    conditions = [f"{cut} AND NOT ({tail})", f"NOT ({cut} AND NOT ({tail}))"]
    query = slices(
        fleet, tmp_path, conditions, lambda s: rolling.rolling_stream(s, str(tmp_path / "said"), str(tmp_path / "cp"))
    )
    got = rolling.read_rolling(spark, str(tmp_path / "said"))
    # A machine whose own clock was ahead of the slice's end may hold nothing that late; all means are there.
    assert got.filter("too_late").isEmpty()
    want = features.features(fleet.telemetry, fleet.registry).select(
        "machine_id", "reading_ts", "rolling_avg_temp_24h", "rolling_avg_vibration_24h"
    ).distinct()
    assert spark_rows(got.drop("too_late")) == spark_rows(want)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= fleet.registry.count()


def test_records_are_accepted_or_rejected(spark, tmp_path):
    good = '{"machine_id": "M1", "reading_ts": "2024-01-01 00:00:00", "temperature_c": 40.5, "more": 1}'
    records = {
        good: "", "junk": "value:json", "": "value:json", "[]": "value:json", "[1, 2]": "value:json", good[:40]: "value:json", "7": "value:json",
        "{}": "machine_id:required,reading_ts:required", '{"machine_id": "M1", "reading_ts": "noon"}': "reading_ts:type",
        '{"machine_id": "M1", "reading_ts": "2024-01-01 00:00:00", "temperature_c": "hot"}': "temperature_c:type",
        '{"machine_id": "M1", "reading_ts": "2024-01-01 00:00:00", "error_code": "E12345678901"}': "error_code:length",
    }
    rows = [(r.encode(),) for r in records] + [(None,), (b"\xff\xfe",)]
    good_rows, bad_rows = ingest.sort_records(spark.createDataFrame(rows, "value BINARY"), TELEMETRY)
    assert good_rows.count() + bad_rows.count() == len(rows)
    assert str(good_rows.first()["temperature_c"]) == "40.50"
    found = {None if r["value"] is None else bytes(r["value"]): r["faults"] for r in bad_rows.collect()}
    assert found == {**{r.encode(): f for r, f in records.items() if f}, None: "value:json", b"\xff\xfe": "value:json"}


@pytest.fixture(scope="module")
def stored(spark, fleet, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tiers") / "scored")
    tables.write_fact(fleet.scored, path)
    return tables.read_fact(spark, path)


def test_tier_states_merge_and_read_their_dates_only(spark, fleet, stored, tmp_path):
    numbers, states = str(tmp_path / "numbers"), str(tmp_path / "states")
    dates = sorted(r[0] for r in stored.select(tables.DATE).distinct().collect())
    tier_state.refresh_tier_states(stored, numbers, states, set(dates[:-1]))
    before = {p.name for p in (tmp_path / "states").glob("reading_date=*/*.parquet")}
    tier_state.refresh_tier_states(stored, numbers, states, {dates[-1]})
    after = {p.name for p in (tmp_path / "states").glob("reading_date=*/*.parquet")}
    assert before < after
    assert spark_rows(tier_state.tier_distribution(spark, states)) == spark_rows(summary.tier_distribution(stored))
    assert tier_state.machine_count(spark, states) == stored.select("machine_id").distinct().count()
    # Restating a date changes nothing, and numbers stay as they are.
    given = spark_rows(tier_state.number_machines(stored, numbers))
    tier_state.refresh_tier_states(stored, numbers, states, {dates[0]})
    assert spark_rows(tier_state.tier_distribution(spark, states)) == spark_rows(summary.tier_distribution(stored))
    assert spark_rows(tier_state.number_machines(stored, numbers)) == given
    assert sorted(r[1] for r in given) == list(range(1, len(given) + 1))
    plan = tier_state.tier_states(tier_state.on_dates(stored, {dates[-1]}), tier_state.number_machines(stored, numbers))
    assert {f.split("reading_date=")[1][:10] for f in plan.inputFiles() if "reading_date=" in f} <= {str(d) for d in dates}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and str(dates[-1]) in text


def test_the_table_function_is_a_projection(spark, fleet):
    rows = features.features(fleet.telemetry, fleet.registry, rolling=False).select("machine_id", "temperature_c")
    rows.createOrReplaceTempView("some_rows")
    views.register_table_function(spark)
    from millwatch.functions.rule import RULE_ARGUMENTS

    arguments = ", ".join("r.temperature_c" if n == "temperature_c" else f"CAST(NULL AS {k})" for n, k in RULE_ARGUMENTS)
    found = spark.sql(f"SELECT r.machine_id, s.* FROM some_rows r, LATERAL score_reading({arguments}) s")
    assert found.count() == rows.count()
    assert {r["risk_tier"] for r in found.select("risk_tier").distinct().collect()} == {"DATA_LOSS"}
    text = found._jdf.queryExecution().executedPlan().toString()
    # The one join is that of the features with the registry.
    assert "Python" not in text and text.count("Join") == rows._jdf.queryExecution().executedPlan().toString().count("Join")
