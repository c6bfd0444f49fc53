"""Operators against brute force on small fixtures with ties, gaps, heavy keys and late rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from compare import spark_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from millwatch.functions.columns import reading_key
from millwatch.operators import anomaly, evaluation, history, quality
from millwatch.operators.joins import attach, keys_missing, rows_with_keys
from millwatch.operators.ranking import ranked
from millwatch.operators.sizing import UNBOUNDED, slice_seconds
from millwatch.operators.trailing import trailing_means
from millwatch.schema import REGISTRY, TELEMETRY

START = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def readings(spark):
    """One machine holds most rows; times repeat, leave gaps and sit on slice borders."""
    rng = random.Random(7)
    rows = []
    for i in range(1200):
        machine = "HOT" if rng.random() < 0.7 else f"M{rng.randrange(5)}"
        minutes = rng.choice([rng.randrange(0, 6 * 1440), 60 * rng.randrange(0, 144), 1440 * rng.randrange(0, 6)])
        at = START + dt.timedelta(minutes=minutes)
        temp = None if rng.random() < 0.3 else rng.randrange(3000, 9000) / 100
        tier = rng.choice(["LOW", "MEDIUM", "HIGH", "CRITICAL", "DATA_LOSS"])
        rows.append((i, machine, at, temp, rng.randrange(0, 5000) / 1000, tier, rng.randrange(0, 100) / 100))
    return spark.createDataFrame(
        rows, "reading_id INT, machine_id STRING, reading_ts TIMESTAMP_NTZ, t DOUBLE, v DOUBLE, risk_tier STRING, s DOUBLE"
    ).select(
        "reading_id", "machine_id", "reading_ts", "risk_tier",
        F.col("t").cast("decimal(7,2)").alias("temperature_c"),
        F.col("v").cast("decimal(7,3)").alias("vibration_mm_s"),
        F.col("s").cast("decimal(5,4)").alias("risk_score"),
    ).cache()


@pytest.mark.parametrize("slice_rows", [10**6, 1], ids=["one-pass", "by-instant"])
@pytest.mark.parametrize("hours", [24, 5])
def test_trailing_means_equal_native_range_frame(readings, slice_rows, hours):
    readings.createOrReplaceTempView("trailing_in")
    frame = f"OVER (PARTITION BY machine_id ORDER BY reading_ts RANGE BETWEEN INTERVAL '{hours}' HOUR PRECEDING AND CURRENT ROW)"
    native = readings.sparkSession.sql(
        f"SELECT reading_id, try_divide(CAST(sum(CAST(temperature_c * 100 AS BIGINT)) {frame} AS DOUBLE), count(temperature_c) {frame} * 100D) AS a, "
        f"try_divide(CAST(sum(CAST(vibration_mm_s * 1000 AS BIGINT)) {frame} AS DOUBLE), count(vibration_mm_s) {frame} * 1000D) AS b FROM trailing_in"
    )
    means = {"a": ("temperature_c", 2), "b": ("vibration_mm_s", 3)}
    ours = trailing_means(readings, means, hours=hours, slice_rows=slice_rows, hot_rows=2)
    assert spark_rows(ours.select("reading_id", "a", "b")) == spark_rows(native)


@pytest.mark.parametrize("slice_rows", [10**6, 60, 6, 1])
def test_fill_gaps(readings, slice_rows):
    got = {
        r["reading_id"]: r
        for r in history.fill_gaps(
            readings, ["temperature_c"], max_hours=6, order=("reading_ts", "reading_id"), slice_rows=slice_rows
        ).collect()
    }
    known = {}
    for r in sorted(readings.collect(), key=lambda r: (r["machine_id"], r["reading_ts"], r["reading_id"])):
        if r["temperature_c"] is not None:
            known[r["machine_id"]] = (r["reading_ts"], r["temperature_c"])
        at, value = known.get(r["machine_id"], (None, None))
        expected = value if at and at >= r["reading_ts"] - dt.timedelta(hours=6) else None
        assert got[r["reading_id"]]["temperature_c"] == expected
        assert got[r["reading_id"]]["temperature_c_filled"] == (r["temperature_c"] is None and expected is not None)


@pytest.mark.parametrize("slice_rows", [10**6, 60, 6, 1])
def test_tier_changes(readings, slice_rows):
    scored = readings.select("machine_id", "reading_ts", "reading_id", "risk_score", "risk_tier")
    got = history.tier_changes(scored, order=("reading_ts", "reading_id"), slice_rows=slice_rows)
    window = Window.partitionBy("machine_id").orderBy("reading_ts", "reading_id")
    expected = (
        scored.withColumn("previous_tier", F.lag("risk_tier").over(window))
        .withColumn("previous_ts", F.lag("reading_ts").over(window))
        .filter("previous_tier <> risk_tier")
    )
    columns = ["machine_id", "reading_ts", "previous_ts", "previous_tier", "risk_tier"]
    assert spark_rows(got.select(*columns)) == spark_rows(expected.select(*columns))
    assert got.filter("escalated IS NULL").filter("'DATA_LOSS' NOT IN (risk_tier, previous_tier)").isEmpty()
    assert not got.filter("escalated AND risk_tier = 'CRITICAL'").isEmpty()
    assert got.filter("escalated AND risk_tier = 'LOW'").isEmpty()


def test_slice_width_follows_the_largest_group(readings):
    assert slice_seconds(readings, "machine_id", "reading_ts", 10**6) == 86_400
    assert slice_seconds(readings, "machine_id", "reading_ts", 1) == 1


def test_short_histories_are_not_cut(readings):
    scored = readings.select("machine_id", "reading_ts", "reading_id", "risk_score", "risk_tier")
    whole, days = (history.tier_changes(scored, order=("reading_ts", "reading_id"), slice_rows=n) for n in (10**6, 500))
    joins = ["Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in (whole, days)]
    assert joins == [False, True] and spark_rows(whole) == spark_rows(days)


@pytest.mark.parametrize("slice_rows", [10**6, 6])
def test_alert_quality(readings, slice_rows):
    alerts = readings.filter("risk_tier = 'CRITICAL' AND machine_id <> 'HOT'")
    failures = readings.filter("risk_tier = 'DATA_LOSS'")
    got = evaluation.alert_quality(alerts, failures, horizon_hours=3, slice_rows=slice_rows).first()
    a = {(r["machine_id"], r["reading_ts"]) for r in alerts.collect()}
    f = {(r["machine_id"], r["reading_ts"]) for r in failures.collect()}
    reach = dt.timedelta(hours=3)
    right = sum(any(m == n and t <= u <= t + reach for n, u in f) for m, t in a)
    caught = sum(any(m == n and t - reach <= u <= t for n, u in a) for m, t in f)
    assert (got["alerts"], got["right_alerts"], got["failures"], got["caught_failures"]) == (len(a), right, len(f), caught)
    assert got["precision"] == pytest.approx(right / len(a))
    assert got["recall"] == pytest.approx(caught / len(f))


@pytest.mark.parametrize("broadcast_rows, hot_rows", [(100, 10), (4, 300), (4, UNBOUNDED), (0, 10)])
def test_attach_gives_the_same_rows_on_every_path(spark, readings, broadcast_rows, hot_rows):
    dim = spark.createDataFrame([(f"M{i}", i) for i in range(4)] + [("HOT", 99)], "machine_id STRING, site INT")
    plain = readings.join(dim, "machine_id")
    ours = attach(readings, dim, broadcast_rows=broadcast_rows, hot_rows=hot_rows)
    assert spark_rows(ours) == spark_rows(plain.select(ours.columns))


def test_heavy_key_is_joined_without_shuffling_it(spark, readings):
    dim = spark.createDataFrame([(f"M{i}", i) for i in range(4)] + [("HOT", 99)], "machine_id STRING, site INT")
    plan = attach(readings, dim, broadcast_rows=4, hot_rows=300)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("strategy=broadcast") == 3


def test_orphans(spark, readings):
    registry = spark.createDataFrame([("HOT",), ("M1",)], "machine_id STRING")
    for limit in (100, 1):
        keys = keys_missing(readings, registry, broadcast_rows=limit)
        assert {r[0] for r in keys.collect()} == {"M0", "M2", "M3", "M4"}
        rows = rows_with_keys(readings, keys, broadcast_rows=limit)
        assert rows.count() == readings.filter("machine_id IN ('M0', 'M2', 'M3', 'M4')").count()


@pytest.mark.parametrize("within", [[], ["risk_tier"]])
def test_ranked_across_tasks_equals_one_window(readings, within):
    order = [F.desc("risk_score"), F.asc("reading_id")]
    small = ranked(readings, "n", order, within=within, at_most=1)
    large = ranked(readings, "n", order, within=within, at_most=UNBOUNDED)
    assert large.columns == small.columns
    assert spark_rows(large.select("reading_id", "n")) == spark_rows(small.select("reading_id", "n"))


def test_risk_slope_finds_a_line(spark):
    rows = [("A", START + dt.timedelta(hours=6 * i), 0.1 + 0.02 * i) for i in range(20)]
    rows += [("B", START + dt.timedelta(hours=1), 0.5)]
    scored = spark.createDataFrame(rows, "machine_id STRING, reading_ts TIMESTAMP_NTZ, s DOUBLE").select(
        "machine_id", "reading_ts", F.col("s").cast("decimal(5,4)").alias("risk_score")
    )
    as_of = F.lit("2024-03-06 00:00:00").cast("timestamp_ntz")
    got = {r["machine_id"]: r for r in history.risk_slope(scored, as_of).collect()}
    assert got["A"]["slope_per_day"] == pytest.approx(0.08)
    assert got["B"]["slope_per_day"] is None


def test_drop_repeats_keeps_the_first_loaded(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("A", at, 2, "second"), ("A", at, 1, "first"), ("B", at, 5, "only")]
    pings = spark.createDataFrame(rows, "machine_id STRING, reading_ts TIMESTAMP_NTZ, load_ts INT, note STRING")
    assert {r["note"] for r in history.drop_repeats(pings).collect()} == {"first", "only"}


def test_contract_checks(spark):
    raw = spark.createDataFrame(
        [
            ("M1", "2024-01-01 00:00:00", "40.5", "RUNNING", None),
            ("M1", "2024-01-01 00:00:00", "hot", "RUNNING", "E5"),
            ("M2", "not a time", "1", "PAUSED", "E1234567890"),
            (None, "2024-01-01 01:00:00", "123456.7", None, ""),
        ],
        "machine_id STRING, reading_ts STRING, temperature_c STRING, operating_mode STRING, error_code STRING",
    )
    found = {(r[0], r[1]): r[2] for r in quality.domain_violations(raw, TELEMETRY).collect()}
    assert found[("temperature_c", "type")] == 2
    assert found[("reading_ts", "type")] == 1
    assert found[("error_code", "length")] == 1
    # A mode beyond the known ones is a warning, not a fault.
    assert ("operating_mode", "value") not in found
    assert {r[0]: r[1] for r in quality.unknown_modes(raw).collect()} == {"PAUSED": 1}
    good, bad = quality.split_valid(raw, TELEMETRY)
    assert good.count() == 1 and good.schema["temperature_c"].dataType.simpleString() == "decimal(7,2)"
    faults = {r["faults"] for r in bad.collect()}
    assert "temperature_c:type" in faults
    assert "temperature_c:type,machine_id:required" in faults
    assert quality.key_violations(raw, TELEMETRY).first()["copies"] == 2
    nulls = {r[0]: r[2] for r in quality.null_violations(raw, TELEMETRY).collect()}
    assert nulls == {"machine_id": 1, "reading_ts": 0}
    assert REGISTRY.struct(enforce_nulls=True)["machine_id"].nullable is False


def test_results_do_not_depend_on_row_order(readings):
    shuffled = readings.repartition(13, "vibration_mm_s")
    for df in (readings, shuffled):
        assert df.count() == 1200
    a, b = (
        trailing_means(df, {"m": ("temperature_c", 2)}).select("reading_id", "m") for df in (readings, shuffled)
    )
    assert spark_rows(a) == spark_rows(b)


def test_robust_deviation(spark):
    at = dt.datetime(2024, 1, 1)
    values = {"A": [1.0, 2.0, 3.0, 4.0, 50.0, None], "B": [7.0, 7.0, 7.0, 9.0], "C": [None, None]}
    rows = [(m, at + dt.timedelta(hours=i), v) for m, vs in values.items() for i, v in enumerate(vs)]
    readings = spark.createDataFrame(rows, "machine_id STRING, reading_ts TIMESTAMP_NTZ, v DOUBLE").select(
        "machine_id", "reading_ts", F.col("v").cast("decimal(7,2)").alias("t")
    )
    registry = spark.createDataFrame([("A",), ("B",), ("C",)], "machine_id STRING")
    got = anomaly.robust_deviation(readings, registry, ["t"]).orderBy("machine_id", "reading_ts").collect()
    assert len(got) == len(rows)
    a = [r["t_robust_z"] for r in got if r["machine_id"] == "A"]
    assert a[2] == 0.0 and a[4] == pytest.approx(47 / 1.4826) and a[5] is None
    assert {r["t_robust_z"] for r in got if r["machine_id"] in "BC"} == {None}


def test_surrogate_keys_follow_the_natural_key(readings):
    keys = readings.select("machine_id", "reading_ts", reading_key().alias("k")).distinct()
    assert keys.select("k").distinct().count() == readings.select("machine_id", "reading_ts").distinct().count()
