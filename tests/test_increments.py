"""Compaction and its recovery, rules as data, change points, baseline states, repeated keys."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from millwatch.config import RiskRule, Weights
from millwatch.operators import baseline, changes, history, quality
from millwatch.plans import rules, scoring
from millwatch.schema import REGISTRY
from millwatch.sources import tables, upkeep
from millwatch.streaming import ingest

START = dt.datetime(2024, 1, 1)


# upkeep ------------------------------------------------------------------------------------------


def parts_of(spark, path):
    """A table of two dates in many small files."""
    for part in range(10):
        rows = [(f"M{k:03d}", START + dt.timedelta(days=d, minutes=10 * part + k), part) for k in range(40) for d in (0, 1)]
        tables.append_new(spark.createDataFrame(rows, "machine_id STRING, reading_ts TIMESTAMP_NTZ, v INT"), str(path))
    return spark_rows(spark.read.parquet(str(path)))


def files(path):
    return sorted(path.glob("reading_date=*/*.parquet"))


def test_compaction_keeps_rows_and_orders_files(spark, tmp_path):
    want = parts_of(spark, tmp_path / "t")
    before = files(tmp_path / "t")
    assert upkeep.compact_dates(spark, str(tmp_path / "t")) == 2
    assert len(files(tmp_path / "t")) == 2 < len(before)
    assert spark_rows(spark.read.parquet(str(tmp_path / "t"))) == want
    assert upkeep.compact_dates(spark, str(tmp_path / "t")) == 0
    # A heavy date gets several files, each with a range of machines of its own.
    parts_of(spark, tmp_path / "u")
    size = sum(p.stat().st_size for p in files(tmp_path / "u")) // 2
    upkeep.compact_dates(spark, str(tmp_path / "u"), target_bytes=size // 3)
    many = spark.read.parquet(str(tmp_path / "u")).filter("reading_date = '2024-01-01'")
    places = many.select("machine_id", F.input_file_name().alias("file")).distinct()
    assert places.select("file").distinct().count() >= 3
    assert places.groupBy("machine_id").count().agg(F.avg("count")).first()[0] < 2


@pytest.mark.parametrize("killed_at", ["staging", "journal", "between"])
def test_a_killed_compaction_spoils_nothing(spark, tmp_path, monkeypatch, killed_at):
    path = tmp_path / "t"
    want = parts_of(spark, path)

    class Killed(Exception):
        pass

    real = upkeep._Folder.rename

    def rename(self, old, new):
        if killed_at == "journal" and old.startswith("reading_date="):
            raise Killed
        if killed_at == "between" and old.startswith("_staged-"):
            raise Killed
        if killed_at == "staging" and old.startswith("_new-"):
            raise Killed
        real(self, old, new)

    monkeypatch.setattr(upkeep._Folder, "rename", rename)
    with pytest.raises(Killed):
        upkeep.compact_dates(spark, str(path))
    monkeypatch.undo()
    if killed_at != "between":
        assert spark_rows(spark.read.parquet(str(path))) == want
    assert upkeep.recover(spark, str(path)) == (0 if killed_at == "staging" else 1)
    assert spark_rows(spark.read.parquet(str(path))) == want
    upkeep.compact_dates(spark, str(path))
    assert spark_rows(spark.read.parquet(str(path))) == want and len(files(path)) == 2


def test_rollup_batches_are_added_up(spark, fleet, tmp_path):
    path = str(tmp_path / "sums")
    for batch in range(5):
        history.hourly_sums(fleet.telemetry.filter(F.col("reading_id") % 5 == batch)).write.parquet(f"{path}/batch={batch}")
    assert upkeep.compact_rollup(spark, path) == 3
    assert sorted(p.name for p in (tmp_path / "sums").glob("batch=*")) == ["batch=3", "batch=4"]
    assert spark_rows(ingest.read_rollup(spark, path)) == spark_rows(history.hourly_rollup(fleet.telemetry))


# rules as data -----------------------------------------------------------------------------------


def rule_rows(spark, *rows):
    return spark.createDataFrame(list(rows), rules.RULE_ROW)


def test_each_reading_is_scored_by_the_rule_of_its_time(spark, fleet, tmp_path):
    change = START + dt.timedelta(days=12)
    first = [("A", START - dt.timedelta(days=1), None, "high", 0.6)]
    second = [("B", change, None, "high", 0.4), ("B", change, "PUMP", "pressure", 0.5), ("B", change, None, "power", 0.2)]
    old = rules.score_by_rules(fleet.telemetry, fleet.registry, rule_rows(spark, *first))
    new = rules.score_by_rules(fleet.telemetry, fleet.registry, rule_rows(spark, *first, *second))
    early = F.col("reading_ts") < F.lit(change)
    assert spark_rows(new.filter(early)) == spark_rows(old.filter(early))
    weights = Weights(power=0.2)
    rule = RiskRule(high=0.4, weights=weights, type_weights={"PUMP": Weights(power=0.2, pressure=0.5)}, version="B")
    expected = scoring.score_readings(fleet.telemetry.filter(~early), fleet.registry, rule)
    assert spark_rows(new.filter(~early)) == spark_rows(expected)
    assert {r[0] for r in new.select("model_version").distinct().collect()} == {"A", "B"}
    # The stored table is read by date folder, once per version.
    tables.write_fact(fleet.telemetry, str(tmp_path / "t"))
    stored = tables.read_fact(spark, str(tmp_path / "t"))
    text = rules.score_by_rules(stored, fleet.registry, rule_rows(spark, *first, *second))._jdf.queryExecution().executedPlan().toString()
    assert "reading_date#" in text and "2024-01-13" in text
    # Before the first version nothing is scored.
    late = [("A", START + dt.timedelta(days=300), None, "high", 0.6)]
    assert rules.score_by_rules(fleet.telemetry, fleet.registry, rule_rows(spark, *late)).isEmpty()


@pytest.mark.parametrize("bad", [
    [], [("A", START, None, "no_such", 1.0)], [("A", START, None, "high", None)], [("A", None, None, "high", 0.5)],
    [("A", START, "PUMP", "high", 0.5)], [("A", START, None, "high", 0.5), ("A", START, None, "high", 0.6)],
    [("A", START, None, "high", 0.5), ("A", START + dt.timedelta(1), None, "medium", 0.6)],
    [("A", START, None, "high", 0.5), ("B", START, None, "high", 0.6)],
])
def test_unclear_rules_are_refused(spark, fleet, bad):
    with pytest.raises(ValueError):
        rules.score_by_rules(fleet.telemetry, fleet.registry, rule_rows(spark, *bad))


# change points -----------------------------------------------------------------------------------


def test_cumulative_sums_do_not_depend_on_slices(spark):
    rng = random.Random(2)
    rows = [(m, START + dt.timedelta(seconds=rng.randrange(400_000)), k, rng.randint(-30, 28)) for m in "AB" for k in range(300)]
    rows += [("C", START, 0, -5), ("C", START, 1, 7)]
    steps = spark.createDataFrame(rows, "machine_id STRING, reading_ts TIMESTAMP_NTZ, k INT, x BIGINT")
    want = []
    for machine in "ABC":
        s = 0
        for m, at, k, x in sorted((r for r in rows if r[0] == machine), key=lambda r: (r[1], r[2])):
            want.append((m, at, k, x, s, max(0, s + x)))
            s = max(0, s + x)
    for seconds in (60, 3_600, 86_400, 10**9):
        found = changes.cumulative_sums(steps, ["machine_id"], order=("reading_ts", "k"), seconds=seconds)
        assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_change_points_tell_worse_from_better(spark):
    scores = [0.2] * 50 + [0.6] * 50 + [0.1] * 50
    rows = [("A", START + dt.timedelta(hours=k), s) for k, s in enumerate(scores)] + [("B", START, 0.5), ("B", START, None)]
    scored = spark.createDataFrame(rows, "machine_id STRING, reading_ts TIMESTAMP_NTZ, s DOUBLE").withColumn(
        "risk_score", F.col("s").cast("decimal(5,4)")
    )
    found = changes.change_points(scored, order=("reading_ts", "risk_score"), alarm=1.0).orderBy("reading_ts").collect()
    assert [(r["machine_id"], r["direction"]) for r in found] == [("A", "BETTER"), ("A", "WORSE"), ("A", "BETTER")]
    assert [(r["reading_ts"] - START) // dt.timedelta(hours=50) for r in found] == [0, 1, 2]


# baseline states ---------------------------------------------------------------------------------


def test_baseline_states_add_up(spark, fleet, tmp_path):
    tables.write_fact(fleet.telemetry, str(tmp_path / "t"))
    stored = tables.read_fact(spark, str(tmp_path / "t"))
    dates = sorted(r[0] for r in stored.select(tables.DATE).distinct().collect())
    for some in (set(dates[:-1]), {dates[-1]}, {dates[-1]}):
        baseline.refresh_baseline_states(stored, str(tmp_path / "s"), some)
    assert spark_rows(baseline.stored_baselines(spark, str(tmp_path / "s"))) == spark_rows(baseline.estimate_baselines(fleet.telemetry))
    middle = dates[len(dates) // 2]
    some = baseline.stored_baselines(spark, str(tmp_path / "s"), start=middle)
    expected = baseline.estimate_baselines(fleet.telemetry, start=F.lit(middle).cast("timestamp_ntz"))
    assert spark_rows(some) == spark_rows(expected)
    # Sketches against exact ranks: within five percent of a machine's values or one value.
    found = {r["machine_id"]: r for r in baseline.stored_quantiles(spark, str(tmp_path / "s"), 0.5).collect()}
    values: dict[str, list[float]] = {}
    for r in baseline.calm_readings(fleet.telemetry).filter("temperature_c IS NOT NULL").collect():
        values.setdefault(r["machine_id"], []).append(float(r["temperature_c"]))
    for machine, some in values.items():
        below = sum(v <= found[machine]["quantile_temp"] for v in some)
        assert abs(below - len(some) / 2) <= max(1.5, 0.05 * len(some))


def test_rows_without_key_are_not_repeats(spark):
    rows = [("A",), ("A",), ("B",), (None,), (None,)]
    raw = spark.createDataFrame(rows, "machine_id STRING")
    faults = {}
    for r in quality.split_valid(raw, REGISTRY, unique=True)[1].collect():
        faults.setdefault(r["machine_id"], set()).add(r["faults"])
    assert faults == {"A": {"machine_id:repeated"}, None: {"machine_id:required"}}
