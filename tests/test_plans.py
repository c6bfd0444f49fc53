"""Summaries and serving queries: corrections, filters, ties and plan shapes."""

from __future__ import annotations

import datetime as dt

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from millwatch.plans import features, serving, summary, views
from millwatch.plans.serving import Selection
from millwatch.sources import tables

T0 = dt.datetime(2024, 1, 10)
SCORED = (
    "machine_id STRING, reading_ts TIMESTAMP_NTZ, s STRING, risk_tier STRING, top_signal STRING, "
    "recommended_action STRING, model_version STRING"
)


def scored_of(spark, rows):
    full = [(m, T0 - dt.timedelta(hours=h), s, tier, sig, f"{tier}!", "V") for m, h, s, tier, sig in rows]
    return spark.createDataFrame(full, SCORED).withColumn("risk_score", F.expr("CAST(s AS DECIMAL(5,4))")).drop("s")


@pytest.fixture(scope="module")
def registry(spark):
    rows = [(f"M{i}", p, "PUMP" if i % 2 else "MIXER", "Z", "STANDARD") for i, p in enumerate(["P1", "p1 ", "P2", "P2", "P3", "P3"])]
    return spark.createDataFrame(rows, "machine_id STRING, plant_id STRING, machine_type STRING, location_zone STRING, criticality_class STRING")


@pytest.fixture(scope="module")
def scored(spark):
    return scored_of(
        spark,
        [
            ("M0", 0, "0.10", "LOW", "POWER"),
            ("M0", 20, "0.95", "CRITICAL", "VIBRATION"),
            ("M0", 200, "0.99", "CRITICAL", "VIBRATION"),
            ("M1", 5, "0.65", "HIGH", "PRESSURE"),
            ("M1", 5, "0.65", "HIGH", "TEMPERATURE"),
            ("M2", 30, "0.00", "DATA_LOSS", "VIBRATION"),
            ("M3", 1, "0.65", "HIGH", "POWER"),
            ("M4", 2, "0.80", "HIGH", "POWER"),
            ("M9", 1, "0.90", "CRITICAL", "POWER"),
        ],
    )


def test_latest_and_worst_differ_as_documented(scored, registry):
    latest = {r["machine_id"]: r for r in summary.latest_risk(scored, registry).collect()}
    assert set(latest) == {"M0", "M1", "M2", "M3", "M4"}  # no unknown M9, no silent M5
    assert str(latest["M0"]["risk_score"]) == "0.1000"
    assert latest["M1"]["top_signal"] == "PRESSURE"  # equal time and score: first signal name
    worst = {r["machine_id"]: r for r in summary.worst_recent_risk(scored, registry).collect()}
    assert str(worst["M0"]["risk_score"]) == "0.9500"  # the 0.99 is older than 144 hours
    assert len(worst) == 5


def test_trend_anchor(scored, registry):
    assert summary.risk_trend(scored, registry).count() == 6
    later = summary.risk_trend(scored, registry, as_of="2024-01-11 01:00:00")
    assert later.isEmpty()


@pytest.mark.parametrize("single_task_rows", [100, 1])
def test_queue_ranks_ties_by_machine(scored, registry, single_task_rows):
    latest = summary.latest_risk(scored, registry)
    queue = summary.actionable_queue(latest, registry, single_task_rows=single_task_rows)
    ranks = [(r["priority_rank"], r["machine_id"]) for r in queue.orderBy("priority_rank").collect()]
    assert ranks == [(1, "M4"), (2, "M1"), (3, "M3"), (4, "M0"), (5, "M2")]
    lost = queue.filter("machine_id = 'M2'").first()
    assert lost["reason"].startswith("Telemetry or sensor data missing")
    top = serving.top_actionable(queue, Selection(plants=["P2"]))
    assert [r["priority_rank"] for r in top.collect()] == [3, 5]  # fleet-wide ranks are kept


@pytest.mark.parametrize("single_task_rows", [100, 1])
def test_tier_pages_hold_every_machine_once(scored, registry, single_task_rows):
    latest = summary.latest_risk(scored, registry)
    whole = summary.tier_machine_list(latest, registry)
    assert {r["risk_tier"]: r["machine_ids"] for r in whole.collect()}["HIGH"] == "M1, M3, M4"
    paged = summary.tier_machine_list(latest, registry, page_size=2, single_task_rows=single_task_rows)
    high = [(r["page"], r["machine_ids"], r["machines"]) for r in paged.filter("risk_tier = 'HIGH'").collect()]
    assert sorted(high) == [(0, "M1, M3", 3), (1, "M4", 3)]


def test_filters(scored, registry):
    latest = summary.latest_risk(scored, registry)

    def machines(**kw):
        return {r["machine"] for r in serving.overview(latest, Selection(**kw)).collect()}

    assert machines() == {"M0", "M1", "M2", "M3", "M4"}
    assert machines(plants=[" p1"]) == {"M0", "M1"}
    assert machines(plants=[]) == set() and machines(plants=["", "  "]) == set()
    assert machines(tiers=["critical"]) == {"M4"}  # stored HIGH, read back from 0.80 as CRITICAL
    assert machines(tiers=[]) == set()
    assert machines(machine_types=["mixer"], tiers=["LOW"]) == {"M0", "M2"}


def test_kpis(scored, registry):
    latest = summary.latest_risk(scored, registry)
    kpi = [(r["risk_tier"], r["machine_count"], str(r["avg_score"])) for r in serving.kpi_by_tier(latest).collect()]
    assert kpi == [("CRITICAL", 1, "0.8000"), ("HIGH", 2, "0.6500"), ("LOW", 2, "0.0500")]
    cards = serving.kpi_cards(latest, Selection(plants=["P2"])).first().asDict()
    assert cards == {"critical": 0, "high": 1, "medium": 0, "low": 1, "machines": 2}
    nothing = serving.kpi_cards(latest, Selection(plants=[])).first().asDict()
    assert set(nothing.values()) == {0}


def test_mismatch_and_silence(scored, registry):
    odd = {r["machine_id"]: (r["risk_tier"], r["derived_tier"]) for r in summary.tier_mismatch(scored).collect()}
    assert odd == {"M2": ("DATA_LOSS", "LOW"), "M4": ("HIGH", "CRITICAL")}
    assert [r["machine_id"] for r in summary.silent_machines(registry, scored).collect()] == ["M5"]
    assert [r["machine_id"] for r in summary.data_loss_machines(summary.latest_risk(scored, registry)).collect()] == ["M2"]


def test_machine_choice_is_checked(registry):
    assert serving.check_machine(registry, " M3 ") == "M3"
    with pytest.raises(serving.UnknownMachine):
        serving.check_machine(registry, "M3' OR '1'='1")


def test_error_bars_take_every_code(spark):
    frequency = spark.createDataFrame([("A", "E1", 3), ("A", "E5", 1), ("B", "E5", 4)], "machine STRING, error_code STRING, occurrences BIGINT")
    rows = {r["machine"]: (r["E1"], r["E5"]) for r in serving.error_bars(frequency).collect()}
    assert rows == {"A": (3, 1), "B": (0, 4)}


def test_sql_views(spark, fleet):
    views.register_views(spark, fleet.telemetry, fleet.registry, fleet.scored)
    top = views.query(spark, "SELECT machine_id, priority_rank FROM V_ACTIONABLE_RISK WHERE is_top_5 ORDER BY priority_rank")
    assert top.columns == ["MACHINE_ID", "PRIORITY_RANK"] and top.count() == 5
    count = views.query_value(spark, "SELECT count(*) FROM MACHINE_TELEMETRY WHERE machine_id = ?", ["MCH_000007"])
    assert count == fleet.telemetry.filter("machine_id = 'MCH_000007'").count() > 0
    assert views.query_value(spark, "SELECT 1 WHERE false") is None
    assert spark.sql("SELECT count(*) FROM v_telemetry_features").first()[0] == fleet.telemetry.count()


def test_zero_spread_gives_no_z_score(fleet):
    rows = features.features(fleet.telemetry, fleet.registry, rolling=False)
    flat = rows.filter("baseline_stddev_temp = 0")
    assert flat.count() > 0 and flat.filter("z_temp IS NOT NULL").isEmpty()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_scores_are_pruned_by_column_range_and_machine(spark, fleet, tmp_path):
    path = str(tmp_path / "scored")
    tables.write_fact(fleet.scored, path)
    stored = tables.read_fact(spark, path)
    high = plan_of(serving.full_trend(stored, fleet.registry, Selection(tiers=["CRITICAL", "HIGH"])))
    assert "GreaterThanOrEqual(risk_score,0.6000)" in high
    assert "recommended_action" not in high
    history = plan_of(serving.score_history(stored, "MCH_000007"))
    assert "EqualTo(machine_id,MCH_000007)" in history
    latest = plan_of(summary.latest_scores(stored))
    assert latest.count("WindowGroupLimit") == 2


def test_unused_score_columns_are_not_computed(fleet):
    plan = plan_of(fleet.scored.agg(F.count("*")))
    assert "_z_vib" not in plan and "IMMEDIATE" not in plan


def test_top_n_is_not_a_full_sort(fleet):
    plan = plan_of(serving.last_readings(fleet.telemetry, "MCH_000007"))
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_error_groups_aggregate_before_the_registry_join(fleet):
    plan = plan_of(serving.error_groups(fleet.telemetry, fleet.registry))
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate")


def test_repeated_scoring_is_the_same(fleet):
    assert spark_rows(fleet.scored) == spark_rows(fleet.scored.repartition(5))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filters_reach_the_scan(spark):
    """Recent scores filter events by time before the rule runs."""
    import __spark_entry__ as driver

    for name in ("risk_trend_24h", "worst_recent_risk", "risk_slope"):
        df = driver.queries()[name](spark, "/root/testdata/sf0.001")
        lines = [x for x in _plan(df).splitlines() if "FileScan parquet" in x and "event_id" in x]
        assert any("DataFilters: [" in x and "ts#" in x.split("DataFilters:")[1] for x in lines), name


def test_hot_keys_are_salted_when_too_many_to_broadcast(spark):
    from millwatch.operators.joins import attach

    fact = spark.range(4000).selectExpr("concat('M', id % 7) AS machine_id", "id AS reading_id")
    fact = fact.unionByName(spark.range(4000).selectExpr("'M1' AS machine_id", "id AS reading_id"))
    dim = spark.range(7).selectExpr("concat('M', id) AS machine_id", "id * 10 AS base")
    plain = sorted(map(tuple, fact.join(dim, "machine_id").collect()))
    for limit in (0, 1, 100):
        got = attach(fact, dim, broadcast_rows=limit, hot_rows=300)
        assert sorted(map(tuple, got.select("machine_id", "reading_id", "base").collect())) == plain


def test_local_scratch_only_in_local_sessions(spark):
    from types import SimpleNamespace

    import pytest as _pytest

    from millwatch.session import shared_dir

    for master, fine in (("local[8]", True), ("local", True), ("spark://host:7077", False), ("local-cluster[3,2,1024]", False)):
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master))
        if fine:
            assert shared_dir(fake)
        else:
            with _pytest.raises(ValueError, match="spark.checkpoint.dir"):
                shared_dir(fake)


def test_carried_values_scan_their_input_once(spark):
    import __spark_entry__ as driver

    for name, scans in (("tier_transitions", 1), ("gap_fill", 1), ("alert_quality", 2)):
        df = driver.queries()[name](spark, "/root/testdata/sf0.001")
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
        assert sum("event_id" in x and "FileScan" in x for x in final.splitlines()) == scans, name
