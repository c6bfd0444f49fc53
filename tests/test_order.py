"""Sequences: queries that promise an order are collected and compared row by row."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from millwatch.plans import serving
from millwatch.plans.serving import Selection


def sequence(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def latest(fleet):
    return fleet.latest.cache()


def test_overview_is_riskiest_first(latest):
    rows = [(r["score"], r["machine"]) for r in serving.overview(latest).collect()]
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1])) and len(rows) > 5


def test_top_five_follow_the_queue(fleet):
    ranks = [r["priority_rank"] for r in serving.top_actionable(fleet.queue, driver.CHOICE).collect()]
    assert ranks == sorted(ranks) and 0 < len(ranks) <= 5


def test_drill_downs(fleet):
    last = [r["reading_time"] for r in serving.last_readings(fleet.telemetry, driver.MACHINE).collect()]
    assert last == sorted(last, reverse=True)
    history = [r["reading_ts"] for r in serving.score_history(fleet.scored_machine, driver.MACHINE).collect()]
    assert history == sorted(history) and len(history) > 1
    trend = [r["reading_ts"] for r in serving.full_trend(fleet.scored, fleet.registry).collect()]
    assert trend == sorted(trend)


def test_lists_and_groups(fleet, latest):
    for df in (serving.distinct_plants(fleet.registry), serving.distinct_tiers(latest), serving.machine_list(fleet.registry)):
        rows = sequence(df)
        assert rows == sorted(rows) and rows
    errors = [r["occurrences"] for r in serving.error_frequency(fleet.telemetry, fleet.registry).collect()]
    assert errors == sorted(errors, reverse=True)
    tiers = [r["risk_tier"] for r in serving.kpi_by_tier(latest).collect()]
    severity = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    assert tiers == sorted(tiers, key=severity.index)


def test_empty_choices_select_nothing(fleet, latest):
    nothing = Selection(plants=[], tiers=[])
    assert sequence(serving.overview(latest, nothing)) == []
    assert sequence(serving.kpi_by_tier(latest, nothing)) == []
    assert sequence(serving.top_actionable(fleet.queue, nothing)) == []
    assert sequence(serving.full_trend(fleet.scored, fleet.registry, nothing)) == []
    assert serving.kpi_cards(latest, nothing).first()["machines"] == 0


def test_unknown_machine(fleet):
    with pytest.raises(serving.UnknownMachine):
        serving.check_machine(fleet.registry, "MCH_999999")
    assert serving.check_machine(fleet.registry, f" {driver.MACHINE} ") == driver.MACHINE
