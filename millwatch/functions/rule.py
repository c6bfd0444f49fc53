"""The risk rule as layered SQL expressions.

Each layer only reads columns of the layers before it, so an intermediate value
such as a z-score is computed once and read by every branch of the next CASE.
The same text drives the DataFrame path (``apply_rule``) and the SQL function
(``register_sql_function``); nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millwatch.config import ACTIONS, DATA_LOSS, DEFAULT_RULE, SIGNALS, RiskRule

Layer = list[tuple[str, str]]

# The argument order callers of the SQL function rely on.
RULE_ARGUMENTS = (
    ("machine_id", "STRING"),
    ("temperature_c", "DOUBLE"),
    ("vibration_mm_s", "DOUBLE"),
    ("pressure_bar", "DOUBLE"),
    ("runtime_hours", "DOUBLE"),
    ("power_kw", "DOUBLE"),
    ("error_code", "STRING"),
    ("baseline_temp_c", "DOUBLE"),
    ("baseline_vibration", "DOUBLE"),
    ("baseline_pressure_bar", "DOUBLE"),
    ("baseline_power_kw", "DOUBLE"),
    ("baseline_stddev_temp", "DOUBLE"),
    ("baseline_stddev_vibration", "DOUBLE"),
    ("hours_since_service", "DOUBLE"),
    ("service_interval_hours", "DOUBLE"),
)

COMPONENTS = ("c_vibration", "c_temperature", "c_pressure", "c_service", "c_power", "c_error")
RESULTS = ("rule_score", "risk_tier", "top_signal", "recommended_action")


def _num(value: float) -> str:
    return f"{value!r}D"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _first_known(*names: str, default: float) -> str:
    return f"coalesce({', '.join(f'CAST({n} AS DOUBLE)' for n in names)}, {_num(default)})"


def _ratio(top: str, bottom: str) -> str:
    """Division that gives 0 instead of failing on a zero divisor."""
    return f"coalesce(try_divide({top}, {bottom}), 0.0D)"


def _unit(x: str) -> str:
    return f"least(1.0D, greatest(0.0D, {x}))"


def _curve(z: str, rule: RiskRule) -> str:
    """Continuous piecewise line through the rule's knots; only the last piece saturates."""
    pieces = [
        f"{_num(base)} + ({z} - {_num(start)}) * {_num(slope)}" if start else f"{z} * {_num(slope)}"
        for start, base, slope in rule.curve
    ]
    ends = [start for start, _, _ in rule.curve[1:]]
    branches = " ".join(f"WHEN {z} < {_num(e)} THEN {p}" for e, p in zip(ends, pieces))
    return f"CASE {branches} ELSE {_unit(pieces[-1])} END"


def _weight(part: str, rule: RiskRule) -> str:
    default = _num(getattr(rule.weights, part))
    if not rule.type_weights:
        return default
    branches = " ".join(
        f"WHEN {_text(kind)} THEN {_num(getattr(w, part))}" for kind, w in rule.type_weights.items()
    )
    return f"CASE machine_type {branches} ELSE {default} END"


def tier_case(score: str, rule: RiskRule = DEFAULT_RULE, literal=_num) -> str:
    branches = " ".join(
        f"WHEN {score} >= {literal(cut)} THEN {_text(tier)}" for tier, cut in rule.thresholds()
    )
    return f"CASE {branches} ELSE 'LOW' END"


def rule_layers(rule: RiskRule = DEFAULT_RULE) -> list[Layer]:
    inputs: Layer = [
        ("_temp", _first_known("temperature_c", "baseline_temp_c", default=0.0)),
        ("_vib", _first_known("vibration_mm_s", "baseline_vibration", default=0.0)),
        ("_pres", _first_known("pressure_bar", "baseline_pressure_bar", default=0.0)),
        ("_power", _first_known("power_kw", "baseline_power_kw", default=0.0)),
        ("_base_temp", _first_known("baseline_temp_c", default=0.0)),
        ("_base_vib", _first_known("baseline_vibration", default=0.0)),
        ("_base_pres", _first_known("baseline_pressure_bar", default=0.0)),
        ("_base_power", _first_known("baseline_power_kw", default=0.0)),
        ("_sd_temp", _first_known("baseline_stddev_temp", default=1.0)),
        ("_sd_vib", _first_known("baseline_stddev_vibration", default=1.0)),
        ("_hours", _first_known("hours_since_service", default=0.0)),
        (
            "_interval",
            _first_known("service_interval_hours", default=rule.default_interval_hours),
        ),
        (
            "_critical_error",
            f"startswith(coalesce(error_code, ''), {_text(rule.critical_error_prefix)})",
        ),
        ("_lost", "temperature_c IS NULL OR vibration_mm_s IS NULL"),
    ]
    deviations: Layer = [
        ("_z_vib", f"abs({_ratio('_vib - _base_vib', '_sd_vib')})"),
        ("_z_temp", f"abs({_ratio('_temp - _base_temp', '_sd_temp')})"),
        ("_pres_dev", f"abs({_ratio('_pres - _base_pres', '_base_pres')})"),
        ("_power_dev", f"abs({_ratio('_power - _base_power', '_base_power')})"),
        ("_service_used", _ratio("_hours", "_interval")),
    ]
    components: Layer = [
        ("c_vibration", _curve("_z_vib", rule)),
        ("c_temperature", _curve("_z_temp", rule)),
        ("c_pressure", _unit(f"_pres_dev * {_num(rule.pressure_gain)}")),
        (
            "c_service",
            _unit(f"(_service_used - {_num(rule.service_start)}) / {_num(rule.service_ramp)}"),
        ),
        ("c_power", _unit(f"_power_dev * {_num(rule.power_gain)}")),
        ("c_error", "CASE WHEN _critical_error THEN 1.0D ELSE 0.0D END"),
    ]
    # The order of the terms fixes the floating-point result; keep it.
    weighted = " + ".join(
        f"c_{part} * {_weight(part, rule)}"
        for part in ("vibration", "temperature", "pressure", "service", "power")
    )
    totals: Layer = [
        ("_raw", f"{weighted} + c_error * {_num(rule.error_premium)}"),
        ("_peak", f"greatest({', '.join(COMPONENTS)})"),
    ]
    leading = " ".join(f"WHEN {c} = _peak THEN {_text(s)}" for c, s in zip(COMPONENTS, SIGNALS))
    verdict: Layer = [
        ("rule_score", f"CASE WHEN _lost THEN 0.0D ELSE {_unit('_raw')} END"),
        ("top_signal", f"CASE {leading} END"),
    ]
    tier: Layer = [
        (
            "risk_tier",
            f"CASE WHEN _lost THEN {_text(DATA_LOSS)} ELSE {tier_case('rule_score', rule)} END",
        )
    ]
    before, after = ACTIONS["MEDIUM"]
    plain = " ".join(
        f"WHEN {_text(t)} THEN {_text(ACTIONS[t])}" for t in (DATA_LOSS, "CRITICAL", "HIGH")
    )
    action: Layer = [
        (
            "recommended_action",
            f"CASE risk_tier {plain} "
            f"WHEN 'MEDIUM' THEN concat({_text(before)}, top_signal, {_text(after)}) "
            f"ELSE {_text(ACTIONS['LOW'])} END",
        )
    ]
    return [inputs, deviations, components, totals, verdict, tier, action]


def _layered(source: str, rule: RiskRule) -> str:
    """``source`` with every layer's columns added by one nested SELECT each."""
    for layer in rule_layers(rule):
        added = ", ".join(f"{sql} AS {name}" for name, sql in layer)
        source = f"(SELECT *, {added} FROM {source})"
    return source


def apply_rule(
    readings: DataFrame, rule: RiskRule = DEFAULT_RULE, *, keep_components: bool = False
) -> DataFrame:
    """Add ``rule_score`` (unrounded), ``risk_tier``, ``top_signal``, ``recommended_action``.

    Works on batch and streaming frames: only row-level expressions, no shuffle.
    """
    kept = ", ".join([*readings.columns, *RESULTS, *(COMPONENTS if keep_components else ())])
    return readings.sparkSession.sql(
        f"SELECT {kept} FROM {_layered('{readings}', rule)}", readings=readings
    )


def stored_score(score: str) -> str:
    """Half-up narrowing to DECIMAL(5,4); a plain cast of a double rounds ties unevenly."""
    return (
        f"CAST(CAST(floor({score} * 10000.0D + 0.5D) AS DECIMAL(9,0)) * 0.0001BD AS DECIMAL(5,4))"
    )


def register_sql_function(
    spark: SparkSession, name: str = "compute_risk_score", rule: RiskRule = DEFAULT_RULE
) -> None:
    """Make the rule callable from SQL as a native function returning a struct."""
    if rule.type_weights:
        raise ValueError("the SQL function has no machine_type argument; use apply_rule")
    inputs = ", ".join(f"p_{arg} AS {arg}" for arg, _ in RULE_ARGUMENTS)
    body = _layered(f"(SELECT {inputs})", rule)
    arguments = ", ".join(f"p_{arg} {kind}" for arg, kind in RULE_ARGUMENTS)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) "
        "RETURNS STRUCT<risk_score DOUBLE, risk_tier STRING, top_signal STRING, "
        "recommended_action STRING> "
        "RETURN (SELECT struct(rule_score AS risk_score, risk_tier, top_signal, "
        f"recommended_action) FROM {body})"
    )


def register_table_function(
    spark: SparkSession, name: str = "score_reading", rule: RiskRule = DEFAULT_RULE
) -> None:
    """Make the rule callable as a native table function of one row per call.

    ``SELECT ... FROM readings r, LATERAL score_reading(r.temperature_c, ...)`` is planned as
    a projection of the readings: no join, no shuffle, no Python.
    """
    if rule.type_weights:
        raise ValueError("the SQL function has no machine_type argument; use apply_rule")
    inputs = ", ".join(f"p_{arg} AS {arg}" for arg, _ in RULE_ARGUMENTS)
    arguments = ", ".join(f"p_{arg} {kind}" for arg, kind in RULE_ARGUMENTS)
    results = ", ".join([*RESULTS, *COMPONENTS])
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE("
        "rule_score DOUBLE, risk_tier STRING, top_signal STRING, recommended_action STRING, "
        + ", ".join(f"{c} DOUBLE" for c in COMPONENTS)
        + f") RETURN SELECT {results} FROM {_layered(f'(SELECT {inputs})', rule)}"
    )
