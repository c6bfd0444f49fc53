"""DuckDB SQL that states, independently of the Spark code, what each query must return."""

from __future__ import annotations

MACHINE = "MCH_000007"

# Action, reason, tier and signal texts below are fixed values of the result contract.

BASE = """
registry AS (
  SELECT concat('MCH_', lpad(CAST(c.c_custkey AS VARCHAR), 6, '0')) AS machine_id,
         r.r_name AS plant_id,
         CASE c.c_custkey % 5 WHEN 0 THEN 'COMPRESSOR' WHEN 1 THEN 'PUMP' WHEN 2 THEN 'TURBINE'
              WHEN 3 THEN 'CONVEYOR' ELSE 'MIXER' END AS machine_type,
         CASE c.c_custkey % 3 WHEN 0 THEN 'ZONE_A' WHEN 1 THEN 'ZONE_B' ELSE 'ZONE_C' END AS location_zone,
         CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'CRITICAL' ELSE 'STANDARD' END AS criticality_class,
         CAST(40 + 15 * (c.c_custkey % 5) AS DECIMAL(6,2)) AS baseline_temp_c,
         CAST(1 + 0.5 * (c.c_custkey % 5) AS DECIMAL(6,3)) AS baseline_vibration,
         CAST(4 + 3 * (c.c_custkey % 5) AS DECIMAL(6,2)) AS baseline_pressure_bar,
         CAST(40 + 60 * (c.c_custkey % 5) AS DECIMAL(8,2)) AS baseline_power_kw,
         CAST(CASE WHEN c.c_custkey % 13 = 7 THEN 0 ELSE 2 + 0.5 * (c.c_custkey % 3) END AS DECIMAL(6,3)) AS baseline_stddev_temp,
         CAST(0.2 + 0.1 * (c.c_custkey % 3) AS DECIMAL(6,3)) AS baseline_stddev_vibration,
         CAST(600 + 200 * (c.c_custkey % 4) AS DECIMAL(8,1)) AS service_interval_hours,
         TIMESTAMP '2023-12-20 00:00:00' AS last_service_ts
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey),
telemetry AS (
  SELECT e.event_id AS reading_id, g.machine_id, e.ts AS reading_ts,
         CASE WHEN e.event_id % 53 = 0 THEN NULL ELSE
           CAST(g.baseline_temp_c + ((e.event_id * 37) % 101 - 30) * 0.1 AS DECIMAL(7,2)) END AS temperature_c,
         CASE WHEN e.event_id % 59 = 0 THEN NULL ELSE
           CAST(g.baseline_vibration + ((e.event_id * 61) % 113 - 30) * 0.02 AS DECIMAL(7,3)) END AS vibration_mm_s,
         CASE WHEN e.event_id % 31 = 0 THEN NULL ELSE
           CAST(g.baseline_pressure_bar * (70 + (e.event_id * 29) % 61) * 0.01 AS DECIMAL(7,2)) END AS pressure_bar,
         CAST(e.value AS DECIMAL(8,2)) AS power_kw,
         CASE WHEN e.event_id % 41 = 0 THEN 'MAINTENANCE' WHEN e.event_id % 211 = 0 THEN NULL
              WHEN e.event_type = 'signup' THEN 'STARTUP' WHEN e.event_type = 'view' THEN 'IDLE' ELSE 'RUNNING' END AS operating_mode,
         CASE WHEN e.event_type <> 'error' THEN NULL WHEN e.event_id % 4 = 0 THEN concat('E5', CAST(10 + e.event_id % 90 AS VARCHAR))
              WHEN e.event_id % 4 = 1 THEN 'E101' WHEN e.event_id % 4 = 2 THEN ' E512 ' ELSE '' END AS error_code
  FROM events e JOIN registry g ON g.machine_id = concat('MCH_', lpad(CAST(e.user_id AS VARCHAR), 6, '0')))
"""

FEATURES = """
features AS (
  SELECT t.*, r.* EXCLUDE (machine_id),
         (CAST(t.temperature_c AS DOUBLE) - CAST(r.baseline_temp_c AS DOUBLE))
           / nullif(CAST(r.baseline_stddev_temp AS DOUBLE), 0) AS z_temp,
         (CAST(t.vibration_mm_s AS DOUBLE) - CAST(r.baseline_vibration AS DOUBLE))
           / nullif(CAST(r.baseline_stddev_vibration AS DOUBLE), 0) AS z_vibration,
         CAST(date_diff('microsecond', r.last_service_ts, t.reading_ts) AS DOUBLE) / 1e6 / 3600 AS hours_since_service
  FROM telemetry t JOIN registry r USING (machine_id))
"""

SCORED = """
inputs AS (
  SELECT machine_id, reading_ts, reading_id,
         CAST(coalesce(temperature_c, baseline_temp_c) AS DOUBLE) AS temp,
         CAST(coalesce(vibration_mm_s, baseline_vibration) AS DOUBLE) AS vib,
         CAST(coalesce(pressure_bar, baseline_pressure_bar) AS DOUBLE) AS pres,
         CAST(coalesce(power_kw, baseline_power_kw) AS DOUBLE) AS pwr,
         CAST(baseline_temp_c AS DOUBLE) AS bt, CAST(baseline_vibration AS DOUBLE) AS bv,
         CAST(baseline_pressure_bar AS DOUBLE) AS bp, CAST(baseline_power_kw AS DOUBLE) AS bw,
         CAST(baseline_stddev_temp AS DOUBLE) AS st, CAST(baseline_stddev_vibration AS DOUBLE) AS sv,
         hours_since_service AS hrs, CAST(service_interval_hours AS DOUBLE) AS itv,
         temperature_c IS NULL OR vibration_mm_s IS NULL AS lost,
         coalesce(starts_with(trim(error_code), 'E5'), FALSE) AS e5
  FROM features WHERE operating_mode <> 'MAINTENANCE'),
deviations AS (
  SELECT *, abs(coalesce((vib - bv) / nullif(sv, 0), 0e0)) AS zv,
         abs(coalesce((temp - bt) / nullif(st, 0), 0e0)) AS zt,
         abs(coalesce((pres - bp) / nullif(bp, 0), 0e0)) AS dp,
         coalesce(hrs / nullif(itv, 0), 0e0) AS ov,
         abs(coalesce((pwr - bw) / nullif(bw, 0), 0e0)) AS dw
  FROM inputs),
components AS (
  SELECT *, CASE WHEN zv < 1 THEN zv * 0.15e0 WHEN zv < 2 THEN 0.15e0 + (zv - 1e0) * 0.3e0
                 WHEN zv < 3 THEN 0.45e0 + (zv - 2e0) * 0.35e0
                 ELSE least(1e0, greatest(0e0, 0.8e0 + (zv - 3e0) * 0.1e0)) END AS cv,
         CASE WHEN zt < 1 THEN zt * 0.15e0 WHEN zt < 2 THEN 0.15e0 + (zt - 1e0) * 0.3e0
              WHEN zt < 3 THEN 0.45e0 + (zt - 2e0) * 0.35e0
              ELSE least(1e0, greatest(0e0, 0.8e0 + (zt - 3e0) * 0.1e0)) END AS ct,
         least(1e0, greatest(0e0, dp * 3e0)) AS cp,
         least(1e0, greatest(0e0, (ov - 0.8e0) / 0.2e0)) AS cs,
         least(1e0, greatest(0e0, dw * 2.5e0)) AS cw,
         CASE WHEN e5 THEN 1e0 ELSE 0e0 END AS ce
  FROM deviations),
verdicts AS (
  SELECT *, CASE WHEN lost THEN 0e0 ELSE least(1e0, greatest(0e0,
              cv * 0.3e0 + ct * 0.25e0 + cp * 0.2e0 + cs * 0.15e0 + cw * 0.1e0 + ce * 0.25e0)) END AS score,
         CASE greatest(cv, ct, cp, cs, cw, ce) WHEN cv THEN 'VIBRATION' WHEN ct THEN 'TEMPERATURE'
              WHEN cp THEN 'PRESSURE' WHEN cs THEN 'SERVICE_OVERDUE' WHEN cw THEN 'POWER'
              ELSE 'ERROR_CODE_E5XX' END AS top_signal
  FROM components),
tiers AS (
  SELECT *, CASE WHEN lost THEN 'DATA_LOSS' WHEN score >= 0.8e0 THEN 'CRITICAL' WHEN score >= 0.6e0 THEN 'HIGH'
                 WHEN score >= 0.35e0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
  FROM verdicts),
scored AS (
  SELECT machine_id, reading_ts, reading_id,
         CAST(CAST(floor(score * 10000 + 0.5) AS BIGINT) * 0.0001 AS DECIMAL(5,4)) AS risk_score,
         risk_tier, top_signal,
         CASE risk_tier
           WHEN 'DATA_LOSS' THEN 'DATA LOSS — investigate telemetry connectivity / sensor health immediately'
           WHEN 'CRITICAL' THEN 'IMMEDIATE SHUTDOWN — schedule emergency maintenance within 4 hours'
           WHEN 'HIGH' THEN 'URGENT — schedule maintenance within 24 hours; increase monitoring frequency'
           WHEN 'MEDIUM' THEN concat('MONITOR — plan maintenance within 7 days; review ', top_signal, ' readings')
           ELSE 'NORMAL — continue standard monitoring schedule' END AS recommended_action,
         'RULE_V1' AS model_version
  FROM tiers)
"""

LATEST = """
latest AS (
  SELECT s.machine_id, r.plant_id, r.machine_type, r.location_zone, r.criticality_class, s.reading_ts,
         s.risk_score, s.risk_tier, s.top_signal, s.recommended_action, s.model_version
  FROM scored s JOIN registry r USING (machine_id)
  QUALIFY row_number() OVER (PARTITION BY s.machine_id
    ORDER BY s.reading_ts DESC, s.risk_score DESC, s.top_signal, s.reading_id DESC) = 1)
"""

DERIVED = (
    "CASE WHEN {s} >= 0.80 THEN 'CRITICAL' WHEN {s} >= 0.60 THEN 'HIGH' "
    "WHEN {s} >= 0.35 THEN 'MEDIUM' ELSE 'LOW' END"
)

QUEUE = """
queue AS (
  SELECT machine_id, plant_id, machine_type, location_zone, criticality_class, reading_ts, risk_score, risk_tier,
         top_signal, recommended_action AS action,
         CASE WHEN risk_tier = 'DATA_LOSS' THEN 'Telemetry or sensor data missing - investigate connectivity'
              WHEN top_signal = 'VIBRATION' THEN 'Elevated vibration relative to baseline (Z-score)'
              WHEN top_signal = 'TEMPERATURE' THEN 'Elevated temperature relative to baseline (Z-score)'
              WHEN top_signal = 'PRESSURE' THEN 'Pressure deviation from baseline'
              WHEN top_signal = 'POWER' THEN 'Power draw anomaly relative to baseline'
              WHEN top_signal = 'SERVICE_OVERDUE' THEN 'Approaching or past scheduled service interval'
              WHEN top_signal = 'ERROR_CODE_E5XX' THEN 'Critical error code observed (E5xx)'
              ELSE top_signal END AS reason,
         row_number() OVER (ORDER BY risk_score DESC, machine_id) AS priority_rank
  FROM latest)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_B = _with(BASE)
_F = _with(BASE, FEATURES)
_S = _with(BASE, FEATURES, SCORED)
_L = _with(BASE, FEATURES, SCORED, LATEST)
_Q = _with(BASE, FEATURES, SCORED, LATEST, QUEUE)

_SCORE_COLUMNS = (
    "machine_id, reading_ts, reading_id, CAST(risk_score AS DOUBLE) AS risk_score, risk_tier, "
    "top_signal, recommended_action, model_version"
)
_LATEST_COLUMNS = (
    "machine_id, plant_id, machine_type, location_zone, criticality_class, reading_ts, "
    "CAST(risk_score AS DOUBLE) AS risk_score, risk_tier, top_signal, recommended_action, model_version"
)
_TELEMETRY_COLUMNS = (
    "reading_id, machine_id, reading_ts, CAST(temperature_c AS DOUBLE) AS temperature_c, "
    "CAST(vibration_mm_s AS DOUBLE) AS vibration_mm_s, CAST(pressure_bar AS DOUBLE) AS pressure_bar, "
    "CAST(power_kw AS DOUBLE) AS power_kw, operating_mode, error_code"
)
_AVG = (
    "CAST(CAST((2 * sum(CAST({s} * 10000 AS BIGINT)) + count({s})) // (2 * count({s})) AS BIGINT) "
    "* 0.0001 AS DOUBLE)"
)
_ROLL = (
    "OVER (PARTITION BY machine_id ORDER BY reading_ts "
    "RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)"
)


def _rolling(column: str, scale: int) -> str:
    whole = f"CAST({column} * {scale} AS BIGINT)"
    return (
        f"CAST(sum({whole}) {_ROLL} AS DOUBLE) / "
        f"nullif(CAST(count({whole}) {_ROLL} AS DOUBLE) * {scale}e0, 0)"
    )


_TIER = DERIVED.format(s="risk_score")
_PLANT_TIER = f"upper(trim(plant_id)) IN ('EUROPE', 'ASIA') AND {_TIER} IN ('CRITICAL', 'HIGH')"

_CHANGES = """
  SELECT machine_id, reading_ts, previous_ts, previous_tier, risk_tier,
         CAST(previous_score AS DOUBLE) AS previous_score, CAST(risk_score AS DOUBLE) AS risk_score,
         CASE WHEN previous_tier = 'DATA_LOSS' OR risk_tier = 'DATA_LOSS' THEN NULL ELSE
           list_position(['LOW','MEDIUM','HIGH','CRITICAL'], risk_tier)
           > list_position(['LOW','MEDIUM','HIGH','CRITICAL'], previous_tier) END AS escalated
  FROM (SELECT *, lag(risk_tier) OVER w AS previous_tier, lag(reading_ts) OVER w AS previous_ts,
               lag(risk_score) OVER w AS previous_score
        FROM scored WINDOW w AS (PARTITION BY machine_id ORDER BY reading_ts, reading_id))
  WHERE previous_tier <> risk_tier"""

_PINGS = """
pings AS (
  SELECT *, reading_ts + INTERVAL 5 SECONDS AS load_ts FROM telemetry
  UNION ALL SELECT *, reading_ts + INTERVAL 60 SECONDS AS load_ts FROM telemetry WHERE error_code IS NOT NULL)
"""


def _mean(column: str, scale: int) -> str:
    return f"CAST(sum(CAST({column} * {scale} AS BIGINT)) AS DOUBLE) / nullif(CAST(count({column}) AS DOUBLE) * {scale}e0, 0)"


def _baseline(column: str, scale: int, name: str) -> str:
    v = f"CAST({column} * {scale} AS HUGEINT)"
    n = f"count({column})"
    return (
        f"{_mean(column, scale)} AS mean_{name}, "
        f"sqrt(CAST({n} * sum({v} * {v}) - sum({v}) * sum({v}) AS DOUBLE) "
        f"/ nullif(CAST({n} * ({n} - 1) AS DOUBLE), 0)) / {scale}e0 AS stddev_{name}"
    )


def _filled(column: str) -> str:
    over = "OVER (PARTITION BY machine_id ORDER BY reading_ts, reading_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    last = f"last_value({column} IGNORE NULLS) {over}"
    at = f"last_value(CASE WHEN {column} IS NOT NULL THEN reading_ts END IGNORE NULLS) {over}"
    return f"CASE WHEN {at} >= reading_ts - INTERVAL 6 HOURS THEN {last} END"


def _required(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'required' AS rule, count(*) FILTER ({c} IS NULL) AS violations FROM telemetry"
        for c in columns
    )


REGISTRY_LENGTHS = {
    "machine_id": 20,
    "plant_id": 10,
    "machine_type": 50,
    "location_zone": 20,
    "criticality_class": 10,
}
REGISTRY_TYPED = {
    "install_date": "DATE",
    "baseline_temp_c": "DECIMAL(6,2)",
    "baseline_vibration": "DECIMAL(6,3)",
    "baseline_pressure_bar": "DECIMAL(6,2)",
    "baseline_power_kw": "DECIMAL(8,2)",
    "baseline_stddev_temp": "DECIMAL(6,3)",
    "baseline_stddev_vibration": "DECIMAL(6,3)",
    "service_interval_hours": "DECIMAL(8,1)",
    "last_service_ts": "TIMESTAMP",
}


def _domain() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, 'length' AS rule, count(*) FILTER (length({c}) > {n}) AS violations FROM registry"
        for c, n in REGISTRY_LENGTHS.items()
    ] + [
        f"SELECT '{c}', 'type', count(*) FILTER (TRY_CAST(CAST({c} AS VARCHAR) AS {t}) IS NULL) FROM dated"
        for c, t in REGISTRY_TYPED.items()
    ]
    broken = "CASE WHEN machine_id LIKE '%3' THEN 'soon' ELSE '2020-01-01' END"
    dated = f"dated AS (SELECT *, {broken} AS install_date FROM registry)"
    return f"{_with(BASE, dated)} {' UNION ALL '.join(parts)}"


def _anomaly() -> str:
    """Every reading in every tree, leaf masses by a window, no packed tables."""

    def whole(value: str, scale: int) -> str:
        return f"CAST({value} * {scale} AS BIGINT)"

    def clamped(value: str) -> str:
        return f"CASE WHEN ({value}) IS NOT NULL THEN greatest(0, least(8191, {value})) END"

    spots = [
        f"{whole('(temperature_c - baseline_temp_c)', 100)} + 4096",
        f"{whole('(vibration_mm_s - baseline_vibration)', 1000)} + 4096",
        f"{whole('pressure_bar', 100)} * 4096 // nullif({whole('baseline_pressure_bar', 100)}, 0)",
        f"{whole('power_kw', 100)} * 4096 // nullif({whole('baseline_power_kw', 100)}, 0)",
    ]
    return f"""{_F}, spots AS (SELECT reading_id, machine_id, reading_ts, [{', '.join(map(clamped, spots))}] AS p FROM features),
        trees AS (SELECT t, t % 4 AS a, (t % 4 + 1 + t // 4 % 3) % 4 AS b, 2 + t % 3 AS ka, 4 - t % 3 AS kb,
          (t * 7919 + 117074) % 8192 AS sa, (t * 7919 + 221803) % 8192 AS sb FROM range(36) r(t)),
        placed AS (SELECT s.*, t, (p[a + 1] + sa) * (1 << ka) // 16384 AS x, (p[b + 1] + sb) * (1 << kb) // 16384 AS y
          FROM spots s CROSS JOIN trees),
        massed AS (SELECT *, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN
          length(bin(count(*) OVER (PARTITION BY t, x, y))) END AS bits FROM placed)
        SELECT reading_id, machine_id, reading_ts, 1e0 - CAST(sum(bits) AS DOUBLE)
          / nullif(CAST(count(bits) * length(bin((SELECT count(*) FROM spots))) AS DOUBLE), 0) AS anomaly_score
        FROM massed GROUP BY reading_id, machine_id, reading_ts"""


def oracle_sql() -> dict[str, str]:
    feature_columns = (
        f"{_TELEMETRY_COLUMNS}, z_temp, z_vibration, hours_since_service, plant_id, machine_type, criticality_class, "
        "CAST(service_interval_hours AS DOUBLE) AS service_interval_hours, "
        + ", ".join(
            f"CAST(baseline_{b} AS DOUBLE) AS baseline_{b}"
            for b in ("temp_c", "vibration", "pressure_bar", "power_kw", "stddev_temp", "stddev_vibration")
        )
    )
    rolling = (
        f"{_rolling('temperature_c', 100)} AS rolling_avg_temp_24h, "
        f"{_rolling('vibration_mm_s', 1000)} AS rolling_avg_vibration_24h"
    )
    score_all = f"{_S} SELECT {_SCORE_COLUMNS} FROM scored"
    latest_risk = f"{_L} SELECT {_LATEST_COLUMNS} FROM latest"
    changes = f"{_S} {_CHANGES}"
    top5 = f"""{_Q} SELECT machine_id AS machine, plant_id AS plant, machine_type,
        strftime(reading_ts, '%Y-%m-%d %H:%M') AS last_reading, CAST(risk_score AS DOUBLE) AS score,
        risk_tier, reason, action, priority_rank FROM queue"""
    tier_counts = ", ".join(
        f"count(DISTINCT CASE WHEN {_TIER} = '{t}' THEN machine_id END) AS {t.lower()}"
        for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW")
    )
    frequency = """SELECT t.machine_id AS machine, r.plant_id AS plant, t.error_code, count(*) AS occurrences,
        strftime(min(t.reading_ts), '%Y-%m-%d %H:%M') AS first_seen,
        strftime(max(t.reading_ts), '%Y-%m-%d %H:%M') AS last_seen
        FROM telemetry t JOIN registry r USING (machine_id)
        WHERE t.error_code IS NOT NULL AND trim(t.error_code) <> '' {more}
        GROUP BY t.machine_id, r.plant_id, t.error_code
        ORDER BY count(*) DESC, machine, t.error_code LIMIT 50"""
    trend = f"""SELECT s.machine_id AS machine, r.plant_id AS plant, s.reading_ts,
        CAST(s.risk_score AS DOUBLE) AS risk_score, {DERIVED.format(s='s.risk_score')} AS risk_tier, s.top_signal
        FROM scored s JOIN registry r USING (machine_id)"""
    hourly_base = f"""machine_id, date_trunc('hour', reading_ts) AS hour_start, count(*) AS readings,
        {_mean('temperature_c', 100)} AS avg_temperature_c"""
    hourly = f"""{_B} SELECT {hourly_base}, CAST(max(temperature_c) AS DOUBLE) AS max_temperature_c,
        {_mean('vibration_mm_s', 1000)} AS avg_vibration_mm_s,
        CAST(max(vibration_mm_s) AS DOUBLE) AS max_vibration_mm_s,
        count(*) FILTER (trim(error_code) <> '') AS errors
        FROM telemetry GROUP BY machine_id, hour_start"""
    baselines = f"""{_B} SELECT machine_id, count(*) AS readings, {_baseline('temperature_c', 100, 'temp')},
            {_baseline('vibration_mm_s', 1000, 'vibration')}, {_baseline('pressure_bar', 100, 'pressure')},
            {_baseline('power_kw', 100, 'power')}
            FROM telemetry WHERE operating_mode = 'RUNNING' AND nullif(trim(error_code), '') IS NULL
            GROUP BY machine_id"""
    later = SCORED
    for old, new in (("0.8e0 THEN 'CRITICAL'", "0.7e0 THEN 'CRITICAL'"), ("0.6e0 THEN 'HIGH'", "0.5e0 THEN 'HIGH'"),
                     ("cv * 0.3e0 + ct * 0.25e0", "cv * 0.4e0 + ct * 0.15e0"), ("ce * 0.25e0", "ce * 0.35e0"),
                     ("'RULE_V1'", "'RULE_V2'")):
        later = later.replace(old, new)
    change = "TIMESTAMP '2024-01-16 00:00:00'"
    tiers = f"""{_S} SELECT risk_tier, count(*) AS reading_count,
            count(DISTINCT machine_id) AS machine_count, {_AVG.format(s='risk_score')} AS avg_score,
            CAST(min(risk_score) AS DOUBLE) AS min_score, CAST(max(risk_score) AS DOUBLE) AS max_score
            FROM scored GROUP BY risk_tier"""
    return {
        "features": f"{_F} SELECT {feature_columns}, {rolling} FROM features",
        "rolling_24h": f"{_B} SELECT reading_id, machine_id, reading_ts, {rolling} FROM telemetry",
        "score_all": score_all,
        "score_components": f"""{_S} SELECT machine_id, reading_ts, reading_id, cv AS c_vibration, ct AS c_temperature,
            cp AS c_pressure, cs AS c_service, cw AS c_power, ce AS c_error FROM components""",
        "sql_function_score": score_all,
        "sql_table_function_score": score_all,
        "tier_distribution_state": tiers,
        "tier_distribution": tiers,
        "latest_risk": latest_risk,
        "latest_incremental": latest_risk,
        "worst_recent_risk": f"""{_S} SELECT s.machine_id, r.plant_id, r.machine_type, r.location_zone,
            r.criticality_class, s.reading_ts, CAST(s.risk_score AS DOUBLE) AS risk_score, s.risk_tier, s.top_signal,
            s.recommended_action, s.model_version
            FROM scored s JOIN registry r USING (machine_id)
            WHERE s.reading_ts >= (SELECT max(reading_ts) FROM scored) - INTERVAL 144 HOURS
            QUALIFY row_number() OVER (PARTITION BY s.machine_id
              ORDER BY s.risk_score DESC, s.reading_ts DESC, s.top_signal, s.reading_id DESC) = 1""",
        "risk_trend_24h": f"""{_S} SELECT s.machine_id, r.plant_id, r.machine_type, s.reading_ts,
            CAST(s.risk_score AS DOUBLE) AS risk_score, s.risk_tier, s.top_signal
            FROM scored s JOIN registry r USING (machine_id)
            WHERE s.reading_ts >= (SELECT max(reading_ts) FROM scored) - INTERVAL 24 HOURS""",
        "actionable_queue": f"""{_Q} SELECT * REPLACE (CAST(risk_score AS DOUBLE) AS risk_score),
            priority_rank <= 5 AS is_top_5 FROM queue""",
        "top5_actionable": f"{top5} ORDER BY priority_rank LIMIT 5",
        "top5_filtered": f"{top5} WHERE {_PLANT_TIER} ORDER BY priority_rank LIMIT 5",
        "sql_view_top5": f"{top5} WHERE priority_rank <= 5",
        "kpi_by_tier": f"""{_L} SELECT {_TIER} AS risk_tier, count(DISTINCT machine_id) AS machine_count,
            {_AVG.format(s='risk_score')} AS avg_score,
            CAST(count(DISTINCT machine_id) AS DOUBLE) / sum(count(DISTINCT machine_id)) OVER () AS share
            FROM latest GROUP BY 1""",
        "kpi_cards_zero_filled": f"""{_L} SELECT *, critical + high + medium + low AS machines FROM (
            SELECT {tier_counts} FROM latest WHERE {_PLANT_TIER})""",
        "overview_filtered": f"""{_L} SELECT machine_id AS machine, plant_id AS plant, machine_type, location_zone,
            criticality_class, {_TIER} AS risk_tier, CAST(risk_score AS DOUBLE) AS score, top_signal,
            recommended_action, strftime(reading_ts, '%Y-%m-%d %H:%M') AS last_reading
            FROM latest WHERE {_PLANT_TIER}""",
        "overview_by_type": f"""{_L} SELECT machine_id AS machine, plant_id AS plant, machine_type, location_zone,
            criticality_class, {_TIER} AS risk_tier, CAST(risk_score AS DOUBLE) AS score, top_signal,
            recommended_action, strftime(reading_ts, '%Y-%m-%d %H:%M') AS last_reading
            FROM latest WHERE machine_type IN ('PUMP', 'TURBINE')""",
        "overview_export": f"""{_L} SELECT machine_id AS "MACHINE", plant_id AS "PLANT", machine_type AS "MACHINE_TYPE",
            location_zone AS "LOCATION_ZONE", criticality_class AS "CRITICALITY_CLASS", {_TIER} AS "RISK_TIER",
            CAST(risk_score AS DOUBLE) AS "SCORE", top_signal AS "TOP_SIGNAL",
            recommended_action AS "RECOMMENDED_ACTION", strftime(reading_ts, '%Y-%m-%d %H:%M') AS "LAST_READING"
            FROM latest WHERE {_PLANT_TIER}""",
        "empty_selection": f"""{_L} SELECT machine_id AS machine, plant_id AS plant, machine_type, location_zone,
            criticality_class, {_TIER} AS risk_tier, CAST(risk_score AS DOUBLE) AS score, top_signal,
            recommended_action, strftime(reading_ts, '%Y-%m-%d %H:%M') AS last_reading
            FROM latest WHERE FALSE""",
        "full_trend": f"{_S} {trend}",
        "full_trend_filtered": f"""{_S} {trend} WHERE upper(trim(r.plant_id)) IN ('EUROPE', 'ASIA')
            AND {DERIVED.format(s='s.risk_score')} IN ('CRITICAL', 'HIGH')""",
        "trend_machines": f"{_S} SELECT count(DISTINCT machine_id) AS machines FROM scored",
        "drill_last72": f"""{_B} SELECT strftime(reading_ts, '%Y-%m-%d %H:%M') AS reading_time,
            CAST(temperature_c AS DOUBLE) AS temp_c, CAST(vibration_mm_s AS DOUBLE) AS vib_mm_s,
            CAST(pressure_bar AS DOUBLE) AS pres_bar, CAST(power_kw AS DOUBLE) AS power_kw, operating_mode, error_code
            FROM telemetry WHERE machine_id = '{MACHINE}' ORDER BY reading_ts DESC, reading_id DESC LIMIT 72""",
        "drill_history": f"""{_S} SELECT reading_ts, CAST(risk_score AS DOUBLE) AS risk_score, {_TIER} AS tier, top_signal
            FROM scored WHERE machine_id = '{MACHINE}'""",
        "drill_latest": f"""{_L} SELECT {_TIER} AS risk_tier, CAST(risk_score AS DOUBLE) AS risk_score, top_signal,
            recommended_action FROM latest WHERE machine_id = '{MACHINE}'""",
        "machine_list": f"{_B} SELECT machine_id FROM registry",
        "error_frequency": f"{_B} {frequency.format(more='')}",
        "error_frequency_filtered": f"""{_B} {frequency.format(
            more="AND upper(trim(r.plant_id)) IN ('EUROPE', 'ASIA')")}""",
        "error_pivot": f"""{_B} SELECT machine,
            CAST(coalesce(sum(occurrences) FILTER (trim(error_code) LIKE 'E1%'), 0) AS BIGINT) AS "E1",
            CAST(coalesce(sum(occurrences) FILTER (trim(error_code) LIKE 'E5%'), 0) AS BIGINT) AS "E5"
            FROM ({frequency.format(more='')}) GROUP BY machine""",
        "tier_machine_list": f"""{_L} SELECT l.risk_tier, l.page, t.machines, t.avg_score, l.machine_ids,
              repeat('#', CAST(floor(t.avg_score * 20) AS BIGINT)) AS bar
            FROM (SELECT risk_tier, page, string_agg(machine_id, ', ' ORDER BY machine_id) AS machine_ids
                  FROM (SELECT *, (row_number() OVER (PARTITION BY risk_tier ORDER BY machine_id) - 1) // 1000 AS page
                        FROM latest) GROUP BY risk_tier, page) l
            JOIN (SELECT risk_tier, count(DISTINCT machine_id) AS machines, {_AVG.format(s='risk_score')} AS avg_score
                  FROM latest GROUP BY risk_tier) t USING (risk_tier)""",
        "table_counts": f"""{_S} SELECT 'machine_registry' AS table_name, count(*) AS rows FROM registry
            UNION ALL SELECT 'machine_telemetry', count(*) FROM telemetry
            UNION ALL SELECT 'scored_telemetry_results', count(*) FROM scored""",
        "distinct_plants": f"{_B} SELECT DISTINCT plant_id FROM registry",
        "distinct_tiers": f"{_L} SELECT DISTINCT {_TIER} AS risk_tier FROM latest",
        "tier_mismatch": f"""{_S} SELECT machine_id, reading_ts, CAST(risk_score AS DOUBLE) AS risk_score, risk_tier,
            {_TIER} AS derived_tier FROM scored WHERE {_TIER} <> risk_tier""",
        "data_loss_machines": f"""{_L} SELECT machine_id, plant_id, machine_type, location_zone, criticality_class,
            reading_ts, 'Telemetry or sensor data missing - investigate connectivity' AS reason
            FROM latest WHERE risk_tier = 'DATA_LOSS'""",
        "sensor_gaps": f"""{_B} SELECT machine_id, count(*) AS readings,
            count(*) FILTER (temperature_c IS NULL OR vibration_mm_s IS NULL) AS missing_required,
            CAST(count(*) FILTER (temperature_c IS NULL OR vibration_mm_s IS NULL) AS DOUBLE) / count(*) AS missing_rate
            FROM telemetry GROUP BY machine_id""",
        "orphan_readings": f"""{_B} SELECT reading_id, machine_id, reading_ts FROM telemetry WHERE machine_id NOT IN (
            SELECT concat('MCH_', lpad(CAST(s_suppkey AS VARCHAR), 6, '0')) FROM supplier)""",
        "silent_machines": f"""{_S} SELECT machine_id, plant_id, machine_type, location_zone, criticality_class
            FROM registry WHERE machine_id NOT IN (SELECT machine_id FROM scored)""",
        "pk_violations": f"""{_with(BASE, _PINGS)} SELECT machine_id, reading_ts, count(*) AS copies
            FROM pings GROUP BY ALL HAVING count(*) > 1""",
        "null_violations": f"""{_B} {_required(['machine_id', 'reading_ts', 'temperature_c', 'vibration_mm_s',
            'pressure_bar', 'power_kw', 'operating_mode', 'error_code'])}""",
        "domain_violations": _domain(),
        "quarantined_readings": f"""{_B} SELECT reading_id, machine_id, concat(CAST(power_kw AS VARCHAR), ' kW') AS power_kw,
            'power_kw:type' AS faults FROM telemetry WHERE operating_mode = 'STARTUP'""",
        "accepted_readings": f"""{_B} SELECT machine_id, reading_ts, CAST(temperature_c AS DOUBLE) AS temperature_c,
            CAST(power_kw AS DOUBLE) AS power_kw, operating_mode
            FROM telemetry WHERE operating_mode IS NULL OR operating_mode <> 'STARTUP'""",
        "dedup_readings": f"""{_with(BASE, _PINGS)} SELECT {_TELEMETRY_COLUMNS}, load_ts FROM pings
            QUALIFY row_number() OVER (PARTITION BY machine_id, reading_ts ORDER BY load_ts) = 1""",
        "baseline_estimate": baselines,
        "baseline_increment": baselines,
        "gap_fill": f"""{_B} SELECT reading_id, machine_id, reading_ts,
            CAST({_filled('temperature_c')} AS DOUBLE) AS temperature_c,
            CAST({_filled('vibration_mm_s')} AS DOUBLE) AS vibration_mm_s,
            temperature_c IS NULL AND {_filled('temperature_c')} IS NOT NULL AS temperature_c_filled,
            vibration_mm_s IS NULL AND {_filled('vibration_mm_s')} IS NOT NULL AS vibration_mm_s_filled
            FROM telemetry""",
        "tier_transitions": changes,
        "live_alerts": changes,
        "live_late": changes,
        "live_conflicts": f"""{_L} SELECT machine_id, reading_ts, CAST(risk_score AS DOUBLE) AS risk_score, risk_tier,
            top_signal, recommended_action, model_version, CAST(risk_score AS DOUBLE) AS stored_score,
            risk_tier AS stored_tier FROM latest""",
        "full_rescore": score_all,
        "machine_check": f"{_B} SELECT machine_id, plant_id FROM registry WHERE machine_id = '{MACHINE}'",
        "unknown_modes": f"""{_B} SELECT 'TRIAL' AS operating_mode, count(*) AS readings FROM telemetry
            WHERE reading_id % 7 = 0 HAVING count(*) > 0""",
        "csv_telemetry": f"""{_B} SELECT machine_id, reading_ts, CAST(temperature_c AS DOUBLE) AS temperature_c,
            CAST(vibration_mm_s AS DOUBLE) AS vibration_mm_s, CAST(power_kw AS DOUBLE) AS power_kw,
            CASE WHEN reading_id % 7 = 0 THEN 'HIGH_LOAD' ELSE operating_mode END AS operating_mode,
            nullif(trim(error_code), '') AS error_code, CAST(NULL AS DOUBLE) AS pressure_bar, TRUE AS has_load_ts
            FROM telemetry WHERE reading_id % 97 <> 0""",
        "csv_registry": f"""{_B}, numbered AS (
              SELECT *, CAST(substr(machine_id, 5, 6) AS INT) AS n FROM registry),
            sent AS (SELECT * FROM numbered UNION ALL SELECT * FROM numbered WHERE n % 50 = 0),
            judged AS (SELECT *, concat_ws(',',
                CASE WHEN length(plant_id) > 10 THEN 'plant_id:length' END,
                CASE WHEN n % 60 = 1 THEN 'install_date:type' END,
                CASE WHEN n % 50 = 0 THEN 'machine_id:repeated' END) AS faults FROM sent)
            SELECT machine_id, plant_id, CASE WHEN faults = '' THEN DATE '2020-01-01' END AS install_date,
              CASE WHEN faults = '' THEN CASE WHEN n % 4 = 0 THEN 'STANDARD' ELSE criticality_class END END AS criticality_class,
              nullif(faults, '') AS faults FROM judged""",
        "live_latest": f"""{_L} SELECT machine_id, reading_ts, CAST(risk_score AS DOUBLE) AS risk_score, risk_tier,
            top_signal, recommended_action, model_version FROM latest""",
        "risk_slope": f"""{_S} , points AS (
              SELECT machine_id, CAST(risk_score * 10000 AS HUGEINT) AS y,
                CAST(floor(CAST(date_diff('microsecond', (SELECT max(reading_ts) FROM scored), reading_ts) AS DOUBLE) / 1e6) AS HUGEINT) AS x
              FROM scored WHERE reading_ts >= (SELECT max(reading_ts) FROM scored) - INTERVAL 168 HOURS)
            SELECT machine_id, count(*) AS readings,
              CAST(count(*) * sum(x * y) - sum(x) * sum(y) AS DOUBLE)
                / nullif(CAST(count(*) * sum(x * x) - sum(x) * sum(x) AS DOUBLE), 0) * 8.64e0 AS slope_per_day
            FROM points GROUP BY machine_id""",
        "mean_drift": f"""{_with(BASE, FEATURES)}, rolled AS (SELECT *, {rolling} FROM features),
            drifted AS (SELECT reading_id, machine_id, reading_ts,
              (rolling_avg_temp_24h - CAST(baseline_temp_c AS DOUBLE))
                / nullif(CAST(baseline_stddev_temp AS DOUBLE), 0) AS temperature_drift,
              (rolling_avg_vibration_24h - CAST(baseline_vibration AS DOUBLE))
                / nullif(CAST(baseline_stddev_vibration AS DOUBLE), 0) AS vibration_drift FROM rolled)
            SELECT * FROM drifted WHERE abs(temperature_drift) >= 2 OR abs(vibration_drift) >= 2""",
        "robust_deviation": f"""{_B}, med AS (
              SELECT machine_id, quantile_disc(temperature_c, 0.5) AS mt, quantile_disc(vibration_mm_s, 0.5) AS mv
              FROM telemetry GROUP BY machine_id),
            mad AS (SELECT machine_id, any_value(mt) AS mt, any_value(mv) AS mv,
                quantile_disc(abs(temperature_c - mt), 0.5) AS dt, quantile_disc(abs(vibration_mm_s - mv), 0.5) AS dv
              FROM telemetry JOIN med USING (machine_id) GROUP BY machine_id)
            SELECT reading_id, machine_id, reading_ts, CAST(temperature_c AS DOUBLE) AS temperature_c,
              CAST(vibration_mm_s AS DOUBLE) AS vibration_mm_s,
              CAST(temperature_c - mt AS DOUBLE) / nullif(CAST(dt AS DOUBLE) * 1.4826e0, 0) AS temperature_c_robust_z,
              CAST(vibration_mm_s - mv AS DOUBLE) / nullif(CAST(dv AS DOUBLE) * 1.4826e0, 0) AS vibration_mm_s_robust_z
            FROM telemetry JOIN mad USING (machine_id)""",
        "hourly_rollup": hourly,
        "retained_readings": f"""{_B} SELECT {_TELEMETRY_COLUMNS} FROM telemetry
            WHERE reading_ts >= (SELECT max(reading_ts) FROM telemetry) - INTERVAL 14 DAYS""",
        "retained_table": f"""{_B} SELECT {_TELEMETRY_COLUMNS} FROM telemetry
            WHERE CAST(reading_ts AS DATE) >= (SELECT CAST(max(reading_ts) AS DATE) FROM telemetry) - 14""",
        "rule_versions": f"""({_S} SELECT {_SCORE_COLUMNS} FROM scored WHERE reading_ts < {change})
            UNION ALL ({_with(BASE, FEATURES, later)} SELECT {_SCORE_COLUMNS} FROM scored WHERE reading_ts >= {change})""",
        "change_points": f"""{_S} , points AS (
              SELECT machine_id, reading_ts, reading_id, CAST(risk_score * 10000 AS BIGINT) AS v FROM scored),
            steps AS (
              SELECT machine_id, reading_ts, reading_id, direction, sign * (v - mean) - 200 AS x
              FROM points JOIN (SELECT machine_id, sum(v) // count(v) AS mean FROM points GROUP BY machine_id) USING (machine_id)
              CROSS JOIN (VALUES ('WORSE', 1), ('BETTER', -1)) w(direction, sign)),
            run AS (SELECT *, sum(x) OVER k AS p FROM steps WINDOW k AS (PARTITION BY machine_id, direction ORDER BY reading_ts, reading_id)),
            sums AS (SELECT *, p - least(0, min(p) OVER k) AS after FROM run
              WINDOW k AS (PARTITION BY machine_id, direction ORDER BY reading_ts, reading_id))
            SELECT machine_id, reading_ts, reading_id, direction, CAST(after AS DOUBLE) / 10000 AS drift FROM sums
            QUALIFY after >= 5000 AND lag(after, 1, 0) OVER (PARTITION BY machine_id, direction ORDER BY reading_ts, reading_id) < 5000""",
        "alert_quality": f"""{_S} , alerts AS (
              SELECT DISTINCT machine_id, reading_ts AS at FROM scored WHERE risk_tier IN ('CRITICAL', 'HIGH')),
            failures AS (SELECT DISTINCT machine_id, reading_ts AS at FROM telemetry WHERE operating_mode = 'MAINTENANCE'),
            counted AS (SELECT
              (SELECT count(*) FROM alerts) AS alerts,
              (SELECT count(*) FROM alerts a WHERE EXISTS (SELECT 1 FROM failures f WHERE f.machine_id = a.machine_id
                 AND f.at BETWEEN a.at AND a.at + INTERVAL 72 HOURS)) AS right_alerts,
              (SELECT count(*) FROM failures) AS failures,
              (SELECT count(*) FROM failures f WHERE EXISTS (SELECT 1 FROM alerts a WHERE a.machine_id = f.machine_id
                 AND a.at BETWEEN f.at - INTERVAL 72 HOURS AND f.at)) AS caught_failures)
            SELECT *, CAST(right_alerts AS DOUBLE) / nullif(alerts, 0) AS precision,
              CAST(caught_failures AS DOUBLE) / nullif(failures, 0) AS recall FROM counted""",
        "incremental_score": score_all,
        "stream_score": score_all,
        "stream_dedup": f"{_B} SELECT {_TELEMETRY_COLUMNS} FROM telemetry",
        "stream_hourly_rollup": hourly,
        "stream_closing_rollup": f"""{_B}, arrived AS (
              SELECT machine_id, date_trunc('hour', reading_ts) AS hour_start, reading_ts,
                CASE WHEN reading_id % 10 < 4 THEN 1 WHEN reading_id % 10 < 6 THEN 2 WHEN reading_id % 10 < 9 THEN 3 ELSE 4 END AS slice
              FROM telemetry),
            upto AS (SELECT s, (SELECT max(reading_ts) FROM arrived WHERE slice <= s) - INTERVAL 2 HOURS AS bound FROM range(5) t(s)),
            states AS (SELECT machine_id, hour_start,
                CASE WHEN bool_or(hour_start + INTERVAL 1 HOUR <= earlier.bound) THEN 'corrected'
                  WHEN any_value(hour_start + INTERVAL 1 HOUR <= last.bound) THEN 'closed' ELSE 'open' END AS state
              FROM arrived LEFT JOIN upto earlier ON earlier.s = slice - 1 CROSS JOIN (SELECT * FROM upto WHERE s = 4) last
              GROUP BY machine_id, hour_start),
            hourly AS ({hourly[len(_B):]})
            SELECT * FROM hourly JOIN states USING (machine_id, hour_start)""",
        "stream_rolling_24h": f"{_B} SELECT reading_id, machine_id, reading_ts, {rolling} FROM telemetry",
        "stream_dead_letters": f"""{_B} SELECT CASE reading_id % 50 WHEN 0 THEN 'value:json' WHEN 3 THEN 'value:json'
              WHEN 1 THEN 'temperature_c:type' WHEN 2 THEN 'machine_id:required' ELSE '' END AS faults, count(*) AS records
            FROM telemetry GROUP BY faults""",
        "anomaly_scores": _anomaly(),
    }
