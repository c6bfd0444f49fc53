
from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwatch.functions.columns import hours, newest_time, upper_names
from millwatch.functions.rule import COMPONENTS, RULE_ARGUMENTS, stored_score
from millwatch.operators import anomaly, baseline, changes, evaluation, forest, history, quality
from millwatch.plans import features, rules, scoring, serving, summary, tier_state, views
from millwatch.schema import REGISTRY, TELEMETRY
from millwatch.session import scratch_path
from millwatch.sources import driver_tables, tables, text, upkeep
from millwatch.streaming import closing, incremental, ingest, rolling
from oracle_queries import MACHINE
from oracle_queries import oracle_sql as _oracle_sql

try:  # the training-data operators may be left out of an installation
    from millwatch.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("millwatch.llm"):
        raise
    llm_queries = None

READING_ORDER = ("reading_ts", "reading_id")
CHOICE = serving.Selection(plants=["europe ", "ASIA"], tiers=["critical", "HIGH"])


class Fleet:
    """The tables of one folder as lazy frames; nothing is computed until it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return driver_tables.table(self.spark, self.folder, name)

    @cached_property
    def registry(self) -> DataFrame:
        return driver_tables.registry(self.spark, self.folder)

    @cached_property
    def telemetry(self) -> DataFrame:
        return driver_tables.telemetry(self.table("events"), self.registry)

    @cached_property
    def scored(self) -> DataFrame:
        return scoring.score_readings(self.telemetry, self.registry)

    @cached_property
    def scored_machine(self) -> DataFrame:
        """Scores of one machine; its filter reaches the scan because it comes before the rule."""
        mine = self.telemetry.filter(F.col("machine_id") == MACHINE)
        return scoring.score_readings(mine, self.registry)

    @property
    def now(self):
        """The newest scored reading's time, found without scoring."""
        return scoring.newest_scorable(self.telemetry)

    def recent(self, within_hours: float) -> DataFrame:
        """Scores of the last hours; the time filter comes before the rule and reaches the scan."""
        return scoring.recent_scores(self.telemetry, self.registry, within_hours)

    @cached_property
    def latest(self) -> DataFrame:
        return summary.latest_risk(self.scored, self.registry)

    @cached_property
    def queue(self) -> DataFrame:
        return summary.actionable_queue(self.latest, self.registry)

    @cached_property
    def pings(self) -> DataFrame:
        """Telemetry in which error readings were sent a second time."""
        first = self.telemetry.withColumn("load_ts", F.expr("reading_ts + INTERVAL 5 SECONDS"))
        again = self.telemetry.filter("error_code IS NOT NULL").withColumn(
            "load_ts", F.expr("reading_ts + INTERVAL 60 SECONDS")
        )
        return first.unionByName(again)

    @cached_property
    def raw_readings(self) -> DataFrame:
        """Telemetry as text, with a unit written into the power field of start-up readings."""
        text = self.telemetry.withColumn(
            "power_kw",
            F.when(F.col("operating_mode") == "STARTUP", F.concat("power_kw", F.lit(" kW"))).otherwise(
                F.col("power_kw").cast("string")
            ),
        )
        return as_text(text, keep=["reading_id"])

    def stream(self) -> DataFrame:
        """The events as a file stream, turned into telemetry."""
        # A glob, because a stream cannot be rooted at a single file.
        path = f"{self.folder}/events.parque[t]"
        events = ingest.file_stream(self.spark, path, driver_tables.SCHEMAS["events"])
        return driver_tables.telemetry(events, self.registry)

    def by_slices(self, conditions: list[str], start: Callable, again: str = "false") -> None:
        """Write the events slice by slice, cut by conditions, and drain a stream over them after each.

        ``start`` starts a query over the stream. The last slice also sends the events of
        ``again`` a second time, with other values.
        """
        path = scratch_path(self.spark, "event-slices")
        events = self.table("events")
        other = events.filter(again).withColumn("event_id", F.col("event_id") + 1_000_000_007)
        for n, condition in enumerate(conditions):
            part = events.filter(condition)
            part = part.unionByName(other) if n == len(conditions) - 1 else part
            part.write.mode("append").parquet(path)
            stream = ingest.file_stream(self.spark, path, driver_tables.SCHEMAS["events"])
            start(driver_tables.telemetry(stream, self.registry)).awaitTermination()

    def drained(self, stream: DataFrame, label: str) -> DataFrame:
        base = scratch_path(self.spark, label)
        ingest.write_stream(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        return self.spark.read.parquet(f"{base}/out")


def as_text(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    return df.select(
        *[F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns]
    )


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hand over the same kind of value."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _telemetry_columns(df: DataFrame) -> DataFrame:
    """Telemetry without the runtime counter, which the test tables lack."""
    return df.drop("runtime_hours")


def _rolling(fleet: Fleet) -> DataFrame:
    from millwatch.operators.trailing import trailing_means

    slim = fleet.telemetry.select(
        "reading_id", "machine_id", "reading_ts", "temperature_c", "vibration_mm_s"
    )
    return trailing_means(slim, features.ROLLING).drop("temperature_c", "vibration_mm_s")


def _sql_function(fleet: Fleet) -> DataFrame:
    rows = features.features(fleet.telemetry, fleet.registry, rolling=False)
    rows.createOrReplaceTempView("feature_rows")
    views.register_sql_function(fleet.spark)
    clean = {"error_code": "nullif(trim(error_code), '')"}
    arguments = ", ".join(
        clean.get(name, f"CAST({name} AS {kind})") for name, kind in RULE_ARGUMENTS
    )
    return fleet.spark.sql(
        f"SELECT machine_id, reading_ts, reading_id, {stored_score('r.risk_score')} AS risk_score, "
        "r.risk_tier, r.top_signal, r.recommended_action, 'RULE_V1' AS model_version "
        f"FROM (SELECT *, compute_risk_score({arguments}) AS r FROM feature_rows "
        "WHERE operating_mode <> 'MAINTENANCE')"
    )


def _sql_view(fleet: Fleet) -> DataFrame:
    views.register_views(fleet.spark, fleet.telemetry, fleet.registry, fleet.scored)
    return fleet.spark.sql(
        "SELECT machine_id AS machine, plant_id AS plant, machine_type, "
        "date_format(reading_ts, 'yyyy-MM-dd HH:mm') AS last_reading, risk_score AS score, "
        "risk_tier, reason, action, priority_rank FROM v_actionable_risk WHERE is_top_5"
    )


def _latest_incremental(fleet: Fleet) -> DataFrame:
    """A stored summary of all but the last day, brought up to date with the last day."""
    cut = fleet.now - hours(24)
    before = scoring.score_readings(fleet.telemetry, fleet.registry, where=F.col("reading_ts") < cut)
    stored = summary.latest_scores(before)
    fresh = fleet.recent(24)
    merged = summary.merge_latest(stored, fresh)
    return summary.with_attributes(merged, fleet.registry, per_machine=True).select(
        *fleet.latest.columns
    )


def _incremental_score(fleet: Fleet) -> DataFrame:
    """All but the last day scored first; then a run over everything adds what is missing."""
    path = scratch_path(fleet.spark, "incremental-score")
    cut = newest_time(fleet.telemetry) - hours(24)
    incremental.score_new(fleet.telemetry.filter(F.col("reading_ts") < cut), fleet.registry, path)
    incremental.score_new(fleet.telemetry, fleet.registry, path)
    return tables.read_fact(fleet.spark, path).select(*fleet.scored.columns)


_FOUR = ["event_id % 10 < 4", "event_id % 10 IN (4, 5)", "event_id % 10 IN (6, 7, 8)", "event_id % 10 = 9"]


def _live(fleet: Fleet, conditions: list[str] = ("true",), again: str = "false") -> incremental.LiveTables:
    live = incremental.LiveTables(scratch_path(fleet.spark, "live"))
    fleet.by_slices(
        list(conditions), lambda stream: incremental.run_live(stream, fleet.registry, live, every=None), again
    )
    return live


def _live_conflicts(fleet: Fleet) -> DataFrame:
    """Latest states beside the stored scores, after some readings came twice with other values."""
    live = _live(fleet, _FOUR, again="event_id % 10 = 2")
    stored = tables.read_fact(fleet.spark, live.scored).select(
        "machine_id", "reading_ts", F.col("risk_score").alias("stored_score"), F.col("risk_tier").alias("stored_tier")
    )
    return live.read_latest(fleet.spark).drop("reading_id").join(stored, ["machine_id", "reading_ts"])


def _live_late(fleet: Fleet) -> DataFrame:
    """Standing alerts after a tenth of the readings came late."""
    return _live(fleet, _FOUR).read_alerts(fleet.spark).drop("batch")


def _stream_rollup(fleet: Fleet) -> DataFrame:
    base = scratch_path(fleet.spark, "stream-rollup")
    fleet.by_slices(_FOUR, lambda stream: ingest.rollup_stream(stream, f"{base}/sums", f"{base}/checkpoint"))
    return ingest.read_rollup(fleet.spark, f"{base}/sums")


def _closing_rollup(fleet: Fleet) -> DataFrame:
    """Hours closed two hours behind the newest reading, and corrected by the slices after that."""
    base = scratch_path(fleet.spark, "closing-rollup")
    hours_of = closing.HourTables(f"{base}/hours")
    fleet.by_slices(
        _FOUR, lambda stream: closing.closing_rollup_stream(stream, hours_of, f"{base}/checkpoint", keep="400 days")
    )
    return hours_of.read(fleet.spark)


# Readings arrive up to six hours after they were taken; a slice is what arrives until then.
_ARRIVAL = "timestampadd(SECOND, CAST((event_id * 7919) % 21600 AS INT), ts)"


def _stream_rolling(fleet: Fleet) -> DataFrame:
    base = scratch_path(fleet.spark, "stream-rolling")
    low, high = fleet.table("events").agg(F.min("ts"), F.max("ts")).first()
    cuts = [low + (high - low) * k / 4 for k in range(1, 4)]
    bounds = ["TIMESTAMP_NTZ'0001-01-01'", *[f"TIMESTAMP_NTZ'{c}'" for c in cuts], "TIMESTAMP_NTZ'9999-01-01'"]
    slices = [f"{_ARRIVAL} >= {a} AND {_ARRIVAL} < {b}" for a, b in zip(bounds, bounds[1:])]
    fleet.by_slices(slices, lambda stream: rolling.rolling_stream(stream, f"{base}/said", f"{base}/checkpoint"))
    means = rolling.read_rolling(fleet.spark, f"{base}/said").drop("too_late")
    return fleet.telemetry.select("reading_id", "machine_id", "reading_ts").join(means, ["machine_id", "reading_ts"])


def _dead_letters(fleet: Fleet) -> DataFrame:
    """Telemetry sent as JSON, some of it broken: how many records were accepted, and rejected why."""
    base = scratch_path(fleet.spark, "dead-letters")
    record = F.to_json(F.struct(
        F.expr("CASE WHEN reading_id % 50 <> 2 THEN machine_id END").alias("machine_id"), "reading_ts",
        F.expr("CASE WHEN reading_id % 50 = 1 THEN 'hot' ELSE CAST(temperature_c AS STRING) END").alias("temperature_c"),
        "vibration_mm_s", "operating_mode",
    ))
    cut = F.when(F.col("reading_id") % 50 == 0, F.left(record, F.lit(30))).when(F.col("reading_id") % 50 == 3, "[1]")
    fleet.telemetry.select(F.coalesce(cut, record).cast("binary").alias("value")).write.parquet(f"{base}/log")
    raw = ingest.file_stream(fleet.spark, f"{base}/log", "value binary")
    ingest.ingest_records(raw, TELEMETRY, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    accepted = fleet.spark.read.parquet(f"{base}/out/accepted").select(F.lit("").alias("faults"))
    rejected = fleet.spark.read.parquet(f"{base}/out/rejected").select("faults")
    return accepted.unionByName(rejected).groupBy("faults").agg(F.count("*").alias("records"))


def _tier_state(fleet: Fleet) -> DataFrame:
    """Tier distribution from per-date states: all dates but the last, then the last one alone."""
    base = scratch_path(fleet.spark, "tier-state")
    tables.write_fact(fleet.scored, f"{base}/scored")
    scored = tables.read_fact(fleet.spark, f"{base}/scored")
    dates = sorted(r[0] for r in scored.select(tables.DATE).distinct().collect())
    for some in (set(dates[:-1]), set(dates[-1:])):
        tier_state.refresh_tier_states(scored, f"{base}/numbers", f"{base}/state", some)
    return tier_state.tier_distribution(fleet.spark, f"{base}/state")


def _rule_versions(fleet: Fleet) -> DataFrame:
    """Two versions of the rule as stored rows; the second one holds from the middle of the month."""
    path = scratch_path(fleet.spark, "rule-rows")
    late = [("critical", 0.7), ("high", 0.5), ("error_premium", 0.35), ("vibration", 0.4), ("temperature", 0.15)]
    rows = [("RULE_V1", dt.datetime(2000, 1, 1), None, "medium", 0.35)]
    rows += [("RULE_V2", dt.datetime(2024, 1, 16), None, name, value) for name, value in late]
    fleet.spark.createDataFrame(rows, rules.RULE_ROW).write.parquet(path)
    return rules.score_by_rules(fleet.telemetry, fleet.registry, fleet.spark.read.parquet(path))


def _baseline_increment(fleet: Fleet) -> DataFrame:
    """Baselines from states per machine and date: all dates but the last two, then these one by one."""
    base = scratch_path(fleet.spark, "baseline-state")
    tables.write_fact(fleet.telemetry, f"{base}/telemetry")
    stored = tables.read_fact(fleet.spark, f"{base}/telemetry")
    dates = sorted(r[0] for r in stored.select(tables.DATE).distinct().collect())
    for some in (set(dates[:-2]), set(dates[-2:-1]), set(dates[-1:])):
        baseline.refresh_baseline_states(stored, f"{base}/state", some)
    return baseline.stored_baselines(fleet.spark, f"{base}/state")


def _retained_table(fleet: Fleet) -> DataFrame:
    """Telemetry appended in parts, compacted, and rid of dates older than two weeks."""
    path = scratch_path(fleet.spark, "retained")
    for part in range(4):
        tables.append_new(fleet.telemetry.filter(F.col("reading_id") % 4 == part).repartition(4), path)
    newest = fleet.telemetry.agg(F.max("reading_ts")).first()[0]
    upkeep.compact_dates(fleet.spark, path, least_files=2)
    tables.drop_old_dates(fleet.spark, path, newest, days=14)
    return _telemetry_columns(tables.read_fact(fleet.spark, path).select(*fleet.telemetry.columns))


def _table_function(fleet: Fleet) -> DataFrame:
    rows = features.features(fleet.telemetry, fleet.registry, rolling=False)
    rows.createOrReplaceTempView("feature_rows")
    views.register_table_function(fleet.spark)
    clean = {"error_code": "nullif(trim(r.error_code), '')"}
    arguments = ", ".join(clean.get(name, f"CAST(r.{name} AS {kind})") for name, kind in RULE_ARGUMENTS)
    return fleet.spark.sql(
        f"SELECT r.machine_id, r.reading_ts, r.reading_id, {stored_score('s.rule_score')} AS risk_score, "
        "s.risk_tier, s.top_signal, s.recommended_action, 'RULE_V1' AS model_version "
        f"FROM feature_rows r, LATERAL score_reading({arguments}) s WHERE r.operating_mode <> 'MAINTENANCE'"
    )


def _csv_telemetry(fleet: Fleet) -> DataFrame:
    """Telemetry written as CSV, columns in another order, some modes new and some fields broken, and loaded."""
    path = scratch_path(fleet.spark, "telemetry-csv")
    odd = fleet.telemetry.select(
        "error_code",
        F.expr("CASE WHEN reading_id % 7 = 0 THEN 'HIGH_LOAD' ELSE operating_mode END").alias("OPERATING_MODE"),
        F.expr("CASE WHEN reading_id % 97 = 0 THEN 'n/a' ELSE CAST(power_kw AS STRING) END").alias("power_kw"),
        F.col("reading_ts").cast("string").alias("Reading_TS"),
        "machine_id",
        "vibration_mm_s",
        "temperature_c",
    )
    text.write_csv(odd, path)
    loaded, _ = text.load_telemetry(fleet.spark, path)
    return loaded.select(
        "machine_id", "reading_ts", "temperature_c", "vibration_mm_s", "power_kw", "operating_mode",
        "error_code", "pressure_bar", F.col("load_ts").isNotNull().alias("has_load_ts"),
    )


def _csv_registry(fleet: Fleet) -> DataFrame:
    """The registry as an upper-cased CSV with blanks, broken dates and repeated machines: what is loaded
    and what is rejected why."""
    path = scratch_path(fleet.spark, "registry-csv")
    number = F.substring("machine_id", 5, 6).cast("int")
    odd = as_text(fleet.registry).withColumns(
        {
            "install_date": F.when(number % 60 == 1, "someday").otherwise(F.col("install_date")),
            "criticality_class": F.when(number % 4 != 0, F.col("criticality_class")),
        }
    )
    odd = odd.unionByName(odd.filter(number % 50 == 0))
    text.write_csv(upper_names(odd.select(*reversed(odd.columns))), path)
    loaded, rejected = text.load_registry(fleet.spark, path)
    return loaded.select(
        "machine_id", "plant_id", "install_date", "criticality_class", F.lit(None).cast("string").alias("faults")
    ).unionByName(
        rejected.select(
            "machine_id", "plant_id", F.lit(None).cast("date").alias("install_date"),
            F.lit(None).cast("string").alias("criticality_class"), "faults",
        )
    )


def _full_rescore(fleet: Fleet) -> DataFrame:
    """The scored table replaced twice and read once."""
    path = scratch_path(fleet.spark, "full-rescore")
    for _ in range(2):
        tables.write_fact(fleet.scored, path)
    return tables.read_fact(fleet.spark, path).select(*fleet.scored.columns)


def _overview_export(fleet: Fleet) -> DataFrame:
    """The overview as an upper-cased CSV, read again as text."""
    path = scratch_path(fleet.spark, "overview-csv")
    text.write_csv(upper_names(serving.overview(fleet.latest, CHOICE)), path)
    return text.read_raw(fleet.spark, path).withColumn("SCORE", F.col("SCORE").cast("double"))


def _machine_check(fleet: Fleet) -> DataFrame:
    return fleet.registry.filter(
        F.col("machine_id") == serving.check_machine(fleet.registry, f" {MACHINE} ")
    ).select("machine_id", "plant_id")


def _orphans(fleet: Fleet) -> DataFrame:
    """Readings of machines outside the registry of supplier-maintained machines."""
    vendor = fleet.table("supplier").select(
        F.expr(driver_tables.machine_key("s_suppkey")).alias("machine_id")
    )
    return quality.orphan_readings(fleet.telemetry, vendor).select(
        "reading_id", "machine_id", "reading_ts"
    )


def _alert_quality(fleet: Fleet) -> DataFrame:
    alerts = fleet.scored.filter(F.col("risk_tier").isin("CRITICAL", "HIGH"))
    failures = fleet.telemetry.filter("operating_mode = 'MAINTENANCE'")
    return evaluation.alert_quality(alerts, failures, horizon_hours=72)


def _stream_dedup(fleet: Fleet) -> DataFrame:
    again = fleet.stream().filter("error_code IS NOT NULL")
    return _telemetry_columns(
        fleet.drained(ingest.drop_repeats_stream(fleet.stream().unionByName(again)), "stream-dedup")
    )


_GAP_COLUMNS = ["temperature_c", "vibration_mm_s"]

QUERIES: dict[str, Callable[[Fleet], DataFrame]] = {
    "features": lambda f: features.features(f.telemetry, f.registry).drop("runtime_hours"),
    "rolling_24h": _rolling,
    "score_all": lambda f: f.scored,
    "score_components": lambda f: scoring.score_readings(
        f.telemetry, f.registry, keep_components=True
    ).select("machine_id", "reading_ts", "reading_id", *COMPONENTS),
    "sql_function_score": _sql_function,
    "sql_table_function_score": _table_function,
    "tier_distribution": lambda f: summary.tier_distribution(f.scored),
    "tier_distribution_state": _tier_state,
    "latest_risk": lambda f: f.latest,
    "latest_incremental": _latest_incremental,
    "worst_recent_risk": lambda f: summary.worst_recent_risk(f.recent(144), f.registry, f.now),
    "risk_trend_24h": lambda f: summary.risk_trend(f.recent(24), f.registry, f.now),
    "actionable_queue": lambda f: f.queue,
    "top5_actionable": lambda f: serving.top_actionable(f.queue),
    "top5_filtered": lambda f: serving.top_actionable(f.queue, CHOICE),
    "sql_view_top5": _sql_view,
    "kpi_by_tier": lambda f: serving.kpi_by_tier(f.latest),
    "kpi_cards_zero_filled": lambda f: serving.kpi_cards(f.latest, CHOICE),
    "overview_filtered": lambda f: serving.overview(f.latest, CHOICE),
    "overview_by_type": lambda f: serving.overview(
        f.latest, serving.Selection(machine_types=["pump", "TURBINE"])
    ),
    "full_trend": lambda f: serving.full_trend(f.scored, f.registry),
    "full_trend_filtered": lambda f: serving.full_trend(f.scored, f.registry, CHOICE),
    "trend_machines": lambda f: serving.trend_machines(serving.full_trend(f.scored, f.registry)),
    "drill_last72": lambda f: serving.last_readings(f.telemetry, MACHINE),
    "drill_history": lambda f: serving.score_history(f.scored_machine, MACHINE),
    "drill_latest": lambda f: serving.latest_recommendation(f.scored_machine, MACHINE),
    "machine_list": lambda f: serving.machine_list(f.registry),
    "error_frequency": lambda f: serving.error_frequency(f.telemetry, f.registry),
    "error_frequency_filtered": lambda f: serving.error_frequency(f.telemetry, f.registry, CHOICE),
    "error_pivot": lambda f: serving.error_bars(
        serving.error_frequency(f.telemetry, f.registry),
        ["E1", "E5"],
        F.substring(F.trim("error_code"), 1, 2),
    ),
    "tier_machine_list": lambda f: summary.tier_machine_list(f.latest, f.registry),
    "table_counts": lambda f: summary.table_counts(
        {
            "machine_registry": f.registry,
            "machine_telemetry": f.telemetry,
            "scored_telemetry_results": f.scored,
        }
    ),
    "distinct_plants": lambda f: serving.distinct_plants(f.registry),
    "distinct_tiers": lambda f: serving.distinct_tiers(f.latest),
    "tier_mismatch": lambda f: summary.tier_mismatch(f.scored),
    "data_loss_machines": lambda f: summary.data_loss_machines(f.latest),
    "sensor_gaps": lambda f: quality.sensor_gaps(f.telemetry),
    "orphan_readings": _orphans,
    "silent_machines": lambda f: summary.silent_machines(f.registry, f.scored),
    "pk_violations": lambda f: quality.key_violations(f.pings, TELEMETRY),
    "null_violations": lambda f: quality.null_violations(
        f.telemetry,
        TELEMETRY,
        [c for c in TELEMETRY.names if c not in ("runtime_hours", "load_ts")],
    ),
    "domain_violations": lambda f: quality.domain_violations(
        as_text(f.registry).withColumn(
            "install_date", F.expr("CASE WHEN machine_id LIKE '%3' THEN 'soon' ELSE install_date END")
        ),
        REGISTRY,
    ),
    "quarantined_readings": lambda f: quality.split_valid(f.raw_readings, TELEMETRY)[1].select(
        "reading_id", "machine_id", "power_kw", "faults"
    ),
    "accepted_readings": lambda f: quality.split_valid(f.raw_readings, TELEMETRY)[0].select(
        "machine_id", "reading_ts", "temperature_c", "power_kw", "operating_mode"
    ),
    "dedup_readings": lambda f: _telemetry_columns(history.drop_repeats(f.pings)),
    "baseline_increment": _baseline_increment,
    "baseline_estimate": lambda f: baseline.estimate_baselines(f.telemetry),
    "gap_fill": lambda f: history.fill_gaps(
        f.telemetry.select("reading_id", "machine_id", "reading_ts", *_GAP_COLUMNS),
        _GAP_COLUMNS,
        order=READING_ORDER,
    ),
    "tier_transitions": lambda f: history.tier_changes(f.scored, order=READING_ORDER),
    "risk_slope": lambda f: history.risk_slope(f.recent(168), f.now),
    "mean_drift": lambda f: anomaly.mean_drift(features.features(f.telemetry, f.registry)),
    "robust_deviation": lambda f: anomaly.robust_deviation(f.telemetry, f.registry, _GAP_COLUMNS),
    "anomaly_scores": lambda f: forest.anomaly_scores(
        features.features(f.telemetry, f.registry, rolling=False)
    ).select("reading_id", "machine_id", "reading_ts", "anomaly_score"),
    "hourly_rollup": lambda f: history.hourly_rollup(f.telemetry),
    "retained_readings": lambda f: _telemetry_columns(
        history.retained(f.telemetry, newest_time(f.telemetry), days=14)
    ),
    "retained_table": _retained_table,
    "alert_quality": _alert_quality,
    "change_points": lambda f: changes.change_points(f.scored, order=READING_ORDER),
    "rule_versions": _rule_versions,
    "incremental_score": _incremental_score,
    "stream_score": lambda f: f.drained(
        scoring.score_readings(f.stream(), f.registry), "stream-score"
    ),
    "stream_dedup": _stream_dedup,
    "stream_hourly_rollup": _stream_rollup,
    "stream_closing_rollup": _closing_rollup,
    "stream_rolling_24h": _stream_rolling,
    "stream_dead_letters": _dead_letters,
    "live_alerts": lambda f: _live(f).read_alerts(f.spark).drop("batch"),
    "live_latest": lambda f: _live(f).read_latest(f.spark).drop("reading_id"),
    "live_conflicts": _live_conflicts,
    "live_late": _live_late,
    "csv_telemetry": _csv_telemetry,
    "csv_registry": _csv_registry,
    "full_rescore": _full_rescore,
    "overview_export": _overview_export,
    "empty_selection": lambda f: serving.overview(f.latest, serving.Selection(plants=[], tiers=[])),
    "machine_check": _machine_check,
    "unknown_modes": lambda f: quality.unknown_modes(
        f.telemetry.withColumn(
            "operating_mode",
            F.expr("CASE WHEN reading_id % 7 = 0 THEN 'TRIAL' ELSE operating_mode END"),
        )
    ),
}


def entry(spark: SparkSession) -> DataFrame:
    """The five machines to look at first, from raw readings to ranked actions."""
    return queries()["top5_actionable"](spark, "/root/testdata/sf0.001")


@lru_cache(maxsize=4)
def _fleet(spark: SparkSession, folder: str) -> Fleet:
    return Fleet(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Fleet], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: plain(build(_fleet(spark, folder)))

    extra = llm_queries.QUERIES if llm_queries else {}
    return {name: bind(build) for name, build in QUERIES.items()} | extra


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | (llm_queries.ORACLE_SQL if llm_queries else {})
