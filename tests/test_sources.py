"""Text and table sources and sinks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millwatch.schema import REGISTRY, SCORED
from millwatch.sources import tables, text

# Header names of the registry file.
REGISTRY_HEADER = (
    "machine_id,plant_id,machine_type,install_date,baseline_temp_c,baseline_vibration,baseline_pressure_bar,"
    "baseline_power_kw,baseline_stddev_temp,baseline_stddev_vibration,service_interval_hours,last_service_ts,"
    "location_zone,criticality_class"
)


def test_registry_csv(spark, tmp_path):
    path = tmp_path / "registry.csv"
    path.write_text(
        REGISTRY_HEADER + "\n"
        "M1,P7,MIXER,2018-11-02,61.5,1.25,4.4,37.0,2.2,0.15,900,2025-06-09 07:30:00,ZONE_Q,STANDARD\n"
        "M2,P7,MIXER,2018-11-02,61.5,1.25,4.4,37.0,2.2,0.15,900,2025-06-09 07:30:00,,\n"
        "M3,P7,MIXER,someday,61.5,1.25,4.4,37.0,2.2,0.15,900,2025-06-09 07:30:00,,\n"
        "M4,P7,MIXER,2018-11-02,61.5,1.25,4.4,37.0,2.2,0.15,900,2025-06-09 07:30:00,,\n"
        "M4,P8,MIXER,2018-11-02,61.5,1.25,4.4,37.0,2.2,0.15,900,2025-06-09 07:30:00,,\n"
    )
    good, bad = text.load_registry(spark, str(path))
    rows = {r["machine_id"]: r for r in good.collect()}
    assert set(rows) == {"M1", "M2"}
    assert rows["M1"]["install_date"] == dt.date(2018, 11, 2)
    assert rows["M1"]["last_service_ts"] == dt.datetime(2025, 6, 9, 7, 30)
    assert rows["M2"]["criticality_class"] == "STANDARD" and rows["M2"]["location_zone"] is None
    assert [f.dataType for f in good.schema] == [c.type for c in REGISTRY.columns]
    faults = sorted((r["machine_id"], r["faults"]) for r in bad.collect())
    assert faults == [("M3", "install_date:type"), ("M4", "machine_id:repeated"), ("M4", "machine_id:repeated")]


def test_telemetry_csv_binds_by_name_and_takes_defaults(spark, tmp_path):
    path = tmp_path / "telemetry.csv"
    path.write_text(
        "reading_ts,machine_id,vibration_mm_s,temperature_c,error_code\n"
        "2026-04-20 00:00:00,M1,2.5,85.1,\n"
    )
    good, bad = text.load_telemetry(spark, str(path))
    row = good.first()
    assert (row["machine_id"], str(row["temperature_c"]), str(row["vibration_mm_s"])) == ("M1", "85.10", "2.500")
    assert row["error_code"] is None and row["power_kw"] is None and row["load_ts"] is not None
    assert bad.isEmpty()


def test_missing_file_and_missing_column_raise(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        text.load_telemetry(spark, str(tmp_path / "absent.csv"))
    path = tmp_path / "short.csv"
    path.write_text("machine_id\nM1\n")
    with pytest.raises(ValueError, match="reading_ts"):
        text.load_telemetry(spark, str(path))


def test_export_round_trip_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "overview.csv"
    path.write_bytes("﻿,MACHINE,SCORE\n0,M1,0.8341\n1,M1,0.8341\n".encode())
    read = text.read_raw(spark, str(path))
    assert read.columns[1:] == ["MACHINE", "SCORE"] and read.count() == 2
    text.write_csv(read.select("MACHINE", "SCORE"), str(tmp_path / "out"))
    assert text.read_raw(spark, str(tmp_path / "out")).count() == 2


def _fact(spark, rows):
    return spark.createDataFrame(rows, "machine_id STRING, reading_ts TIMESTAMP_NTZ, risk_score DOUBLE")


def test_fact_overwrite_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "scored")
    day1, day2 = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 5)
    for _ in range(2):
        assert tables.write_fact(_fact(spark, [("A", day1, 0.1), ("A", day2, 0.2)]), path) == 2
    assert tables.read_fact(spark, path).count() == 2

    assert tables.replace_dates(_fact(spark, [("A", day2, 0.9)]), path) == 1
    got = {r["reading_ts"]: r["risk_score"] for r in tables.read_fact(spark, path).collect()}
    assert got == {day1: 0.1, day2: 0.9}

    both = _fact(spark, [("A", day2, 0.5), ("B", day2, 0.3)])
    assert [tables.append_new(both, path) for _ in range(2)] == [1, 0]
    assert tables.read_fact(spark, path).count() == 3
    assert tables.append_new(_fact(spark, [("A", day2, 0.5)]).limit(0), path) == 0
    assert tables.read_fact(spark, path).count() == 3


def test_time_filter_prunes_date_partitions(spark, tmp_path):
    path = str(tmp_path / "scored")
    rows = [("A", dt.datetime(2024, 1, d, 5), 0.1) for d in range(1, 11)]
    tables.write_fact(_fact(spark, rows), path)
    stored = tables.read_fact(spark, path)
    recent = tables.since_date(stored, F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))
    assert recent.count() == 3
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_date" in plan


def test_retention_keeps_young_dates(spark, tmp_path):
    path = str(tmp_path / "all")
    rows = [("A", dt.datetime(2024, 1, d, 5), 0.1) for d in range(1, 11)]
    tables.write_fact(_fact(spark, rows), path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "all").glob("reading_date=*/*.parquet")}
    assert tables.drop_old_dates(spark, path, "2024-01-10 12:00:00", days=3) == 6
    assert tables.read_fact(spark, path).agg(F.min("reading_date")).first()[0] == dt.date(2024, 1, 7)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "all").glob("reading_date=*/*.parquet")}
    assert after.items() <= before.items() and len(after) == 4
    plain = str(tmp_path / "plain")
    _fact(spark, rows).write.parquet(plain)
    with pytest.raises(ValueError, match="not partitioned"):
        tables.drop_old_dates(spark, plain, "2024-01-10", days=3)


def test_one_row_per_key_however_the_input_is_cut(spark, tmp_path):
    when = dt.datetime(2024, 1, 2, 5)
    twice = _fact(spark, [("A", when, 0.5), ("A", when, 0.3)])
    path = str(tmp_path / "once")
    assert [tables.append_new(twice, path) for _ in range(2)] == [1, 0]
    assert [r["risk_score"] for r in tables.read_fact(spark, path).collect()] == [0.3]


def test_tables_can_be_created_empty_and_again(spark, fleet, tmp_path):
    path = str(tmp_path / "scored")
    tables.write_fact(fleet.scored, path)
    tables.create_empty(spark, SCORED, path)
    assert tables.read_fact(spark, path, SCORED).count() == 0
    assert tables.append_new(fleet.scored.drop("reading_id"), path) == fleet.scored.count()
    assert tables.read_fact(spark, path, SCORED).count() == fleet.scored.count()
    tables.create_empty(spark, REGISTRY, str(tmp_path / "registry"))
    assert spark.read.parquet(str(tmp_path / "registry")).columns == REGISTRY.names
