"""From change-log text to marts and views, on the declared schemas."""

import json

import pytest

from sparkmart import jobs
from sparkmart.plans import views
from sparkmart.session import scratch_dir
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.specs import TABLES
from sparkmart.streaming.ingest import text_stream

AT = "2024-01-01T{:02d}:00:00.000000Z"
ROWS = {
    "region": [{"id": "r1", "terrain_type": "mountain"}],
    "asset": [{"id": "a1", "name": "one"}],
    "equipment": [{"id": "e1", "asset_id": "a1", "range_km": "100.0000", "hit_probability": "0.5000"}],
    "sensor": [{"id": "s1", "asset_id": "a1"}],
    "operator_user": [{"id": "u1", "role": "commander"}],
    "subject": [{"id": "t1", "iff_status": "foe"}],
    "asset_status": [
        {"id": "x1", "asset_id": "a1", "region_id": "r1", "lat": "0.00000000", "lon": "0.00000000", "health_percent": "80.0000", "event_time": AT.format(1)}
    ],
    "condition": [
        {"id": "c1", "region_id": "r1", "type": "fog", "intensity": "0.5000", "wind_speed_kmh": "20.0000", "precipitation_mm": "0.0000", "event_time": AT.format(1)}
    ],
    "supply": [{"id": "p1", "asset_id": "a1", "region_id": "r1", "supply_level": "30.0000", "event_time": AT.format(2)}],
    "interference": [{"id": "i1", "sensor_id": "s1", "effect": "jammed", "event_time": AT.format(2)}],
    "observation": [
        {"id": "o1", "sensor_id": "s1", "subject_id": "t1", "region_id": "r1", "lat": "0.00000000", "lon": "1.00000000", "speed_kmh": "600.0000", "confidence": "0.9500", "event_time": AT.format(3)}
    ],
    "interaction": [
        {"id": "n1", "asset_id": "a1", "subject_id": "t1", "equipment_id": "e1", "result": "missed", "event_time": AT.format(4)}
    ],
    "policy_update": [{"id": "q1", "rules": '["r1"]', "event_time": AT.format(1)}],
    "incident": [{"id": "k1", "observation_id": "o1", "threat_level": "critical", "created_at": AT.format(3)}],
    "instruction": [],
}


def lines_of(spark, base):
    def lines(name):
        return text_stream(spark, f"{base}/{name}")

    return lines


def write(spark, base, name, rows, op="c", ts=1):
    images = [{"before": r, "after": None} if op == "d" else {"before": None, "after": r} for r in rows]
    text = [(json.dumps({**image, "op": op, "ts_ms": ts, "seq": ts}),) for image in images]
    spark.createDataFrame(text, "value string").coalesce(1).write.mode("append").text(f"{base}/{name}")


def test_end_to_end(spark):
    base = scratch_dir(spark, "jobs")
    log, silver, gold = f"{base}/log", f"{base}/silver", f"{base}/gold"
    for name in TABLES:
        write(spark, log, name, ROWS[name])
    read = jobs.ingest_job(spark, lines_of(spark, log), silver, buckets=2)
    assert read == {name: len(rows) for name, rows in ROWS.items()}
    tables = jobs.Silver(spark, silver)
    assert tables["instruction"].count() == 0 and len(tables) == 15
    assert jobs.marts_job(spark, tables, gold, 0, buckets=2) == {
        "asset_strength": 1,
        "subject_priority": 1,
        "incident_instructions": 1,
        "supply_readiness": 1,
        "interaction_review": 1,
    }
    assert set(jobs.marts_job(spark, tables, gold, 0, buckets=2).values()) == {0}
    strength = KeyedTable(spark, f"{gold}/asset_strength", ["asset_id", "equipment_id"]).read().collect()[0]
    assert float(strength.adjusted_hit_probability) == pytest.approx(0.45)
    assert float(strength.effective_range_km) == pytest.approx(100 * 0.8 * 0.98)
    review = KeyedTable(spark, f"{gold}/interaction_review", ["interaction_id"]).read().collect()[0]
    assert float(review.impact_factor) == pytest.approx(0.8 * 0.7 * 0.8)
    incident = KeyedTable(spark, f"{gold}/incident_instructions", ["incident_id"]).read()
    from pyspark.sql import functions as F

    now = F.lit("2024-01-01 03:30:00").cast("timestamp")
    assert [r.minutes_pending for r in views.unanswered(incident, now).collect()] == [30.0]

    # a later change moves on through the same jobs
    write(spark, log, "supply", [{**ROWS["supply"][0], "supply_level": "70.0000"}], op="u", ts=2)
    jobs.ingest_job(spark, lines_of(spark, log), silver, {"supply": TABLES["supply"]}, buckets=2)
    jobs.marts_job(spark, jobs.Silver(spark, silver), gold, 1, buckets=2)
    supply = KeyedTable(spark, f"{gold}/supply_readiness", ["asset_id"]).read().collect()[0]
    assert float(supply.supply_level) == 70.0


def test_lake_copy(spark):
    base = scratch_dir(spark, "copy")
    only = {"supply": TABLES["supply"]}
    write(spark, f"{base}/log", "supply", ROWS["supply"])
    write(spark, f"{base}/log", "supply", ROWS["supply"], op="d")
    jobs.lake_copy_job(spark, lines_of(spark, f"{base}/log"), f"{base}/lake", only)
    jobs.lake_copy_job(spark, lines_of(spark, f"{base}/log"), f"{base}/lake", only)
    assert [r.op for r in spark.read.parquet(f"{base}/lake/supply").collect()] == ["c"]
    spark.createDataFrame([("not json",)], "value string").coalesce(1).write.mode("append").text(f"{base}/log/supply")
    jobs.lake_copy_job(spark, lines_of(spark, f"{base}/log"), f"{base}/lake", only)
    assert [r.value for r in spark.read.parquet(f"{base}/lake/_quarantine/supply").collect()] == ["not json"]
    assert spark.read.parquet(f"{base}/lake/supply").count() == 1


def test_lake_copy_sets_rows_without_image_aside(spark):
    base = scratch_dir(spark, "copy")
    only = {"supply": TABLES["supply"]}
    write(spark, f"{base}/log", "supply", ROWS["supply"])
    bad = ['{"op":"c","after":null}', '{"op":"u"}', '{"op":"u","before":{"id":"s"},"after":{"asset_id":"a"}}']
    lines = spark.createDataFrame([(x,) for x in bad], "value string")
    lines.coalesce(1).write.mode("append").text(f"{base}/log/supply")
    jobs.lake_copy_job(spark, lines_of(spark, f"{base}/log"), f"{base}/lake", only)
    copied = spark.read.parquet(f"{base}/lake/supply").collect()
    assert len(copied) == 1 and copied[0].id is not None
    assert sorted(r.value for r in spark.read.parquet(f"{base}/lake/_quarantine/supply").collect()) == sorted(bad)
