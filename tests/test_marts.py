"""The choices made where descriptions of the marts differ, on hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart.plans import marts, refresh, views
from sparkmart.session import scratch_dir, settle
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.specs import UNKNOWN_DISTANCE
from sparkmart.workload.base import Replaced, Tables

T0 = dt.datetime(2024, 1, 1)


def at(h):
    return T0 + dt.timedelta(hours=h)


SHAPES = {
    "region": "id long, region_name string, terrain_type string",
    "asset": "id long, name string",
    "equipment": "id long, asset_id long, range_km double, hit_probability double",
    "sensor": "id long, asset_id long",
    "operator_user": "id long, username string, role string",
    "subject": "id long, name string, iff_status string",
    "asset_status": "id long, asset_id long, region_id long, lat double, lon double, health_percent double, event_time timestamp_ntz",
    "condition": "id long, region_id long, type string, intensity double, wind_speed_kmh double, precipitation_mm double, event_time timestamp_ntz",
    "supply": "id long, asset_id long, supply_level double, event_time timestamp_ntz",
    "interference": "id long, sensor_id long, effect string, event_time timestamp_ntz",
    "observation": "id long, sensor_id long, subject_id long, region_id long, lat double, lon double, speed_kmh double, confidence double, event_time timestamp_ntz",
    "interaction": "id long, asset_id long, subject_id long, equipment_id long, result string, event_time timestamp_ntz",
    "incident": "id long, observation_id long, threat_level string, created_at timestamp_ntz",
    "instruction": "id long, incident_id long, user_id long, action string, event_time timestamp_ntz",
}


@pytest.fixture(scope="module")
def tables(spark):
    rows = {
        "region": [(1, "one", "mountain"), (2, "two", "desert")],
        "asset": [(1, "a"), (2, "b")],
        "equipment": [(1, 1, 100.0, 0.5), (2, 1, 10.0, 0.8), (3, 2, 50.0, 0.9)],
        "sensor": [(1, 1), (2, 9)],
        "operator_user": [(1, "u1", "commander"), (2, "u2", "analyst")],
        "subject": [(1, "s1", "foe"), (2, "s2", "friend"), (3, "s3", None)],
        "asset_status": [
            (1, 1, 1, 0.0, 0.0, 80.0, at(1)),
            (2, 1, 2, 0.0, 1.0, 50.0, at(5)),
            (3, 2, 1, 1.0, 1.0, 100.0, at(2)),
        ],
        "condition": [
            (1, 1, "fog", 0.5, 20.0, 0.0, at(1)),
            (2, 1, "storm", 1.0, 60.0, 2.0, at(9)),
            (3, 2, "fog", 0.4, None, None, at(4)),
        ],
        "supply": [(1, 1, 30.0, at(6)), (2, 2, 10.0, at(3)), (3, 2, None, at(2))],
        "interference": [(1, 1, "jammed", at(3)), (2, 1, "ddos", at(8))],
        "observation": [
            (1, 1, 1, 2, 0.0, 2.0, 600.0, 0.9, at(5)),
            (2, 2, 2, 1, 0.0, 2.0, 0.0, 0.9, at(5)),
            (3, 7, 3, 1, 0.0, 2.0, 10.0, 0.9, at(5)),
        ],
        "interaction": [
            (1, 1, 1, 1, "destroyed", at(4)),
            (2, 1, 1, 99, None, at(6)),
            (3, 2, 2, 3, "missed", at(1)),
        ],
        "incident": [(1, 1, "high", at(1)), (2, 2, "critical", at(2)), (3, 3, "medium", at(2)), (4, 99, "high", at(1))],
        "instruction": [(1, 1, 2, "hold", at(3)), (2, 1, 1, "recon", at(4))],
    }
    return {
        name: settle(spark.createDataFrame(rows[name], SHAPES[name]).coalesce(1), name) for name in SHAPES
    }


def by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_product_uses_newest_condition_linear_the_one_in_force(tables):
    product = by(marts.asset_strength(tables, "product"), "asset_id", "equipment_id")
    linear = by(marts.asset_strength(tables, "linear"), "asset_id", "region_id", "equipment_id")
    # asset 2 stood in region 1 at hour 2: fog was in force, the storm came later
    assert product[2, 3]["adjusted_hit_probability"] == pytest.approx(0.9 * (1 - 0.15 * 2))
    assert linear[2, 1, 3]["adjusted_hit_probability"] == pytest.approx(0.9 * (1 - 0.2 * 0.5))
    assert product[1, 1]["region_id"] == 2 and product[1, 1]["effective_range_km"] == pytest.approx(100)
    assert set(linear) == {(1, 1, 1), (1, 1, 2), (1, 2, 1), (1, 2, 2), (2, 1, 3)}


def test_unclamped_by_default(tables):
    wet = tables["condition"].withColumn("precipitation_mm", F.lit(50.0))
    t = {**tables, "condition": wet}
    assert by(marts.asset_strength(t), "equipment_id")[(3,)]["strength"] < 0
    assert by(marts.asset_strength(t, clamp=True), "equipment_id")[(3,)]["strength"] == 0


def test_subject_priority_unknowns(tables):
    product = by(marts.subject_priority(tables, "product"), "subject_id")
    # subject 3 was seen by a sensor nobody knows: left out in product, kept in linear
    assert set(product) == {(1,), (2,)}
    linear = by(marts.subject_priority(tables, "linear"), "subject_id", "region_id")
    assert set(linear) == {(1, 2), (2, 1), (3, 1)}
    far = linear[2, 1]
    assert far["distance_km"] == UNKNOWN_DISTANCE and far["response_time_sec"] == UNKNOWN_DISTANCE
    assert linear[3, 1]["iff_status"] == "unknown"
    # jammed at hour 3 was in force at hour 5; the newest effect is another one
    assert linear[1, 2]["adjusted_confidence"] == pytest.approx(0.9 * (1 - 0.3 * 0.4 - 0.5))
    assert product[(1,)]["adjusted_confidence"] == pytest.approx(0.9 * (1 - 0.3 * 0.4))


def test_incidents_keep_unanswered_unless_strict(tables):
    product = by(marts.incident_instructions(tables, "product"), "incident_id")
    assert set(product) == {(1,), (2,)}
    assert product[(1,)]["action"] == "recon" and product[(1,)]["event_time"] == at(4)
    assert product[(2,)]["action"] == "none" and product[(2,)]["instruction_id"] is None
    linear = by(marts.incident_instructions(tables, "linear"), "incident_id")
    assert linear[(2,)]["action"] is None
    assert set(by(marts.incident_instructions(tables, "product", strict=True), "incident_id")) == {(1,)}
    pending = views.unanswered(marts.incident_instructions(tables), F.lit(at(3)).cast("timestamp_ntz")).collect()
    assert [(r.incident_id, r.minutes_pending) for r in pending] == [(2, 60.0)]


def test_supply_feasibility_tests_precipitation(tables):
    rows = by(marts.supply_readiness(tables, "product"), "asset_id")
    assert rows[(2,)]["resupply_feasibility"] == 0  # wind 60
    assert rows[(2,)]["projected_supply"] == pytest.approx(10 * (1 - 0.5 * 1.0 * 0.7))
    assert rows[(2,)]["event_time"] == at(9)
    assert rows[(1,)]["resupply_feasibility"] == 1 and rows[(1,)]["event_time"] == at(6)
    linear = by(marts.supply_readiness(tables, "linear"), "asset_id", "region_id")
    assert set(linear) == {(1, 1), (1, 2), (2, 1)}


def test_interactions_use_what_held_at_their_time(tables):
    product = by(marts.interaction_review(tables, "product"), "interaction_id")
    # interaction 3 is earlier than any status of its asset
    assert set(product) == {(1,), (2,)}
    assert product[(1,)]["region_id"] == 1
    assert product[(1,)]["adjusted_hit_probability"] == pytest.approx(0.5 * (1 - 0.2 * 0.5) * (1 - 0.3))
    assert product[(1,)]["impact_factor"] == pytest.approx(0.8 * 0.7 * 0.8)
    # unknown equipment and result fall to their defaults
    assert product[(2,)]["adjusted_hit_probability"] == 0 and product[(2,)]["result"] == "missed"
    assert set(by(marts.interaction_review(tables, "linear"), "interaction_id")) == {(1,)}


def test_interference_link_can_be_replaced(tables):
    own = tables["interference"].select("id", F.lit(1).cast("long").alias("owner"), F.lit("ddos").alias("effect"), "event_time")
    rows = by(marts.interaction_review(tables, interference=own, interference_key="owner"), "interaction_id")
    assert rows[(1,)]["impact_factor"] == pytest.approx(0.8 * 0.8)


def test_unknown_variant_is_an_error(tables):
    for build in marts.BUILDERS.values():
        with pytest.raises(ValueError):
            build(tables, "other")


def test_publish_types(tables):
    out = marts.publish(marts.asset_strength(tables), "asset_strength")
    assert out.schema["strength"].dataType.simpleString() == "decimal(19,4)"


def test_marts_without_any_rows(spark, tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    for name, build in marts.BUILDERS.items():
        for variant in ("product", "linear"):
            assert build(empty, variant).count() == 0, name


CHANGED = {
    "asset_strength": ("asset_status", "condition", "equipment", "region", "asset"),
    "subject_priority": ("observation", "condition", "interference", "sensor", "asset_status", "subject"),
    "incident_instructions": ("incident", "instruction", "observation", "operator_user"),
    "supply_readiness": ("supply", "condition", "asset_status", "region"),
    "interaction_review": ("interaction", "asset_status", "condition", "interference", "equipment", "region", "sensor"),
}


@pytest.mark.parametrize("name", list(CHANGED))
@pytest.mark.parametrize("variant", ["product", "linear"])
def test_touched_rows_equal_a_full_rebuild(spark, tables, name, variant):
    """For a change in any input table, rows outside the touched keys do not change."""
    key = marts.mart_key(name, variant)
    full = by(marts.BUILDERS[name](tables, variant), *key)
    for role in CHANGED[name]:
        one = tables[role].filter("id = 1")
        before = Replaced(tables, **{role: tables[role].filter("id <> 1")})
        old = by(marts.BUILDERS[name](before, variant), *key)
        part = by(refresh.affected_rows(name, tables, {role: one}, variant), *key)
        assert all(full[k] == v for k, v in part.items()), role
        changed = {k for k, v in full.items() if old.get(k) != v}
        assert changed <= set(part), role


def test_refresh_writes_only_touched_rows(spark, tables):
    target = KeyedTable(spark, scratch_dir(spark, "mart"), ["asset_id"], 4)
    assert refresh.refresh("supply_readiness", tables, {"supply": tables["supply"]}, target, 0)
    assert {r.asset_id for r in target.read().collect()} == {1, 2}
    moved = tables["supply"].filter("asset_id = 1").withColumns({"supply_level": F.lit(5.0), "event_time": F.col("event_time") + F.expr("interval 1 hour"), "id": F.lit(50).cast("long")})
    later = {**tables, "supply": tables["supply"].unionByName(moved)}
    assert refresh.refresh("supply_readiness", later, {"supply": moved}, target, 1)
    assert {r.asset_id: r.supply_level for r in target.read().collect()} == {1: 5.0, 2: 10.0}


def test_refresh_withdraws_rows_that_are_gone(spark, tables):
    target = KeyedTable(spark, scratch_dir(spark, "gone"), ["asset_id", "equipment_id"], 4)
    assert refresh.refresh("asset_strength", tables, {"asset": tables["asset"]}, target, 0)
    assert {(r.asset_id, r.equipment_id) for r in target.read().collect()} == {(1, 1), (1, 2), (2, 3)}
    removed = tables["equipment"].filter("id = 2")
    later = {**tables, "equipment": tables["equipment"].filter("id <> 2")}
    assert refresh.refresh("asset_strength", later, {"equipment": removed}, target, 1)
    assert {(r.asset_id, r.equipment_id) for r in target.read().collect()} == {(1, 1), (2, 3)}


def test_a_rebuild_or_a_new_checkpoint_replaces_an_earlier_refresh(spark, tables):
    from sparkmart import jobs

    base = scratch_dir(spark, "gold")

    def levels():
        target = jobs.mart_table(spark, base, "supply_readiness", "product", 2)
        return {r.asset_id: float(r.supply_level) for r in target.read().collect()}

    def given(level):
        return {**tables, "supply": tables["supply"].withColumn("supply_level", F.lit(level))}

    def refreshed(level, batch_id, stream):
        t = given(level)
        done = jobs.mart_refresh_job(spark, t, {"supply": t["supply"]}, base, batch_id, stream, buckets=2)
        assert set(done) == {"supply_readiness"}
        return done["supply_readiness"]

    assert refreshed(1.0, 57, "a") and levels() == {1: 1.0, 2: 1.0}
    jobs.marts_job(spark, given(2.0), base, 2, buckets=2)
    assert levels() == {1: 2.0, 2: 2.0}
    assert refreshed(3.0, 0, "b") and levels() == {1: 3.0, 2: 3.0}
    # a repeated batch changes nothing
    assert not refreshed(4.0, 57, "a") and levels() == {1: 3.0, 2: 3.0}


def test_large_inputs_give_the_same_marts(spark, monkeypatch):
    """The hot-key path of every as-of step, forced on the given tables."""
    from sparkmart.operators import skew

    t = Tables(spark, "/root/testdata/sf0.001")
    for name in ("asset_strength", "interaction_review"):
        plain = sorted(map(tuple, marts.BUILDERS[name](t, "linear").collect()), key=repr)
        with monkeypatch.context() as m:
            m.setattr(skew, "SPLIT_ROWS", 5)
            cut = sorted(map(tuple, marts.BUILDERS[name](t, "linear").collect()), key=repr)
        assert plain and cut == plain
