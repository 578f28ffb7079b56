import math

import pytest
from pyspark.sql import functions as F

from sparkmart.functions import geo, rules, timeval, validate
from sparkmart.specs import ENUMS, TABLES, UNKNOWN_DISTANCE


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return row.select(expr.alias("x")).collect()[0].x


def test_bands(spark):
    label = rules.band(F.col("v"), ((20, "CRITICAL"), (40, "LOW")), "MODERATE")
    got = [one(spark, label, v=v) for v in (0, 19.99, 20, 39.9, 40, 100)]
    assert got == ["CRITICAL", "CRITICAL", "LOW", "LOW", "MODERATE", "MODERATE"]


def test_level_order_is_not_text_order(spark):
    keep = rules.at_least(F.col("v"), "high", ENUMS["level"])
    got = {v: one(spark, keep, v=v) for v in ("low", "medium", "high", "critical", "odd")}
    assert got == {"low": False, "medium": False, "high": True, "critical": True, "odd": False}
    ranks = [one(spark, rules.enum_rank(F.col("v"), ENUMS["level"]), v=v) for v in ("low", "critical", "odd")]
    assert ranks == [1, 4, None]


def test_penalties(spark):
    p = [F.lit(0.3), F.lit(0.5)]
    assert one(spark, rules.penalise(F.lit(1.0), p, "product")) == pytest.approx(0.35)
    assert one(spark, rules.penalise(F.lit(1.0), p, "linear")) == pytest.approx(0.2)
    big = [F.lit(7.5)]
    assert one(spark, rules.penalise(F.lit(2.0), big, "product")) == -13.0
    assert one(spark, rules.penalise(F.lit(2.0), big, "product", clamp=True)) == 0.0
    assert one(spark, rules.penalise(F.lit(2.0), big, "linear", clamp=True)) == 0.0
    with pytest.raises(ValueError):
        rules.penalise(F.lit(1.0), p, "other")


def test_factors_and_indicators(spark):
    factor = rules.lookup_factor(F.col("v"), {"mountain": 0.8, "swamp": 0.7})
    assert [one(spark, factor, v=v) for v in ("mountain", "swamp", "desert")] == [0.8, 0.7, 1.0]
    nothing = F.lit(None).cast("string")
    assert one(spark, rules.lookup_factor(nothing, {"a": 0.5})) == 1.0
    assert one(spark, rules.indicator(nothing == "fog")) == 0.0


def test_classifier_and_feasibility(spark):
    def cls(speed, iff, conf):
        return one(spark, rules.priority_class(F.lit(speed), F.lit(iff), F.lit(conf)))

    assert cls(501, "friend", 0.81) == "high"
    assert cls(500, "friend", 0.81) == "medium"
    assert cls(0, "foe", 0.81) == "high"
    assert cls(0, "foe", 0.8) == "medium"
    none = F.lit(None).cast("double")
    assert one(spark, rules.feasible(none, none)) == 1
    assert one(spark, rules.feasible(F.lit(51.0), none)) == 0
    assert one(spark, rules.feasible(none, F.lit(10.5))) == 0


def test_rates_and_latest(spark):
    assert one(spark, rules.guarded_rate_pct(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, rules.guarded_rate_pct(F.lit(1), F.lit(0))) is None
    assert one(spark, rules.latest_of([F.lit(None).cast("int"), F.lit(2)])) == 2


def test_distance(spark):
    km = geo.haversine_km(F.lit(0), F.lit(0), F.lit(0), F.lit(180))
    assert one(spark, km) == pytest.approx(math.pi * 6371.0)
    assert one(spark, geo.haversine_km(F.lit(10), F.lit(20), F.lit(10), F.lit(20))) == 0
    missing = geo.haversine_km(F.lit(None), F.lit(0), F.lit(1), F.lit(1))
    assert one(spark, geo.distance_or_unknown(missing)) == UNKNOWN_DISTANCE
    assert one(spark, geo.travel_seconds(F.lit(UNKNOWN_DISTANCE), F.lit(100))) == UNKNOWN_DISTANCE
    assert one(spark, geo.travel_seconds(F.lit(10.0), F.lit(0))) == UNKNOWN_DISTANCE
    assert one(spark, geo.travel_seconds(F.lit(10.0), F.lit(36))) == pytest.approx(1000)


def test_angles(spark):
    got = [one(spark, rules.normalise_angle(F.lit(v))) for v in (-90.0, 360.0, 725.0)]
    assert got == [270.0, 0.0, 5.0]


def test_wall_clock_does_not_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on this day in that zone
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.000001' AS t")
        us = df.select(timeval.micros(df, "t").alias("x")).collect()[0].x
        assert us == 1710037800000001
        back = df.select(timeval.to_wall_clock(timeval.to_instant(df, "t")) == F.col("t"))
        assert back.collect()[0][0] is True
        old = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.999999' AS t")
        assert old.select(timeval.micros(old, "t")).collect()[0][0] == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_minutes(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-03 01:02:03' AS a, timestamp_ntz'2024-01-01 00:00:00' AS b")
    assert df.select(timeval.minutes_between(F.col("a"), F.col("b"))).collect()[0][0] == pytest.approx(2942.05)
    assert df.select(timeval.minutes_between(F.col("b"), F.col("a"))).collect()[0][0] == pytest.approx(-2942.05)


def test_spec_validation_quarantines_with_reasons(spark):
    spec = TABLES["condition"]
    df = spark.createDataFrame(
        [("1", "fog", 0.5), ("2", "hail", 0.5), ("3", "rain", 1.5), (None, None, None)],
        "id string, type string, intensity double",
    )
    clean, bad = validate.split_valid(df, validate.spec_rules(df, spec))
    assert [r.id for r in clean.collect()] == ["1"]
    reasons = {r.id: r._reasons for r in bad.collect()}
    assert reasons == {"2": ["type:value"], "3": ["intensity:range"], None: ["id:missing"]}


def test_uuid_text(spark):
    ok = validate.is_uuid(F.col("v"))
    assert one(spark, ok, v="123e4567-e89b-12d3-a456-426614174000") is True
    assert one(spark, ok, v="123e4567e89b12d3a456426614174000") is False


def test_specs_are_consistent():
    assert len(TABLES) == 15 and len(ENUMS) == 9
    assert sum(len(t.references) for t in TABLES.values()) == 19
    for t in TABLES.values():
        names = t.schema.names
        for column in [*t.key, *t.enums, *t.ranges, *[r.column for r in t.references]]:
            assert column in names, (t.name, column)
        assert t.time_column is None or t.time_column in names
        assert all(e in ENUMS for e in t.enums.values())
        assert all(r.target in TABLES for r in t.references)
