"""One query per scalar-function family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.geo import haversine_km
from sparkmart.functions.timeval import micros, minutes_between, month_key
from sparkmart.workload.base import Tables, query
from sparkmart.workload.marts import newest


@query(
    "fn_math",
    """SELECT id, round(sqrt(speed_kmh), 6) AS root, round(power(confidence, 2), 6) AS squared,
            round(sin(radians(lat)), 6) AS sine, round(cos(radians(lat)), 6) AS cosine,
            round(asin(confidence), 6) AS arc, CAST(floor(lon) AS BIGINT) AS whole,
            round(speed_kmh * 0.5::DOUBLE, 2) AS half, speed_kmh + lat - lon AS mixed FROM r_observation""",
)
def _math(t: Tables) -> DataFrame:
    lat, speed, conf = F.col("lat"), F.col("speed_kmh"), F.col("confidence")
    return t["observation"].select(
        "id",
        F.round(F.sqrt(speed), 6).alias("root"),
        F.round(F.pow(conf, F.lit(2)), 6).alias("squared"),
        F.round(F.sin(F.radians(lat)), 6).alias("sine"),
        F.round(F.cos(F.radians(lat)), 6).alias("cosine"),
        F.round(F.asin(conf), 6).alias("arc"),
        F.floor("lon").alias("whole"),
        F.round(speed * 0.5, 2).alias("half"),
        (speed + lat - F.col("lon")).alias("mixed"),
    )


@query(
    "fn_conditional",
    """SELECT id, COALESCE(NULLIF(type, 'fog'), 'none') AS kind,
            greatest(intensity, precipitation_mm, wind_speed_kmh) AS worst,
            CASE type WHEN 'storm' THEN 2 WHEN 'rain' THEN 1 ELSE 0 END AS severity,
            CASE WHEN intensity > 0.5 AND NOT (type = 'rain') THEN 'strong' ELSE 'weak' END AS strength,
            greatest(NULLIF(intensity, 0.0), NULLIF(precipitation_mm, 0.0)) AS skips_null
        FROM r_condition""",
)
def _conditional(t: Tables) -> DataFrame:
    kind, power = F.col("type"), F.col("intensity")
    return t["condition"].select(
        "id",
        F.coalesce(F.nullif(kind, F.lit("fog")), F.lit("none")).alias("kind"),
        F.greatest("intensity", "precipitation_mm", "wind_speed_kmh").alias("worst"),
        F.when(kind == "storm", 2).when(kind == "rain", 1).otherwise(0).alias("severity"),
        F.when((power > 0.5) & ~(kind == "rain"), "strong").otherwise("weak").alias("strength"),
        F.greatest(
            F.nullif(power, F.lit(0.0)), F.nullif(F.col("precipitation_mm"), F.lit(0.0))
        ).alias("skips_null"),
    )


@query(
    "fn_json",
    """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
            json_extract_string(props, '$.missing') AS missing FROM events""",
)
def _json(t: Tables) -> DataFrame:
    return t.raw("events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.from_json("props", "k long").getField("k").alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )


@query(
    "fn_time",
    """SELECT event_id, strftime(ts, '%Y%m') AS month, epoch_us(ts) // 1000 AS ts_ms,
            ts - INTERVAL 1 HOUR AS hour_before,
            (epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts)) / 6e7::DOUBLE AS minutes_ago,
            ts AS parsed, date_trunc('second', ts) AS parsed_space FROM events""",
)
def _time(t: Tables) -> DataFrame:
    ts = F.col("ts")
    events = t.raw("events")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    spaced = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return events.select(
        "event_id",
        month_key(ts).alias("month"),
        F.floor(micros(events, "ts") / 1000).alias("ts_ms"),
        (ts - F.expr("interval 1 hour")).alias("hour_before"),
        minutes_between(newest(events, "ts"), ts).alias("minutes_ago"),
        F.to_timestamp_ntz(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("parsed"),
        F.to_timestamp_ntz(spaced, F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed_space"),
    )


@query(
    "fn_text_cast",
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text, CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS size,
            TRY_CAST(p_brand AS INTEGER) AS not_a_number, CAST(p_retailprice AS DECIMAL(19,4)) AS price,
            upper(p_name) AS upper_name, 'part' AS kind FROM part""",
)
def _text(t: Tables) -> DataFrame:
    return t.raw("part").select(
        "p_partkey",
        F.col("p_size").cast("string").alias("size_text"),
        F.col("p_size").cast("string").cast("int").alias("size"),
        F.col("p_brand").try_cast("int").alias("not_a_number"),
        F.col("p_retailprice").cast("decimal(19,4)").alias("price"),
        F.upper("p_name").alias("upper_name"),
        F.lit("part").alias("kind"),
    )


@query(
    "fn_array",
    """SELECT id, len(CAST(json(rules) AS VARCHAR[])) AS n_rules,
            CAST(json(rules) AS VARCHAR[])[1] AS first_rule,
            list_contains(CAST(json(rules) AS VARCHAR[]), 'r2') AS has_r2,
            ['low', 'medium', 'high'][1 + id % 3] AS chosen FROM r_policy_update""",
)
def _array(t: Tables) -> DataFrame:
    parsed = t["policy_update"].withColumn("_rules", F.from_json("rules", "array<string>"))
    levels = F.array(F.lit("low"), F.lit("medium"), F.lit("high"))
    return parsed.select(
        "id",
        F.size("_rules").cast("long").alias("n_rules"),
        F.element_at("_rules", 1).alias("first_rule"),
        F.array_contains("_rules", "r2").alias("has_r2"),
        F.element_at(levels, (F.pmod("id", F.lit(3)) + 1).cast("int")).alias("chosen"),
    )


@query(
    "fn_array_explode",
    """SELECT rule, COUNT(*) AS updates FROM (SELECT unnest(CAST(json(rules) AS VARCHAR[])) AS rule
            FROM r_policy_update) GROUP BY rule""",
)
def _explode(t: Tables) -> DataFrame:
    exploded = t["policy_update"].select(
        F.explode(F.from_json("rules", "array<string>")).alias("rule")
    )
    return exploded.groupBy("rule").agg(F.count(F.lit(1)).alias("updates"))


@query(
    "fn_haversine",
    """SELECT id, round(2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians(0 - lat) / 2), 2)
            + cos(radians(lat)) * cos(radians(0)) * power(sin(radians(0 - lon) / 2), 2)))), 4) AS km
        FROM r_asset_status""",
)
def _haversine(t: Tables) -> DataFrame:
    origin = F.lit(0.0)
    km = haversine_km(F.col("lat"), F.col("lon"), origin, origin)
    return t["asset_status"].select("id", F.round(km, 4).alias("km"))


@query(
    "fn_uuid",
    """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT c_custkey) AS n_keys, COUNT(*) AS n_well_formed FROM customer""",
)
def _uuid(t: Tables) -> DataFrame:
    """Generated keys: their values differ in every run, but all are distinct and of the form of a UUID."""
    keyed = t.raw("customer").select(F.uuid().alias("key"))
    form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return keyed.groupBy("key").count().agg(
        F.sum("count").alias("n_rows"),
        F.count("key").alias("n_keys"),
        F.count_if(F.col("key").rlike(form)).alias("n_well_formed"),
    )
