"""Projections, filters, predicates and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import rules, validate
from sparkmart.functions.timeval import within
from sparkmart.operators import keyed
from sparkmart.operators.lookups import clearance_filter
from sparkmart.specs import ENUMS, SUPPLY_TERRAIN_FACTOR, TERRAIN_FACTOR
from sparkmart.workload.base import Tables, query
from sparkmart.workload.marts import newest


@query("flatten_struct", "SELECT event_id, user_id, event_type, value FROM events")
def _flatten(t: Tables) -> DataFrame:
    nested = t.raw("events").select(
        F.struct("event_id", "user_id", "event_type", "value").alias("data")
    )
    return nested.select("data.*")


@query(
    "project_rename",
    """SELECT id AS equipment_id, asset_id AS owner_id, range_km, hit_probability FROM r_equipment""",
)
def _rename(t: Tables) -> DataFrame:
    return t["equipment"].withColumnsRenamed({"id": "equipment_id", "asset_id": "owner_id"})


# rows whose level or region is null stand for incomplete facts
_GAPPY = """SELECT id, NULLIF(region_id, 3) AS region_id, NULLIF(type, 'fog') AS type, intensity
    FROM r_condition"""


def _gappy(t: Tables) -> DataFrame:
    return t["condition"].select(
        "id",
        F.nullif(F.col("region_id"), F.lit(3)).alias("region_id"),
        F.nullif(F.col("type"), F.lit("fog")).alias("type"),
        "intensity",
    )


@query(
    "require_keys",
    f"SELECT * FROM ({_GAPPY}) WHERE region_id IS NOT NULL AND type IS NOT NULL",
)
def _require(t: Tables) -> DataFrame:
    return keyed.require_keys(_gappy(t), ["region_id", "type"])


@query(
    "fill_defaults",
    f"""SELECT id, COALESCE(region_id, -1) AS region_id, COALESCE(type, 'clear') AS type, intensity
        FROM ({_GAPPY})""",
)
def _fill(t: Tables) -> DataFrame:
    return keyed.fill_defaults(_gappy(t), {"region_id": -1, "type": "clear"})


@query("filter_in", "SELECT * FROM r_incident WHERE threat_level IN ('high', 'critical')")
def _filter_in(t: Tables) -> DataFrame:
    return t["incident"].filter(F.col("threat_level").isin("high", "critical"))


@query(
    "filter_enum_rank",
    "SELECT * FROM r_incident WHERE threat_level = 'high' OR threat_level = 'critical'",
)
def _enum_rank(t: Tables) -> DataFrame:
    return t["incident"].filter(rules.at_least(F.col("threat_level"), "high", ENUMS["level"]))


@query(
    "validate_enum",
    """SELECT o_orderkey, lower(split_part(o_orderpriority, '-', 2)) AS threat_level,
            CASE WHEN lower(split_part(o_orderpriority, '-', 2)) IN ('low', 'medium', 'high', 'critical')
                THEN '' ELSE 'threat_level:value' END AS reasons FROM orders""",
)
def _validate_enum(t: Tables) -> DataFrame:
    """Priority texts as levels: two of the five are not declared levels."""
    level = F.lower(F.split_part("o_orderpriority", F.lit("-"), F.lit(2)))
    rows = t.raw("orders").select("o_orderkey", level.alias("threat_level"))
    rule = {"threat_level:value": validate.in_enum(F.col("threat_level"), "level")}
    checked = validate.with_reasons(rows, rule)
    return checked.select(
        "o_orderkey", "threat_level", F.array_join(validate.REASONS, ",").alias("reasons")
    )


@query(
    "validate_enum_counts",
    """SELECT 'condition.type' AS column_name, COUNT(*) FILTER
            (WHERE type NOT IN ('rain', 'fog', 'storm', 'solar_flare')) AS invalid FROM r_condition
        UNION ALL SELECT 'interaction.result', COUNT(*) FILTER
            (WHERE result NOT IN ('destroyed', 'damaged', 'escaped', 'missed')) FROM r_interaction
        UNION ALL SELECT 'operator_user.role', COUNT(*) FILTER
            (WHERE role NOT IN ('commander', 'analyst', 'operator')) FROM r_operator_user
        UNION ALL SELECT 'asset.domain', COUNT(*) FILTER
            (WHERE domain NOT IN ('land', 'sea', 'air', 'space', 'cyber')) FROM r_asset""",
)
def _enum_counts(t: Tables) -> DataFrame:
    parts = None
    for role, column, enum in (
        ("condition", "type", "condition_type"),
        ("interaction", "result", "result"),
        ("operator_user", "role", "role"),
        ("asset", "domain", "domain"),
    ):
        bad = F.count_if(~validate.in_enum(F.col(column), enum)).alias("invalid")
        part = t[role].agg(bad).select(F.lit(f"{role}.{column}").alias("column_name"), "invalid")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query(
    "validate_range",
    """SELECT id, concat_ws(',',
            CASE WHEN lat < -45 OR lat > 45 THEN 'lat' END,
            CASE WHEN lon < -90 OR lon > 90 THEN 'lon' END,
            CASE WHEN confidence < 0.6 OR confidence > 1 THEN 'confidence' END,
            CASE WHEN speed_kmh < 100 THEN 'speed_kmh' END) AS reasons
        FROM r_observation""",
)
def _validate_range(t: Tables) -> DataFrame:
    limits = {
        "lat": (-45.0, 45.0),
        "lon": (-90.0, 90.0),
        "confidence": (0.6, 1.0),
        "speed_kmh": (100.0, None),
    }
    checked = validate.with_reasons(
        t["observation"],
        {c: validate.in_range(F.col(c), low, high) for c, (low, high) in limits.items()},
    )
    return checked.select("id", F.array_join(validate.REASONS, ",").alias("reasons"))


@query(
    "normalize_angle",
    """SELECT id, lon * 3 AS heading, CASE WHEN (lon * 3) % 360 < 0
            THEN ((lon * 3) % 360 + 360) % 360 ELSE (lon * 3) % 360 END AS heading_deg FROM r_observation""",
)
def _angle(t: Tables) -> DataFrame:
    heading = F.col("lon") * 3
    return t["observation"].select(
        "id", heading.alias("heading"), rules.normalise_angle(heading).alias("heading_deg")
    )


@query(
    "validate_key_format",
    r"""SELECT c_custkey, h, regexp_matches(h,
            '^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$') AS valid
        FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE
            substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' ||
            substr(m, 17, 4) || '-' || substr(m, 21, 12) END AS h
            FROM (SELECT *, md5(c_name) AS m FROM customer))""",
)
def _key_format(t: Tables) -> DataFrame:
    digest = F.md5(F.col("c_name").cast("binary"))
    pieces = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.concat_ws("-", *pieces))
    keyed_rows = t.raw("customer").select("c_custkey", key.alias("h"))
    return keyed_rows.withColumn("valid", validate.is_uuid(F.col("h")))


@query(
    "case_factor",
    """SELECT id, terrain_type,
            CASE terrain_type WHEN 'mountain' THEN 0.8::DOUBLE WHEN 'swamp' THEN 0.7 ELSE 1.0 END AS terrain_factor,
            CASE terrain_type WHEN 'mountain' THEN 0.7::DOUBLE ELSE 1.0 END AS supply_factor FROM r_region""",
)
def _case_factor(t: Tables) -> DataFrame:
    terrain = F.col("terrain_type")
    return t["region"].select(
        "id",
        "terrain_type",
        rules.lookup_factor(terrain, TERRAIN_FACTOR).alias("terrain_factor"),
        rules.lookup_factor(terrain, SUPPLY_TERRAIN_FACTOR).alias("supply_factor"),
    )


@query(
    "indicator_columns",
    """SELECT id, CASE WHEN type = 'fog' THEN 1.0::DOUBLE ELSE 0.0 END AS is_fog,
            CASE WHEN type IN ('fog', 'storm') THEN 1.0::DOUBLE ELSE 0.0 END AS is_poor FROM r_condition""",
)
def _indicators(t: Tables) -> DataFrame:
    return t["condition"].select(
        "id",
        rules.indicator(F.col("type") == "fog").alias("is_fog"),
        rules.indicator(F.col("type").isin("fog", "storm")).alias("is_poor"),
    )


@query(
    "band_level",
    """SELECT id, supply_level, CASE WHEN supply_level < 20 THEN 'CRITICAL' WHEN supply_level < 40
            THEN 'LOW' ELSE 'MODERATE' END AS band FROM r_supply WHERE supply_level < 60""",
)
def _band(t: Tables) -> DataFrame:
    low = t["supply"].filter(F.col("supply_level") < 60)
    label = rules.band(F.col("supply_level"), ((20, "CRITICAL"), (40, "LOW")), "MODERATE")
    return low.select("id", "supply_level", label.alias("band"))


@query(
    "role_masked_column",
    """SELECT i.id, i.incident_id, u.role,
            CASE WHEN u.role = 'commander' THEN i.action ELSE 'none' END AS action
        FROM r_instruction i JOIN r_operator_user u ON u.id = i.user_id""",
)
def _masked(t: Tables) -> DataFrame:
    user = t["operator_user"].select(F.col("id").alias("user_id"), "role")
    rows = t["instruction"].join(user, "user_id")
    shown = rules.gated(F.col("action"), F.col("role") == "commander", F.lit("none"))
    return rows.select("id", "incident_id", "role", shown.alias("action"))


@query(
    "clearance_filter",
    """SELECT * FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'unclassified'
            WHEN 1 THEN 'confidential' WHEN 2 THEN 'secret' ELSE 'top_secret' END AS classification
            FROM part) WHERE classification IN ('unclassified', 'confidential')""",
)
def _clearance(t: Tables) -> DataFrame:
    label = F.expr(
        "CASE p_size % 4 WHEN 0 THEN 'unclassified' WHEN 1 THEN 'confidential' "
        "WHEN 2 THEN 'secret' ELSE 'top_secret' END"
    )
    labelled = t.raw("part").select("p_partkey", label.alias("classification"))
    return clearance_filter(labelled, "confidential")


@query(
    "recent_filter",
    """SELECT event_id, ts, event_type FROM events
        WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""",
)
def _recent(t: Tables) -> DataFrame:
    events = t.raw("events").select("event_id", "ts", "event_type")
    return events.filter(within(F.col("ts"), newest(events, "ts"), "24 hours"))


@query(
    "sentinel_fill",
    """SELECT s.id, CASE WHEN o.speed_kmh > 500 THEN 3600 / o.speed_kmh ELSE 1e9 END AS seconds_per_km,
            COALESCE(o.lat, 1e9) AS lat FROM r_subject s
        LEFT JOIN (SELECT subject_id, max(speed_kmh) AS speed_kmh, max(lat) AS lat FROM r_observation
            GROUP BY subject_id) o ON o.subject_id = s.id""",
)
def _sentinel(t: Tables) -> DataFrame:
    seen = t["observation"].groupBy("subject_id").agg(
        F.max("speed_kmh").alias("speed_kmh"), F.max("lat").alias("lat")
    )
    rows = t["subject"].select(F.col("id").alias("subject_id")).join(seen, "subject_id", "left")
    pace = F.when(F.col("speed_kmh") > 500, F.lit(3600) / F.col("speed_kmh")).otherwise(F.lit(1e9))
    return rows.select(
        F.col("subject_id").alias("id"),
        pace.alias("seconds_per_km"),
        F.coalesce("lat", F.lit(1e9)).alias("lat"),
    )


@query(
    "rule_classifier",
    """SELECT o.id, CASE WHEN (o.speed_kmh > 500 OR s.iff_status = 'foe') AND o.confidence > 0.8
            THEN 'high' ELSE 'medium' END AS predicted_level
        FROM r_observation o JOIN r_subject s ON s.id = o.subject_id""",
)
def _classifier(t: Tables) -> DataFrame:
    subject = t["subject"].select(F.col("id").alias("subject_id"), "iff_status")
    rows = t["observation"].join(subject, "subject_id")
    level = rules.priority_class(F.col("speed_kmh"), F.col("iff_status"), F.col("confidence"))
    return rows.select("id", level.alias("predicted_level"))


@query(
    "feasibility_flag",
    """SELECT id, CASE WHEN wind_speed_kmh > 50 OR precipitation_mm > 10 THEN 0 ELSE 1 END AS feasible
        FROM r_condition""",
)
def _feasibility(t: Tables) -> DataFrame:
    flag = rules.feasible(F.col("wind_speed_kmh"), F.col("precipitation_mm"))
    return t["condition"].select("id", flag.alias("feasible"))


@query(
    "decimal_cast",
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(19,4)) AS price,
            CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) * 0.5::DOUBLE AS half FROM orders""",
)
def _decimal(t: Tables) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(19,4)")
    return t.raw("orders").select(
        "o_orderkey", price.alias("price"), (price.cast("double") * 0.5).alias("half")
    )
