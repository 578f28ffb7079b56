"""Equi, latest-snapshot, as-of and bounded inequality joins, and referential checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators import quality
from sparkmart.operators.asof import asof_join, count_preceding
from sparkmart.operators.keyed import latest_per_key, latest_snapshot
from sparkmart.operators.skew import join_many_to_one
from sparkmart.plans import marts
from sparkmart.specs import TABLES
from sparkmart.workload.base import CHECKED, Tables, query
from sparkmart.workload.mart_sql import MART_SQL, asof_sql, latest_sql


def _renamed(df: DataFrame, key: str, *columns: str) -> DataFrame:
    return df.select(F.col("id").alias(key), *columns)


@query(
    "join_inner",
    """SELECT s.id, s.asset_id, s.region_id, r.terrain_type FROM r_asset_status s
        JOIN r_region r ON r.id = s.region_id""",
)
def _inner(t: Tables) -> DataFrame:
    region = _renamed(t["region"], "region_id", "terrain_type")
    return t["asset_status"].select("id", "asset_id", "region_id").join(region, "region_id")


@query(
    "join_left",
    """SELECT a.id AS incident_id, a.threat_level, c.id AS instruction_id, c.action FROM r_incident a
        LEFT JOIN r_instruction c ON c.incident_id = a.id""",
)
def _left(t: Tables) -> DataFrame:
    incident = _renamed(t["incident"], "incident_id", "threat_level")
    instruction = _renamed(t["instruction"], "instruction_id", "incident_id", "action")
    return incident.join(instruction, "incident_id", "left")


@query(
    "join_star",
    f"""SELECT w.id AS equipment_id, s.id AS status_id, u.domain, r.terrain_type, w.range_km
        FROM {latest_sql("r_asset_status", "asset_id")} s JOIN r_asset u ON u.id = s.asset_id
        JOIN r_region r ON r.id = s.region_id JOIN r_equipment w ON w.asset_id = s.asset_id""",
)
def _star(t: Tables) -> DataFrame:
    status = latest_snapshot(
        t["asset_status"].select("id", "asset_id", "region_id", "event_time"), ["asset_id"], ties=("id",)
    ).select(F.col("id").alias("status_id"), "asset_id", "region_id")
    placed = status.join(_renamed(t["asset"], "asset_id", "domain"), "asset_id").join(
        _renamed(t["region"], "region_id", "terrain_type"), "region_id"
    )
    equipment = _renamed(t["equipment"], "equipment_id", "asset_id", "range_km")
    rows = join_many_to_one(equipment, placed, ["asset_id"])
    return rows.select("equipment_id", "status_id", "domain", "terrain_type", "range_km")


@query(
    "join_split_keys",
    f"""SELECT w.id AS equipment_id, s.id AS status_id, s.region_id FROM r_equipment w
        LEFT JOIN {latest_sql("r_asset_status", "asset_id")} s ON s.asset_id = w.asset_id""",
)
def _split_keys(t: Tables) -> DataFrame:
    """The hot-key path of the many-to-one join, forced by a low limit."""
    status = latest_snapshot(
        t["asset_status"].select("id", "asset_id", "region_id", "event_time"), ["asset_id"], ties=("id",)
    ).select(F.col("id").alias("status_id"), "asset_id", "region_id")
    equipment = _renamed(t["equipment"], "equipment_id", "asset_id")
    rows = join_many_to_one(equipment, status, ["asset_id"], "left", split_rows=12)
    return rows.select("equipment_id", "status_id", "region_id")


@query(
    "join_multi_hop",
    f"""SELECT o.id, s.asset_id, p.lat AS observer_lat, p.lon AS observer_lon
        FROM r_observation o JOIN r_sensor s ON s.id = o.sensor_id
        JOIN r_asset a ON a.id = s.asset_id
        LEFT JOIN {latest_sql("r_asset_status", "asset_id")} p ON p.asset_id = a.id""",
)
def _multi_hop(t: Tables) -> DataFrame:
    position = latest_snapshot(
        t["asset_status"].select("id", "asset_id", "lat", "lon", "event_time"), ["asset_id"], ties=("id",)
    ).select("asset_id", F.col("lat").alias("observer_lat"), F.col("lon").alias("observer_lon"))
    return (
        t["observation"]
        .select("id", "sensor_id")
        .join(_renamed(t["sensor"], "sensor_id", "asset_id"), "sensor_id")
        .join(_renamed(t["asset"], "asset_id"), "asset_id")
        .join(position, "asset_id", "left")
        .select("id", "asset_id", "observer_lat", "observer_lon")
    )


@query(
    "join_latest",
    f"""SELECT s.id, s.region_id, c.type, c.intensity FROM r_asset_status s
        LEFT JOIN {latest_sql("r_condition", "region_id")} c ON c.region_id = s.region_id""",
)
def _latest(t: Tables) -> DataFrame:
    newest = latest_snapshot(
        t["condition"].select("id", "region_id", "type", "intensity", "event_time"),
        ["region_id"],
        ties=("id",),
    ).select("region_id", "type", "intensity")
    return t["asset_status"].select("id", "region_id").join(newest, "region_id", "left")


_ASSET_MATCH = "r.asset_id = l.asset_id"
_REGION_MATCH = "r.region_id = l.region_id"


def _located(t: Tables, how: str, **options) -> DataFrame:
    return asof_join(
        t["interaction"].select("id", "asset_id", "event_time"),
        t["asset_status"],
        on=[("asset_id", "asset_id")],
        left_time="event_time",
        right_time="event_time",
        select={"region_id": "region_id", "status_id": "id"},
        how=how,
        **options,
    )


_LOCATED = "r.region_id AS region_id, r.id AS status_id"
_INTERACTION = "(SELECT id, asset_id, event_time FROM r_interaction)"


@query("asof_inner", f"SELECT * FROM {asof_sql(_INTERACTION, 'r_asset_status', _ASSET_MATCH, 'id', _LOCATED, 'INNER')}")
def _asof_inner(t: Tables) -> DataFrame:
    return _located(t, "inner")


@query("asof_left", f"SELECT * FROM {asof_sql(_INTERACTION, 'r_asset_status', _ASSET_MATCH, 'id', _LOCATED)}")
def _asof_left(t: Tables) -> DataFrame:
    return _located(t, "left")


@query(
    "asof_split_keys",
    f"SELECT * FROM {asof_sql(_INTERACTION, 'r_asset_status', _ASSET_MATCH, 'id', _LOCATED)}",
)
def _asof_split(t: Tables) -> DataFrame:
    """The hot-key path: every key above a few rows is cut into time slices."""
    return _located(t, "left", split_rows=20)


@query(
    "asof_chain",
    "SELECT * FROM "
    + asof_sql(
        asof_sql(_INTERACTION, "r_asset_status", _ASSET_MATCH, "id", _LOCATED, "INNER"),
        "r_condition",
        _REGION_MATCH,
        "id",
        "r.type AS type, r.intensity AS intensity",
    ),
)
def _asof_chain(t: Tables) -> DataFrame:
    return asof_join(
        _located(t, "inner"),
        t["condition"],
        on=[("region_id", "region_id")],
        left_time="event_time",
        right_time="event_time",
        select={"type": "type", "intensity": "intensity"},
    )


@query(
    "asof_nearest",
    """SELECT id, asset_id, event_time, status_id FROM (
        SELECT l.id, l.asset_id, l.event_time, r.id AS status_id, ROW_NUMBER() OVER (PARTITION BY l.id
            ORDER BY abs(epoch_us(l.event_time) - epoch_us(r.event_time)) ASC NULLS LAST,
                r.event_time ASC, r.id DESC) AS rn
        FROM r_interaction l LEFT JOIN r_asset_status r ON r.asset_id = l.asset_id) WHERE rn = 1""",
)
def _asof_nearest(t: Tables) -> DataFrame:
    return asof_join(
        t["interaction"].select("id", "asset_id", "event_time"),
        t["asset_status"],
        on=[("asset_id", "asset_id")],
        left_time="event_time",
        right_time="event_time",
        select={"status_id": "id"},
        direction="nearest",
    )


@query(
    "join_range_all",
    """SELECT l.id, l.region_id, COUNT(r.id) AS preceding FROM r_asset_status l
        LEFT JOIN r_condition r ON r.region_id = l.region_id AND r.event_time <= l.event_time
        GROUP BY l.id, l.region_id""",
)
def _range_all(t: Tables) -> DataFrame:
    return count_preceding(
        t["asset_status"].select("id", "region_id", "event_time"),
        t["condition"],
        on=[("region_id", "region_id")],
        left_time="event_time",
        right_time="event_time",
    ).select("id", "region_id", "preceding")


@query(
    "join_range_keep_last",
    """SELECT asset_id, region_id, event_time, type FROM (
        SELECT l.asset_id, l.region_id, l.event_time, r.type, ROW_NUMBER() OVER (
            PARTITION BY l.asset_id, l.region_id ORDER BY l.event_time DESC, l.id DESC,
                r.event_time DESC NULLS LAST, r.id DESC NULLS LAST) AS rn
        FROM r_asset_status l
        LEFT JOIN r_condition r ON r.region_id = l.region_id AND r.event_time <= l.event_time)
        WHERE rn = 1""",
)
def _range_keep_last(t: Tables) -> DataFrame:
    # keep-last first: only the surviving fact of each key needs its preceding row
    last = latest_per_key(
        t["asset_status"].select("id", "asset_id", "region_id", "event_time"),
        ["asset_id", "region_id"],
        ties=("id",),
    )
    return asof_join(
        last,
        t["condition"],
        on=[("region_id", "region_id")],
        left_time="event_time",
        right_time="event_time",
        select={"type": "type"},
    ).select("asset_id", "region_id", "event_time", "type")


_REFS = [(name, ref.column, ref.target) for name, spec in TABLES.items() for ref in spec.references]
_CHECKED_SQL = {role: f"({text.replace('{', '').replace('}', '')})" for role, text in CHECKED.items()}
_KEYS = [(name, ",".join(key)) for name, spec in TABLES.items() for key in (spec.key, *spec.unique)]
_MART_KEYS = [(name, variant, marts.mart_key(name, variant)) for name, variant in MART_SQL]


@query(
    "orphan_check",
    " UNION ALL ".join(
        f"""SELECT '{child}' AS table_name, '{column}' AS column_name, '{target}' AS target,
            COUNT(*) AS violations, COUNT(DISTINCT c.{column}) AS missing_keys
            FROM {_CHECKED_SQL.get(child, f'r_{child}')} c ANTI JOIN r_{target} p ON p.id = c.{column}
            WHERE c.{column} IS NOT NULL HAVING COUNT(*) > 0"""
        for child, column, target in _REFS
    ),
)
def _orphans(t: Tables) -> DataFrame:
    return quality.reference_violation_counts(t.checked())


@query(
    "duplicate_key_check",
    " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{key}' AS key_columns, CAST({key} AS VARCHAR) AS key_value,
            COUNT(*) AS copies FROM r_{table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1"""
        for table, key in _KEYS
    ),
)
def _duplicates(t: Tables) -> DataFrame:
    return quality.key_violations(t.checked())


@query(
    "mart_key_check",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS mart, '{variant}' AS variant, COUNT(*) AS rows,
            COUNT(DISTINCT ({", ".join(key)})) AS keys FROM ({MART_SQL[name, variant]})"""
        for name, variant, key in _MART_KEYS
    ),
)
def _mart_keys(t: Tables) -> DataFrame:
    """Rows and distinct keys of every mart in both variants; they are equal where the key is unique."""
    counted = [
        marts.BUILDERS[name](t, variant)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .agg(F.sum("_copies").alias("rows"), F.count(F.lit(1)).alias("keys"))
        .select(F.lit(name).alias("mart"), F.lit(variant).alias("variant"), "rows", "keys")
        for name, variant, key in _MART_KEYS
    ]
    return reduce(DataFrame.unionByName, counted)
