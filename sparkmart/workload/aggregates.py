"""Aggregations, latest-row windows, ordering and fan-out over tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparkmart.functions import rules
from sparkmart.operators import keyed
from sparkmart.workload.base import ROLES, Tables, query
from sparkmart.workload.mart_sql import latest_sql


@query(
    "agg_count",
    "SELECT region_id, COUNT(*) AS observations FROM r_observation GROUP BY region_id",
)
def _count(t: Tables) -> DataFrame:
    return t["observation"].groupBy("region_id").agg(F.count(F.lit(1)).alias("observations"))


@query(
    "agg_count_if",
    """SELECT equipment_id, COUNT(*) FILTER (WHERE result = 'destroyed') AS hits,
            COUNT(*) FILTER (WHERE result = 'missed') AS misses FROM r_interaction GROUP BY equipment_id""",
)
def _count_if(t: Tables) -> DataFrame:
    return t["interaction"].groupBy("equipment_id").agg(
        F.count_if(F.col("result") == "destroyed").alias("hits"),
        F.count_if(F.col("result") == "missed").alias("misses"),
    )


@query(
    "agg_rate_pct",
    """SELECT asset_id, round(mean(CASE result WHEN 'destroyed' THEN 1 WHEN 'escaped' THEN NULL ELSE 0 END) * 100, 2) AS rate_pct
        FROM r_interaction GROUP BY asset_id""",
)
def _rate(t: Tables) -> DataFrame:
    counted = t["interaction"].groupBy("asset_id").agg(
        F.count_if(F.col("result") == "destroyed").alias("_hits"),
        F.count_if(F.col("result") != "escaped").alias("_tries"),
    )
    rate = rules.guarded_rate_pct(F.col("_hits"), F.col("_tries"))
    return counted.select("asset_id", rate.alias("rate_pct"))


@query(
    "agg_count_distinct",
    "SELECT region_id, COUNT(DISTINCT asset_id) AS assets FROM r_asset_status GROUP BY region_id",
)
def _count_distinct(t: Tables) -> DataFrame:
    return t["asset_status"].groupBy("region_id").agg(F.count_distinct("asset_id").alias("assets"))


@query(
    "agg_avg",
    "SELECT region_id, AVG(health_percent) AS mean_health FROM r_asset_status GROUP BY region_id",
)
def _avg(t: Tables) -> DataFrame:
    return t["asset_status"].groupBy("region_id").agg(F.avg("health_percent").alias("mean_health"))


@query(
    "agg_min_distance",
    f"""SELECT subject_id, round(MIN(COALESCE(dist, 1e9)), 4) AS min_distance_km FROM (
        SELECT o.subject_id, CASE WHEN p.lat IS NOT NULL THEN 2 * 6371.0 * asin(sqrt(least(1.0,
            power(sin(radians(o.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(o.lat))
            * power(sin(radians(o.lon - p.lon) / 2), 2)))) END AS dist
        FROM r_observation o LEFT JOIN r_sensor s ON s.id = o.sensor_id
        LEFT JOIN {latest_sql("r_asset_status", "asset_id")} p ON p.asset_id = s.asset_id)
        GROUP BY subject_id""",
)
def _min_distance(t: Tables) -> DataFrame:
    from sparkmart.functions.geo import distance_or_unknown, haversine_km

    position = keyed.latest_snapshot(
        t["asset_status"].select("id", "asset_id", "lat", "lon", "event_time"), ["asset_id"], ties=("id",)
    ).select("asset_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    sensor = t["sensor"].select(F.col("id").alias("sensor_id"), "asset_id")
    rows = (
        t["observation"]
        .select("subject_id", "sensor_id", "lat", "lon")
        .join(sensor, "sensor_id", "left")
        .join(position, "asset_id", "left")
    )
    distance = haversine_km(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lon"))
    nearest = F.round(F.min(distance_or_unknown(distance)), 4).alias("min_distance_km")
    return rows.groupBy("subject_id").agg(nearest)


@query(
    "batch_metrics",
    """SELECT 'orders' AS table_name, COUNT(*) AS rows, max(o_orderkey) AS max_key,
            COUNT(DISTINCT o_custkey) AS keys FROM orders""",
)
def _metrics(t: Tables) -> DataFrame:
    """Row metrics of a batch, observed while its one pass runs (no second scan)."""
    seen = Observation("batch")
    rows = t.raw("orders").observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("max_key")
    )
    keys = rows.select("o_custkey").distinct().count()
    found = seen.get
    return t.spark.createDataFrame(
        [("orders", found["rows"], found["max_key"], keys)],
        "table_name string, rows long, max_key long, keys long",
    )


@query(
    "drop_duplicates",
    """SELECT id, incident_id, user_id, action, event_time FROM (SELECT *, ROW_NUMBER() OVER (
            PARTITION BY id ORDER BY event_time DESC, incident_id DESC, user_id DESC, action DESC) AS rn
        FROM r_instruction) WHERE rn = 1""",
)
def _drop_duplicates(t: Tables) -> DataFrame:
    return keyed.latest_per_key(t["instruction"], ["id"])


@query("latest_per_key", f"SELECT * FROM {latest_sql('r_asset_status', 'asset_id')}")
def _latest(t: Tables) -> DataFrame:
    return keyed.latest_per_key(t["asset_status"], ["asset_id"], ties=("id",))


@query(
    "latest_time_fallback",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY threat_level
            ORDER BY created_at DESC, id DESC) AS rn FROM r_incident) WHERE rn = 1""",
)
def _fallback(t: Tables) -> DataFrame:
    return keyed.latest_snapshot(t["incident"], ["threat_level"], ties=("id",))


@query(
    "dedupe_composite",
    """SELECT incident_id, user_id, id, action, event_time FROM (SELECT *, ROW_NUMBER() OVER (
            PARTITION BY incident_id, user_id ORDER BY event_time DESC, id DESC, action DESC) AS rn
        FROM r_instruction) WHERE rn = 1""",
)
def _dedupe(t: Tables) -> DataFrame:
    return keyed.latest_per_key(t["instruction"], ["incident_id", "user_id"])


@query("rank_row_number", f"SELECT * FROM {latest_sql('r_supply', 'asset_id')}")
def _ranked(t: Tables) -> DataFrame:
    return keyed.top_ranked(
        t["supply"], ["asset_id"], [F.col("event_time").desc_nulls_last(), F.col("id").desc()]
    )


@query(
    "sort_result",
    "SELECT id, supply_level FROM r_supply ORDER BY supply_level ASC, id ASC",
)
def _sorted(t: Tables) -> DataFrame:
    return t["supply"].select("id", "supply_level").orderBy("supply_level", "id")


@query(
    "top_k_recent",
    "SELECT * FROM r_observation ORDER BY event_time DESC, id DESC LIMIT 100",
)
def _top_k(t: Tables) -> DataFrame:
    return keyed.latest_n(t["observation"], 100)


@query(
    "multi_table_run",
    " UNION ALL ".join(
        f"SELECT '{role}' AS table_name, COUNT(*) AS rows, COUNT(DISTINCT id) AS keys FROM r_{role}"
        for role in ROLES
    ),
)
def _multi(t: Tables) -> DataFrame:
    """The same operator over every declared table."""
    parts = [
        t[role]
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"))
        .select(F.lit(role).alias("table_name"), "rows", "keys")
        for role in ROLES
    ]
    return reduce(DataFrame.unionByName, parts)
