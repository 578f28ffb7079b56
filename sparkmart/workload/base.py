"""Query registry and the role views that give the driver tables their roles."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# One text per role for both engines; {K} is the number inside the JSON column.
_K = {
    "spark": "CAST(get_json_object(props, '$.k') AS BIGINT)",
    "oracle": "CAST(json_extract_string(props, '$.k') AS BIGINT)",
}

ROLES: dict[str, str] = {
    "region": """SELECT n_nationkey AS id, n_name AS region_name,
        CASE r_name WHEN 'ASIA' THEN 'mountain' WHEN 'AFRICA' THEN 'swamp'
            WHEN 'EUROPE' THEN 'urban' WHEN 'AMERICA' THEN 'forest' ELSE 'desert' END AS terrain_type
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "asset": """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS domain,
        c_nationkey AS region_id FROM {customer}""",
    "equipment": """SELECT o_orderkey AS id, o_custkey AS asset_id, o_totalprice / 1000 AS range_km,
        CAST(50 + o_orderkey % 46 AS DOUBLE) / 100 AS hit_probability FROM {orders}""",
    "sensor": """SELECT s_suppkey AS id, s_suppkey AS asset_id, s_acctbal AS range_km
        FROM {supplier}""",
    "operator_user": """SELECT s_suppkey AS id, s_name AS username,
        CASE s_suppkey % 3 WHEN 0 THEN 'commander' WHEN 1 THEN 'analyst' ELSE 'operator' END AS role
        FROM {supplier}""",
    "subject": """SELECT p_partkey AS id, p_name AS name, p_name AS designator,
        CASE p_size % 4 WHEN 0 THEN 'friend' WHEN 1 THEN 'foe' WHEN 2 THEN 'neutral'
            ELSE 'unknown' END AS iff_status FROM {part}""",
    "asset_status": """SELECT event_id AS id, user_id AS asset_id, event_id % 25 AS region_id,
        CAST(event_id * 37 % 18000 AS DOUBLE) / 100 - 90 AS lat,
        CAST(event_id * 53 % 36000 AS DOUBLE) / 100 - 180 AS lon,
        CAST(20 + {K} % 80 AS DOUBLE) AS health_percent, ts AS event_time
        FROM {events} WHERE event_type = 'view'""",
    "condition": """SELECT event_id AS id, event_id % 25 AS region_id,
        CASE {K} % 4 WHEN 0 THEN 'rain' WHEN 1 THEN 'fog' WHEN 2 THEN 'storm'
            ELSE 'solar_flare' END AS type,
        CAST({K} AS DOUBLE) / 100 AS intensity, value AS wind_speed_kmh,
        CAST({K} AS DOUBLE) / 5 AS precipitation_mm, ts AS event_time
        FROM {events} WHERE event_type = 'error'""",
    "supply": """SELECT event_id AS id, user_id AS asset_id, event_id % 27 AS region_id,
        CAST({K} AS DOUBLE) AS supply_level,
        ts AS event_time FROM {events} WHERE event_type = 'purchase'""",
    "interference": """SELECT event_id AS id, event_id % 200 AS source_id, user_id % 10 AS sensor_id,
        CASE {K} % 4 WHEN 0 THEN 'jammed' WHEN 1 THEN 'spoofed' WHEN 2 THEN 'disabled'
            ELSE 'ddos' END AS effect, ts AS event_time
        FROM {events} WHERE event_type = 'signup'""",
    "observation": """SELECT event_id AS id, event_id % 10 AS sensor_id,
        event_id % 200 AS subject_id, event_id % 25 AS region_id,
        CAST(event_id * 41 % 18000 AS DOUBLE) / 100 - 90 AS lat,
        CAST(event_id * 59 % 36000 AS DOUBLE) / 100 - 180 AS lon,
        value * 10 AS speed_kmh, CAST(100 + {K} AS DOUBLE) / 200 AS confidence, ts AS event_time
        FROM {events} WHERE event_type = 'click'""",
    "interaction": """SELECT event_id AS id, user_id AS asset_id, event_id % 200 AS subject_id,
        event_id % 1500 AS equipment_id,
        CASE {K} % 4 WHEN 0 THEN 'destroyed' WHEN 1 THEN 'damaged' WHEN 2 THEN 'escaped'
            ELSE 'missed' END AS result, ts AS event_time
        FROM {events} WHERE event_type = 'click'""",
    "incident": """SELECT o_orderkey AS id, o_orderkey AS observation_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high'
            WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END AS threat_level, o_orderdate AS created_at
        FROM {orders}""",
    "instruction": """SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS incident_id,
        l_suppkey AS user_id,
        CASE l_returnflag WHEN 'A' THEN 'hold' WHEN 'R' THEN 'retreat' ELSE 'recon' END AS action,
        l_shipdate AS event_time FROM {lineitem}""",
    "policy_update": """SELECT event_id AS id,
        CASE {K} % 3 WHEN 0 THEN '["r1"]' WHEN 1 THEN '["r1","r2"]' ELSE '["r2","r3","r4"]' END
            AS rules, ts AS event_time FROM {events}""",
}


# Instructions with the asset they name, for the checks of references and keys.
CHECKED = {
    "instruction": """SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS incident_id,
        l_partkey AS asset_id, l_suppkey AS user_id FROM {lineitem}"""
}


class Tables(Mapping[str, DataFrame]):
    """Roles by name (``t["asset"]``) and driver tables (``t.raw("orders")``) of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        # reading a table looks up its files and schema, so each is defined once
        self._raw: dict[str, DataFrame] = {}
        self._roles: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def __getitem__(self, role: str) -> DataFrame:
        if role not in self._roles:
            self._roles[role] = self._define(ROLES[role])
        return self._roles[role]

    def checked(self) -> dict[str, DataFrame]:
        """All roles, with every column that a reference or a key names."""
        return {**{role: self[role] for role in ROLES}, **{role: self._define(CHECKED[role]) for role in CHECKED}}

    def _define(self, text: str) -> DataFrame:
        text = text.replace("{K}", _K["spark"])
        used = re.findall(r"\{(\w+)\}", text)
        return self.spark.sql(text, **{name: self.raw(name) for name in used})

    def __iter__(self) -> Iterator[str]:
        return iter(ROLES)

    def __len__(self) -> int:
        return len(ROLES)


class Replaced(Mapping[str, DataFrame]):
    """A role mapping with some roles replaced."""

    def __init__(self, base: Mapping[str, DataFrame], **replaced: DataFrame):
        self.base, self.replaced = base, replaced

    def __getitem__(self, role: str) -> DataFrame:
        return self.replaced[role] if role in self.replaced else self.base[role]

    def __iter__(self) -> Iterator[str]:
        return iter(self.base)

    def __len__(self) -> int:
        return len(self.base)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name with its SQL (roles are ``r_<role>``)."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, None if sql is None else with_roles(sql))
        return build

    return register


def with_roles(sql: str) -> str:
    """Prefix the definitions of the role views a statement uses."""
    used = [r for r in ROLES if re.search(rf"\br_{r}\b", sql)]
    if not used:
        return sql.strip()
    views = []
    for role in used:
        text = ROLES[role].replace("{K}", _K["oracle"])
        views.append(f"r_{role} AS ({re.sub(r'[{}]', '', text)})")
    body = sql.strip()
    joined = ",\n".join(views)
    if body.upper().startswith("WITH"):
        return f"WITH {joined},\n{body[4:].lstrip()}"
    return f"WITH {joined}\n{body}"
