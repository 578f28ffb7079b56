"""Declared shapes of the silver tables and of the marts.

Everything here is data: schemas, keys, time columns, allowed values, ranges, references
and defaults.  Operators take these specs instead of hard-coding table knowledge.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Reference:
    """``column`` of the owning table points at ``target`` table's key."""

    column: str
    target: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    key: tuple[str, ...] = ("id",)
    time_column: str | None = None
    enums: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()

    @property
    def schema(self) -> T.StructType:
        # parsed without a session so that specs can be imported anywhere
        return T.StructType(
            [
                T.StructField(name, _TYPES[kind], True)
                for name, kind in (part.split() for part in self.ddl.split(","))
            ]
        )


@dataclass(frozen=True)
class MartSpec:
    name: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    defaults: dict[str, object]
    time_column: str = "event_time"
    decimals: tuple[str, ...] = ()


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    # d4 / d8: the two decimal shapes used by every source table
    "d4": T.DecimalType(19, 4),
    "d8": T.DecimalType(19, 8),
}

# Allowed values of the nine enumerated columns, in declared order.
# For ``level`` the order is the ranking low < medium < high < critical.
ENUMS: dict[str, tuple[str, ...]] = {
    "asset_state": ("ready", "engaged", "damaged", "destroyed", "retreat"),
    "domain": ("land", "sea", "air", "space", "cyber"),
    "incident_state": ("active", "resolved", "acknowledged", "dismissed"),
    "effect": ("jammed", "spoofed", "disabled", "ddos"),
    "condition_type": ("rain", "fog", "storm", "solar_flare"),
    "result": ("destroyed", "damaged", "escaped", "missed"),
    "level": ("low", "medium", "high", "critical"),
    "iff_status": ("friend", "foe", "neutral", "unknown"),
    "role": ("commander", "analyst", "operator"),
}

# Ordered classification labels, least restricted first.
CLASSIFICATIONS = ("unclassified", "confidential", "secret", "top_secret")

# Factors of terrain (any other terrain counts 1.0).
TERRAIN_FACTOR = {"mountain": 0.8, "swamp": 0.7}
IMPACT_TERRAIN_FACTOR = {"mountain": 0.8}
SUPPLY_TERRAIN_FACTOR = {"mountain": 0.7}

# Weights of the penalty terms, and the kinds of condition they apply to.
RANGE_WIND_WEIGHT = 0.1
HIT_PRECIPITATION_WEIGHT = 0.15
HIT_FOG_WEIGHT = 0.2
CONFIDENCE_POOR_WEIGHT = 0.3
CONFIDENCE_JAM_WEIGHT = 0.5
SUPPLY_WEATHER_WEIGHT = 0.5
REVIEW_FOG_WEIGHT = 0.2
REVIEW_JAM_WEIGHT = 0.3
FOG_KINDS = ("fog",)
POOR_KINDS = ("fog", "storm")
SUPPLY_KINDS = ("storm", "rain")
JAM_EFFECT = "jammed"

# Thresholds of the classifier, of feasibility and of the supply view.
FAST_KMH = 500
HOSTILE = "foe"
CONFIDENT = 0.8
MAX_WIND_KMH = 50
MAX_PRECIPITATION_MM = 10
LOW_SUPPLY = 60
SUPPLY_BANDS = ((20, "CRITICAL"), (40, "LOW"))
SUPPLY_BAND_ABOVE = "MODERATE"

# Stand-in for an unknown distance or time, and the radius of the earth.
UNKNOWN_DISTANCE = 1e9
EARTH_RADIUS_KM = 6371.0

_UNIT = (0.0, 1.0)
_PERCENT = (0.0, 100.0)
_LAT = (-90.0, 90.0)
_LON = (-180.0, 180.0)
_NON_NEGATIVE = (0.0, None)


def _table(name: str, ddl: str, **kw) -> TableSpec:
    return TableSpec(name, " ".join(ddl.split()), **kw)


# Columns, types, ranges, allowed values and references of the tables, which a mart's result depends
TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        _table(
            "region",
            """id string, region_name string, terrain_type string, infrastructure_level d4,
               area_sqkm d4, lat_center d8, lon_center d8, classification string""",
            ranges={
                "infrastructure_level": _UNIT,
                "area_sqkm": _NON_NEGATIVE,
                "lat_center": _LAT,
                "lon_center": _LON,
            },
        ),
        _table(
            "subject",
            """id string, designator string, subject_type string, domain string,
               estimated_intent string, threat_level string, iff_status string,
               classification string""",
            enums={"domain": "domain", "threat_level": "level", "iff_status": "iff_status"},
            unique=(("designator",),),
        ),
        _table(
            "operator_user",
            "id string, username string, role string, classification string",
            enums={"role": "role"},
            unique=(("username",),),
        ),
        _table(
            "asset",
            """id string, name string, domain string, asset_type string, status string,
               classification string""",
            enums={"domain": "domain", "status": "asset_state"},
        ),
        _table(
            "equipment",
            """id string, asset_id string, name string, type string, effective_domain string,
               range_km d4, hit_probability d4, speed_kmh d4""",
            enums={"effective_domain": "domain"},
            ranges={"hit_probability": _UNIT},
            references=(Reference("asset_id", "asset"),),
        ),
        _table(
            "sensor",
            "id string, asset_id string, sensor_type string, range_km d4, status string",
            references=(Reference("asset_id", "asset"),),
        ),
        _table(
            "observation",
            """id string, sensor_id string, subject_id string, subject_domain string,
               region_id string, lat d8, lon d8, altitude_depth d4, speed_kmh d4,
               heading_deg d4, confidence d4, iff_status string, threat_level string,
               event_time timestamp""",
            time_column="event_time",
            enums={"subject_domain": "domain", "iff_status": "iff_status", "threat_level": "level"},
            ranges={"lat": _LAT, "lon": _LON, "confidence": _UNIT, "speed_kmh": _NON_NEGATIVE},
            references=(
                Reference("sensor_id", "sensor"),
                Reference("subject_id", "subject"),
                Reference("region_id", "region"),
            ),
        ),
        _table(
            "condition",
            """id string, region_id string, type string, intensity d4, wind_speed_kmh d4,
               precipitation_mm d4, event_time timestamp""",
            time_column="event_time",
            enums={"type": "condition_type"},
            ranges={
                "intensity": _UNIT,
                "wind_speed_kmh": _NON_NEGATIVE,
                "precipitation_mm": _NON_NEGATIVE,
            },
            references=(Reference("region_id", "region"),),
        ),
        _table(
            "asset_status",
            """id string, asset_id string, region_id string, lat d8, lon d8, health_percent d4,
               max_range_km d4, status string, event_time timestamp""",
            time_column="event_time",
            enums={"status": "asset_state"},
            ranges={"lat": _LAT, "lon": _LON, "health_percent": _PERCENT},
            references=(Reference("asset_id", "asset"), Reference("region_id", "region")),
        ),
        _table(
            "supply",
            "id string, asset_id string, region_id string, supply_level d4, event_time timestamp",
            time_column="event_time",
            ranges={"supply_level": _PERCENT},
            references=(Reference("asset_id", "asset"), Reference("region_id", "region")),
        ),
        _table(
            "interference",
            """id string, source_id string, sensor_id string, effect string,
               impact_domain string, level string, event_time timestamp""",
            time_column="event_time",
            enums={"effect": "effect", "impact_domain": "domain", "level": "level"},
            references=(Reference("source_id", "asset"), Reference("sensor_id", "sensor")),
        ),
        _table(
            "interaction",
            """id string, asset_id string, subject_id string, equipment_id string, hit boolean,
               result string, policy_compliant boolean, event_time timestamp""",
            time_column="event_time",
            enums={"result": "result"},
            references=(
                Reference("asset_id", "asset"),
                Reference("equipment_id", "equipment"),
                Reference("subject_id", "subject"),
            ),
        ),
        _table(
            "policy_update",
            "id string, rules string, event_time timestamp",
            time_column="event_time",
        ),
        _table(
            "incident",
            """id string, observation_id string, status string, msg string,
               threat_level string, created_at timestamp""",
            time_column="created_at",
            enums={"status": "incident_state", "threat_level": "level"},
            references=(Reference("observation_id", "observation"),),
        ),
        _table(
            "instruction",
            """id string, incident_id string, asset_id string, user_id string, action string,
               event_time timestamp""",
            time_column="event_time",
            references=(
                Reference("incident_id", "incident"),
                Reference("asset_id", "asset"),
                Reference("user_id", "operator_user"),
            ),
        ),
    )
}

MARTS: dict[str, MartSpec] = {
    m.name: m
    for m in (
        MartSpec(
            "asset_strength",
            key=("asset_id", "equipment_id"),
            required=("asset_id", "region_id", "equipment_id"),
            defaults={
                "terrain_factor": 1.0,
                "effective_range_km": 0.0,
                "adjusted_hit_probability": 0.0,
                "strength": 0.0,
            },
            decimals=("terrain_factor", "effective_range_km", "adjusted_hit_probability", "strength"),
        ),
        MartSpec(
            "subject_priority",
            key=("subject_id",),
            required=("subject_id", "region_id"),
            defaults={
                "iff_status": "unknown",
                "adjusted_confidence": 0.0,
                "predicted_level": "medium",
                "distance_km": 0.0,
                "response_time_sec": 0.0,
            },
            decimals=("adjusted_confidence", "distance_km", "response_time_sec"),
        ),
        MartSpec(
            "incident_instructions",
            key=("incident_id",),
            required=("incident_id", "observation_id", "region_id"),
            defaults={"threat_level": "low"},
        ),
        MartSpec(
            "supply_readiness",
            key=("asset_id",),
            required=("asset_id", "region_id"),
            defaults={"supply_level": 0.0, "projected_supply": 0.0, "resupply_feasibility": 0},
            decimals=("supply_level", "projected_supply"),
        ),
        MartSpec(
            "interaction_review",
            key=("interaction_id",),
            required=("interaction_id", "asset_id", "subject_id", "equipment_id", "region_id"),
            defaults={"result": "missed", "adjusted_hit_probability": 0.0, "impact_factor": 1.0},
            decimals=("adjusted_hit_probability", "impact_factor"),
        ),
    )
}
