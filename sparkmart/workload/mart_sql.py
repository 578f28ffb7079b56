"""SQL of the five marts, written from their formulas as a check that shares no plan with Spark.

Every mart is facts, what applies to them, and terms that reduce a measure.  What applies is the
newest row of a key (product) or the newest at or before the fact (linear, and reviews always), found
by numbering the rows of a range join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from sparkmart import specs

PRODUCT, LINEAR = "product", "linear"

_LATEST = """(SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER
    (PARTITION BY {keys} ORDER BY event_time DESC NULLS LAST, id DESC) AS rn FROM {table}) WHERE rn = 1)"""


def latest_sql(table: str, keys: str) -> str:
    return _LATEST.format(table=table, keys=keys)


def asof_sql(left: str, right: str, match: str, row: str, columns: str, how: str = "LEFT") -> str:
    """Newest right row at or before each left row; ``row`` lists columns that identify it."""
    partition = ", ".join(f"l.{c.strip()}" for c in row.split(","))
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT l.*, {columns}, ROW_NUMBER() OVER (
        PARTITION BY {partition} ORDER BY r.event_time DESC NULLS LAST, r.id DESC NULLS LAST) AS rn
        FROM {left} l {how} JOIN {right} r ON {match} AND r.event_time <= l.event_time) WHERE rn = 1)"""


def _applying(facts: str, table: str, key: str, variant: str, columns: Sequence[str], row: str = "id") -> str:
    """Facts with columns of the row of ``table`` that applies to them, if any."""
    match, brought = f"r.{key} = l.{key}", ", ".join(f"r.{c}" for c in columns)
    if variant == LINEAR:
        return asof_sql(facts, table, match, row, brought)
    return f"(SELECT l.*, {brought} FROM {facts} l LEFT JOIN {latest_sql(table, key)} r ON {match})"


def _reduced(measure: str, terms: Sequence[str], variant: str, clamp: bool = False) -> str:
    """The measure times what the terms leave of it: each in turn (product), or all at once."""
    if variant == PRODUCT:
        return " * ".join([measure, *[f"(1 - {t})" for t in terms]])
    left = f"1 - {' - '.join(terms)}"
    return f"{measure} * {f'greatest(0.0, least(1.0, {left}))' if clamp else f'({left})'}"


def _one_of(column: str, values: Sequence[str]) -> str:
    return f"CASE WHEN {column} IN ({', '.join(map(repr, values))}) THEN 1 ELSE 0 END"


def _factor(column: str, factors: Mapping[str, float]) -> str:
    cases = " ".join(f"WHEN {value!r} THEN {factor}" for value, factor in factors.items())
    return f"CASE {column} {cases} ELSE 1.0 END"


def _force(kinds: Sequence[str]) -> str:
    return f"coalesce(intensity, 0) * ({_one_of('type', kinds)})"


# what a condition does, whichever facts it meets
_WEATHER = f"""weather AS (
    SELECT id, region_id, event_time, {_one_of("type", specs.FOG_KINDS)} AS foggy,
        {_force(specs.FOG_KINDS)} AS fog_force, {_force(specs.POOR_KINDS)} AS poor_force,
        {_force(specs.SUPPLY_KINDS)} AS supply_force,
        wind_speed_kmh AS wind, precipitation_mm AS wet, event_time AS weather_time
    FROM r_condition)"""
_WIND, _WET = "coalesce(wind, 0)", "coalesce(wet, 0)"
_JAM = _one_of("effect", [specs.JAM_EFFECT])


def strength_sql(variant: str) -> str:
    status = latest_sql("r_asset_status", "asset_id" if variant == PRODUCT else "asset_id, region_id")
    terms = [f"{specs.HIT_PRECIPITATION_WEIGHT} * {_WET}", f"{specs.HIT_FOG_WEIGHT} * coalesce(fog_force, 0)"]
    return f"""WITH {_WEATHER},
    placed AS (
        SELECT * FROM {_applying(status, "weather", "region_id", variant, ["fog_force", "wind", "wet"])}),
    armed AS (
        SELECT placed.*, gear.id AS equipment_id, gear.range_km,
            CAST({_factor("terrain_type", specs.TERRAIN_FACTOR)} AS DOUBLE) AS terrain_factor,
            {_reduced("gear.hit_probability", terms, variant)} AS adjusted_hit_probability
        FROM placed
        JOIN r_region place ON place.id = placed.region_id
        JOIN r_equipment gear ON gear.asset_id = placed.asset_id
        WHERE placed.asset_id IN (SELECT id FROM r_asset))
    SELECT asset_id, region_id, equipment_id, terrain_factor, adjusted_hit_probability, event_time,
        range_km * terrain_factor * (1 - {specs.RANGE_WIND_WEIGHT} * {_WIND} / 100) AS effective_range_km,
        adjusted_hit_probability * health_percent / 100 AS strength
    FROM armed"""


def priority_sql(variant: str, clamp: bool = False) -> str:
    seen = latest_sql("r_observation", "subject_id" if variant == PRODUCT else "subject_id, region_id")
    seen = _applying(seen, "weather", "region_id", variant, ["poor_force"])
    seen = _applying(seen, "r_interference", "sensor_id", variant, ["effect"])
    terms = [
        f"{specs.CONFIDENCE_POOR_WEIGHT} * coalesce(poor_force, 0)",
        f"{specs.CONFIDENCE_JAM_WEIGHT} * {_JAM}",
    ]
    unknown = f"{specs.UNKNOWN_DISTANCE:.0e}"
    # a subject's sensor must be known in the product variant only
    sensed = "JOIN" if variant == PRODUCT else "LEFT JOIN"
    return f"""WITH {_WEATHER},
    observers AS (
        SELECT sensor.id AS sensor_id, own.lat AS own_lat, own.lon AS own_lon
        FROM r_sensor sensor
        LEFT JOIN {latest_sql("r_asset_status", "asset_id")} own ON own.asset_id = sensor.asset_id),
    rated AS (
        SELECT seen.*, who.iff_status, own_lat, own_lon,
            {_reduced("seen.confidence", terms, variant, clamp)} AS adjusted_confidence,
            power(sin(radians(seen.lat - own_lat) / 2), 2) + cos(radians(own_lat)) * cos(radians(seen.lat))
                * power(sin(radians(seen.lon - own_lon) / 2), 2) AS chord
        FROM {seen} seen
        JOIN r_subject who ON who.id = seen.subject_id
        {sensed} observers ON observers.sensor_id = seen.sensor_id),
    ranged AS (
        SELECT *, CASE WHEN own_lat IS NOT NULL
            THEN 2 * {specs.EARTH_RADIUS_KM} * asin(sqrt(least(1.0, chord))) END AS km
        FROM rated)
    SELECT subject_id, region_id, coalesce(iff_status, 'unknown') AS iff_status, adjusted_confidence, event_time,
        CASE WHEN adjusted_confidence > {specs.CONFIDENT}
                AND (iff_status = '{specs.HOSTILE}' OR speed_kmh > {specs.FAST_KMH})
            THEN 'high' ELSE 'medium' END AS predicted_level,
        round(coalesce(km, {unknown}), 4) AS distance_km,
        round(CASE WHEN km IS NULL OR coalesce(speed_kmh, 0) <= 0 THEN {unknown}
            ELSE km / speed_kmh * 3600 END, 4) AS response_time_sec
    FROM ranged"""


def incident_sql(variant: str, strict: bool = False) -> str:
    """The instruction of the latest time, then of the greatest id, stands for its incident."""
    answered = "JOIN" if strict else "LEFT JOIN"
    hidden = "'none'" if variant == PRODUCT else "NULL"
    last = ("event_time", "instruction_id", "issued_at", "issued_by", "issued")
    return f"""WITH answers AS (
        SELECT given.incident_id, given.id AS instruction_id, given.event_time AS issued_at,
            given.user_id AS issued_by, given.action AS issued, issuer.id AS user_id,
            CASE issuer.role WHEN 'commander' THEN given.action ELSE {hidden} END AS action
        FROM r_instruction given {answered} r_operator_user issuer ON given.user_id = issuer.id),
    pairs AS (
        SELECT urgent.id AS incident_id, urgent.observation_id, region_id, threat_level,
            answers.* EXCLUDE (incident_id, action), coalesce(action, {hidden}) AS action,
            greatest(issued_at, urgent.created_at) AS event_time
        FROM r_incident urgent
        JOIN (SELECT id, region_id FROM r_observation) seen ON seen.id = urgent.observation_id
        {answered} answers ON answers.incident_id = urgent.id
        WHERE threat_level IN {specs.ENUMS["level"][2:]!r})
    SELECT * EXCLUDE (issued_at, issued_by, issued) FROM pairs
    QUALIFY ROW_NUMBER() OVER (PARTITION BY incident_id
        ORDER BY {", ".join(f"{c} DESC NULLS LAST" for c in last)}) = 1"""


def supply_sql(variant: str) -> str:
    places = latest_sql("r_asset_status", "asset_id")
    if variant == LINEAR:
        places = "(SELECT DISTINCT asset_id, region_id FROM r_asset_status)"
    stocks = f"""(SELECT stock.id, asset_id, place.region_id, stock.supply_level, stock.event_time
        FROM {latest_sql("r_supply", "asset_id")} stock JOIN {places} place USING (asset_id))"""
    brought = ["supply_force", "wind", "wet", "weather_time"]
    strain = _factor("terrain_type", specs.SUPPLY_TERRAIN_FACTOR)
    term = f"{specs.SUPPLY_WEATHER_WEIGHT} * coalesce(supply_force, 0) * {strain}"
    return f"""WITH {_WEATHER},
    stocked AS (SELECT * FROM {_applying(stocks, "weather", "region_id", variant, brought, "id, region_id")})
    SELECT asset_id, region_id, supply_level, {_reduced("supply_level", [term], variant)} AS projected_supply,
        CASE WHEN {_WIND} <= {specs.MAX_WIND_KMH} AND {_WET} <= {specs.MAX_PRECIPITATION_MM}
            THEN 1 ELSE 0 END AS resupply_feasibility,
        greatest(weather_time, event_time) AS event_time
    FROM stocked JOIN (SELECT id AS region_id, terrain_type FROM r_region) USING (region_id)"""


def review_sql(variant: str) -> str:
    by_asset = "(SELECT i.*, s.asset_id FROM r_interference i JOIN r_sensor s ON s.id = i.sensor_id)"
    located = asof_sql(
        "r_interaction", "r_asset_status", "r.asset_id = l.asset_id", "id", "r.region_id", "INNER"
    )
    exposed = _applying(located, by_asset, "asset_id", LINEAR, ["effect"])
    known = "LEFT JOIN" if variant == PRODUCT else "JOIN"
    fog, jam = specs.REVIEW_FOG_WEIGHT, specs.REVIEW_JAM_WEIGHT
    hit = [f"{fog} * coalesce(fog_force, 0)", f"{jam} * {_JAM}"]
    impact = [f"CAST({fog} AS DOUBLE) * coalesce(foggy, 0)", f"CAST({jam} AS DOUBLE) * {_JAM}"]
    return f"""WITH {_WEATHER},
    met AS (
        SELECT * FROM {_applying(exposed, "weather", "region_id", LINEAR, ["foggy", "fog_force"])})
    SELECT met.id AS interaction_id, met.asset_id, subject_id, met.equipment_id, met.region_id, met.event_time,
        coalesce(result, 'missed') AS result,
        coalesce({_reduced("gear.hit_probability", hit, variant)}, 0) AS adjusted_hit_probability,
        {_reduced("CAST(1 AS DOUBLE)", impact, variant)}
            * {_factor("terrain_type", specs.IMPACT_TERRAIN_FACTOR)} AS impact_factor
    FROM met
    {known} r_region place ON place.id = met.region_id
    {known} r_equipment gear ON gear.id = met.equipment_id"""


_BY_MART = {
    "asset_strength": strength_sql,
    "subject_priority": priority_sql,
    "incident_instructions": incident_sql,
    "supply_readiness": supply_sql,
    "interaction_review": review_sql,
}
MART_SQL = {(name, v): write(v) for name, write in _BY_MART.items() for v in (PRODUCT, LINEAR)}
