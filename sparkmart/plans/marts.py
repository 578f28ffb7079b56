"""The five marts.

Every mart is a function of a mapping role -> DataFrame and comes in two variants:

``product``  penalties multiply, and the newest condition applies even if it is later than the fact
``linear``   penalties add up, and the condition is the newest one at or before the fact; the
             asset and subject marts keep one row per region

Inputs are current-state tables (one row per ``id``), so the grain follows from the joins and no
mart needs a last deduplication.  Columns are selected before every reduction, which is what
lets the parquet scans read only those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import rules
from sparkmart.functions.geo import distance_or_unknown, haversine_km, travel_seconds
from sparkmart.operators.asof import Right, asof_join, asof_join_many
from sparkmart.operators.keyed import fill_defaults, latest_snapshot, newest_of, require_keys
from sparkmart.operators.skew import join_many_to_one
from sparkmart.specs import (
    CONFIDENCE_JAM_WEIGHT,
    CONFIDENCE_POOR_WEIGHT,
    ENUMS,
    FOG_KINDS,
    HIT_FOG_WEIGHT,
    HIT_PRECIPITATION_WEIGHT,
    IMPACT_TERRAIN_FACTOR,
    JAM_EFFECT,
    MARTS,
    POOR_KINDS,
    RANGE_WIND_WEIGHT,
    REVIEW_FOG_WEIGHT,
    REVIEW_JAM_WEIGHT,
    SUPPLY_KINDS,
    SUPPLY_TERRAIN_FACTOR,
    SUPPLY_WEATHER_WEIGHT,
    TERRAIN_FACTOR,
    MartSpec,
)

Tables = Mapping[str, DataFrame]
PRODUCT, LINEAR = "product", "linear"
_ID_TIES = ("id",)


def _newest(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Newest row per key, reduced to the columns a mart reads."""
    wanted = list(dict.fromkeys([*keys, *columns]))
    needed = df.select(*dict.fromkeys([*wanted, "event_time", "id"]))
    return latest_snapshot(needed, keys, ties=_ID_TIES).select(*wanted)


def _regions(t: Tables) -> DataFrame:
    return t["region"].select(F.col("id").alias("region_id"), "terrain_type")


def _newest_condition(t: Tables, measures: Sequence[str], times: bool = False) -> DataFrame:
    extra = ["event_time"] if times else []
    newest = _newest(t["condition"], ["region_id"], [*measures, *extra])
    names = {m: f"condition_{m}" for m in [*measures, *extra]}
    return newest.withColumnsRenamed(names)


def _asof_condition(
    facts: DataFrame, t: Tables, measures: Sequence[str], times: bool = False
) -> DataFrame:
    """Newest condition at or before each fact."""
    extra = ["event_time"] if times else []
    return asof_join(
        facts,
        t["condition"],
        on=[("region_id", "region_id")],
        left_time="event_time",
        right_time="event_time",
        select={f"condition_{m}": m for m in [*measures, *extra]},
        derived=True,
    )


def _placed(
    facts: DataFrame,
    t: Tables,
    measures: Sequence[str],
    variant: str,
    times: bool = False,
) -> DataFrame:
    """Facts with the terrain of their region and the condition that applies to them."""
    if variant == PRODUCT:
        # region and newest condition are one row per region: joined first, the facts move once
        places = _regions(t).join(_newest_condition(t, measures, times), "region_id", "left")
        return facts.join(places, "region_id")
    return _asof_condition(facts, t, measures, times).join(_regions(t), "region_id")


def _severity(kinds: Sequence[str]) -> Column:
    """Intensity where the condition is of one of these kinds, else zero."""
    present = rules.indicator(F.col("condition_type").isin(*kinds))
    return rules.zero_if_null(F.col("condition_intensity")) * present


def _jammed(column: str = "interference_effect") -> Column:
    return rules.indicator(F.col(column) == JAM_EFFECT)


def _since(facts: DataFrame, since: Column | None) -> DataFrame:
    """Only the facts after ``since``, taken before anything is reduced or joined.

    A mart's rows after a time are those of the facts after it: its time is the fact's own, and a key whose newest row
    is after a time has the same newest row among those after it.
    """
    return facts if since is None else facts.filter(F.col("event_time") > since)


def _finish(df: DataFrame, spec: MartSpec) -> DataFrame:
    return require_keys(fill_defaults(df, spec.defaults), spec.required)


def _check(variant: str) -> None:
    if variant not in (PRODUCT, LINEAR):
        raise ValueError(f"unknown variant {variant!r}: use 'product' or 'linear'")


def asset_strength(
    t: Tables, variant: str = PRODUCT, clamp: bool = False, since: Column | None = None
) -> DataFrame:
    """Terrain- and condition-adjusted strength of every (asset, equipment)."""
    _check(variant)
    grain = ["asset_id"] if variant == PRODUCT else ["asset_id", "region_id"]
    status = _newest(_since(t["asset_status"], since), grain, ["region_id", "health_percent", "event_time"])
    measures = ["type", "intensity", "wind_speed_kmh", "precipitation_mm"]
    known = t["asset"].select(F.col("id").alias("asset_id"))
    equipment = t["equipment"].select(
        "asset_id", F.col("id").alias("equipment_id"), "range_km", "hit_probability"
    )
    # everything joins the few status rows first, so equipment meets finished rows
    placed = _placed(status.join(known, "asset_id"), t, measures, variant)
    if variant == PRODUCT:
        # one row per asset: equipment of a hot asset need not gather in one task
        rows = join_many_to_one(equipment, placed, ["asset_id"])
    else:
        rows = placed.join(equipment, "asset_id")
    wind = rules.zero_if_null(F.col("condition_wind_speed_kmh"))
    wet = F.lit(HIT_PRECIPITATION_WEIGHT) * rules.zero_if_null(F.col("condition_precipitation_mm"))
    fog = F.lit(HIT_FOG_WEIGHT) * _severity(FOG_KINDS)
    terrain = rules.lookup_factor(F.col("terrain_type"), TERRAIN_FACTOR)
    hit = rules.penalise(F.col("hit_probability").cast("double"), [wet, fog], variant, clamp)
    health = F.col("health_percent").cast("double")
    if variant == LINEAR:
        health = F.coalesce(health, F.lit(0.0))
    scored = rows.withColumn("terrain_factor", terrain).withColumn("adjusted_hit_probability", hit)
    return _finish(
        scored.select(
            "asset_id",
            "region_id",
            "equipment_id",
            "terrain_factor",
            (
                F.col("range_km").cast("double")
                * F.col("terrain_factor")
                * (F.lit(1.0) - F.lit(RANGE_WIND_WEIGHT) * wind / F.lit(100))
            ).alias("effective_range_km"),
            "adjusted_hit_probability",
            (F.col("adjusted_hit_probability") * health / F.lit(100)).alias("strength"),
            "event_time",
        ),
        MARTS["asset_strength"],
    )


def subject_priority(
    t: Tables, variant: str = PRODUCT, clamp: bool = False, since: Column | None = None
) -> DataFrame:
    """Class, distance and response time of every observed subject."""
    _check(variant)
    grain = ["subject_id"] if variant == PRODUCT else ["subject_id", "region_id"]
    seen = _newest(
        _since(t["observation"], since),
        grain,
        ["sensor_id", "region_id", "lat", "lon", "speed_kmh", "confidence", "event_time"],
    )
    subject = t["subject"].select(F.col("id").alias("subject_id"), "iff_status")
    sensor = t["sensor"].select(F.col("id").alias("sensor_id"), F.col("asset_id").alias("observer_id"))
    position = _newest(t["asset_status"], ["asset_id"], ["lat", "lon"]).select(
        F.col("asset_id").alias("observer_id"),
        F.col("lat").alias("observer_lat"),
        F.col("lon").alias("observer_lon"),
    )
    if variant == PRODUCT:
        effect = _newest(t["interference"], ["sensor_id"], ["effect"])
        effect = effect.withColumnRenamed("effect", "interference_effect")
        seen = seen.join(effect, "sensor_id", "left")
    else:
        seen = asof_join(
            seen,
            t["interference"],
            on=[("sensor_id", "sensor_id")],
            left_time="event_time",
            right_time="event_time",
            select={"interference_effect": "effect"},
            derived=True,
        )
    measures = ["type", "intensity"]
    if variant == PRODUCT:
        seen = seen.join(_newest_condition(t, measures), "region_id", "left")
    else:
        seen = _asof_condition(seen, t, measures)
    rows = (
        seen.join(subject, "subject_id")
        .join(sensor, "sensor_id", "inner" if variant == PRODUCT else "left")
        .join(position, "observer_id", "left")
    )
    poor = F.lit(CONFIDENCE_POOR_WEIGHT) * _severity(POOR_KINDS)
    jam = F.lit(CONFIDENCE_JAM_WEIGHT) * _jammed()
    confidence = rules.penalise(F.col("confidence").cast("double"), [poor, jam], variant, clamp)
    distance = haversine_km(
        F.col("observer_lat"), F.col("observer_lon"), F.col("lat"), F.col("lon")
    )
    scored = rows.withColumns(
        {"adjusted_confidence": confidence, "distance_km": distance_or_unknown(distance)}
    )
    return _finish(
        scored.select(
            "subject_id",
            "region_id",
            "iff_status",
            "adjusted_confidence",
            rules.priority_class(
                F.col("speed_kmh"), F.col("iff_status"), F.col("adjusted_confidence")
            ).alias("predicted_level"),
            "distance_km",
            travel_seconds(F.col("distance_km"), F.col("speed_kmh")).alias("response_time_sec"),
            "event_time",
        ),
        MARTS["subject_priority"],
    )


def incident_instructions(t: Tables, variant: str = PRODUCT, strict: bool = False) -> DataFrame:
    """High and critical incidents with their latest instruction.

    Incidents without an instruction are kept unless ``strict``.  The action shows only where a
    commander issued it; elsewhere it is ``'none'`` (product) or null (linear).
    """
    _check(variant)
    incident = t["incident"].select(
        F.col("id").alias("incident_id"), "observation_id", "threat_level", "created_at"
    )
    incident = incident.filter(rules.at_least(F.col("threat_level"), "high", ENUMS["level"]))
    observation = t["observation"].select(F.col("id").alias("observation_id"), "region_id")
    user = t["operator_user"].select("id", "role")
    issued = t["instruction"].select(
        "incident_id",
        F.col("id").alias("instruction_id"),
        "user_id",
        "action",
        F.col("event_time").alias("issued_at"),
    )
    if strict:
        issued = issued.filter(F.col("instruction_id").isNotNull()).join(
            user, F.col("user_id") == F.col("id"), "left_semi"
        )
    # The row kept is the one of latest greatest(created, issued), then of greatest id.  That is
    # the last issued one if it came after the incident, else the one of greatest id: two
    # candidates, found by one map-side reduced aggregate, so no incident fans out.
    candidates = issued.groupBy("incident_id").agg(
        newest_of(issued, ["incident_id"], ["issued_at", "instruction_id", "user_id"]).alias("_last"),
        newest_of(issued, ["incident_id"], ["instruction_id", "issued_at", "user_id"]).alias("_top"),
    )
    after = F.coalesce(F.col("_last.issued_at") > F.col("created_at"), F.lit(False))
    picked = {
        c: F.when(after, F.col("_last")[c]).otherwise(F.col("_top")[c])
        for c in ("instruction_id", "user_id", "action", "issued_at")
    }
    rows = (
        incident.join(observation, "observation_id")
        .join(candidates, "incident_id", "inner" if strict else "left")
        .withColumns(picked)
        .join(user, F.col("user_id") == F.col("id"), "left")
    )
    hidden = F.lit("none") if variant == PRODUCT else None
    action = rules.gated(F.col("action"), F.col("role") == "commander", hidden)
    if variant == PRODUCT:
        action = F.coalesce(action, F.lit("none"))
    shaped = rows.select(
        "incident_id",
        "observation_id",
        "region_id",
        "threat_level",
        "instruction_id",
        action.alias("action"),
        F.col("id").alias("user_id"),
        rules.latest_of([F.col("created_at"), F.col("issued_at")]).alias("event_time"),
    )
    return _finish(shaped, MARTS["incident_instructions"])


def supply_readiness(t: Tables, variant: str = PRODUCT, clamp: bool = False) -> DataFrame:
    """Projected supply and feasibility of resupply for every asset."""
    _check(variant)
    supply = _newest(t["supply"], ["asset_id"], ["supply_level", "event_time"])
    if variant == PRODUCT:
        place = _newest(t["asset_status"], ["asset_id"], ["region_id"])
    else:
        place = t["asset_status"].select("asset_id", "region_id").distinct()
    facts = supply.join(place, "asset_id")
    measures = ["type", "intensity", "wind_speed_kmh", "precipitation_mm"]
    rows = _placed(facts, t, measures, variant, times=True)
    terrain = rules.lookup_factor(F.col("terrain_type"), SUPPLY_TERRAIN_FACTOR)
    loss = F.lit(SUPPLY_WEATHER_WEIGHT) * _severity(SUPPLY_KINDS) * terrain
    level = F.col("supply_level").cast("double")
    return _finish(
        rows.select(
            "asset_id",
            "region_id",
            level.alias("supply_level"),
            rules.penalise(level, [loss], variant, clamp).alias("projected_supply"),
            rules.feasible(
                F.col("condition_wind_speed_kmh"), F.col("condition_precipitation_mm")
            ).alias("resupply_feasibility"),
            rules.latest_of([F.col("event_time"), F.col("condition_event_time")]).alias("event_time"),
        ),
        MARTS["supply_readiness"],
    )


def interference_by_asset(t: Tables) -> DataFrame:
    """Interference keyed by the asset that owns the sensor it hit."""
    sensor = t["sensor"].select(F.col("id").alias("sensor_id"), "asset_id")
    return t["interference"].join(sensor, "sensor_id")


def interaction_review(
    t: Tables,
    variant: str = PRODUCT,
    clamp: bool = False,
    interference: DataFrame | None = None,
    interference_key: str = "asset_id",
    since: Column | None = None,
) -> DataFrame:
    """Interactions with the region, condition and interference that held at their time.

    ``interference`` may replace the default link (through the sensors of the asset); its
    ``interference_key`` is matched with the interaction's asset.
    """
    _check(variant)
    facts = _since(t["interaction"], since).select(
        "id", "asset_id", "subject_id", "equipment_id", "result", "event_time"
    )
    other = interference_by_asset(t) if interference is None else interference
    # both sides are keyed by the asset, so one pass over the facts finds both
    exposed = asof_join_many(
        facts,
        ["asset_id"],
        "event_time",
        [
            Right(t["asset_status"], ["asset_id"], "event_time", {"region_id": "region_id"}, required=True),
            Right(other, [interference_key], "event_time", {"interference_effect": "effect"}),
        ],
    )
    placed = _asof_condition(exposed, t, ["type", "intensity"])
    how = "left" if variant == PRODUCT else "inner"
    equipment = t["equipment"].select(F.col("id").alias("equipment_id"), "hit_probability")
    rows = placed.join(_regions(t), "region_id", how).join(equipment, "equipment_id", how)
    fog = F.lit(REVIEW_FOG_WEIGHT) * _severity(FOG_KINDS)
    jam = F.lit(REVIEW_JAM_WEIGHT) * _jammed()
    foggy = F.lit(REVIEW_FOG_WEIGHT) * rules.indicator(F.col("condition_type").isin(*FOG_KINDS))
    impact = rules.penalise(F.lit(1.0), [foggy, jam], variant, clamp) * rules.lookup_factor(
        F.col("terrain_type"), IMPACT_TERRAIN_FACTOR
    )
    return _finish(
        rows.select(
            F.col("id").alias("interaction_id"),
            "asset_id",
            "subject_id",
            "equipment_id",
            "region_id",
            "result",
            rules.penalise(F.col("hit_probability").cast("double"), [fog, jam], variant, clamp).alias(
                "adjusted_hit_probability"
            ),
            impact.alias("impact_factor"),
            "event_time",
        ),
        MARTS["interaction_review"],
    )


BUILDERS = {
    "asset_strength": asset_strength,
    "subject_priority": subject_priority,
    "incident_instructions": incident_instructions,
    "supply_readiness": supply_readiness,
    "interaction_review": interaction_review,
}


def mart_key(name: str, variant: str) -> tuple[str, ...]:
    """Business key of a mart; linear asset and subject marts also keep the region."""
    key = MARTS[name].key
    per_region = name in ("asset_strength", "subject_priority", "supply_readiness")
    if variant == LINEAR and per_region:
        return (key[0], "region_id", *key[1:])
    return key


def publish(df: DataFrame, name: str, asof: Column | None = None) -> DataFrame:
    """Sink types of a mart: measures as DECIMAL(19,4); rows without a time get ``asof``, as a sink that requires one needs."""
    spec = MARTS[name]
    typed = df.withColumns({c: F.col(c).cast("decimal(19,4)") for c in spec.decimals})
    return typed if asof is None else typed.withColumn("event_time", F.coalesce("event_time", asof))
