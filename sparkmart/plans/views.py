"""Views over the marts.  ``asof`` stands for the present; it may be a literal or a subquery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import rules
from sparkmart.functions.timeval import minutes_between, within
from sparkmart.specs import LOW_SUPPLY, SUPPLY_BAND_ABOVE, SUPPLY_BANDS


def recent_high(subject_priority: DataFrame, asof: Column, interval: str = "1 hour") -> DataFrame:
    rows = subject_priority.filter(
        F.col("predicted_level").isin("high", "critical") & within(F.col("event_time"), asof, interval)
    )
    return rows.select(
        "region_id",
        "subject_id",
        "iff_status",
        "predicted_level",
        "distance_km",
        "response_time_sec",
        "event_time",
    ).orderBy(F.col("event_time").desc())


def low_supply(supply_readiness: DataFrame) -> DataFrame:
    rows = supply_readiness.filter(F.col("supply_level") < LOW_SUPPLY)
    label = rules.band(F.col("supply_level"), SUPPLY_BANDS, SUPPLY_BAND_ABOVE)
    return rows.withColumn("supply_band", label).orderBy("supply_level")


def success_rate(interaction_review: DataFrame, asof: Column, interval: str = "24 hours") -> DataFrame:
    recent = interaction_review.filter(within(F.col("event_time"), asof, interval))
    counted = recent.groupBy("region_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("result") == "destroyed").alias("_hits"),
    )
    rate = rules.guarded_rate_pct(F.col("_hits"), F.col("total"))
    return counted.select("region_id", "total", rate.alias("success_rate_pct"))


def strength_by_region(asset_strength: DataFrame, asof: Column, interval: str = "1 hour") -> DataFrame:
    recent = asset_strength.filter(within(F.col("event_time"), asof, interval))
    return recent.groupBy("region_id").agg(
        F.count_distinct("asset_id").alias("active_assets"),
        F.avg("strength").alias("mean_strength"),
    )


def unanswered(incident_instructions: DataFrame, asof: Column) -> DataFrame:
    rows = incident_instructions.filter(
        (F.col("threat_level") == "critical") & F.col("instruction_id").isNull()
    )
    return rows.select(
        "incident_id",
        "region_id",
        "threat_level",
        "event_time",
        minutes_between(asof, F.col("event_time")).alias("minutes_pending"),
    )
