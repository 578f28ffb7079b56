"""Parameterised questions over the marts, and row access by classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.rules import at_most
from sparkmart.specs import CLASSIFICATIONS


def clearance_filter(df: DataFrame, clearance: str, label: Column | str = "classification") -> DataFrame:
    """Rows whose classification is at or below the caller's; unlabelled rows stay hidden."""
    label = F.col(label) if isinstance(label, str) else label
    return df.filter(at_most(label, clearance, CLASSIFICATIONS))


def _in_region(df: DataFrame, region_id) -> DataFrame:
    return df if region_id is None else df.filter(F.col("region_id") == F.lit(region_id))


def subjects_in_region(subject_priority: DataFrame, region_id=None, levels=("high",)) -> DataFrame:
    """Which subjects of these priority levels were seen in a region (or in any)?"""
    return _in_region(subject_priority, region_id).filter(F.col("predicted_level").isin(*levels))


def assets_able_in_region(
    asset_strength: DataFrame, region_id=None, min_strength: float = 0.0
) -> DataFrame:
    """Which assets of a region (or of any) have more than this strength?"""
    return _in_region(asset_strength, region_id).filter(F.col("strength") > F.lit(min_strength))


def resupply_by_region(supply_readiness: DataFrame, region_id=None) -> DataFrame:
    """Can assets be resupplied, per region (or in one region)?"""
    return _in_region(supply_readiness, region_id).groupBy("region_id").agg(
        F.count(F.lit(1)).alias("assets"),
        F.sum(F.col("resupply_feasibility").cast("long")).alias("feasible"),
    )


def results_in_region(
    interaction_review: DataFrame, region_id=None, results=("missed",)
) -> DataFrame:
    """Interactions of a region (or of any) with one of these results, with their factors."""
    return _in_region(interaction_review, region_id).filter(F.col("result").isin(*results))
