"""Great-circle distance and travel time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.specs import EARTH_RADIUS_KM, UNKNOWN_DISTANCE


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in km; null if any coordinate is null."""
    phi1, lam1, phi2, lam2 = (F.radians(c.cast("double")) for c in (lat1, lon1, lat2, lon2))
    half_dphi, half_dlam = F.sin((phi2 - phi1) / 2), F.sin((lam2 - lam1) / 2)
    chord = half_dphi * half_dphi + F.cos(phi1) * F.cos(phi2) * half_dlam * half_dlam
    # rounding may push the chord of antipodal points above one (``least`` would hide a null)
    bounded = F.when(chord > 1, F.lit(1.0)).otherwise(chord)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(bounded))


def distance_or_unknown(distance: Column) -> Column:
    return F.coalesce(distance, F.lit(UNKNOWN_DISTANCE))


def travel_seconds(distance_km: Column, speed_kmh: Column) -> Column:
    """Seconds to cover a distance; an unknown distance or no speed stays 'unknown'."""
    computable = (distance_km < F.lit(UNKNOWN_DISTANCE)) & (speed_kmh > 0)
    return F.when(computable, distance_km / speed_kmh.cast("double") * 3600).otherwise(
        F.lit(UNKNOWN_DISTANCE)
    )
