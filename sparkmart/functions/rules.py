"""Scoring rules as plain column expressions (no UDFs, all inside codegen)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.specs import CONFIDENT, FAST_KMH, HOSTILE, MAX_PRECIPITATION_MM, MAX_WIND_KMH


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def lookup_factor(value: Column, table: Mapping[str, float], default: float = 1.0) -> Column:
    """Factor of a category; categories that are not listed (or null) get ``default``."""
    if not table:
        return F.lit(float(default))
    expr = None
    for category, factor in table.items():
        arm = (value == category, F.lit(float(factor)))
        expr = F.when(*arm) if expr is None else expr.when(*arm)
    return expr.otherwise(F.lit(float(default)))


def indicator(condition: Column) -> Column:
    """1.0 where the condition holds, else 0.0 (null counts as not holding)."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def penalise(base: Column, penalties: Sequence[Column], variant: str, clamp: bool = False) -> Column:
    """Reduce ``base`` by penalty terms.

    ``product`` multiplies the remainders ``(1 - p)``; ``linear`` subtracts the sum of the
    terms from one.  ``clamp`` keeps the factor within 0..1.
    """
    if variant == "product":
        remainders = [F.lit(1.0) - p for p in penalties]
        if clamp:
            remainders = [F.greatest(F.lit(0.0), F.least(F.lit(1.0), r)) for r in remainders]
        result = base
        for remainder in remainders:
            result = result * remainder
        return result
    if variant != "linear":
        raise ValueError(f"unknown variant {variant!r}: use 'product' or 'linear'")
    factor = F.lit(1.0)
    for p in penalties:
        factor = factor - p
    if clamp:
        factor = F.greatest(F.lit(0.0), F.least(F.lit(1.0), factor))
    return base * factor


def band(value: Column, limits: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first upper limit the value is below; null falls to ``default``."""
    expr = None
    for limit, label in limits:
        arm = (value < F.lit(limit), F.lit(label))
        expr = F.when(*arm) if expr is None else expr.when(*arm)
    return expr.otherwise(F.lit(default))


def enum_rank(value: Column, ordered: Sequence[str]) -> Column:
    """1-based rank of an ordered label; unknown labels and null have no rank."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in ordered]), value), F.lit(0))


def at_least(value: Column, floor: str, ordered: Sequence[str]) -> Column:
    """``value >= floor`` by declared order, which text comparison would get wrong.

    A membership test, so that it reaches the scan as a pushed filter.
    """
    return value.isin(*ordered[ordered.index(floor) :])


def at_most(value: Column, ceiling: str, ordered: Sequence[str]) -> Column:
    return value.isin(*ordered[: ordered.index(ceiling) + 1])


def gated(value: Column, condition: Column, otherwise: Column | None = None) -> Column:
    """Show ``value`` only where the condition holds, else ``otherwise`` (null if not given)."""
    return F.when(condition, value).otherwise(F.lit(None) if otherwise is None else otherwise)


def guarded_rate_pct(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(total, F.lit(0)), digits)


def latest_of(times: Iterable[Column]) -> Column:
    """Latest of several times; nulls are skipped."""
    return F.greatest(*times)


def normalise_angle(degrees: Column) -> Column:
    return F.pmod(degrees, F.lit(360.0))


def priority_class(speed: Column, iff_status: Column, confidence: Column) -> Column:
    """Two-level classifier: fast or hostile, and confidently observed."""
    notable = (speed > F.lit(FAST_KMH)) | (iff_status == F.lit(HOSTILE))
    return F.when(notable & (confidence > F.lit(CONFIDENT)), F.lit("high")).otherwise(F.lit("medium"))


def feasible(wind: Column, precipitation: Column) -> Column:
    blocked = (zero_if_null(wind) > F.lit(MAX_WIND_KMH)) | (
        zero_if_null(precipitation) > F.lit(MAX_PRECIPITATION_MM)
    )
    return F.when(blocked, F.lit(0)).otherwise(F.lit(1))
