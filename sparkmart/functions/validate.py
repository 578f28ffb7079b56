"""Row validation: every rule adds a reason; rows with reasons go to quarantine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.specs import ENUMS, TableSpec

# Fixed value: canonical 8-4-4-4-12 text form of a UUID.
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

REASONS = "_reasons"


def in_enum(value: Column, enum: str) -> Column:
    """Null is allowed; anything else must be a declared value."""
    return value.isNull() | value.isin(*ENUMS[enum])


def in_range(value: Column, low: float | None, high: float | None) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value >= F.lit(low))
    if high is not None:
        ok = ok & (value <= F.lit(high))
    return value.isNull() | ok


def is_uuid(value: Column) -> Column:
    return value.rlike(UUID_PATTERN)


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds an array of the names of the rules a row breaks (empty if it is clean)."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    if not broken:
        return df.withColumn(REASONS, F.array().cast("array<string>"))
    return df.withColumn(REASONS, F.array_compact(F.array(*broken)))


def spec_rules(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    """Rules of a declared table for the columns that are present."""
    rules: dict[str, Column] = {}
    for k in spec.key:
        rules[f"{k}:missing"] = F.col(k).isNotNull()
    for column, enum in spec.enums.items():
        if column in df.columns:
            rules[f"{column}:value"] = in_enum(F.col(column), enum)
    for column, (low, high) in spec.ranges.items():
        if column in df.columns:
            rules[f"{column}:range"] = in_range(F.col(column), low, high)
    return rules


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with their reasons)."""
    checked = with_reasons(df, rules)
    clean = checked.filter(F.size(REASONS) == 0).drop(REASONS)
    return clean, checked.filter(F.size(REASONS) > 0)


def cast_split(df: DataFrame, casts: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows with the columns cast, rows that hold a value which does not cast, with reasons)."""
    rules = {
        f"{c}:{kind}": F.col(c).isNull() | F.col(c).try_cast(kind).isNotNull()
        for c, kind in casts.items()
    }
    clean, bad = split_valid(df, rules)
    return clean.withColumns({c: F.col(c).cast(kind) for c, kind in casts.items()}), bad
