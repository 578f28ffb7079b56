"""Latest row per key, deduplication, gates and defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from sparkmart.operators.skew import all_present, key_counts


def unordered(dtype: T.DataType) -> bool:
    """Types Spark cannot compare."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return unordered(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(unordered(f.dataType) for f in dtype.fields)


def newest_of(df: DataFrame, keys: Sequence[str], order: Sequence[str], among: Column | None = None) -> Column:
    """Aggregate that keeps a whole row: the greatest by ``order``, then by the other columns (``among`` some rows; null if none).

    One struct carries both the ordering and the row, so that the partial results which are
    shuffled hold each column once.
    """
    rest = [f for f in df.schema.fields if f.name not in (*keys, *order)]
    ordered = [*order, *[f.name for f in rest if not unordered(f.dataType)]]
    rank = F.struct(*ordered) if among is None else F.when(among, F.struct(*ordered))
    if len(ordered) == len(order) + len(rest):
        return F.max(rank)
    return F.max_by(F.struct(*order, *[f.name for f in rest]), rank)


def resolve_time_column(df: DataFrame, time_column: str = "event_time") -> str | None:
    """The wanted time column, else ``created_at``, else none."""
    for candidate in (time_column, "created_at"):
        if candidate in df.columns:
            return candidate
    return None


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("event_time",),
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest ``order``, then ``ties``, then other columns, of every key.

    An aggregate, not a window: each map task keeps one row per key before the shuffle, so a
    key that holds a third of the input sends one row per task and never gathers in one place.
    """
    keys = list(keys)
    if set(df.columns) == set(keys):
        return df.dropDuplicates(keys)
    leading = [c for c in dict.fromkeys([*order, *(ties or ())]) if c not in keys]
    picked = df.groupBy(*keys).agg(newest_of(df, keys, leading).alias("_best"))
    return picked.select(*[c if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


def latest_snapshot(
    df: DataFrame,
    keys: Sequence[str],
    time_column: str = "event_time",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Latest row per key by event time, by ``created_at`` if absent, unchanged without either."""
    column = resolve_time_column(df, time_column)
    return df if column is None else latest_per_key(df, keys, (column,), ties)


def top_ranked(df: DataFrame, keys: Sequence[str], ordering: Sequence[Column]) -> DataFrame:
    """First row per key by ROW_NUMBER; Catalyst limits each group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_n(df: DataFrame, n: int, time_column: str = "event_time", ties: Sequence[str] = ("id",)) -> DataFrame:
    """Newest ``n`` rows (a report or a reduced run, not a step of a full one)."""
    column = resolve_time_column(df, time_column)
    order = [F.col(column).desc_nulls_last()] if column else []
    order += [F.col(c).desc_nulls_last() for c in ties if c in df.columns]
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    filled = {
        name: F.coalesce(F.col(name), F.lit(value))
        for name, value in defaults.items()
        if name in df.columns
    }
    return df.withColumns(filled) if filled else df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; null keys are outside a uniqueness rule.

    A task counts a bounded number of keys (``skew.key_counts``); building looks through the keys of large tables once.
    """
    return key_counts(df.filter(all_present(keys)).select(*keys), keys, "copies").filter(F.col("copies") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose reference has no parent; a null reference is allowed."""
    known = parent.select(F.col(parent_key).alias("_known"))
    referring = child.filter(F.col(column).isNotNull())
    return referring.join(known, F.col(column) == F.col("_known"), "left_anti")
