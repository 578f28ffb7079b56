"""Hot keys: finding them, and joining them without gathering their rows in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.session import estimated_bytes, settle

# Rows of one key that one task is expected to handle with ease.
SPLIT_ROWS = 4_000_000
BUCKETS = 1 << 16  # in which rows are counted before keys are
KEYS_A_TASK = 1 << 18  # different keys that one task counts or joins, about


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def crowded_buckets(rows: DataFrame, keys: Sequence[str], split_rows: int) -> list[int]:
    """Those of 2**16 hash buckets with more than ``split_rows`` rows; there are fewer of them than rows / ``split_rows``."""
    counted = rows.groupBy(_bucket(keys).alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    return [r[0] for r in counted.filter(F.col("_rows") > split_rows).select("_bucket").collect()]


def tasks_for_keys(rows: DataFrame, keys: Sequence[str]) -> int:
    """How many tasks the different keys of ``rows`` need, or 0 if the session's shuffle partitions will do.

    Tables that are small by Catalyst's estimate are not looked at; else the keys are estimated in one pass.
    """
    enough = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * KEYS_A_TASK
    size = estimated_bytes(rows.select(*keys))
    if size is not None and size < enough // 4:  # packed well, a key may take a quarter of a byte
        return 0
    different = rows.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0]
    return -(-different // KEYS_A_TASK) if different > enough else 0


def key_counts(
    rows: DataFrame, keys: Sequence[str], name: str, needed: int | None = None, join_tasks: int = 0
) -> DataFrame:
    """Rows of every key, as column ``name``; dealt out by key to ``join_tasks`` at least, if given, for a join.

    Few keys are summed before the exchange, so that a key with a third of the rows sends one row per task. More
    keys than the session's shuffle partitions should hold are dealt out to tasks of KEYS_A_TASK each, however many there are;
    the rows of crowded buckets, which are few keys, are summed before the exchange there too. ``needed``: what
    ``tasks_for_keys`` said, where it is known.
    """
    keys, count = list(keys), F.count(F.lit(1)).alias(name)
    needed = tasks_for_keys(rows, keys) if needed is None else needed
    dealt = max(needed, join_tasks)
    if not needed:
        counted = rows.groupBy(*keys).agg(count)
        return counted.repartition(dealt, *keys) if dealt else counted
    crowded = crowded_buckets(rows, keys, SPLIT_ROWS)
    hot = _bucket(keys).isin(crowded)
    spread = (rows.filter(~hot) if crowded else rows).select(*keys).repartition(dealt, *keys).groupBy(*keys).agg(count)
    if not crowded:
        return spread
    counted = spread.unionByName(rows.filter(hot).groupBy(*keys).agg(count))
    return counted.repartition(dealt, *keys) if join_tasks else counted


def hot_keys(rows: DataFrame, keys: Sequence[str], split_rows: int) -> DataFrame | None:
    """All keys with more than ``split_rows`` rows, with their number of rows, written out; none if there is none.

    A key cannot have more rows than its hash bucket.  So rows are counted by 2**16 buckets first, which takes an
    exchange of so many numbers per task at most, and keys are counted one by one in the crowded buckets
    only.  There are fewer hot keys than rows / ``split_rows``, and fewer crowded buckets.
    """
    present = rows.filter(all_present(keys))
    crowded = crowded_buckets(present, keys, split_rows)
    if not crowded:
        return None
    each = present.filter(_bucket(keys).isin(crowded)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = settle(each.filter(F.col("_rows") > split_rows), "hot-keys")
    return None if hot.isEmpty() else hot


def join_many_to_one(
    many: DataFrame, one: DataFrame, on: Sequence[str], how: str = "inner", split_rows: int | None = None
) -> DataFrame:
    """``many`` joined to the row of its key in ``one``, which has at most one row per key.

    Adaptive execution splits a skewed partition only where both sides come straight from an
    exchange, which a chain of joins on one key does not.  Here the hot keys and the ``one`` rows they
    need are written first (fewer than rows / ``split_rows`` of each), so Spark knows their true size:
    it broadcasts them where they are small and the rows of hot keys stay where they are; else it
    splits their partitions, as both sides come from an exchange.  All other rows are joined as usual.
    Rows with a null key match nothing and are set aside.

    Building the result runs the search for hot keys (``hot_keys``): one pass over the keys of ``many``.
    """
    on = list(on)
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    hot = hot_keys(many, on, SPLIT_ROWS if split_rows is None else split_rows)
    keyed = many.filter(all_present(on))
    if hot is None:
        joined = keyed.join(one, on, how)
    else:
        hot = hot.select(*on)
        needed = settle(one.join(hot, on, "left_semi"), "hot-rows")
        split = keyed.join(hot, on, "left_semi").join(needed, on, how)
        joined = split.unionByName(keyed.join(hot, on, "left_anti").join(one, on, how))
    if how == "inner":
        return joined
    return joined.unionByName(many.filter(~all_present(on)), allowMissingColumns=True)
