"""As-of joins without row multiplication, safe for hot keys.

All sides are stacked on one time line per key; a running ``last`` carries the newest right row
to each left row, so the work is linear in the rows of the sides and takes one shuffle, however
many right sides share the key.

Hot keys.  A key whose rows exceed ``split_rows`` is cut into time slices that are handled by
different tasks.  Cuts are quantiles of that key's own times, then quantiles again within each of
these cells (so a burst is cut like any other stretch), refined evenly by the row count of the cell.
Each slice then starts with a carry row: the last right row of the earlier slices, found from
one (partially aggregated) summary row per slice.  The result is the same with or without cuts.
Every key above the limit is cut; their list and their cuts are written and joined without a hint,
so Spark picks the join by their true size.  Finding hot keys costs one pass over the keys (counted by
hash bucket first, see ``skew.hot_keys``); where none is found, the plan is the plain one.  Rows of one key at one instant stay together.

Left rows with a null key or time match nothing: they are set aside before the exchange and added
to the result.  Building a result runs the search for hot keys (and writes ``derived`` left rows).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.timeval import micros
from sparkmart.operators import skew
from sparkmart.operators.skew import all_present
from sparkmart.session import settle

_CUTS = 32
_CARRY, _RIGHT, _LEFT = -1, 0, 1


@dataclass(frozen=True)
class Right:
    """A right side: its key and time columns, and output names of the columns to bring over.

    Of rows with equal time the one with the greatest ``ties`` wins; ``required`` drops left
    rows without a match.
    """

    df: DataFrame
    keys: Sequence[str]
    time: str
    select: Mapping[str, str]
    ties: Sequence[str] = ("id",)
    required: bool = False


def _stack(
    left: DataFrame, left_keys: Sequence[str], left_time: str, rights: Sequence[Right]
) -> tuple[DataFrame, list[str]]:
    """Left and right rows under common keys ``_k*``, time ``_t`` and side; ``_r<i>`` holds the
    row of right side i, ``_tie<i>`` its tie-break and ``_n<i>`` one per row."""
    keys = [f"_k{i}" for i in range(len(left_keys))]
    stacked = left.select(
        *[F.col(c).alias(k) for k, c in zip(keys, left_keys)],
        F.col(left_time).alias("_t"),
        micros(left, left_time).alias("_us"),
        F.lit(_LEFT).alias("_side"),
        # flat, so that columns nobody reads later are pruned at the scan
        *left.columns,
    )
    for i, right in enumerate(rights):
        usable = right.df.filter(all_present([*right.keys, right.time]))
        payload = [c for c in dict.fromkeys(right.select.values())]
        rows = usable.select(
            *[F.col(c).alias(k) for k, c in zip(keys, right.keys)],
            F.col(right.time).alias("_t"),
            micros(right.df, right.time).alias("_us"),
            F.lit(_RIGHT).alias("_side"),
            F.struct(F.col(right.time).alias("_rt"), *payload).alias(f"_r{i}"),
            F.struct(*right.ties).alias(f"_tie{i}"),
            F.lit(1).cast("long").alias(f"_n{i}"),
        )
        stacked = stacked.unionByName(rows, allowMissingColumns=True)
    return stacked, keys


def _cells(rows: DataFrame, by: list[str], counted: bool = False) -> DataFrame:
    """Quantile cuts of the times of each group, and with ``counted`` its rows."""
    steps = [i / _CUTS for i in range(_CUTS + 1)]
    count = [F.count(F.lit(1)).alias("_rows")] if counted else []
    return rows.groupBy(*by).agg(F.percentile_approx("_us", steps, 2000).alias("_cuts"), *count)


def _cuts_passed(us: Column, low: int = 0, high: int = _CUTS + 1) -> Column:
    """How many cuts are at or before ``us``: a binary search as nested conditions."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(us >= F.col("_cuts")[middle], _cuts_passed(us, middle + 1, high)).otherwise(
        _cuts_passed(us, low, middle)
    )


def _cell(rows: DataFrame, by: list[str], cuts: DataFrame, name: str) -> DataFrame:
    """Adds the number of cuts a row's time has passed (null for groups that have no cuts)."""
    cut = rows.join(cuts, by, "left")
    return cut.withColumn(name, F.when(F.col("_cuts").isNotNull(), _cuts_passed(F.col("_us"))))


def _slice(rows: DataFrame, keys: list[str], hot: DataFrame, split_rows: int) -> DataFrame:
    """Adds ``_hot``, and ``_slice``: a number that rises with time (null for ordinary keys)."""
    # written, so that every branch that reads the slices sees the same (approximate) cuts
    points = rows.select(*keys, "_us").join(hot.select(*keys), keys, "left_semi")
    coarse = settle(_cells(points, keys), "cuts")
    points = _cell(points, keys, coarse, "_cell").drop("_cuts")
    fine = settle(_cells(points, [*keys, "_cell"], counted=True), "cuts")
    cut = _cell(rows, keys, coarse, "_cell").drop("_cuts").withColumn("_hot", F.col("_cell").isNotNull())
    cut = _cell(cut, [*keys, "_cell"], fine, "_part")
    low = F.try_element_at(F.col("_cuts"), F.col("_part"))
    high = F.try_element_at(F.col("_cuts"), F.col("_part") + 1)
    inside = (F.col("_part") > 0) & (F.col("_part") <= _CUTS) & (high > low)
    parts = F.ceil(F.col("_rows") / F.lit(_CUTS * split_rows))
    even = F.when(inside, F.floor((F.col("_us") - low) / (high - low) * parts)).otherwise(F.lit(0))
    number = (F.col("_cell") * F.lit(2 * _CUTS) + F.col("_part")).cast("long") * F.lit(1 << 32) + even
    return cut.withColumn("_slice", F.when(F.col("_hot"), number)).drop("_cuts", "_rows", "_cell", "_part")


def _carry_rows(rows: DataFrame, keys: list[str], sides: int, way: str) -> DataFrame:
    """One row per (hot key, slice with left rows): the nearest right rows outside the slice, and
    the counts of those before it.

    Only right rows are reduced to whole rows; of left rows just the slices are needed.
    """
    hot = rows.filter("_hot")
    time = F.col("_us") if way == "b" else -F.col("_us")
    best = []
    for i in range(sides):
        mine = F.col(f"_r{i}").isNotNull()
        rank = F.when(mine, F.struct(time.alias("t"), F.col(f"_tie{i}")))
        best.append(F.max_by(f"_r{i}", rank).alias(f"_r{i}"))
        best.append(F.sum(f"_n{i}").alias(f"_n{i}"))
    summary = hot.filter(F.col("_side") == _RIGHT).groupBy(*keys, "_slice").agg(*best)
    wanted = hot.filter(F.col("_side") == _LEFT).select(*keys, "_slice", F.lit(1).alias("_want"))
    both = summary.unionByName(wanted.distinct(), allowMissingColumns=True)
    # by value of the slice, so that rows of the same slice do not see each other
    order = F.col("_slice").asc() if way == "b" else F.col("_slice").desc()
    before = Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    carried = both.select(
        *keys,
        "_slice",
        "_want",
        F.lit(_CARRY).alias("_side"),
        F.lit(way).alias("_way"),
        *[F.last(f"_r{i}", ignorenulls=True).over(before).alias(f"_r{i}") for i in range(sides)],
        *[F.sum(f"_n{i}").over(before).alias(f"_n{i}") for i in range(sides)],
    )
    useful = F.coalesce(*[f"_r{i}._rt" for i in range(sides)]).isNotNull()
    return carried.filter((F.col("_want") == 1) & useful).drop("_want")


def _run(
    left: DataFrame,
    left_keys: Sequence[str],
    left_time: str,
    rights: Sequence[Right],
    ways: str,
    split_rows: int | None,
) -> DataFrame:
    """Left rows with key and time, with ``_b<i>`` / ``_f<i>`` (nearest row of side i before / after)
    and ``_before<i>`` (how many came before)."""
    left = left.filter(all_present([*left_keys, left_time]))
    rows, keys = _stack(left, left_keys, left_time, rights)
    n, limit = len(rights), skew.SPLIT_ROWS if split_rows is None else split_rows
    hot = skew.hot_keys(rows, keys, limit)
    if hot is None:
        rows = rows.withColumns(
            {"_way": F.lit(None).cast("string"), "_slice": F.lit(None).cast("long")}
        )
    else:
        rows = _slice(rows.withColumn("_way", F.lit(None).cast("string")), keys, hot, limit)
        carries = [_carry_rows(rows, keys, n, way) for way in ways]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), carries, rows)
    ties = [F.col(f"_tie{i}") for i in range(n)]
    carry_first = F.when(F.col("_side") == _CARRY, F.lit(0)).otherwise(F.lit(1))
    added: dict[str, Column] = {}
    for way in ways:
        line = F.col("_t").asc() if way == "b" else F.col("_t").desc()
        w = (
            Window.partitionBy(*keys, "_slice")
            .orderBy(carry_first, line, F.col("_side"), *ties)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        mine = F.col("_way").isNull() | (F.col("_way") == way)
        for i in range(n):
            added[f"_{way}{i}"] = F.last(F.when(mine, F.col(f"_r{i}")), ignorenulls=True).over(w)
            if way == "b":
                added[f"_before{i}"] = F.sum(F.when(mine, F.col(f"_n{i}"))).over(w)
    return rows.withColumns(added).filter(F.col("_side") == _LEFT)


def _match(direction: str, i: int) -> Column:
    before, after = F.col(f"_b{i}"), F.col(f"_f{i}")
    if direction == "backward":
        found = before
    elif direction == "forward":
        found = after
    else:
        gap_before = F.col("_t") - F.col(f"_b{i}._rt")
        gap_after = F.col(f"_f{i}._rt") - F.col("_t")
        nearer = after.isNull() | (before.isNotNull() & (gap_before <= gap_after))
        found = F.when(nearer, before).otherwise(after)
    return found


def asof_join_many(
    left: DataFrame,
    left_keys: Sequence[str],
    left_time: str,
    rights: Sequence[Right],
    direction: str = "backward",
    split_rows: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """Left rows with columns of the nearest row of each right side of the same key.

    ``direction`` is ``backward`` (newest at or before), ``forward`` (earliest at or after) or
    ``nearest`` (least gap, the earlier one if gaps are equal).  Null keys and null times never
    match.  ``derived`` says that the left rows are costly to compute, so they are written out once and
    read from there: the search for hot keys, the carry rows and the join itself each read them.
    """
    ways = {"backward": "b", "forward": "f", "nearest": "bf"}[direction]
    if derived:
        left = settle(left, "asof")
    found = _run(left, left_keys, left_time, rights, ways, split_rows)
    found = found.withColumns({f"_m{i}": _match(direction, i) for i in range(len(rights))})
    for i, right in enumerate(rights):
        if right.required:
            found = found.filter(F.col(f"_m{i}").isNotNull())
    brought = [
        F.col(f"_m{i}")[src].alias(out)
        for i, right in enumerate(rights)
        for out, src in right.select.items()
    ]
    found = found.select(*left.columns, *brought)
    if any(r.required for r in rights):
        return found
    unmatched = left.filter(~all_present([*left_keys, left_time]))
    return found.unionByName(unmatched, allowMissingColumns=True)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    select: Mapping[str, str],
    how: str = "left",
    direction: str = "backward",
    ties: Sequence[str] = ("id",),
    split_rows: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """``asof_join_many`` with one right side; ``on`` pairs (left, right) key columns."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    side = Right(right, [b for _, b in on], right_time, select, ties, required=how == "inner")
    return asof_join_many(
        left, [a for a, _ in on], left_time, [side], direction, split_rows, derived
    )


def count_preceding(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    name: str = "preceding",
    ties: Sequence[str] = ("id",),
    split_rows: int | None = None,
) -> DataFrame:
    """How many right rows of the same key are at or before each left row.

    This is the row count of the unreduced inequality join, without building its pairs.
    """
    side = Right(right, [b for _, b in on], right_time, {}, ties)
    left_keys = [a for a, _ in on]
    found = _run(left, left_keys, left_time, [side], "b", split_rows)
    unmatched = left.filter(~all_present([*left_keys, left_time])).withColumn("_before0", F.lit(0).cast("long"))
    rows = found.select(*left.columns, "_before0").unionByName(unmatched)
    return rows.select(*left.columns, F.coalesce("_before0", F.lit(0)).cast("long").alias(name))
