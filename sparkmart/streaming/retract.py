"""Results over change logs that take back what a deletion or an update undoes.

Each step merges a batch into keyed tables, asks them what changed between the version before and the version
after, and moves the result by that difference.  A step that is repeated after a failure finds the same versions, so
it changes nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.keyed import latest_per_key
from sparkmart.session import scratch_scope, settle, side_by_side
from sparkmart.sources.keyed_table import KeyedTable

Step = tuple[DataFrame, int]


def feed_of(table: KeyedTable, batch_id: int, writer: str) -> Step | None:
    """What a merged batch has changed, as rows before and after, and the version that holds it (none if it had no row)."""
    version = table.version_of(writer, batch_id)
    if version is None:
        return None
    feed = table.change_feed(version - 1, version)
    return feed if version == 1 else settle(feed, "feed"), version  # the first one is what was just written


def merge_with_feed(table: KeyedTable, changes: DataFrame, batch_id: int, writer: str) -> Step | None:
    table.merge(changes, batch_id, writer)
    return feed_of(table, batch_id, writer)


def images(feed: DataFrame, *which: str) -> DataFrame:
    """The rows before, after, or both, of a feed."""
    parts = [feed.filter(F.col(w).isNotNull()).select(f"{w}.*") for w in which]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def as_changes(rows: DataFrame, op: str, order: Column) -> DataFrame:
    return rows.select("*", F.lit(op).alias("_op"), order.alias("_ts"), F.lit(0).cast("long").alias("_seq"))


class _Members:
    """Live rows under the values they are looked up by, kept current from a feed."""

    def __init__(self, table: KeyedTable, by: Sequence[str], path: str):
        self.by, self.id = list(by), table.key
        key = list(dict.fromkeys([*by, *table.key]))
        self.table = KeyedTable(
            table.spark, path, key, table.buckets, table.compact_after, bucket_by=by, tombstones=False
        )

    def follow(self, step: Step, batch_id: int, writer: str) -> int:
        """Apply a feed; returns the version that holds it."""
        feed, version = step
        order = F.lit(version).cast("long")
        moved = ~F.struct(*[F.col(f"before.{c}") for c in self.by]).eqNullSafe(
            F.struct(*[F.col(f"after.{c}") for c in self.by])
        )
        left = images(feed.filter(F.col("after").isNull() | moved), "before")
        changes = as_changes(left, "d", order).unionByName(as_changes(images(feed, "after"), "u", order))
        # a feed has a key once, and a row that moved has another key here
        self.table.merge(changes, batch_id, writer, single=True)
        return self.table.version_of(writer, batch_id) or (self.table.versions() or [0])[-1]

    def near(self, values: DataFrame, version: int, exact: bool = True) -> DataFrame | None:
        return self.table.read_near(values, version, exact) if version else None


class LatestOfGroup:
    """The newest live row of every group, from changes of rows that have their own ids.

    Where the newest row of a group is deleted, moves to another group or is set back in time, the one before it
    takes its place; a group without rows disappears.  All live rows are kept under their group, so a batch reads
    the buckets of the groups it touches, and a group is reduced before it is exchanged.  Rows with a null group belong to none.
    """

    def __init__(self, rows: KeyedTable, group: Sequence[str], order: Sequence[str], base: str):
        self.rows, self.group, self.order = rows, list(group), list(order)
        self.members = _Members(rows, group, f"{base}/members")
        self.latest = KeyedTable(rows.spark, f"{base}/latest", group, rows.buckets, rows.compact_after)

    def apply(self, changes: DataFrame, batch_id: int, writer: str = "latest") -> None:
        """Merge a batch of changes (``cdc.changes``) and bring the groups it touches up to date."""
        if self.latest.has(writer, batch_id):  # written last, so all of the batch is done
            return
        with scratch_scope(self.rows.spark):
            step = merge_with_feed(self.rows, changes, batch_id, writer)
            if step is None:
                return
            version = self.members.follow(step, batch_id, writer)
            touched = images(step[0], "before", "after").select(*self.group).dropna().distinct()
            touched = settle(touched, "touched-groups")
            best = None
            if version:
                best = latest_per_key(self.members.near(touched, version), self.group, self.order, self.rows.key)
                best = settle(best, "newest")
            order = F.lit(step[1]).cast("long")
            gone = touched if best is None else touched.join(best, self.group, "left_anti")
            out = as_changes(gone, "d", order)
            if best is not None:
                out = as_changes(best, "u", order).unionByName(out, allowMissingColumns=True)
            self.latest.merge(out, batch_id, writer, single=True)


class ChangeJoin:
    """Inner equi join of two tables kept current under changes of either, without a bound in time.

    A batch joins its own difference only: the rows it changed on one side meet the other side's rows of the same
    join values.  Pairs of the rows before are withdrawn unless the rows after form them again.  Column names
    of the sides must differ but for the join columns, which have one name; null join values match nothing.
    """

    def __init__(self, left: KeyedTable, right: KeyedTable, on: Sequence[str], base: str):
        if set(left.key) & set(right.key) - set(on):
            raise ValueError("the sides must have different key columns")
        self.sides, self.on = (left, right), list(on)
        self.members = [_Members(t, on, f"{base}/{n}") for t, n in zip(self.sides, ("left", "right"))]
        key = list(dict.fromkeys([*left.key, *right.key]))
        self.result = KeyedTable(left.spark, f"{base}/result", key, left.buckets, left.compact_after)

    def _pairs(self, image: str, steps: list[Step | None], versions: list[int], old: list[int]) -> list[DataFrame]:
        """Changed rows of each side, as of ``image``, with the other side's rows at the given versions."""
        found = []
        for i, step in enumerate(steps):
            other = self.members[1 - i]
            if step is None or not versions[1 - i]:
                continue
            if i and steps[0] is not None and not old[0]:
                continue  # all rows of the left side are new: their pairs are found already
            mine = images(step[0], image).dropna(subset=self.on)
            found.append(mine.join(other.near(mine, versions[1 - i], exact=False), self.on))
        return found

    def _follow(self, side: int, changes: DataFrame, batch_id: int, writer: str) -> tuple[Step | None, int, int]:
        """Bring a side up to date: its difference, and the versions of its members before and after."""
        members = self.members[side]
        step = merge_with_feed(self.sides[side], changes, batch_id, writer)
        if step is None:
            held = (members.table.versions() or [0])[-1]
            return None, held, held
        after = members.follow(step, batch_id, writer)
        own = members.table.version_of(writer, batch_id)
        return step, after if own is None else own - 1, after

    def apply(self, left: DataFrame, right: DataFrame, batch_id: int, writer: str = "join") -> None:
        """Merge a batch of changes of both sides and move the result by the difference."""
        if self.result.has(writer, batch_id):  # written last, so all of the batch is done
            return
        with scratch_scope(self.result.spark):
            sides = side_by_side(
                lambda: self._follow(0, left, batch_id, writer), lambda: self._follow(1, right, batch_id, writer)
            )
            steps, old, new = map(list, zip(*sides))
            plus, minus = self._pairs("after", steps, new, old), self._pairs("before", steps, old, old)
            if not plus and not minus:
                return
            order, key = F.lit(batch_id).cast("long"), self.result.key
            columns = (plus or minus)[0].columns
            added = None
            for part in plus:
                added = part.select(*columns) if added is None else added.unionByName(part.select(*columns))
            out = None
            if added is not None:
                added = settle(added if len(plus) == 1 else added.dropDuplicates(key), "pairs")
                out = as_changes(added, "u", order)
            if minus:
                gone = reduce(DataFrame.unionByName, [part.select(*key) for part in minus])
                gone = gone.distinct() if len(minus) > 1 else gone
                gone = gone if added is None else gone.join(added, key, "left_anti")
                gone = as_changes(gone, "d", order)
                out = gone if out is None else out.unionByName(gone, allowMissingColumns=True)
            self.result.merge(out, batch_id, writer, single=True)
