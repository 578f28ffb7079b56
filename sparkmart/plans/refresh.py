"""Incremental mart refresh: recompute only the rows that a batch of changes can affect.

For each mart, the rows of its driving table that changed silver rows reach through any join path
are found; the mart is then built with its driving table restricted to them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.asof import asof_join
from sparkmart.operators.keyed import latest_snapshot
from sparkmart.plans import marts
from sparkmart.session import settle
from sparkmart.sources.keyed_table import KeyedTable, upsert_rows


@dataclass(frozen=True)
class Path:
    """Changed rows of ``role`` reach the driving key by these hops of (column, role, column, next).

    ``facts`` (a role, its driving key first in its grain) say that in the linear variant a changed row applies only to the facts between its
    time and the next row's: see ``_in_force``.
    """

    role: str
    column: str
    hops: tuple[tuple[str, str, str], ...] = ()
    facts: tuple[str, tuple[str, ...]] | None = None


@dataclass(frozen=True)
class Driver:
    """``restrict``: role whose rows are restricted by ``key`` before the mart is built."""

    restrict: tuple[tuple[str, str], ...]
    paths: tuple[Path, ...]


# A hop (role, from, to): rows of that role whose ``from`` is a reached value give their ``to``.
_STATUS_BY_REGION = ("asset_status", "region_id", "asset_id")
_OBSERVATION_BY_REGION = ("observation", "region_id", "subject_id")
_OBSERVATION_BY_SENSOR = ("observation", "sensor_id", "subject_id")
_SENSOR_BY_ASSET = ("sensor", "asset_id", "id")

DRIVERS: dict[str, Driver] = {
    "asset_strength": Driver(
        restrict=(("asset_status", "asset_id"),),
        paths=(
            Path("asset_status", "asset_id"),
            Path("asset", "id"),
            Path("equipment", "asset_id"),
            Path("region", "id", (_STATUS_BY_REGION,)),
            Path("condition", "region_id", (_STATUS_BY_REGION,), ("asset_status", ("asset_id", "region_id"))),
        ),
    ),
    "subject_priority": Driver(
        restrict=(("observation", "subject_id"),),
        paths=(
            Path("observation", "subject_id"),
            Path("subject", "id"),
            Path("sensor", "id", (_OBSERVATION_BY_SENSOR,)),
            Path("interference", "sensor_id", (_OBSERVATION_BY_SENSOR,)),
            Path("asset_status", "asset_id", (_SENSOR_BY_ASSET, _OBSERVATION_BY_SENSOR)),
            Path("condition", "region_id", (_OBSERVATION_BY_REGION,), ("observation", ("subject_id", "region_id"))),
        ),
    ),
    "incident_instructions": Driver(
        restrict=(("incident", "id"),),
        paths=(
            Path("incident", "id"),
            Path("instruction", "incident_id"),
            Path("observation", "id", (("incident", "observation_id", "id"),)),
            Path("operator_user", "id", (("instruction", "user_id", "incident_id"),)),
        ),
    ),
    "supply_readiness": Driver(
        restrict=(("supply", "asset_id"),),
        paths=(
            Path("supply", "asset_id"),
            Path("asset_status", "asset_id"),
            Path("region", "id", (_STATUS_BY_REGION,)),
            Path("condition", "region_id", (_STATUS_BY_REGION,)),
        ),
    ),
    "interaction_review": Driver(
        restrict=(("interaction", "id"),),
        paths=(
            Path("interaction", "id"),
            Path("equipment", "id", (("interaction", "equipment_id", "id"),)),
            Path("asset_status", "asset_id", (("interaction", "asset_id", "id"),)),
            Path("region", "id", (_STATUS_BY_REGION, ("interaction", "asset_id", "id"))),
            Path("condition", "region_id", (_STATUS_BY_REGION, ("interaction", "asset_id", "id"))),
            Path("sensor", "asset_id", (("interaction", "asset_id", "id"),)),
            Path(
                "interference",
                "sensor_id",
                (("sensor", "id", "asset_id"), ("interaction", "asset_id", "id")),
            ),
        ),
    ),
}


def feeds(name: str) -> set[str]:
    """Roles whose changes can reach the mart."""
    return {path.role for path in DRIVERS[name].paths}


def _in_force(path: Path, tables: Mapping[str, DataFrame], changed: DataFrame) -> DataFrame:
    """Driving keys of the facts that a changed row applies to, or applied to.

    In the linear variant that is the newest row of the fact's ``column`` at or before it. The changed rows (before and after)
    are put among the unchanged ones of their values; a fact is touched if the newest of all these is a changed one: else
    the row that applies to it has not changed. One as-of join over the facts of these values, and no others.
    """
    role, grain = path.facts
    moved = changed.select(path.column, "event_time", "id", F.lit(True).alias("_moved")).distinct()
    near = moved.select(path.column).distinct()
    still = tables[path.role].select(path.column, "event_time", "id")
    still = still.join(near, path.column, "left_semi").join(moved.select("id"), "id", "left_anti")
    rows = still.withColumn("_moved", F.lit(False)).unionByName(moved)
    facts = latest_snapshot(tables[role].select(*grain, "event_time", "id"), grain, ties=("id",))
    facts = facts.join(near, path.column, "left_semi").select(*grain, "event_time")
    met = asof_join(
        facts, rows, [(path.column, path.column)], "event_time", "event_time", {"_met": "_moved"}, ties=("_moved", "id"), how="inner"
    )
    return met.filter("_met").select(F.col(grain[0]).alias("_touched")).distinct()


def touched_keys(
    name: str,
    tables: Mapping[str, DataFrame],
    changed: Mapping[str, DataFrame],
    variant: str = marts.PRODUCT,
) -> DataFrame:
    """Distinct driving keys that the changed rows can affect, as column ``_touched``."""
    found = []
    for path in DRIVERS[name].paths:
        if path.role not in changed:
            continue
        if variant == marts.LINEAR and path.facts:
            found.append(_in_force(path, tables, changed[path.role]))
            continue
        keys = changed[path.role].select(F.col(path.column).alias("_touched")).distinct()
        for role, source, target in path.hops:
            reached = tables[role].select(F.col(source).alias("_from"), F.col(target).alias("_to"))
            keys = (
                reached.join(keys, F.col("_from") == F.col("_touched"), "left_semi")
                .select(F.col("_to").alias("_touched"))
                .distinct()
            )
        found.append(keys)
    if not found:
        raise ValueError(f"none of the changed tables feeds {name}")
    return reduce(DataFrame.unionByName, found).distinct()


class _Restricted(Mapping[str, DataFrame]):
    def __init__(self, base: Mapping[str, DataFrame], replaced: Mapping[str, DataFrame]):
        self._base, self._replaced = base, replaced

    def __getitem__(self, role):
        return self._replaced[role] if role in self._replaced else self._base[role]

    def __iter__(self):
        return iter(self._base)

    def __len__(self):
        return len(self._base)


def _build(
    name: str, tables: Mapping[str, DataFrame], keys: DataFrame, variant: str
) -> DataFrame:
    replaced = {
        role: tables[role].join(keys, F.col(column) == F.col("_touched"), "left_semi")
        for role, column in DRIVERS[name].restrict
    }
    return marts.BUILDERS[name](_Restricted(tables, replaced), variant)


def affected_rows(
    name: str,
    tables: Mapping[str, DataFrame],
    changed: Mapping[str, DataFrame],
    variant: str = marts.PRODUCT,
) -> DataFrame:
    """Mart rows of the touched keys, computed from those keys' facts only."""
    return _build(name, tables, touched_keys(name, tables, changed, variant), variant)


def refresh(
    name: str,
    tables: Mapping[str, DataFrame],
    changed: Mapping[str, DataFrame],
    target: KeyedTable,
    batch_id: int,
    variant: str = marts.PRODUCT,
    stream: str = "",
    sink_types: bool = False,
) -> bool:
    """Bring the mart up to date with a batch of changes.

    Rows of touched keys are upserted, and rows that those keys no longer have are deleted.  Both carry
    the next generation of the target, so a later refresh or rebuild always replaces an earlier one, whichever
    job or checkpoint its batch numbers come from; ``stream`` names the source of ``batch_id``, and a
    batch that this stream has committed is not applied again.  ``sink_types`` writes measures as ``marts.publish``
    does, which a target shared with a rebuild needs.  ``changed`` holds the changed rows as they
    were before, after, or both, so that keys a row has left are touched too.
    """
    # read by three branches below
    keys = settle(touched_keys(name, tables, changed, variant), "touched")
    rows = _build(name, tables, keys, variant)
    rows = settle(marts.publish(rows, name) if sink_types else rows, "affected")
    generation = target.generation()
    changes = upsert_rows(rows, "event_time", generation=generation)
    if target.versions():
        key = list(marts.mart_key(name, variant))
        held = target.read().select(*key)
        gone = held.join(keys, F.col(marts.MARTS[name].key[0]) == F.col("_touched"), "left_semi")
        gone = gone.join(rows.select(*key), key, "left_anti").select(
            *key,
            F.lit("d").alias("_op"),
            F.lit(generation).cast("long").alias("_ts"),
            F.lit(0).cast("long").alias("_seq"),
        )
        changes = changes.unionByName(gone, allowMissingColumns=True)
    return target.merge(changes, batch_id, writer=f"refresh-{name}-{stream}")
