"""A keyed current-state table on parquet: merge by key, guarded by event time.

Rows live in hash buckets of the key.  A merge first adds the batch's rows as a small change
folder to each bucket it touches; a bucket that has gathered ``compact_after`` of them is written
anew, so a small batch against a large table does not rewrite it each time.  A commit adds one
manifest file that names the folders of every bucket: other buckets keep theirs, and running
readers keep what they read.  Reading reduces only the buckets that have change folders.  Where a
table format with MERGE is at hand, ``sources.lake.merge_into`` does the same in one statement.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.timeval import micros
from sparkmart.operators.cdc import DELETE
from sparkmart.operators.keyed import latest_per_key, newest_of, unordered
from sparkmart.session import estimated_bytes, settle
from sparkmart.sources import storage

SLICE_ROWS = 1 << 19  # rows that one task of a merge writes, about
KEYS_LG = 11  # a bucket's different keys are counted in 2**11 registers: with an error of about 2.3 %
NEAR_BYTES = 8 << 20  # values up to this size, as written, are looked for before the rows are reduced

META = ("_op", "_ts", "_seq", "_batch", "_created_at", "_updated_at", "_bucket", "_version")


class KeyedTable:
    """``merge`` change rows (key, columns, ``_op``, ``_ts``, ``_seq``) and ``read`` live rows.

    An older change never replaces a newer row, and a deleted key leaves a tombstone, so a late
    insert cannot bring it back.  Each writer's last batch id is recorded with the commit, so a
    replayed batch changes nothing.

    ``bucket_by`` (columns of the key, all of them unless given) decides the bucket, so that ``read_near`` finds
    the rows of such values in few buckets.  ``tombstones=False`` forgets deleted keys whenever a bucket is
    written anew, which suits tables whose changes never come late: they hold about their live rows only.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: Sequence[str],
        buckets: int = 16,
        compact_after: int = 4,
        bucket_by: Sequence[str] | None = None,
        tombstones: bool = True,
    ):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        self.buckets, self.compact_after = buckets, compact_after
        self.bucket_by, self.tombstones = list(bucket_by or key), tombstones

    # -- state ---------------------------------------------------------------------------

    def versions(self) -> list[int]:
        names = storage.list_names(self.spark, f"{self.path}/_manifest")
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json"))

    def generation(self) -> int:
        """A number above that of every commit so far, for results that replace whatever came before."""
        return (self.versions() or [0])[-1] + 1

    def manifest(self, version: int | None = None) -> dict:
        versions = self.versions()
        if not versions:
            return {
                "version": 0,
                "count": self.buckets,
                "folders": {},
                "buckets": {},
                "writers": {},
                "schema": None,
            }
        chosen = versions[-1] if version is None else version
        return json.loads(storage.read_text(self.spark, self._manifest_path(chosen)))

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/_manifest/{version:010d}.json"

    def _scan(self, manifest: dict, parts: Sequence[tuple[str, int]]) -> DataFrame:
        """Rows of (bucket, version) parts, in the shape of the latest schema."""
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/data/{manifest['folders'][str(v)]}/_bucket={b}" for b, v in parts]
        return self.spark.read.schema(schema).parquet(*paths)

    def _rows(self, manifest: dict, parts: Sequence[tuple[str, int]], schema: dict | None = None) -> DataFrame:
        """As ``_scan``, in the shape of a later schema if given; no parts have no rows."""
        shaped = {**manifest, "schema": schema or manifest["schema"]}
        if not parts:
            return self.spark.createDataFrame([], T.StructType.fromJson(shaped["schema"]))
        return self._scan(shaped, parts)

    def layered(self) -> bool:
        """Whether some bucket holds more than one folder, so that a read has to reduce it."""
        return any(len(versions) > 1 for versions in self.manifest()["buckets"].values())

    def read(
        self, version: int | None = None, with_meta: bool = False, audit: str | None = None
    ) -> DataFrame:
        """Live rows of the latest (or a kept earlier) version; ``audit`` names a column for the time of their last update."""
        rows = self._state(self._committed(version))
        return self._shown(rows.filter(F.col("_op") != DELETE), with_meta, audit)

    def read_near(self, values: DataFrame, version: int | None = None, exact: bool = True) -> DataFrame:
        """Live rows whose ``bucket_by`` columns are among ``values``, from the buckets of these values only.

        Other rows go before the buckets are reduced, as all changes of a key have one value. Unless ``exact``, other rows
        of these buckets may come too, for a join that drops them anyway: many values are then not looked for.
        """
        manifest = self._committed(version)
        # written, so that Spark knows the size of few values before it moves the rows
        near = settle(values.select(*self.bucket_by).distinct(), "near")
        # at most one row per bucket comes back
        touched = {str(r[0]) for r in near.select(self._bucket(manifest["count"])).distinct().collect()}
        few = exact or (estimated_bytes(near) or 0) <= NEAR_BYTES
        rows = self._state(manifest, touched, near if few else None)
        rows = rows.select(*self.bucket_by, *[c for c in rows.columns if c not in self.bucket_by])
        return self._shown(rows.filter(F.col("_op") != DELETE))

    def _committed(self, version: int | None) -> dict:
        manifest = self.manifest(version)
        if manifest["schema"] is None:
            raise FileNotFoundError(f"{self.path} has no committed version")
        return manifest

    def _shown(self, rows: DataFrame, with_meta: bool = False, audit: str | None = None) -> DataFrame:
        if audit is not None:
            rows = rows.withColumn(audit, F.col("_updated_at"))
        return rows if with_meta else rows.drop(*META)

    def _state(self, manifest: dict, only: set[str] | None = None, near: DataFrame | None = None) -> DataFrame:
        """The newest change of every key, deletions included, in all buckets or some, and of all values or those ``near``."""

        def scan(parts: Sequence[tuple[str, int]]) -> DataFrame:
            rows = self._scan(manifest, parts)
            return rows if near is None else rows.join(near, self.bucket_by, "left_semi").select(*rows.columns)

        held = [(b, v) for b, v in manifest["buckets"].items() if only is None or b in only]
        settled = [(b, versions[0]) for b, versions in held if len(versions) == 1]
        changed = [(b, v) for b, versions in held if len(versions) > 1 for v in versions]
        parts = []
        if settled:
            parts.append(scan(settled))
        if changed:
            # a folder holds a key once: there is next to nothing to reduce before the exchange, and a sort to save
            parts.append(self._reduced(scan(changed).repartition(*self.key), self.key))
        return reduce(DataFrame.unionByName, parts) if parts else self._rows(manifest, [])

    # -- changes between versions --------------------------------------------------------

    def version_of(self, writer: str, batch_id: int) -> int | None:
        """The kept version with which a writer committed a batch."""
        for version in reversed(self.versions()):
            manifest = self.manifest(version)
            if manifest["writers"].get(writer, -1) < batch_id:
                return None
            if manifest["writers"][writer] == batch_id and self._writers_before(version).get(writer, -1) < batch_id:
                return version
        return None

    def has(self, writer: str, batch_id: int) -> bool:
        """Whether a writer has committed this batch or a later one."""
        return self.manifest()["writers"].get(writer, -1) >= batch_id

    def _writers_before(self, version: int) -> dict:
        earlier = [v for v in self.versions() if v < version]
        return self.manifest(earlier[-1])["writers"] if earlier else {}

    def change_feed(self, since: int, until: int | None = None) -> DataFrame:
        """Keys that changed after version ``since`` (0: from the start), with their rows ``before`` and ``after``.

        Either is null where the key had, or has, no live row.  Only buckets that differ between the versions are
        read, and of the older one only the keys that changed.  A change that lost to a newer row is none, nor is one that
        leaves the row as it was, so what follows the feed has no work with it.
        """
        new = self._committed(until)
        old = self.manifest(since) if since else None
        held = old["buckets"] if old else {}
        differ = {b for b, versions in new["buckets"].items() if held.get(b) != versions}
        columns = [f["name"] for f in new["schema"]["fields"] if f["name"] not in META]

        def image(df: DataFrame, name: str) -> DataFrame:
            live = F.when(F.col("_op") != DELETE, F.struct(*[F.col(c) for c in columns]))
            return df.select(*self.key, live.alias(name))

        came = F.coalesce(F.col("_version"), F.lit(0)) > since
        if old is None:
            after = image(self._state(new, differ).filter(came), "after")
            kind = after.schema["after"].dataType
            return after.select(*self.key, F.lit(None).cast(kind).alias("before"), "after").filter("after is not null")
        past, fresh = self._past_and_fresh(old, new, differ, since)
        if 4 * (estimated_bytes(fresh) or 0) < (estimated_bytes(past) or 0):
            past = past.join(fresh.select(*self.key), self.key, "left_semi").select(*fresh.columns)
        return self._images(past.unionByName(fresh), columns, since).filter("_moved").drop("_moved")

    def follow(self, since: int, until: int | None = None) -> DataFrame:
        """The rows of a version and how they came about since an earlier one, in one pass for who needs both.

        Keys that have a live row, or had one and changed: the row ``before`` (null unless it changed), the row ``after`` (null
        if it is gone), and ``_moved``, true for the rows of ``change_feed``.
        """
        old, new = self.manifest(since), self._committed(until)
        differ = {b for b, versions in new["buckets"].items() if old["buckets"].get(b) != versions}
        columns = [f["name"] for f in new["schema"]["fields"] if f["name"] not in META]
        past, fresh = self._past_and_fresh(old, new, differ, since)
        found = self._images(past.unionByName(fresh), columns, since)
        found = found.withColumn("before", F.when(F.col("_moved"), F.col("before"))).filter("_moved or after is not null")
        same = set(new["buckets"]) - differ
        if not same:
            return found
        rest = self._state(new, same).filter(F.col("_op") != DELETE)
        none = F.lit(None).cast(found.schema["before"].dataType)
        rest = rest.select(*self.key, none.alias("before"), F.struct(*columns).alias("after"), F.lit(False).alias("_moved"))
        return found.unionByName(rest)

    def _past_and_fresh(self, old: dict, new: dict, buckets: set[str], since: int) -> tuple[DataFrame, DataFrame]:
        """What some buckets held, and what came: it lies in later folders, and only rows of its keys can have been there before or beat it."""
        came = F.coalesce(F.col("_version"), F.lit(0)) > since
        fresh = self._rows(new, [(b, v) for b in buckets for v in new["buckets"][b] if v > since]).filter(came)
        held = old["buckets"]
        return self._rows(old, [(b, v) for b in buckets & set(held) for v in held[b]], new["schema"]), fresh

    def _images(self, rows: DataFrame, columns: Sequence[str], since: int) -> DataFrame:
        """Every key with its rows ``before`` and ``after``, and ``_moved``: whether what came since has changed the row.

        One pass: the newest of all changes of a key, and the newest of those before.
        """
        order = ["_ts", "_seq", "_batch"]
        came = F.coalesce(F.col("_version"), F.lit(0)) > since
        newest = rows.repartition(*self.key).groupBy(*self.key).agg(
            newest_of(rows, self.key, order).alias("_new"), newest_of(rows, self.key, order, ~came).alias("_old")
        )

        def found(which: str) -> Column:
            row = F.struct(*[F.col(c) if c in self.key else F.col(f"{which}.{c}").alias(c) for c in columns])
            return F.when(F.col(f"{which}._op") != DELETE, row)

        won = F.coalesce(F.col("_new._version"), F.lit(0)) > since
        both = newest.select(*self.key, found("_old").alias("before"), found("_new").alias("after"), won.alias("_won"))
        if unordered(both.schema["after"].dataType):  # such rows cannot be compared
            differs = F.col("before").isNotNull() | F.col("after").isNotNull()
        else:
            differs = ~F.col("before").eqNullSafe(F.col("after"))
        return both.select(*self.key, "before", "after", (F.col("_won") & differs).alias("_moved"))

    def grow(self, buckets: int) -> None:
        """Deal the rows out to more buckets, for a table that has outgrown its first number of them; a commit like any other."""
        manifest = self._committed(None)
        version = manifest["version"] + 1
        folder = f"v{version:010d}-{uuid.uuid4().hex}"
        rows = self._state(manifest).withColumn("_bucket", self._bucket(buckets))
        most = rows.groupBy("_bucket").count().agg(F.max("count")).first()[0] or 1
        self._dealt(rows, buckets, most).drop("_slice").write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        names = storage.list_names(self.spark, f"{self.path}/data/{folder}")
        held = {n.split("=")[1]: [version] for n in names if n.startswith("_bucket=")}
        commit = {**manifest, "version": version, "count": buckets, "folders": {str(version): folder}, "buckets": held}
        storage.create_text(self.spark, self._manifest_path(version), json.dumps(commit))

    # -- merge ---------------------------------------------------------------------------

    def merge(self, batch: DataFrame, batch_id: int, writer: str = "default", single: bool = False) -> bool:
        """Apply a batch; False if it was empty or this writer already committed it.

        ``single`` says that the batch has at most one change of a key, so it need not be reduced.
        """
        manifest = self.manifest()
        if manifest["writers"].get(writer, -1) >= batch_id:
            return False
        count = manifest["count"]
        version = manifest["version"] + 1
        flat = batch.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.key]))
        flat = flat.withColumn("_bucket", self._bucket(count)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            keys = F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*self.key), KEYS_LG))
            keys = F.lit(None).cast("long") if single else keys
            # at most one row per bucket comes back
            counted = flat.groupBy("_bucket").agg(F.count(F.lit(1)), keys).collect()
            touched = [r[0] for r in counted]
            if not touched:
                return False
            few = single or _few_repeats(counted)
            sizes = {b: rows if few else min(rows, different) for b, rows, different in counted}
            held = {b: manifest["buckets"].get(str(b), []) for b in touched}
            full = [b for b in touched if len(held[b]) > self.compact_after]
            if not full and few and not single:
                # one exchange serves the reduction (grouped by bucket, slice and key) and the write
                dealt = self._dealt(flat, len(touched), max(sizes.values()))
                last = latest_per_key(dealt, ["_bucket", "_slice", *self.key], order=("_ts", "_seq"))
                rows = self._stamped(last.drop("_slice"), batch_id, version)
            elif not full:
                incoming = self._stamped(flat if single else self._last_changes(flat), batch_id, version)
                rows = self._dealt(incoming, len(touched), max(sizes.values())).drop("_slice")
            else:
                incoming = self._stamped(flat if single else self._last_changes(flat), batch_id, version)
                old = self._scan(manifest, [(str(b), v) for b in full for v in held[b]])
                old = old.withColumn("_bucket", self._bucket(count))
                for r in old.groupBy("_bucket").count().collect():
                    sizes[r[0]] += r[1]
                both = old.unionByName(incoming, allowMissingColumns=True)
                # one exchange serves the reduction (grouped by slice, bucket and key) and the write
                both = self._dealt(both, len(touched), max(sizes.values()))
                rows = self._reduced(both, ["_slice", "_bucket", *self.key]).drop("_slice")
                if not self.tombstones:
                    rows = rows.filter((F.col("_op") != DELETE) | ~F.col("_bucket").isin(*full))
            # a fresh name, so that what a failed attempt left behind is never read or in the way
            folder = f"v{version:010d}-{uuid.uuid4().hex}"
            rows.write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        finally:
            flat.unpersist()
        stored = T.StructType([f for f in rows.schema.fields if f.name != "_bucket"])
        rewritten = set(full)
        buckets = {
            **manifest["buckets"],
            **{str(b): [version] if b in rewritten else [*held[b], version] for b in touched},
        }
        if full and not self.tombstones:  # a bucket may have forgotten its last row
            written = storage.list_names(self.spark, f"{self.path}/data/{folder}")
            buckets.update({str(b): [] for b in full if f"_bucket={b}" not in written})
        in_use = {v for versions in buckets.values() for v in versions}
        folders = {**manifest["folders"], str(version): folder}
        commit = {
            "version": version,
            "count": count,
            "folders": {v: name for v, name in folders.items() if int(v) in in_use},
            "buckets": buckets,
            "writers": {**manifest["writers"], writer: batch_id},
            "schema": _merged_schema(manifest["schema"], stored).jsonValue(),
        }
        storage.create_text(self.spark, self._manifest_path(version), json.dumps(commit))
        return True

    def _dealt(self, rows: DataFrame, buckets: int, most: int) -> DataFrame:
        """The rows with the ``_slice`` of their bucket (of at most ``most`` rows), each slice in a task of its own.

        No task gathers a large bucket, and a grouping by slice and key needs no further exchange.
        """
        slices = -(-most // SLICE_ROWS)
        place = F.col("_bucket") * slices + F.pmod(F.hash(*self.key), F.lit(slices))
        tasks = buckets * slices
        return rows.withColumn("_slice", F.pmod(place, F.lit(tasks)).cast("int")).repartitionById(tasks, F.col("_slice"))

    def _bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(count)).cast("int")

    def _reduced(self, rows: DataFrame, grouping: Sequence[str]) -> DataFrame:
        """Newest change per key; the row keeps the time its key was first written."""
        best = newest_of(rows, [*grouping, "_created_at"], ["_ts", "_seq", "_batch"])
        picked = rows.groupBy(*grouping).agg(
            best.alias("_best"), F.min("_created_at").alias("_created_at")
        )
        return picked.select(*grouping, "_best.*", "_created_at").select(*rows.columns)

    def _last_changes(self, flat: DataFrame) -> DataFrame:
        return latest_per_key(flat, ["_bucket", *self.key], order=("_ts", "_seq"))

    def _stamped(self, last: DataFrame, batch_id: int, version: int) -> DataFrame:
        now = F.current_timestamp()
        return last.withColumns(
            {
                "_batch": F.lit(batch_id).cast("long"),
                "_created_at": now,
                "_updated_at": now,
                "_version": F.lit(version).cast("long"),
            }
        )

    # -- housekeeping --------------------------------------------------------------------

    def vacuum(self, keep: int = 2) -> int:
        """Drop bucket folders that none of the last ``keep`` versions uses; returns how many.

        Run it while no merge is under way: a folder that is not committed yet counts as unused.
        """
        versions = self.versions()
        used: set[tuple[str, str]] = set()
        for kept in versions[-keep:]:
            manifest = self.manifest(kept)
            for bucket, held in manifest["buckets"].items():
                used.update((manifest["folders"][str(v)], bucket) for v in held)
        removed = 0
        for folder in storage.list_names(self.spark, f"{self.path}/data"):
            names = storage.list_names(self.spark, f"{self.path}/data/{folder}")
            buckets = [n.split("=")[1] for n in names if n.startswith("_bucket=")]
            unused = [b for b in buckets if (folder, b) not in used]
            if len(unused) == len(buckets):
                storage.remove(self.spark, f"{self.path}/data/{folder}")
            else:
                for b in unused:
                    storage.remove(self.spark, f"{self.path}/data/{folder}/_bucket={b}")
            removed += len(unused)
        for v in versions[:-keep]:
            storage.remove(self.spark, self._manifest_path(v))
        return removed


def _few_repeats(counted: Sequence[tuple[int, int, int]]) -> bool:
    """Whether (bucket, rows, different keys, about) leave little to reduce before an exchange, and no key that would crowd a task."""
    extra = [max(0, rows - keys) for _, rows, keys in counted]
    crowded = any(more > max(SLICE_ROWS, rows // 16) for more, (_, rows, _) in zip(extra, counted))
    return not crowded and 4 * sum(extra) <= sum(rows for _, rows, _ in counted)


def _merged_schema(old: dict | None, new: T.StructType) -> T.StructType:
    """Columns of the earlier schema, then new ones; folders of old shape read as null there."""
    if old is None:
        return new
    fields = list(T.StructType.fromJson(old).fields)
    known = {f.name for f in fields}
    return T.StructType(fields + [f for f in new.fields if f.name not in known])


def upsert_rows(
    df: DataFrame, time: str, ties: Sequence[str] = (), generation: int | None = None
) -> DataFrame:
    """Change rows that upsert a plain frame.

    They are ordered by the time column, so an older row never replaces a newer one.  With
    ``generation`` (``KeyedTable.generation`` of the target) they replace whatever was committed before,
    as a recomputed result should, and the time column only decides among them.
    """
    at = F.coalesce(micros(df, time), F.lit(0).cast("long"))
    tie = F.xxhash64(*ties) if ties else F.lit(0).cast("long")
    if generation is None:
        ordering = {"_ts": at, "_seq": tie}
    else:
        ordering = {"_ts": F.lit(generation).cast("long"), "_seq": at}
    return df.withColumns({"_op": F.lit("u"), **ordering})
