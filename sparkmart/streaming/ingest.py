"""Change-log streams into keyed tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.operators import cdc
from sparkmart.operators.keyed import newest_of
from sparkmart.sources import storage
from sparkmart.sources.keyed_table import KeyedTable


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Change-log lines from files that keep arriving in a folder, oldest first."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def start_batches(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str | None):
    """Start a batch-function sink: once over what is there, or at a steady interval."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def writer_of(spark: SparkSession, name: str, checkpoint: str) -> str:
    """Writer name under which a stream commits: batch ids count from zero per checkpoint."""
    return f"{name}:{json.loads(storage.read_text(spark, f'{checkpoint}/metadata'))['id']}"


def merge_lines(
    lines: DataFrame, row: T.StructType, table: KeyedTable, batch_id: int, writer: str, quarantine: str | None = None, deletes: str = "apply"
) -> int | None:
    """Decode change-log lines and merge them; lines that do not decode are written to the folder ``quarantine``, if there are any.

    The merge counts them as it parses; only if it met some, or a replay did not parse at all, are lines parsed again.
    Returns how many lines there are (with ``quarantine``; else they are not counted).
    """
    seen = None if quarantine is None else Observation()
    events, bad = cdc.decode(lines, row, key=table.key, seen=seen)
    flat = cdc.changes(events, table.key)
    if deletes == "ignore":
        flat = flat.filter(F.col("_op") != cdc.DELETE)
    merged = table.merge(flat, batch_id, writer)
    if seen is None:
        return None
    rows, spoilt = (seen.get["rows"], seen.get["bad"]) if merged else (lines.count(), None)
    if rows if spoilt is None else spoilt:
        bad.write.mode("overwrite").text(quarantine)
    return rows


def ingest(
    lines: DataFrame,
    row: T.StructType,
    table: KeyedTable,
    checkpoint: str,
    deletes: str = "apply",
    every: str | None = None,
    quarantine: str | None = None,
    writer: str = "ingest",
    read: dict[int, int] | None = None,
) -> StreamingQuery:
    """Decode change-log lines and merge each micro-batch into a keyed table.

    Undecodable lines (see ``cdc.decode``) go to ``quarantine`` if given; ``read`` then gets the lines of each batch by
    its number.  The merge records the batch id, so a batch replayed after a failure changes nothing.
    The lines of a batch are not kept: they would fill memory and disk to be read again only where some do not decode.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream = writer_of(table.spark, writer, checkpoint)
        # one folder per stream and batch: a replay rewrites it, a new checkpoint leaves it alone
        aside = None if quarantine is None else f"{quarantine}/stream={stream.rpartition(':')[2]}/batch={batch_id}"
        rows = merge_lines(batch, row, table, batch_id, stream, aside, deletes)
        if read is not None and rows is not None:
            read[batch_id] = rows

    return start_batches(lines, merge, checkpoint, every)


@dataclass(frozen=True)
class Feed:
    """One change log: its lines, the declared row and the table it keeps current."""

    lines: DataFrame
    row: T.StructType
    table: KeyedTable
    checkpoint: str
    quarantine: str


def ingest_all(feeds: Mapping[str, Feed], every: str | None = None, wave: int = 8) -> dict[str, int]:
    """Run the feeds as concurrent queries; any fault is raised.  Returns rows read per feed, in all micro-batches.

    With a steady interval all feeds run until one stops; otherwise they run to the end of the
    available input, ``wave`` at a time.
    """
    if every is not None:
        running = [ingest(f.lines, f.row, f.table, f.checkpoint, every=every, quarantine=f.quarantine) for f in feeds.values()]
        feeds_spark = next(iter(feeds.values())).table.spark
        feeds_spark.streams.awaitAnyTermination()
        for q in running:  # one has stopped: the others go with it
            q.stop()
        for q in running:
            if q.exception() is not None:
                raise q.exception()
        return {}
    # counted by the merges: a stream's own count has a line as often as a batch reads it
    read: dict[str, dict[int, int]] = {name: {} for name in feeds}
    names = list(feeds)
    for start in range(0, len(names), wave):
        started = [
            ingest(f.lines, f.row, f.table, f.checkpoint, quarantine=f.quarantine, read=read[n])
            for n in names[start : start + wave]
            for f in [feeds[n]]
        ]
        for q in started:
            q.awaitTermination()
    return {name: sum(batches.values()) for name, batches in read.items()}


def latest_state(
    events: DataFrame, key: Sequence[str], table: KeyedTable, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Latest row per key as streaming state, changed keys written on in update mode.

    A streaming aggregate: the micro-batch is reduced map-side and the state lives in the JVM
    state store, one row per key.
    """
    newest = newest_of(events, key, ["_ts", "_seq"]).alias("_best")
    state = events.groupBy(*key).agg(newest).select(*key, "_best.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, batch_id, writer_of(table.spark, "latest_state", checkpoint))

    writer = state.writeStream.outputMode("update").foreachBatch(write)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def pinned_version(table: KeyedTable, checkpoint: str, batch_id: int) -> int:
    """The version of a table that a micro-batch reads: the newest when it first ran, the same one if it runs again.

    It is written down next to the checkpoint before it is used; keep the versions that a replay may need.
    """
    note = f"{checkpoint}-versions/{batch_id}"
    if not storage.exists(table.spark, note):
        storage.create_text(table.spark, note, str((table.versions() or [0])[-1]))
    return int(storage.read_text(table.spark, note))


def join_versions(
    facts: DataFrame,
    table: KeyedTable,
    path: str,
    checkpoint: str,
    how: str = "inner",
    every: str | None = None,
) -> StreamingQuery:
    """Stream to keyed-table join on the table's key, where the table changes while the stream runs.

    Each micro-batch joins one version (``pinned_version``) and writes the folder of its own number, so a
    batch that runs again after a failure writes the same rows in the same place.  Before the table has any
    version, an inner join finds nothing and another ``how`` is an error.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        version = pinned_version(table, checkpoint, batch_id)
        if not version:
            if how != "inner":
                raise FileNotFoundError(f"{table.path} has no committed version")
            return
        joined = batch.join(table.read(version), table.key, how)
        joined.withColumn("table_version", F.lit(version).cast("long")).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}"
        )

    return start_batches(facts, write, checkpoint, every)


def append_stream(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet lake copy (exactly once through the sink's own log)."""
    writer = stream.writeStream.format("parquet").option("path", path)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def join_streams(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    left_time: str,
    right_time: str,
    within: str,
    late: str,
    how: str = "inner",
) -> DataFrame:
    """Stream–stream equi join; the right row follows the left one within an interval.

    Watermarks on both sides and the time bound let Spark drop state that can no longer match.
    With ``how="left_outer"`` a left row without a match appears once the watermark has passed
    the last time one could come.
    """
    earlier = left.withWatermark(left_time, late)
    later = right.withWatermark(right_time, late)
    bound = (F.col(right_time) >= F.col(left_time)) & (
        F.col(right_time) <= F.col(left_time) + F.expr(f"interval {within}")
    )
    return earlier.join(later, (F.col(on[0]) == F.col(on[1])) & bound, how)
