"""The jobs a deployment runs: ingest change logs, copy them to a lake, refresh the marts.

Each call does one run (or one endless stream if ``every`` is given); repeating it is the
scheduler's business.  Faults are raised.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.operators import cdc
from sparkmart.plans import marts, refresh
from sparkmart.session import scratch_scope, settle, side_by_side
from sparkmart.sources.keyed_table import KeyedTable, upsert_rows
from sparkmart.specs import TABLES, TableSpec
from sparkmart.streaming import ingest
from sparkmart.streaming.retract import feed_of, images

Lines = Callable[[str], DataFrame]


def silver_table(spark: SparkSession, base: str, spec: TableSpec, buckets: int = 64) -> KeyedTable:
    return KeyedTable(spark, f"{base}/{spec.name}", spec.key, buckets)


def ingest_job(
    spark: SparkSession,
    lines: Lines,
    base: str,
    specs: Mapping[str, TableSpec] = TABLES,
    every: str | None = None,
    buckets: int = 64,
) -> dict[str, int]:
    """Keep one silver table per spec current; ``lines(name)`` is the change-log stream of a table."""
    feeds = {
        name: ingest.Feed(
            lines(name),
            spec.schema,
            silver_table(spark, base, spec, buckets),
            f"{base}/_checkpoints/{name}",
            f"{base}/_quarantine/{name}",
        )
        for name, spec in specs.items()
    }
    return ingest.ingest_all(feeds, every)


def lake_copy_job(
    spark: SparkSession,
    lines: Lines,
    base: str,
    specs: Mapping[str, TableSpec] = TABLES,
    every: str | None = None,
) -> None:
    """Append the inserted and updated rows of every change log to a lake copy, undecodable lines to a quarantine."""
    queries = []
    for name, spec in specs.items():
        events, bad = cdc.decode(lines(name), spec.schema, key=spec.key)
        rows = cdc.keep_ops(events).select("after.*", "op", "ts_ms")
        queries.append(
            ingest.append_stream(rows, f"{base}/{name}", f"{base}/_checkpoints/{name}", every)
        )
        queries.append(
            ingest.append_stream(
                bad, f"{base}/_quarantine/{name}", f"{base}/_checkpoints/{name}-quarantine", every
            )
        )
    try:
        if every is not None:
            spark.streams.awaitAnyTermination()
        for q in queries if every is None else []:
            q.awaitTermination()
    finally:  # one has stopped or failed: the others go with it
        for q in queries:
            q.stop()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


class Silver(Mapping[str, DataFrame]):
    """Current rows of the silver tables by name; a table without any commit is empty."""

    def __init__(self, spark: SparkSession, base: str, specs: Mapping[str, TableSpec] = TABLES):
        self.spark, self.base, self.specs = spark, base, specs

    def __getitem__(self, name: str) -> DataFrame:
        table = silver_table(self.spark, self.base, self.specs[name])
        if not table.versions():
            return self.spark.createDataFrame([], self.specs[name].schema)
        return table.read()

    def __iter__(self) -> Iterator[str]:
        return iter(self.specs)

    def __len__(self) -> int:
        return len(self.specs)


def mart_table(spark: SparkSession, base: str, name: str, variant: str, buckets: int = 64) -> KeyedTable:
    return KeyedTable(spark, f"{base}/{name}", marts.mart_key(name, variant), buckets)


def mart_refresh_job(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    changed: Mapping[str, DataFrame],
    base: str,
    batch_id: int,
    stream: str,
    variant: str = marts.PRODUCT,
    buckets: int = 64,
) -> dict[str, bool]:
    """Bring every mart that a batch of changes can reach up to date; says which were changed.

    ``tables`` hold the state after the batch, ``changed`` its rows by role (before, after, or both) and
    ``stream`` names the checkpoint that ``batch_id`` counts in.  A repeated batch changes nothing, and one
    that failed half way goes on with the marts it had not reached.
    """
    return {
        name: refresh.refresh(
            name,
            tables,
            changed,
            mart_table(spark, base, name, variant, buckets),
            batch_id,
            variant,
            stream,
            sink_types=True,
        )
        for name in marts.BUILDERS
        if refresh.feeds(name) & set(changed)
    }


def marts_from_logs(
    spark: SparkSession,
    lines: Mapping[str, DataFrame],
    rows: Mapping[str, T.StructType],
    silver: Mapping[str, KeyedTable],
    gold: Mapping[str, KeyedTable],
    checkpoint: str,
    variant: str = marts.PRODUCT,
    quarantine: str | None = None,
    every: str | None = None,
    sink_types: bool = True,
) -> StreamingQuery:
    """Keep silver tables and marts current from change logs alone.

    One stream reads the logs of all roles together. Each micro-batch is merged into the silver tables, whose change feed between the
    two versions says which rows were there before and after; the marts recompute the keys that these rows reach. A batch that
    runs again after a failure finds the same versions and feeds, and each mart takes it once. Its scratch folders go
    with it. ``gold`` names the marts to keep.
    """
    parts = [stream.select(F.lit(role).alias("role"), "value") for role, stream in lines.items()]
    every_line = reduce(DataFrame.unionByName, parts)

    def step(batch: DataFrame, batch_id: int) -> None:
        writer = ingest.writer_of(spark, "marts", checkpoint)

        def merge(role: str) -> None:
            # the lines are not kept: each role unpacks them once, which takes about as long and no memory
            aside = None if quarantine is None else f"{quarantine}/{role}/stream={writer.rpartition(':')[2]}/batch={batch_id}"
            ingest.merge_lines(batch.filter(F.col("role") == role), rows[role], silver[role], batch_id, writer, aside)

        side_by_side(*[partial(merge, role) for role in lines])  # tables do not depend on each other
        if not any(silver[role].version_of(writer, batch_id) for role in lines):
            return
        with scratch_scope(spark):
            steps = side_by_side(*[partial(_step, spark, silver[role], rows[role], batch_id, writer) for role in silver])
            changed = {role: moved for role, (moved, _) in zip(silver, steps) if moved is not None}
            tables = {role: current for role, (_, current) in zip(silver, steps)}
            for name, target in gold.items():
                reach = {role: df for role, df in changed.items() if role in refresh.feeds(name)}
                if reach:
                    refresh.refresh(name, tables, reach, target, batch_id, variant, writer, sink_types)

    return ingest.start_batches(every_line, step, checkpoint, every)


def _step(spark, table, row, batch_id, writer) -> tuple[DataFrame | None, DataFrame]:
    """The rows that a batch has changed in a table, before and after (none if it had none there), and the live rows."""
    version = table.version_of(writer, batch_id)
    if version is None or version == 1 or version != table.versions()[-1] or not table.layered():
        feed = feed_of(table, batch_id, writer)
        return None if feed is None else images(feed[0], "before", "after"), _current(spark, table, row)
    step = settle(table.follow(version - 1, version), "step")
    return images(step.filter("_moved"), "before", "after"), images(step, "after")


def _current(spark, table, row) -> DataFrame:
    """Live rows of a table that several joins read: reduced once, if they have to be."""
    if not table.versions():
        return spark.createDataFrame([], row)
    return settle(table.read(), "current") if table.layered() else table.read()


def every_tick(spark: SparkSession, action: Callable[[int], None], interval: str, checkpoint: str, runs: int | None = None) -> int:
    """Run an action at a steady interval, ``runs`` times or until it fails; returns how often it ran.

    A rate source gives the ticks, so what is missed while an action takes long is not made up for. A fault in the
    action ends the stream and is raised. An action gets the number of its run, counted in the checkpoint.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    done: list[int] = []

    def step(batch: DataFrame, batch_id: int) -> None:
        if runs is None or len(done) < runs:
            action(batch_id)
            done.append(batch_id)

    query = ingest.start_batches(ticks, step, checkpoint, interval)
    try:
        while query.isActive and (runs is None or len(done) < runs):
            query.awaitTermination(0.2)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return len(done)


def marts_job(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    base: str,
    batch_id: int,
    variant: str = marts.PRODUCT,
    buckets: int = 64,
) -> dict[str, int]:
    """Rebuild the five marts and upsert them into their tables; returns the rows of each."""
    written = {}
    for name, build in marts.BUILDERS.items():
        # counted while the one pass that writes them runs
        seen = Observation()
        rows = marts.publish(build(tables, variant), name)
        target = mart_table(spark, base, name, variant, buckets)
        rows = upsert_rows(rows, "event_time", generation=target.generation())
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        # without a merge (a replayed batch) nothing ran that could be observed
        written[name] = seen.get["rows"] if target.merge(rows, batch_id, writer="marts") else 0
    return written
