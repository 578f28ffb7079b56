"""Streaming operators, run over everything that is available and compared with a batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.timeval import micros, to_instant, to_wall_clock
from sparkmart.operators import cdc
from sparkmart.plans import refresh
from sparkmart.session import scratch_dir
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.streaming import ingest
from sparkmart.workload.base import ROLES, Replaced, Tables, query
from sparkmart.workload.changes import (
    ACCOUNT,
    LAST_ACCOUNT,
    LAST_KEPT_ACCOUNT,
    account_lines,
)
from sparkmart.workload.mart_sql import MART_SQL, latest_sql
from sparkmart.workload.sinks import bucket_count, file_count, side_by_side, side_by_side_sql


def _log_folder(t: Tables, label: str) -> tuple[str, str, int]:
    """(base folder, folder of change-log files, number of files)."""
    base, files = scratch_dir(t.spark, label), file_count(t.raw("events"))
    account_lines(t).repartition(files).write.text(f"{base}/log")
    return base, f"{base}/log", files


def _parquet_stream(t: Tables, rows: DataFrame, path: str, order: str | None = None) -> DataFrame:
    """The rows as a stream of files that takes two micro-batches."""
    files = file_count(rows)
    spread = rows.repartition(files) if order is None else rows.repartitionByRange(files, order)
    spread.write.parquet(path)
    return (
        t.spark.readStream.schema(rows.schema)
        .option("maxFilesPerTrigger", files // 2)
        .parquet(path)
    )


def _account_table(t: Tables, base: str) -> KeyedTable:
    return KeyedTable(t.spark, f"{base}/table", ["user_id"], bucket_count(t.raw("events")))


# micro-batches of the rate-limited stream
BATCHES = 4
LOG_LINES = 1 << 20  # lines of a packed log file, which one task reads whole


@query("cdc_stream_ingest", LAST_ACCOUNT)
def _ingest(t: Tables) -> DataFrame:
    base, log, files = _log_folder(t, "ingest")
    table = _account_table(t, base)
    lines = ingest.text_stream(t.spark, log, max_files=files // 2)
    ingest.ingest(lines, ACCOUNT, table, f"{base}/checkpoint").awaitTermination()
    return table.read()


@query("stream_foreach_merge", LAST_KEPT_ACCOUNT)
def _foreach(t: Tables) -> DataFrame:
    """Micro-batches merged by a batch function, deletes ignored, bad lines set aside."""
    base, log, files = _log_folder(t, "foreach")
    table = _account_table(t, base)
    lines = ingest.text_stream(t.spark, log, max_files=files // 2)
    q = ingest.ingest(
        lines, ACCOUNT, table, f"{base}/checkpoint", deletes="ignore", quarantine=f"{base}/bad"
    )
    q.awaitTermination()
    return table.read()


@query("stream_resume", LAST_ACCOUNT)
def _resume(t: Tables) -> DataFrame:
    """Stopped after part of the log, then continued from the checkpoint."""
    base = scratch_dir(t.spark, "resume")
    log, table = f"{base}/log", _account_table(t, base)
    ops = {0: ("c", "d"), 1: ("u", "r")}
    for kinds in ops.values():
        # the later delivery holds events of all times, so many of them come late
        account_lines(t, kinds).write.mode("append").text(log)
        stream = ingest.text_stream(t.spark, log)
        ingest.ingest(stream, ACCOUNT, table, f"{base}/checkpoint").awaitTermination()
    return table.read()


@query(
    "stream_rate_limited",
    f"SELECT CAST({BATCHES} AS BIGINT) AS batches, COUNT(*) AS rows FROM events",
)
def _rate_limited(t: Tables) -> DataFrame:
    """A quarter of the files per micro-batch."""
    base, log, files = _log_folder(t, "rate")
    lines = ingest.text_stream(t.spark, log, max_files=files // BATCHES)
    batches = lines.select("value", F.lit(1).alias("one"))
    q = ingest.append_stream(batches, f"{base}/copy", f"{base}/checkpoint")
    q.awaitTermination()
    progress = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    copied = t.spark.read.parquet(f"{base}/copy")
    return copied.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(len(progress)).cast("long").alias("batches"), "rows"
    )


@query(
    "stream_multi_table",
    side_by_side_sql(
        {
            r: f"SELECT *, (SELECT COUNT(*) FROM r_{r}) AS rows_read FROM r_{r}"
            # the one table whose ids repeat: the latest row of each
            + (" QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY event_time DESC, incident_id DESC, user_id DESC, action DESC) = 1" if r == "instruction" else "")
            for r in ROLES
        },
        "table_name",
    ),
)
def _multi(t: Tables) -> DataFrame:
    """One query per table, side by side; every row, and how many lines its feed has read."""
    base = scratch_dir(t.spark, "multi")
    feeds = {}
    for role in ROLES:
        rows = t[role]
        row = F.struct(*rows.columns)
        at = micros(rows, "event_time") if "event_time" in rows.columns else F.lit(0).cast("long")
        event = cdc.to_envelope(row, None, F.lit("r"), F.lit(0).cast("long"), at)
        packed = rows.select(event.alias("value")).write.option("maxRecordsPerFile", LOG_LINES)
        packed.text(f"{base}/{role}/log", compression="snappy")
        feeds[role] = ingest.Feed(
            ingest.text_stream(t.spark, f"{base}/{role}/log"),
            rows.schema,
            KeyedTable(t.spark, f"{base}/{role}/table", ["id"], bucket_count(rows)),
            f"{base}/{role}/checkpoint",
            f"{base}/{role}/bad",
        )
    read = ingest.ingest_all(feeds)
    kept = {r: f.table.read().withColumn("rows_read", F.lit(read[r]).cast("long")) for r, f in feeds.items()}
    return side_by_side(kept, "table_name")


@query("stream_latest_state", f"SELECT asset_id, region_id, health_percent, event_time FROM {latest_sql('r_asset_status', 'asset_id')}")
def _latest_state(t: Tables) -> DataFrame:
    base = scratch_dir(t.spark, "state")
    status = t["asset_status"].select("id", "asset_id", "region_id", "health_percent", "event_time")
    stream = _parquet_stream(t, status, f"{base}/in")
    changes = stream.select(
        "asset_id",
        "region_id",
        "health_percent",
        "event_time",
        F.lit("u").alias("_op"),
        micros(stream, "event_time").alias("_ts"),
        F.col("id").alias("_seq"),
    )
    table = KeyedTable(t.spark, f"{base}/table", ["asset_id"], bucket_count(status))
    ingest.latest_state(changes, ["asset_id"], table, f"{base}/checkpoint").awaitTermination()
    return table.read()


@query("stream_mart_refresh", f"SELECT * FROM ({MART_SQL['supply_readiness', 'product']})")
def _mart_refresh(t: Tables) -> DataFrame:
    """Supply rows stream in; each micro-batch recomputes only the assets it touches."""
    base = scratch_dir(t.spark, "refresh")
    supply = t["supply"]
    silver = KeyedTable(t.spark, f"{base}/supply", ["id"], bucket_count(supply))
    mart = KeyedTable(t.spark, f"{base}/mart", ["asset_id"], bucket_count(supply))

    def step(batch: DataFrame, batch_id: int) -> None:
        changes = batch.select(
            "*",
            F.lit("u").alias("_op"),
            micros(batch, "event_time").alias("_ts"),
            F.lit(0).cast("long").alias("_seq"),
        )
        silver.merge(changes, batch_id)
        tables = Replaced(t, supply=silver.read())
        refresh.refresh("supply_readiness", tables, {"supply": batch}, mart, batch_id)

    stream = _parquet_stream(t, supply, f"{base}/in", order="event_time")
    q = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return mart.read()


@query(
    "stream_static_join",
    """SELECT i.id, i.result, w.hit_probability FROM r_interaction i
        JOIN r_equipment w ON w.id = i.equipment_id""",
)
def _static(t: Tables) -> DataFrame:
    base = scratch_dir(t.spark, "static")
    facts = t["interaction"]
    stream = _parquet_stream(t, facts, f"{base}/in")
    equipment = t["equipment"].select(F.col("id").alias("equipment_id"), "hit_probability")
    enriched = stream.join(equipment, "equipment_id").select("id", "result", "hit_probability")
    ingest.append_stream(enriched, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/out")


@query(
    "stream_stream_join",
    """SELECT a.id AS incident_id, c.id AS instruction_id, c.action, a.created_at, c.event_time
        FROM r_incident a JOIN r_instruction c ON c.incident_id = a.id
            AND c.event_time >= a.created_at AND c.event_time <= a.created_at + INTERVAL 365 DAY""",
)
def _streams(t: Tables) -> DataFrame:
    """Instructions that follow their incident within a year, both sides streaming."""
    base = scratch_dir(t.spark, "streams")
    incident = t["incident"].select(F.col("id").alias("incident_id"), "created_at")
    instruction = t["instruction"].select(
        F.col("id").alias("instruction_id"), F.col("incident_id").alias("answers"), "action", "event_time"
    )
    sides = []
    for name, rows, time in (("a", incident, "created_at"), ("c", instruction, "event_time")):
        # a watermark needs instants; the tables hold wall-clock times
        zoned = rows.withColumn(time, to_instant(rows, time))
        zoned.write.parquet(f"{base}/{name}")
        sides.append(t.spark.readStream.schema(zoned.schema).parquet(f"{base}/{name}"))
    joined = ingest.join_streams(
        sides[0], sides[1], ("incident_id", "answers"), "created_at", "event_time", "365 days", "30 days"
    ).drop("answers")
    ingest.append_stream(joined, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    out = t.spark.read.parquet(f"{base}/out")
    return out.withColumns({c: to_wall_clock(F.col(c)) for c in ("created_at", "event_time")})
