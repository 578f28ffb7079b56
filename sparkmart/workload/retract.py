"""Change logs whose later batches update, move and delete what earlier ones brought."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart import jobs
from sparkmart.functions.timeval import micros
from sparkmart.operators import cdc
from sparkmart.plans import marts, refresh
from sparkmart.session import scratch_dir
from sparkmart.session import side_by_side as at_once
from sparkmart.sources import lake
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.streaming import ingest
from sparkmart.streaming.metrics import BatchMetrics
from sparkmart.streaming.retract import ChangeJoin, LatestOfGroup
from sparkmart.workload.base import Replaced, Tables, query
from sparkmart.workload.mart_sql import MART_SQL, asof_sql, latest_sql
from sparkmart.workload.marts import tidy
from sparkmart.workload.sinks import bucket_count, side_by_side, side_by_side_sql


def _lines(rows: DataFrame, op: str, phase: int, before: bool = False) -> DataFrame:
    """Change events of one kind for whole rows, as text."""
    image = F.struct(*rows.columns)
    text = cdc.to_envelope(
        None if before else image, image if before else None, F.lit(op), F.lit(phase).cast("long"), F.lit(phase).cast("long")
    )
    return rows.select(text.alias("value"))


LOG_RECORDS = 100_000


def _run_phases(phases: list[dict[str, DataFrame]], base: str, start) -> None:
    """Write the logs phase by phase; after each the stream runs over what is new, so phases never share a batch."""

    def write(name: str, lines: DataFrame) -> None:
        # packed files cannot be cut, so each holds few enough lines for one task
        packed = lines.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LOG_RECORDS)
        packed.text(f"{base}/log/{name}")

    for phase in phases:
        at_once(*[partial(write, name, lines) for name, lines in phase.items()])
        start().awaitTermination()


def _batches(lines: dict[str, DataFrame], step, checkpoint: str):
    """A stream over several logs; ``step`` gets a batch's lines by log."""
    tagged = [stream.select(F.lit(name).alias("log"), "value") for name, stream in lines.items()]
    both = tagged[0] if len(tagged) == 1 else tagged[0].unionByName(tagged[1])

    def run(batch: DataFrame, batch_id: int) -> None:
        step({name: batch.filter(F.col("log") == name) for name in lines}, batch_id)

    return ingest.start_batches(both, run, checkpoint, None)


# -- the newest row of a group, taken back -----------------------------------------------------

# Rows are created; then every third gets a time a day earlier, every fifth moves to the next asset
# and every fourth is deleted; at last every eighth (deleted, then) comes back.
_FINAL_STATUS = """SELECT id, CASE WHEN id % 5 = 0 AND id % 8 <> 0 THEN asset_id + 1 ELSE asset_id END AS asset_id, region_id, health_percent,
        CASE WHEN id % 3 = 0 AND id % 8 <> 0 THEN event_time - INTERVAL 1 DAY ELSE event_time END AS event_time
    FROM r_asset_status WHERE id % 4 <> 0 OR id % 8 = 0"""


@query(
    "stream_latest_retract",
    f"""SELECT asset_id, id, region_id, health_percent, event_time FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY asset_id ORDER BY event_time DESC, id DESC) AS rn FROM ({_FINAL_STATUS})) WHERE rn = 1""",
)
def _latest(t: Tables) -> DataFrame:
    """Latest status of every asset under creates, updates, moves and deletes in four batches, the last delivered twice."""
    base = scratch_dir(t.spark, "retract")
    rows = t["asset_status"].select("id", "asset_id", "region_id", "health_percent", "event_time")
    table = KeyedTable(t.spark, f"{base}/rows", ["id"], bucket_count(rows))
    view = LatestOfGroup(table, ["asset_id"], ["event_time"], base)
    early = F.col("event_time") - F.expr("interval 1 day")
    changed = rows.filter((F.col("id") % 3 == 0) | (F.col("id") % 5 == 0)).select(
        "id",
        F.when(F.col("id") % 5 == 0, F.col("asset_id") + 1).otherwise(F.col("asset_id")).alias("asset_id"),
        "region_id",
        "health_percent",
        F.when(F.col("id") % 3 == 0, early).otherwise(F.col("event_time")).alias("event_time"),
    )
    phases = [
        _lines(rows, "c", 1),
        _lines(changed, "u", 3),
        _lines(rows.filter("id % 4 = 0"), "d", 4, before=True),
        _lines(rows.filter("id % 8 = 0"), "c", 5),
    ]

    def step(lines: dict[str, DataFrame], batch_id: int) -> None:
        events, _ = cdc.decode(lines["status"], rows.schema, key=["id"])
        changes = cdc.changes(events, ["id"])
        view.apply(changes, batch_id)
        if batch_id == len(phases) - 1:
            view.apply(changes, batch_id)

    def start():
        return _batches({"status": ingest.text_stream(t.spark, f"{base}/log/status")}, step, f"{base}/checkpoint")

    _run_phases([{"status": p} for p in phases], base, start)
    return view.latest.read()


# -- a join that follows both sides ------------------------------------------------------------


@query(
    "stream_change_join",
    """SELECT i.id AS interaction_id, i.equipment_id, i.result, w.hit_probability
        FROM (SELECT id, CASE WHEN id % 7 = 0 THEN equipment_id + 1 ELSE equipment_id END AS equipment_id,
                CASE WHEN id % 7 = 0 THEN 'unknown' ELSE result END AS result FROM r_interaction WHERE id % 9 <> 0) i
        JOIN (SELECT id, CASE WHEN id % 4 = 0 THEN hit_probability / 2 ELSE hit_probability END AS hit_probability
            FROM r_equipment WHERE id % 6 <> 0) w ON w.id = i.equipment_id""",
)
def _change_join(t: Tables) -> DataFrame:
    """Interactions with their equipment under updates and deletes on both sides in four batches, one delivered twice."""
    base = scratch_dir(t.spark, "change-join")
    facts = t["interaction"].select(F.col("id").alias("interaction_id"), "equipment_id", "result")
    kinds = t["equipment"].select(F.col("id").alias("equipment_id"), "hit_probability")
    join = ChangeJoin(
        KeyedTable(t.spark, f"{base}/facts", ["interaction_id"], bucket_count(facts)),
        KeyedTable(t.spark, f"{base}/kinds", ["equipment_id"], bucket_count(kinds)),
        ["equipment_id"],
        base,
    )
    moved = facts.filter("interaction_id % 7 = 0").withColumns(
        {"equipment_id": F.col("equipment_id") + 1, "result": F.lit("unknown")}
    )
    weaker = kinds.filter("equipment_id % 4 = 0").withColumn("hit_probability", F.col("hit_probability") / 2)
    phases = [
        {"facts": _lines(facts, "c", 1), "kinds": _lines(kinds.filter("equipment_id % 2 = 0"), "c", 1)},
        {"facts": _lines(moved, "u", 2), "kinds": _lines(kinds.filter("equipment_id % 2 = 1"), "c", 2)},
        {"facts": _lines(facts.filter("interaction_id % 9 = 0"), "d", 3, before=True), "kinds": _lines(weaker, "u", 3)},
        {"kinds": _lines(kinds.filter("equipment_id % 6 = 0"), "d", 5, before=True)},
    ]
    schemas = {"facts": (facts.schema, ["interaction_id"]), "kinds": (kinds.schema, ["equipment_id"])}

    def step(lines: dict[str, DataFrame], batch_id: int) -> None:
        sides = []
        for name, (schema, key) in schemas.items():
            events, _ = cdc.decode(lines[name], schema, key=key)
            sides.append(cdc.changes(events, key))
        join.apply(*sides, batch_id)
        if batch_id == 2:
            join.apply(*sides, batch_id)

    def start():
        logs = {name: ingest.text_stream(t.spark, f"{base}/log/{name}") for name in schemas}
        return _batches(logs, step, f"{base}/checkpoint")

    _run_phases(phases, base, start)
    return join.result.read()


# -- marts from change logs alone --------------------------------------------------------------


def _role_log(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three deliveries whose end is ``rows``: creates with wrong times and rows that never were, then corrections, then deletes."""
    timed, keyed = "event_time" in rows.columns, "action" not in rows.columns
    wrong = rows
    if timed and keyed:
        late = F.when(F.col("id") % 5 == 0, F.col("event_time") - F.expr("interval 40 days")).otherwise(F.col("event_time"))
        wrong = rows.withColumn("event_time", late)
    ghosts = rows.filter("id % 7 = 0").withColumn("id", -F.col("id") - 1)
    if timed:
        ghosts = ghosts.withColumn("event_time", F.col("event_time") + F.expr("interval 1 day"))
    first = _lines(wrong, "c", 1).unionByName(_lines(ghosts, "c", 1))
    return first, _lines(rows.filter("id % 5 = 0"), "u", 2), _lines(ghosts, "d", 3, before=True)


def _register_refresh(name: str) -> None:
    @query(f"stream_mart_refresh_{name}", MART_SQL[name, "product"])
    def build(t: Tables) -> DataFrame:
        """The mart after three deliveries of all logs it depends on; nobody says what has changed."""
        base, roles = scratch_dir(t.spark, f"logs-{name}"), sorted(refresh.feeds(name))
        logs = {role: _role_log(t[role]) for role in roles}
        # ids of instructions repeat, so there a row is known by all its columns
        keys = {role: t[role].columns if role == "instruction" else ["id"] for role in roles}
        silver = {r: KeyedTable(t.spark, f"{base}/silver/{r}", keys[r], bucket_count(t[r])) for r in roles}
        mart = KeyedTable(t.spark, f"{base}/gold", marts.mart_key(name, "product"), bucket_count(t["asset_status"]))

        def start():
            lines = {r: ingest.text_stream(t.spark, f"{base}/log/{r}") for r in roles}
            rows = {r: t[r].schema for r in roles}
            return jobs.marts_from_logs(
                t.spark, lines, rows, silver, {name: mart}, f"{base}/checkpoint", quarantine=f"{base}/bad", sink_types=False
            )

        _run_phases([{r: logs[r][phase] for r in roles} for phase in range(3)], base, start)
        return tidy(mart.read())


for _name in marts.BUILDERS:
    _register_refresh(_name)


# Conditions whose number divides by 50 come late; a mart row is touched if one of them applies to its status.
_LATE = "id % 50 = 0"
_LATE_ASSETS = f"""SELECT asset_id FROM {asof_sql(latest_sql("r_asset_status", "asset_id, region_id"), "r_condition",
    "r.region_id = l.region_id", "asset_id, region_id", "r.id AS condition_id", "INNER")} WHERE condition_id % 50 = 0"""


@query(
    "refresh_late_condition",
    f"SELECT * FROM ({MART_SQL['asset_strength', 'linear']}) WHERE asset_id IN ({_LATE_ASSETS})",
)
def _late(t: Tables) -> DataFrame:
    """Late conditions recompute only assets with a status between their time and the next condition of the region."""
    late = t["condition"].filter(_LATE)
    return refresh.affected_rows("asset_strength", t, {"condition": late}, "linear")


# -- a stream that joins a moving table --------------------------------------------------------


@query(
    "stream_versioned_join",
    """SELECT i.id, i.result, CASE WHEN i.id % 3 = 0 THEN w.hit_probability ELSE w.hit_probability / 2 END AS hit_probability,
            CAST(CASE WHEN i.id % 3 = 0 THEN 1 WHEN i.id % 3 = 1 THEN 2 ELSE 3 END AS BIGINT) AS table_version
        FROM r_interaction i JOIN r_equipment w ON w.id = i.equipment_id
        WHERE i.id % 3 < 2 OR w.id % 4 <> 0""",
)
def _versioned(t: Tables) -> DataFrame:
    """Facts in three batches; between them all equipment loses half its quality, and a quarter of it then goes."""
    base, facts = scratch_dir(t.spark, "versioned"), t["interaction"].select("id", "result", "equipment_id")
    kinds = t["equipment"].select(F.col("id").alias("equipment_id"), "hit_probability")
    table = KeyedTable(t.spark, f"{base}/kinds", ["equipment_id"], bucket_count(kinds))
    half = kinds.withColumn("hit_probability", F.col("hit_probability") / 2)
    steps = [(kinds, "c"), (half, "u"), (half.filter("equipment_id % 4 = 0"), "d")]
    for i, (rows, op) in enumerate(steps):
        at = F.lit(i).cast("long")
        table.merge(rows.select("*", F.lit(op).alias("_op"), at.alias("_ts"), at.alias("_seq")), i)
        facts.filter(F.col("id") % 3 == i).write.mode("append").parquet(f"{base}/in")
        stream = t.spark.readStream.schema(facts.schema).parquet(f"{base}/in")
        ingest.join_versions(stream, table, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/out").select("id", "result", "hit_probability", "table_version")


# -- metrics, small files, ticks ---------------------------------------------------------------

BATCHES = 104


@query(
    "stream_batch_metrics",
    f"""SELECT CAST({BATCHES} AS BIGINT) AS batches, COUNT(*) AS rows_read, COUNT(*) AS rows_observed,
        CAST(SUM(event_id) AS BIGINT) AS ids_observed, TRUE AS timed FROM events""",
)
def _metrics(t: Tables) -> DataFrame:
    """Rows, an observed sum and the duration of every one of more micro-batches than a query remembers."""
    base, events = scratch_dir(t.spark, "metrics"), t.raw("events").select("event_id", "user_id")
    # dealt out evenly, so that every file has rows
    events.repartition(BATCHES).write.parquet(f"{base}/in")
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    observed = stream.observe("seen", F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))
    with BatchMetrics(t.spark) as metrics:
        copy = ingest.append_stream(observed, f"{base}/out", f"{base}/checkpoint")
        copy.awaitTermination()
        batches = [
            (b.batch_id, b.rows, b.millis, b.observed["seen"]["rows"], b.observed["seen"]["ids"])
            for b in metrics.batches(copy)
        ]
    # one row per micro-batch
    told = t.spark.createDataFrame(batches, "batch long, rows long, millis long, seen long, ids long")
    return told.agg(
        F.count_distinct("batch").alias("batches"), F.sum("rows").alias("rows_read"), F.sum("seen").alias("rows_observed"),
        F.sum("ids").alias("ids_observed"), (F.min("millis") > 0).alias("timed"),
    )


_COMPACTED = {
    "rows": "SELECT *, CAST(strftime(event_time, '%Y%m') AS INTEGER) AS month FROM r_instruction",
    "files": """SELECT CAST(strftime(event_time, '%Y%m') AS INTEGER) AS month, TRUE AS one_file FROM r_instruction GROUP BY 1""",
}


@query("lake_compact", side_by_side_sql(_COMPACTED, "part"))
def _compact(t: Tables) -> DataFrame:
    """A month layout written by ten small appends, packed: the same rows, and one file a month instead of ten."""
    base, rows = scratch_dir(t.spark, "compact"), t["instruction"]
    monthly = rows.withColumn("month", F.date_format("event_time", "yyyyMM"))
    for i in range(10):
        part = monthly.filter(F.pmod(F.col("id"), F.lit(10)) == i).repartition("month")
        part.write.mode("append").partitionBy("month").parquet(f"{base}/small")
    lake.compact(t.spark, f"{base}/small", f"{base}/packed")
    packed = t.spark.read.parquet(f"{base}/packed").withColumn("month", F.col("month").cast("int"))
    files = packed.groupBy("month").agg((F.count_distinct(F.col("_metadata.file_path")) == 1).alias("one_file"))
    return side_by_side({"rows": packed, "files": files}, "part")


@query(
    "stream_periodic_refresh",
    f"SELECT *, CAST(3 AS BIGINT) AS runs FROM ({MART_SQL['supply_readiness', 'product']})",
)
def _periodic(t: Tables) -> DataFrame:
    """Three refreshes at a steady interval, each with a third more of the supply rows."""
    base = scratch_dir(t.spark, "periodic")
    mart = KeyedTable(t.spark, f"{base}/mart", ["asset_id"], bucket_count(t["supply"]))
    done: list[int] = []

    def refresh_some(batch_id: int) -> None:
        part = t["supply"].filter(F.col("id") % 3 == len(done))
        present = t["supply"].filter(F.col("id") % 3 <= len(done))
        done.append(batch_id)
        refresh.refresh("supply_readiness", Replaced(t, supply=present), {"supply": part}, mart, batch_id)

    runs = jobs.every_tick(t.spark, refresh_some, "1 second", f"{base}/checkpoint", runs=3)
    return mart.read().withColumn("runs", F.lit(runs).cast("long"))


@query(
    "mart_event_time_default",
    f"""SELECT interaction_id, event_time FROM (
        SELECT interaction_id, CASE WHEN interaction_id % 5 = 0 THEN (SELECT max(ts) FROM events) ELSE event_time END AS event_time
        FROM ({MART_SQL['interaction_review', 'product']}))""",
)
def _time_default(t: Tables) -> DataFrame:
    """Rows whose time is unknown get the time of the run when they are published."""
    mart = marts.interaction_review(t)
    unknown = mart.withColumn("event_time", F.when(F.col("interaction_id") % 5 != 0, F.col("event_time")))
    present = t.raw("events").agg(F.max("ts")).scalar()
    return marts.publish(unknown, "interaction_review", asof=present).select("interaction_id", "event_time")
