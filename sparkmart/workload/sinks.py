"""Scans and sinks: what was written is read back and compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.plans import marts
from sparkmart.session import estimated_bytes, scratch_dir
from sparkmart.sources import lake, scan, topics
from sparkmart.sources.keyed_table import KeyedTable, upsert_rows
from sparkmart.workload.base import ROLES, Tables, query
from sparkmart.workload.mart_sql import MART_SQL
from sparkmart.workload.marts import newest, tidy

_BUCKET_BYTES = 256 << 20
FILE_RECORDS = 5_000


def bucket_count(df: DataFrame) -> int:
    """Buckets of a new keyed table, so that each holds about a quarter gigabyte."""
    size = estimated_bytes(df) or 0
    return max(8, min(65536, -(-size // _BUCKET_BYTES)))


def file_count(df: DataFrame) -> int:
    """Files of a written log: a multiple of four, each up to about a quarter gigabyte."""
    size = estimated_bytes(df) or 0
    return 4 * max(1, -(-size // (4 * _BUCKET_BYTES)))


@query("scan_table", "SELECT * FROM part")
def _scan(t: Tables) -> DataFrame:
    return scan.scan_table(t.spark, t.sf_dir, "part", suffix=".parquet")


@query(
    "scan_latest_n",
    "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 100",
)
def _latest_n(t: Tables) -> DataFrame:
    from sparkmart.operators.keyed import latest_n

    events = scan.scan_table(t.spark, t.sf_dir, "events", suffix=".parquet")
    return latest_n(events, 100, "ts", ("event_id",)).select("event_id", "ts", "event_type")


@query(
    "scan_or_empty",
    """SELECT 'orders' AS table_name, COUNT(*) AS rows FROM orders
        UNION ALL SELECT 'missing', 0""",
)
def _scan_or_empty(t: Tables) -> DataFrame:
    schema = t.raw("orders").schema
    parts = [
        scan.scan_or_empty(t.spark, f"{t.sf_dir}/{name}.parquet", schema)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "rows")
        for name in ("orders", "missing")
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "lake_append",
    "SELECT * FROM r_instruction UNION ALL SELECT id, incident_id, user_id, action, event_time FROM r_instruction WHERE action = 'hold'",
)
def _append(t: Tables) -> DataFrame:
    """Two appends; the second brings one action's rows again, as an append copy keeps them."""
    path = f"{scratch_dir(t.spark, 'append')}/instruction"
    rows = t["instruction"]
    lake.append(rows, path)
    lake.append(rows.filter(F.col("action") == "hold"), path)
    return t.spark.read.parquet(path)


@query(
    "lake_file_sizing",
    """SELECT COUNT(*) AS rows, TRUE AS within_cap FROM lineitem""",
)
def _sizing(t: Tables) -> DataFrame:
    """No file holds more records than the cap."""
    rows, path, cap = t.raw("lineitem"), f"{scratch_dir(t.spark, 'sizing')}/lineitem", FILE_RECORDS
    lake.append(rows, path, max_records_per_file=cap)
    per_file = (
        t.spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_file.agg(F.sum("n").alias("rows"), (F.max("n") <= cap).alias("within_cap"))


@query("keyed_topic_sink", MART_SQL["asset_strength", "product"])
def _topic(t: Tables) -> DataFrame:
    """The mart as keyed JSON, delivered twice; compaction leaves one value per key."""
    mart = marts.asset_strength(t)
    key = list(marts.mart_key("asset_strength", "product"))
    sent = topics.to_keyed(mart, key)
    log = sent.withColumn("offset", F.lit(0)).unionByName(sent.withColumn("offset", F.lit(1)))
    return topics.from_keyed(topics.compact(log, ["offset"]), mart.schema)


def side_by_side(parts: dict[str, DataFrame], label: str) -> DataFrame:
    """The rows of several tables as one, by column name; ``label`` says which table a row is from."""
    named = [rows.select(F.lit(name).alias(label), "*") for name, rows in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def side_by_side_sql(parts: dict[str, str], label: str) -> str:
    return " UNION ALL BY NAME ".join(f"SELECT '{name}' AS {label}, * FROM ({text})" for name, text in parts.items())


@query(
    "keyed_topics_all_marts",
    side_by_side_sql({name: MART_SQL[name, "linear"] for name in marts.BUILDERS}, "mart"),
)
def _topics(t: Tables) -> DataFrame:
    """All five marts as keyed topics, read back after compaction."""
    parts = {}
    for name, build in marts.BUILDERS.items():
        mart = build(t, "linear")
        sent = topics.to_keyed(mart, marts.mart_key(name, "linear")).withColumn("offset", F.lit(0))
        parts[name] = tidy(topics.from_keyed(topics.compact(sent, ["offset"]), mart.schema))
    return side_by_side(parts, "mart")


@query("lake_copy_all_tables", side_by_side_sql({role: f"SELECT * FROM r_{role}" for role in ROLES}, "table_name"))
def _copies(t: Tables) -> DataFrame:
    """An append copy of every table, read back."""
    base = scratch_dir(t.spark, "copies")
    for role in ROLES:
        lake.append(t[role], f"{base}/{role}")
    return side_by_side({role: t.spark.read.parquet(f"{base}/{role}") for role in ROLES}, "table_name")


@query(
    "mart_upsert",
    f"""SELECT incident_id, observation_id, region_id, threat_level, instruction_id, action, user_id,
            event_time FROM ({MART_SQL["incident_instructions", "product"]})""",
)
def _mart_upsert(t: Tables) -> DataFrame:
    """The mart goes to its table twice: the second delivery updates every key in place."""
    mart = marts.incident_instructions(t)
    target = KeyedTable(
        t.spark, scratch_dir(t.spark, "upsert"), marts.mart_key("incident_instructions", "product"),
        bucket_count(t["incident"]),
    )
    changes = upsert_rows(mart, "event_time")
    target.merge(changes, 0)
    target.merge(changes, 1)
    return target.read()


@query(
    "mart_replace",
    f"SELECT * FROM ({MART_SQL['supply_readiness', 'product']})",
)
def _mart_replace(t: Tables) -> DataFrame:
    """Replace-all by overwriting: the rows of the second write only (a reader meanwhile may find files gone)."""
    path = f"{scratch_dir(t.spark, 'replace')}/supply_readiness"
    marts.supply_readiness(t, "linear").write.mode("overwrite").parquet(path)
    marts.supply_readiness(t, "product").write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query(
    "sink_typed_cast",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS row_id,
            CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(19,4)) END AS price,
            CASE WHEN o_orderstatus <> 'P' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS priority,
            CASE WHEN o_orderstatus = 'P' THEN 'row_id:bigint' ELSE '' END AS reasons FROM orders""",
)
def _typed(t: Tables) -> DataFrame:
    """Text keys of pending orders do not cast; those rows are set aside with the reason."""
    from sparkmart.functions import validate

    text = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(
        F.col("o_orderkey").cast("string")
    )
    rows = t.raw("orders").select(
        "o_orderkey",
        text.alias("row_id"),
        F.col("o_totalprice").alias("price"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
    )
    casts = {"row_id": "bigint", "price": "decimal(19,4)", "priority": "int"}
    clean, bad = validate.cast_split(rows, casts)
    aside = bad.select("o_orderkey", F.array_join(validate.REASONS, ",").alias("reasons"))
    return clean.withColumn("reasons", F.lit("")).unionByName(aside, allowMissingColumns=True)


_BULK = {
    "customer": "c_custkey AS id, c_name AS label, c_acctbal AS amount",
    "orders": "o_orderkey AS id, o_orderstatus AS label, o_totalprice AS amount",
    "part": "p_partkey AS id, p_name AS label, p_retailprice AS amount",
}


@query(
    "bulk_import_by_path",
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, {columns} FROM {name}" for name, columns in _BULK.items()),
)
def _bulk(t: Tables) -> DataFrame:
    """Files are routed by their folder; the second run finds nothing new."""
    base = scratch_dir(t.spark, "bulk")
    root, target, log = f"{base}/marts", f"{base}/loaded", f"{base}/log"
    for name in _BULK:
        t.raw(name).write.parquet(f"{root}/{name}/run=1")
    lake.bulk_import(t.spark, root, target, log)
    lake.bulk_import(t.spark, root, target, log)
    parts = [
        t.spark.read.parquet(f"{target}/{name}").selectExpr(
            f"'{name}' AS table_name", *[c.strip() for c in columns.split(",")]
        )
        for name, columns in _BULK.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_MONTH = "CAST(strftime(event_time, '%Y%m') AS INTEGER) AS month"


@query("mart_month_layout", f"SELECT *, {_MONTH} FROM r_instruction")
def _by_month(t: Tables) -> DataFrame:
    """Written by month twice; the second write replaces only the months it holds."""
    path = f"{scratch_dir(t.spark, 'month')}/instruction"
    rows = t["instruction"]
    lake.write_by_month(rows, path, "event_time", ["user_id", "id", "event_time"])
    again = rows.filter(F.col("event_time") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    lake.write_by_month(again, path, "event_time", ["user_id", "id", "event_time"])
    return t.spark.read.parquet(path).withColumn("month", F.col("month").cast("int"))


@query(
    "mart_month_layout_all_marts",
    side_by_side_sql({n: f"SELECT *, {_MONTH} FROM ({MART_SQL[n, 'product']})" for n in marts.BUILDERS}, "mart"),
)
def _months(t: Tables) -> DataFrame:
    """All five marts partitioned by month and clustered by region, key and time."""
    base, parts = scratch_dir(t.spark, "months"), {}
    for name, build in marts.BUILDERS.items():
        order = ["region_id", *marts.mart_key(name, "product"), "event_time"]
        lake.write_by_month(build(t, "product"), f"{base}/{name}", "event_time", order)
        stored = t.spark.read.parquet(f"{base}/{name}")
        parts[name] = tidy(stored).withColumn("month", F.col("month").cast("int"))
    return side_by_side(parts, "mart")


@query(
    "json_path_extract",
    """SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
            epoch_us(ts) // 1000 AS event_ms FROM events""",
)
def _json_paths(t: Tables) -> DataFrame:
    """Columns of a table pulled out of change-event text by path, times as epoch milliseconds."""
    from sparkmart.functions.jsonval import extract_paths, iso_to_millis

    at = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("ts")
    row = F.struct("event_id", "user_id", "event_type", "value", "props", at)
    lines = t.raw("events").select(F.to_json(F.struct(row.alias("after"))).alias("value"))
    pulled = extract_paths(
        lines,
        "value",
        {
            "event_id": ("$.after.event_id", "bigint"),
            "user_id": ("$.after.user_id", "bigint"),
            "event_type": ("$.after.event_type", "string"),
            "value": ("$.after.value", "double"),
            "props": ("$.after.props", "string"),
            "ts": ("$.after.ts", "string"),
        },
    )
    inner = extract_paths(
        pulled, "props", {"k": ("$.k", "int")}, "event_id", "user_id", "event_type", "value", "ts"
    )
    return inner.withColumn("event_ms", iso_to_millis(F.col("ts"))).drop("ts")


@query(
    "retention_filter",
    """SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY""",
)
def _retention(t: Tables) -> DataFrame:
    orders = t.raw("orders").select("o_orderkey", "o_orderdate")
    return lake.retain(orders, "o_orderdate", newest(orders, "o_orderdate"))
