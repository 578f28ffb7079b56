"""Change capture and keyed merge over change logs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.timeval import micros
from sparkmart.operators import cdc
from sparkmart.session import scratch_dir
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.streaming import ingest
from sparkmart.workload.base import Tables, query
from sparkmart.workload.sinks import bucket_count

ACCOUNT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

# Each event of the table is one change of its user's account row.
_OP = """CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END"""


def account_events(t: Tables) -> DataFrame:
    events = t.raw("events")
    row = F.struct("user_id", "value", "ts")
    gone = F.col("event_type") == "error"
    return events.select(
        F.when(gone, row).alias("before"),
        F.when(~gone, row).alias("after"),
        F.expr(_OP).alias("op"),
        F.floor(micros(events, "ts") / 1000).alias("ts_ms"),
        F.col("event_id").alias("seq"),
    )


def account_lines(t: Tables, ops: tuple[str, ...] = ("c", "u", "r", "d")) -> DataFrame:
    """The change log as JSON text, one event per line."""
    e = account_events(t).filter(F.col("op").isin(*ops))
    text = cdc.to_envelope(
        F.col("after"), F.col("before"), F.col("op"), F.col("ts_ms"), F.col("seq")
    )
    return e.select(text.alias("value"))


_DECODED = f"""SELECT user_id, value, ts, {_OP} AS op, epoch_us(ts) // 1000 AS ts_ms, event_id AS seq FROM events"""
LAST_ACCOUNT = f"""SELECT user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY user_id ORDER BY ts_ms DESC, seq DESC) AS rn FROM ({_DECODED}))
    WHERE rn = 1 AND op <> 'd'"""
LAST_KEPT_ACCOUNT = f"""SELECT user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY user_id ORDER BY ts_ms DESC, seq DESC) AS rn FROM ({_DECODED}) WHERE op <> 'd')
    WHERE rn = 1"""


@query(
    "cdc_decode",
    f"""SELECT user_id, CASE WHEN op = 'd' THEN NULL ELSE value END AS value,
            CASE WHEN op = 'd' THEN NULL ELSE ts END AS ts, op, ts_ms, seq FROM ({_DECODED})""",
)
def _decode(t: Tables) -> DataFrame:
    events, _ = cdc.decode(account_lines(t), ACCOUNT)
    return events.select(
        *cdc.row_image(["user_id"]), "after.value", "after.ts", "op", "ts_ms", "seq"
    )


@query(
    "cdc_quarantine",
    """SELECT event_id, CAST(NULL AS VARCHAR) AS line FROM events UNION ALL SELECT NULL, text FROM conversations""",
)
def _quarantine(t: Tables) -> DataFrame:
    """Plain text mixed into the log is set aside as it came, not lost and not decoded."""
    lines = account_lines(t).unionByName(t.raw("conversations").select(F.col("text").alias("value")))
    events, bad = cdc.decode(lines, ACCOUNT)
    return events.select(F.col("seq").alias("event_id"), F.lit(None).cast("string").alias("line")).unionByName(
        bad.select(F.lit(None).cast("long").alias("event_id"), F.col("value").alias("line"))
    )


# Clicks come as updates that name their row but bring no new image.
_IMAGED = _DECODED + " WHERE event_type <> 'click'"


@query(
    "cdc_missing_image_quarantine",
    f"""SELECT user_id, value, ts, COALESCE(n, 0) AS set_aside FROM (
            SELECT user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (
                PARTITION BY user_id ORDER BY ts_ms DESC, seq DESC) AS rn FROM ({_IMAGED})) WHERE rn = 1 AND op <> 'd')
        FULL JOIN (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'click' GROUP BY user_id) USING (user_id)""",
)
def _missing_image(t: Tables) -> DataFrame:
    """Updates without an ``after`` image go to the quarantine of the ingest and leave the rows as they are."""
    base, events = scratch_dir(t.spark, "images"), account_events(t)
    lines = t.raw("events").select("event_id", (F.col("event_type") == "click").alias("_bare"))
    cut = events.join(lines, F.col("seq") == F.col("event_id"))
    text = cdc.to_envelope(
        F.when(~F.col("_bare"), F.col("after")),
        F.when(F.col("_bare"), F.col("after")).otherwise(F.col("before")),
        F.col("op"), F.col("ts_ms"), F.col("seq"),
    )
    cut.select(text.alias("value")).write.text(f"{base}/log")
    table = KeyedTable(t.spark, f"{base}/table", ["user_id"], bucket_count(events))
    stream = ingest.text_stream(t.spark, f"{base}/log")
    ingest.ingest(stream, ACCOUNT, table, f"{base}/checkpoint", quarantine=f"{base}/bad").awaitTermination()
    bad = t.spark.read.text(f"{base}/bad").select(
        F.get_json_object("value", "$.before.user_id").cast("long").alias("user_id")
    )
    return table.read().join(bad.groupBy("user_id").agg(F.count(F.lit(1)).alias("set_aside")), "user_id", "full").select(
        "user_id", "value", "ts", F.coalesce("set_aside", F.lit(0)).cast("long").alias("set_aside")
    )


@query("cdc_op_filter", f"SELECT user_id, value, ts, op FROM ({_DECODED}) WHERE op <> 'd'")
def _op_filter(t: Tables) -> DataFrame:
    events, _ = cdc.decode(account_lines(t), ACCOUNT)
    return cdc.keep_ops(events).select("after.*", "op")


@query("cdc_apply_changes", LAST_ACCOUNT)
def _apply(t: Tables) -> DataFrame:
    events, _ = cdc.decode(account_lines(t), ACCOUNT)
    return cdc.apply_changes(events, ["user_id"])


@query("cdc_apply_ignoring_deletes", LAST_KEPT_ACCOUNT)
def _apply_ignoring(t: Tables) -> DataFrame:
    return cdc.apply_changes(account_events(t), ["user_id"], deletes="ignore")


@query(
    "cdc_before_after_diff",
    """SELECT o_orderkey, column_name, old_value, new_value, ts_ms FROM (
        SELECT o_orderkey, 'o_orderstatus' AS column_name, 'O' AS old_value,
            o_orderstatus AS new_value, epoch_us(o_orderdate) // 1000 AS ts_ms FROM orders
        UNION ALL SELECT o_orderkey, 'o_orderpriority', '5-LOW', o_orderpriority,
            epoch_us(o_orderdate) // 1000 FROM orders) WHERE old_value <> new_value""",
)
def _diff(t: Tables) -> DataFrame:
    """Every order is an update of the row it was first entered as."""
    orders = t.raw("orders")
    images = orders.select(
        F.struct(
            "o_orderkey",
            "o_custkey",
            F.lit("O").alias("o_orderstatus"),
            F.lit("5-LOW").alias("o_orderpriority"),
        ).alias("before"),
        F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("after"),
        F.lit("u").alias("op"),
        F.floor(micros(orders, "o_orderdate") / 1000).alias("ts_ms"),
    )
    return cdc.changed_columns(images, ["o_orderkey"])


_LAST_ORDER = """(SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, ROW_NUMBER() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders {where})
    WHERE rn = 1 {keep})"""


def last_orders(orders: DataFrame) -> DataFrame:
    from sparkmart.operators.keyed import latest_per_key

    needed = orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    last = latest_per_key(needed, ["o_custkey"], ("o_orderdate",), ("o_orderkey",))
    return last.drop("o_orderdate")


@query(
    "cdc_snapshot_diff",
    f"""SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey,
            CASE WHEN b.o_custkey IS NULL THEN 'c' WHEN a.o_custkey IS NULL THEN 'd' ELSE 'u' END AS op,
            b.o_orderkey AS old_order, a.o_orderkey AS new_order
        FROM {_LAST_ORDER.format(where="WHERE o_orderdate < TIMESTAMP '1998-07-01'", keep="")} b
        FULL JOIN {_LAST_ORDER.format(where="", keep="AND o_orderstatus <> 'P'")} a
            ON a.o_custkey = b.o_custkey
        WHERE a.o_custkey IS NULL OR b.o_custkey IS NULL OR a.o_orderkey <> b.o_orderkey
            OR a.o_orderstatus <> b.o_orderstatus""",
)
def _snapshot_diff(t: Tables) -> DataFrame:
    """Customers' last orders as of mid 1998 against now, where pending ones are withdrawn."""
    orders = t.raw("orders")
    before = last_orders(orders.filter(F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz")))
    after = last_orders(orders).filter(F.col("o_orderstatus") != "P")
    return cdc.snapshot_diff(before, after, ["o_custkey"]).select(
        "o_custkey",
        "op",
        F.col("before.o_orderkey").alias("old_order"),
        F.col("after.o_orderkey").alias("new_order"),
    )


@query(
    "cdc_first_snapshot",
    "SELECT c_custkey, 'r' AS op, c_name, c_nationkey FROM customer",
)
def _first_snapshot(t: Tables) -> DataFrame:
    rows = t.raw("customer").select("c_custkey", "c_name", "c_nationkey")
    events = cdc.snapshot_diff(None, rows, ["c_custkey"])
    return events.select("c_custkey", "op", "after.c_name", "after.c_nationkey")


# -- keyed merge -------------------------------------------------------------------------------


def order_changes(t: Tables, *columns: str) -> DataFrame:
    """Orders as changes of their customer's row; orders that are pending withdraw the row."""
    orders = t.raw("orders")
    return orders.select(
        "o_custkey",
        "o_orderkey",
        "o_totalprice",
        *columns,
        F.when(F.col("o_orderstatus") == "P", "d").otherwise("u").alias("_op"),
        micros(orders, "o_orderdate").alias("_ts"),
        F.col("o_orderkey").alias("_seq"),
    )


def yearly(changes: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """Changes of a range of years: the batches a merge receives one after another."""
    year = F.floor(F.col("_ts") / F.lit(1_000_000 * 86_400 * 365.25)) + 1970
    rows = changes
    if first is not None:
        rows = rows.filter(year >= first)
    if last is not None:
        rows = rows.filter(year <= last)
    return rows


LAST_ORDERS = """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1 AND o_orderstatus <> 'P'"""


def _merged(t: Tables, label: str, spans) -> KeyedTable:
    changes = order_changes(t)
    table = KeyedTable(
        t.spark, scratch_dir(t.spark, label), ["o_custkey"], bucket_count(changes)
    )
    for batch_id, (first, last) in spans:
        table.merge(yearly(changes, first, last), batch_id)
    return table


@query("merge_upsert", LAST_ORDERS)
def _merge(t: Tables) -> DataFrame:
    """Three batches in order, the second of them delivered twice."""
    spans = [(0, (None, 1996)), (1, (1997, 1998)), (1, (1997, 1998)), (2, (1999, None))]
    return _merged(t, "merge", spans).read()


@query("merge_create_first", LAST_ORDERS)
def _merge_first(t: Tables) -> DataFrame:
    return _merged(t, "merge-first", [(0, (None, None))]).read()


@query("stream_late_guard", LAST_ORDERS)
def _late_guard(t: Tables) -> DataFrame:
    """The newest batch arrives first; later deliveries of older changes do not undo it."""
    spans = [(0, (1999, None)), (1, (None, 1996)), (2, (1997, 1998))]
    return _merged(t, "late", spans).read()


@query(
    "merge_schema_evolve",
    """SELECT o_custkey, o_orderkey, o_totalprice,
            CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1 AND o_orderstatus <> 'P'""",
)
def _evolve(t: Tables) -> DataFrame:
    """A column that only later batches have is null on rows that came before it."""
    orders = t.raw("orders").withColumn("_y", F.year("o_orderdate"))
    wide = order_changes(t, "o_orderpriority", F.year("o_orderdate").alias("_year"))
    table = KeyedTable(
        t.spark, scratch_dir(t.spark, "evolve"), ["o_custkey"], bucket_count(orders)
    )
    table.merge(wide.filter(F.col("_year") < 1998).drop("o_orderpriority", "_year"), 0)
    table.merge(wide.filter(F.col("_year") >= 1998).drop("_year"), 1)
    return table.read()


@query(
    "stamp_update_time",
    """SELECT o_custkey, o_orderkey, COUNT_early > 0 AND COUNT_late > 0 AS updated FROM (
        SELECT o_custkey, o_orderkey, o_orderstatus,
            COUNT(*) FILTER (WHERE year(o_orderdate) < 1998) OVER (PARTITION BY o_custkey) AS COUNT_early,
            COUNT(*) FILTER (WHERE year(o_orderdate) >= 1998) OVER (PARTITION BY o_custkey) AS COUNT_late,
            ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1 AND o_orderstatus <> 'P'""",
)
def _stamp(t: Tables) -> DataFrame:
    """A merge keeps the time a row was created and renews the time it was updated."""
    changes = order_changes(t, F.year("o_orderdate").alias("_year"))
    table = KeyedTable(
        t.spark, scratch_dir(t.spark, "stamp"), ["o_custkey"], bucket_count(changes)
    )
    table.merge(changes.filter(F.col("_year") < 1998).drop("_year"), 0)
    table.merge(changes.filter(F.col("_year") >= 1998).drop("_year"), 1)
    rows = table.read(with_meta=True)
    return rows.select(
        "o_custkey", "o_orderkey", (F.col("_updated_at") > F.col("_created_at")).alias("updated")
    )


@query("skip_empty", "SELECT FALSE AS committed, CAST(0 AS BIGINT) AS versions, COUNT(*) AS candidates FROM orders")
def _skip_empty(t: Tables) -> DataFrame:
    """A batch without any row commits nothing."""
    changes = order_changes(t)
    table = KeyedTable(t.spark, scratch_dir(t.spark, "empty"), ["o_custkey"], 4)
    committed = table.merge(changes.filter(F.col("o_totalprice") < 0), 0)
    return changes.agg(F.count(F.lit(1)).alias("candidates")).select(
        F.lit(committed).alias("committed"),
        F.lit(len(table.versions())).cast("long").alias("versions"),
        "candidates",
    )
