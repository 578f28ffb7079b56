import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators import cdc
from sparkmart.specs import TABLES

ROW = TABLES["supply"].schema


def line(op, ts, key, level=None, seq=0, when="2024-01-01T00:00:00.000001Z"):
    row = {"id": key, "asset_id": "A", "region_id": "R", "supply_level": level, "event_time": when}
    image = {"before": None if op in "cr" else row, "after": None if op == "d" else row}
    return json.dumps({**image, "op": op, "ts_ms": ts, "seq": seq, "source": {"x": 1}})


def log(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_decode_types_and_quarantine(spark):
    events, bad = cdc.decode(log(spark, [line("c", 1, "1", "12.5000"), "not json", "{}", '{"op":']), ROW)
    row = events.collect()[0]
    assert row.after.supply_level == Decimal("12.5000")
    assert row.after.event_time == dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    assert {r.value for r in bad.collect()} == {"not json", "{}", '{"op":'}
    keyless = '{"after": {"asset_id": "A"}, "op": "c", "ts_ms": 1}'
    events, bad = cdc.decode(log(spark, [line("c", 1, "1", "1"), keyless]), ROW, key=["id"])
    assert events.count() == 1 and [r.value for r in bad.collect()] == [keyless]


def test_last_change_wins_by_time_then_sequence(spark):
    lines = [line("c", 5, "1", "1"), line("u", 9, "1", "2", seq=1), line("u", 9, "1", "3", seq=2), line("u", 7, "1", "4")]
    events, _ = cdc.decode(log(spark, lines), ROW)
    assert [r.supply_level for r in cdc.apply_changes(events, ["id"]).collect()] == [Decimal(3)]


def test_deletes_apply_or_are_ignored(spark):
    lines = [line("c", 1, "1", "1"), line("d", 2, "1"), line("c", 1, "2", "2"), line("u", 0, "1", "9")]
    events, _ = cdc.decode(log(spark, lines), ROW)
    assert [r.id for r in cdc.apply_changes(events, ["id"]).collect()] == ["2"]
    kept = cdc.apply_changes(events, ["id"], deletes="ignore")
    assert {r.id: r.supply_level for r in kept.collect()} == {"1": Decimal(1), "2": Decimal(2)}


def test_unknown_operations_are_left_out(spark):
    events, _ = cdc.decode(log(spark, [line("t", 1, "1", "1"), line("r", 1, "2", "1")]), ROW)
    assert [r.id for r in cdc.apply_changes(events, ["id"]).collect()] == ["2"]
    assert cdc.keep_ops(events).count() == 1


def test_changed_columns(spark):
    before = {"id": "1", "asset_id": "A", "region_id": "R", "supply_level": "1", "event_time": None}
    after = {**before, "asset_id": "B", "supply_level": None}
    text = json.dumps({"before": before, "after": after, "op": "u", "ts_ms": 3})
    events, _ = cdc.decode(log(spark, [text]), ROW)
    got = {r.column_name: (r.old_value, r.new_value) for r in cdc.changed_columns(events, ["id"]).collect()}
    assert got == {"asset_id": ("A", "B"), "supply_level": ("1.0000", None)}


def test_changed_columns_of_a_log_of_one_operation(spark):
    # the operation is a constant of the plan, and all columns are taken, not only counted
    rows = spark.range(3).select("id", F.col("id").cast("string").alias("a"), (F.col("id") * 2).alias("b"))
    before = F.struct("id", F.lit("1").alias("a"), F.lit(4).cast("long").alias("b")).alias("before")
    images = rows.select(before, F.struct("id", "a", "b").alias("after"), F.lit("u").alias("op"), F.lit(7).alias("ts_ms"))
    got = {tuple(r) for r in cdc.changed_columns(images, ["id"]).collect()}
    assert got == {(0, 7, "a", "1", "0"), (0, 7, "b", "4", "0"), (1, 7, "b", "4", "2"), (2, 7, "a", "1", "2")}


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "id int, v string")
    got = {r.id: (r.op, r.before and r.before.v, r.after and r.after.v) for r in cdc.snapshot_diff(old, new, ["id"]).collect()}
    assert got == {1: ("d", "a", None), 2: ("u", "b", "B"), 4: ("c", None, "d")}
    assert {r.op for r in cdc.snapshot_diff(None, new, ["id"]).collect()} == {"r"}


def test_diff_rebuilds_the_next_snapshot(spark):
    old = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string")
    new = spark.createDataFrame([(i, f"v{i % 60}x" if i % 3 else f"v{i}") for i in range(20, 80)], "id int, v string")
    from pyspark.sql import functions as F

    first = cdc.snapshot_diff(None, old, ["id"]).withColumns({"ts_ms": F.lit(0).cast("long"), "seq": F.lit(0).cast("long")})
    then = cdc.snapshot_diff(old, new, ["id"]).withColumns({"ts_ms": F.lit(1).cast("long"), "seq": F.lit(0).cast("long")})
    rebuilt = cdc.apply_changes(first.unionByName(then), ["id"])
    assert sorted(rebuilt.collect()) == sorted(new.collect())


def test_order_within_a_millisecond_and_bad_fields(spark):
    row = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.DoubleType())])
    line = '{"before":%s,"after":%s,"op":"%s","ts_ms":7,"source":{"lsn":%d,"db":"x"}}'
    lines = [
        line % ("null", '{"id":"a","v":1}', "c", 10),
        line % ('{"id":"a","v":1}', "null", "d", 11),
        line % ("null", '{"id":"b","v":9.0}', "u", 20),
        line % ("null", '{"id":"b","v":2.0}', "u", 21),
        line % ("null", '{"id":"c","v":5.0}', "c", 30),
        line % ("null", '{"id":"c","v":"junk"}', "u", 31),
        line % ("null", '{"id":"d","v":1.0}', "x", 40),
        "not json",
    ]
    events, bad = cdc.decode(spark.createDataFrame([(x,) for x in lines], "value string"), row, key=["id"])
    assert {r.id: r.v for r in cdc.apply_changes(events, ["id"]).collect()} == {"b": 2.0, "c": 5.0}
    assert sorted(r.value for r in bad.collect()) == sorted(lines[5:])


def test_offsets_order_events(spark):
    row = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.DoubleType())])
    line = '{"before":null,"after":{"id":"a","v":%s},"op":"u","ts_ms":7}'
    raw = spark.createDataFrame([(line % "9.0", 0, 1), (line % "2.0", 0, 2)], "value string, partition int, offset long")
    assert [r.v for r in cdc.apply_changes(cdc.decode(raw, row)[0], ["id"]).collect()] == [2.0]


def test_events_without_their_image_are_set_aside(spark):
    good = line("c", 1, "1", "1.5")
    row = json.loads(good)["after"]
    bare = [
        json.dumps({"op": "u", "before": row, "after": None, "ts_ms": 2}),
        json.dumps({"op": "c", "after": None, "ts_ms": 3}),
        json.dumps({"op": "u", "ts_ms": 4}),
        json.dumps({"op": "u", "before": row, "after": {**row, "id": None}, "ts_ms": 5}),
        json.dumps({"op": "d", "before": None, "after": row, "ts_ms": 6}),
    ]
    events, bad = cdc.decode(log(spark, [good, *bare]), ROW, key=["id"])
    assert sorted(r.value for r in bad.collect()) == sorted(bare)
    assert [(r.id, r.supply_level) for r in cdc.apply_changes(events, ["id"]).collect()] == [("1", Decimal("1.5"))]
    # without a key the image itself decides, and changes made elsewhere are held to the same rule
    events, bad = cdc.decode(log(spark, [good, *bare]), ROW)
    assert bad.count() == 4
    assert [r.id for r in cdc.changes(events, ["id"]).collect()] == ["1"]


def test_a_delete_names_its_row_in_the_image_before(spark):
    moved = json.dumps({"op": "d", "before": {"id": "1"}, "after": {"id": "2"}, "ts_ms": 9})
    events, _ = cdc.decode(log(spark, [line("c", 1, "1", "1"), line("c", 1, "2", "1"), moved]), ROW, key=["id"])
    assert [r.id for r in cdc.apply_changes(events, ["id"]).collect()] == ["2"]


def test_a_line_is_parsed_once(spark):
    row = T.StructType.fromDDL("id long, v string")
    lines = spark.createDataFrame([('{"after":{"id":1,"v":"a"},"op":"c","ts_ms":1,"seq":1}',), ('{"after":{"id":"x"},"op":"c"}',), ("{",), (None,)], "value string")
    events, bad = cdc.decode(lines, row, key=["id"])
    flat = cdc.changes(events, ["id"])
    for df in (flat, bad):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [(r.id, r.v, r["_op"]) for r in flat.collect()] == [(1, "a", "c")]
    assert bad.count() == 3
