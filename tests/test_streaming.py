import datetime as dt
import json

import pytest

from sparkmart.session import scratch_dir
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.specs import TABLES
from sparkmart.streaming import ingest

ROW = TABLES["supply"].schema


def line(op, ts, key, level):
    row = {"id": key, "asset_id": "A", "supply_level": level}
    return json.dumps({"before": row if op == "d" else None, "after": None if op == "d" else row, "op": op, "ts_ms": ts, "seq": ts})


def drop(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def state(t):
    return {r.id: float(r.supply_level) for r in t.read().collect()}


@pytest.fixture
def setup(spark):
    base = scratch_dir(spark, "s")
    return base, f"{base}/log", KeyedTable(spark, f"{base}/table", ["id"], 4)


def run(spark, setup, **kw):
    base, log, table = setup
    q = ingest.ingest(ingest.text_stream(spark, log, kw.pop("max_files", None)), ROW, table, f"{base}/cp", **kw)
    q.awaitTermination()
    return q


def test_resume_late_and_delete(spark, setup):
    base, log, table = setup
    drop(spark, log, line("c", 10, "1", "1"), line("c", 10, "2", "2"))
    run(spark, setup)
    assert state(table) == {"1": 1.0, "2": 2.0}
    drop(spark, log, line("u", 5, "1", "9"), line("d", 20, "2", "2"), line("c", 1, "3", "3"))
    run(spark, setup)
    assert state(table) == {"1": 1.0, "3": 3.0}
    run(spark, setup)
    assert state(table) == {"1": 1.0, "3": 3.0} and len(table.versions()) == 2


def test_bad_lines_are_set_aside_and_deletes_ignored(spark, setup):
    base, log, table = setup
    drop(spark, log, line("c", 1, "1", "1"), "garbage", line("d", 2, "1", "1"))
    run(spark, setup, deletes="ignore", quarantine=f"{base}/bad")
    assert state(table) == {"1": 1.0}
    assert [r.value for r in spark.read.text(f"{base}/bad").collect()] == ["garbage"]


def test_one_file_per_batch(spark, setup):
    base, log, table = setup
    for i in range(3):
        drop(spark, log, line("c", i, "1", str(i)))
    q = run(spark, setup, max_files=1)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    assert state(table) == {"1": 2.0} and len(table.versions()) == 3


def test_a_fault_in_a_batch_is_raised(spark, setup, monkeypatch):
    base, log, table = setup
    drop(spark, log, line("c", 1, "1", "1"))
    monkeypatch.setattr(KeyedTable, "merge", lambda *a, **k: (_ for _ in ()).throw(ValueError("no disk")))
    with pytest.raises(Exception, match="no disk"):
        run(spark, setup)
    monkeypatch.undo()
    run(spark, setup)
    assert state(table) == {"1": 1.0}


def test_many_tables_side_by_side(spark):
    base = scratch_dir(spark, "many")
    feeds = {}
    for i, name in enumerate(("a", "b", "c")):
        drop(spark, f"{base}/{name}/log", *[line("c", k, str(k), "1") for k in range(i + 1)])
        feeds[name] = ingest.Feed(
            ingest.text_stream(spark, f"{base}/{name}/log"), ROW, KeyedTable(spark, f"{base}/{name}/t", ["id"], 2), f"{base}/{name}/cp", f"{base}/{name}/bad"
        )
    assert ingest.ingest_all(feeds, wave=2) == {"a": 1, "b": 2, "c": 3}
    assert [feeds[n].table.read().count() for n in feeds] == [1, 2, 3]


def test_lines_of_a_batch_are_not_kept_and_count_once(spark, monkeypatch):
    base, kept = scratch_dir(spark, "counted"), []
    merge_lines = ingest.merge_lines

    def watched(lines, *args):
        kept.append(lines.storageLevel.useDisk or lines.storageLevel.useMemory)
        return merge_lines(lines, *args)

    monkeypatch.setattr(ingest, "merge_lines", watched)
    logs = {"good": [line("c", 1, "1", "1"), line("c", 2, "1", "2")], "mixed": ["garbage", line("c", 1, "2", "1"), "{}"], "bad": ["garbage"]}
    for name, lines in logs.items():
        drop(spark, f"{base}/{name}/log", *lines)
        drop(spark, f"{base}/{name}/log", *lines)
    feeds = {
        n: ingest.Feed(
            ingest.text_stream(spark, f"{base}/{n}/log", 1), ROW, KeyedTable(spark, f"{base}/{n}/t", ["id"], 2), f"{base}/{n}/cp", f"{base}/{n}/bad"
        )
        for n in logs
    }
    assert ingest.ingest_all(feeds) == {"good": 4, "mixed": 6, "bad": 2}  # the bad ones are read twice
    assert kept == [False] * 6
    assert sorted(r.value for r in spark.read.text(f"{base}/mixed/bad").collect()) == ["garbage"] * 2 + ["{}"] * 2
    assert ingest.ingest_all(feeds) == {"good": 0, "mixed": 0, "bad": 0}


def test_logs_of_many_tables_are_packed(spark, tmp_path, monkeypatch):
    from sparkmart.workload import REGISTRY, streams

    monkeypatch.setattr(streams, "LOG_LINES", 1000)
    monkeypatch.setattr(streams, "scratch_dir", lambda spark, label: str(tmp_path))
    REGISTRY["stream_multi_table"](spark, "/root/testdata/sf0.001")
    files = list((tmp_path / "instruction" / "log").glob("part-*"))
    lines = spark.read.text(f"{tmp_path}/instruction/log")
    assert max(r[0] for r in lines.groupBy("_metadata.file_path").count().select("count").collect()) <= 1000
    assert 2 * sum(f.stat().st_size for f in files) < sum(len(r.value) for r in lines.collect())


def test_late_rows_leave_the_state_alone(spark):
    base = scratch_dir(spark, "state")
    schema = "k long, v string, _op string, _ts long, _seq long"
    table = KeyedTable(spark, f"{base}/t", ["k"], 2)

    def feed(*rows):
        spark.createDataFrame([(k, v, "u", ts, 0) for k, v, ts in rows], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        ingest.latest_state(stream, ["k"], table, f"{base}/cp").awaitTermination()

    feed((1, "a", 10), (2, "b", 10))
    feed((1, "late", 5), (2, "c", 11))
    assert {r.k: r.v for r in table.read().collect()} == {1: "a", 2: "c"}


def test_stream_join_bounds(spark):
    base = scratch_dir(spark, "join")
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    spark.createDataFrame([(1, t(0)), (2, t(0))], "a long, at timestamp").write.parquet(f"{base}/l")
    spark.createDataFrame([(1, t(1)), (1, t(30)), (2, t(-1))], "b long, seen timestamp").write.parquet(f"{base}/r")
    l = spark.readStream.schema("a long, at timestamp").parquet(f"{base}/l")
    r = spark.readStream.schema("b long, seen timestamp").parquet(f"{base}/r")
    joined = ingest.join_streams(l, r, ("a", "b"), "at", "seen", "24 hours", "48 hours")
    ingest.append_stream(joined, f"{base}/out", f"{base}/cp").awaitTermination()
    assert [(x.a, x.seen) for x in spark.read.parquet(f"{base}/out").collect()] == [(1, t(1))]


def test_outer_stream_join_emits_unmatched_rows_late(spark):
    base = scratch_dir(spark, "outer")
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    left, right = "a long, at timestamp", "b long, seen timestamp"

    def feed(l, r):
        spark.createDataFrame(l, left).coalesce(1).write.mode("append").parquet(f"{base}/l")
        spark.createDataFrame(r, right).coalesce(1).write.mode("append").parquet(f"{base}/r")
        ls = spark.readStream.schema(left).parquet(f"{base}/l")
        rs = spark.readStream.schema(right).parquet(f"{base}/r")
        joined = ingest.join_streams(ls, rs, ("a", "b"), "at", "seen", "2 hours", "1 hour", "left_outer")
        ingest.append_stream(joined, f"{base}/out", f"{base}/cp").awaitTermination()
        return sorted((x.a, x.b) for x in spark.read.parquet(f"{base}/out").collect())

    assert feed([(1, t(0)), (2, t(0))], [(1, t(1))]) == [(1, 1)]
    # times move on by a day: nothing can follow row 2 any more
    assert (2, None) in [r for r in feed([(3, t(24))], [(9, t(24))])]


def test_a_new_checkpoint_is_not_taken_for_a_replay(spark, setup):
    base, log, table = setup
    drop(spark, log, line("c", 1, "1", "1"))
    run(spark, setup)
    drop(spark, log, line("u", 2, "1", "2"))
    # the checkpoint is lost: the log is read again from its start, as batch 0 of a new stream
    q = ingest.ingest(ingest.text_stream(spark, log), ROW, table, f"{base}/cp2")
    q.awaitTermination()
    assert state(table) == {"1": 2.0}


def test_quarantine_outlives_a_new_checkpoint(spark):
    base = scratch_dir(spark, "bad")
    spark.createDataFrame([("not json",)], "value string").coalesce(1).write.text(f"{base}/log")
    for run_ in (1, 2):
        table = KeyedTable(spark, f"{base}/t", ["id"], 2)
        query = ingest.ingest(ingest.text_stream(spark, f"{base}/log"), ROW, table, f"{base}/cp{run_}", quarantine=f"{base}/bad")
        query.awaitTermination()
        assert [r.value for r in spark.read.text(f"{base}/bad").collect()] == ["not json"] * run_
