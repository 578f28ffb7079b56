"""Metrics of every batch, pinned versions, ticks, packed files, and marts that follow their logs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart import jobs
from sparkmart.operators import skew
from sparkmart.operators.quality import key_violations, reference_violation_counts, reference_violations
from sparkmart.plans import marts, refresh
from sparkmart.session import scratch_dir, scratch_scope, settle
from sparkmart.sources import lake, storage
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.streaming import ingest
from sparkmart.streaming.metrics import BatchMetrics
from sparkmart.workload.base import Tables

SF = "/root/testdata/sf0.001"


def test_metrics_of_every_batch(spark):
    """The registered query has more batches than a query remembers."""
    base = scratch_dir(spark, "metrics")
    spark.range(3000).repartition(6).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    observed = stream.observe("seen", F.count(F.lit(1)).alias("n"))
    with BatchMetrics(spark) as metrics:
        q = ingest.append_stream(observed, f"{base}/out", f"{base}/checkpoint")
        q.awaitTermination()
        batches = metrics.batches(q)
        assert [b.batch_id for b in batches] == list(range(6))
        assert metrics.rows(q) == 3000 == sum(b.observed["seen"]["n"] for b in batches)
        assert all(b.millis > 0 for b in batches)
        again = ingest.append_stream(stream, f"{base}/out", f"{base}/checkpoint")
        again.awaitTermination()
        assert metrics.rows(again) == 0


def test_a_batch_that_runs_again_reads_its_version(spark):
    base = scratch_dir(spark, "pinned")
    table = KeyedTable(spark, f"{base}/kinds", ["k"], 2)
    change = lambda v, at: spark.createDataFrame([(1, v, "u", at, 0)], "k long, v string, _op string, _ts long, _seq long")
    spark.createDataFrame([(1, 1), (2, 9)], "id long, k long").write.parquet(f"{base}/in")
    facts = spark.readStream.schema("id long, k long").parquet(f"{base}/in")

    def run():
        ingest.join_versions(facts, table, f"{base}/out", f"{base}/checkpoint").awaitTermination()

    table.merge(change("old", 1), 0)
    run()
    read = lambda: [(r.id, r.v, r.table_version) for r in spark.read.parquet(f"{base}/out").collect()]
    assert read() == [(1, "old", 1)]
    table.merge(change("new", 2), 1)
    storage.remove(spark, f"{base}/checkpoint/commits/0")  # as if the run had failed before it was done
    run()
    assert read() == [(1, "old", 1)]
    spark.createDataFrame([(3, 1)], "id long, k long").write.mode("append").parquet(f"{base}/in")
    run()
    assert sorted(read()) == [(1, "old", 1), (3, "new", 2)]


def test_ticks_stop_after_their_runs_and_raise_faults(spark):
    base, seen = scratch_dir(spark, "ticks"), []
    assert jobs.every_tick(spark, seen.append, "200 milliseconds", f"{base}/one", runs=3) == 3
    assert seen == [0, 1, 2]

    def fail(run):
        raise ValueError("no more")

    with pytest.raises(Exception, match="no more"):
        jobs.every_tick(spark, fail, "200 milliseconds", f"{base}/two")


@pytest.mark.parametrize("size,files", [(128 << 20, 1), (20_000, None)])
def test_small_files_are_packed(spark, size, files):
    base = scratch_dir(spark, "pack")
    rows = spark.range(4000).select("id", (F.col("id") % 3).alias("p"), F.md5(F.col("id").cast("string")).alias("v"))
    for i in range(8):
        rows.filter(F.col("id") % 8 == i).repartition("p").write.mode("append").partitionBy("p").parquet(f"{base}/small")
    lake.compact(spark, f"{base}/small", f"{base}/packed", size)
    packed = spark.read.parquet(f"{base}/packed")
    key = lambda r: (r.id, r.p, r.v)
    assert sorted(map(key, packed.collect())) == sorted(map(key, rows.collect()))
    per_folder = packed.groupBy("p").agg(F.count_distinct(F.col("_metadata.file_path")).alias("n")).collect()
    assert len(per_folder) == 3
    if files is not None:
        assert {r.n for r in per_folder} <= set(range(1, files + 1))
    else:
        assert all(1 < r.n < 8 for r in per_folder)
    spark.range(10).repartition(4).write.parquet(f"{base}/flat")
    lake.compact(spark, f"{base}/flat", f"{base}/flat-packed")
    assert sorted(r.id for r in spark.read.parquet(f"{base}/flat-packed").collect()) == list(range(10))


def test_a_key_just_above_the_limit_in_a_crowded_bucket(spark, monkeypatch):
    monkeypatch.setattr(skew, "BUCKETS", 4)
    rows = spark.range(400).select((F.col("id") % 100).alias("k")).unionByName(spark.range(7).select(F.lit(5).cast("long").alias("k")))
    assert [(r.k, r["_rows"]) for r in skew.hot_keys(rows, ["k"], 10).collect()] == [(5, 11)]
    assert skew.hot_keys(rows, ["k"], 11) is None  # crowded buckets, no hot key
    assert skew.hot_keys(rows, ["k"], 10**6) is None
    nulls = spark.range(50).select(F.lit(None).cast("long").alias("k"))
    assert skew.hot_keys(nulls, ["k"], 10) is None


def test_keys_are_counted_in_their_own_types(spark):
    class Rule:
        key, unique = ("a",), (("b", "c"),)

    rows = [(1, "x", 1.5), (1, "y", 2.5), (2, "x", 1.5), (None, None, 2.5), (None, None, 2.5)]
    df = spark.createDataFrame(rows, "a long, b string, c double")
    got = sorted(map(tuple, key_violations({"t": df}, {"t": Rule}).collect()))
    assert got == [("t", "a", "1", 2), ("t", "b,c", "x,1.5", 2)]


def test_references_are_compared_in_their_own_types(spark):
    class Ref:
        column, target = "p", "parent"

    class Child:
        key, references = ("id",), (Ref,)

    class Parent:
        key, references = ("id",), ()

    child = spark.createDataFrame([(1, 10), (2, 11), (3, 11), (4, None), (5, 12)], "id long, p long")
    tables = {"child": child, "parent": spark.createDataFrame([(10,)], "id long")}
    specs = {"child": Child, "parent": Parent}
    got = sorted(map(tuple, reference_violations(tables, specs).collect()))
    assert got == [("child", "p", "parent", i, k) for i, k in (("2", "11"), ("3", "11"), ("5", "12"))]
    assert [tuple(r) for r in reference_violation_counts(tables, specs).collect()] == [("child", "p", "parent", 3, 2)]


def test_scratch_folders_go_with_their_step(spark):
    with scratch_scope(spark):
        path = scratch_dir(spark, "gone")
        settle(spark.range(3), "gone-too")
    assert not storage.exists(spark, path)
    kept = scratch_dir(spark, "kept")
    assert storage.exists(spark, kept)


def test_late_condition_touches_few_facts_and_agrees_with_a_rebuild(spark):
    t = Tables(spark, SF)
    tables = {r: t[r] for r in ("asset", "asset_status", "equipment", "region", "condition")}
    late = tables["condition"].filter("id % 40 = 0")
    before = {**tables, "condition": tables["condition"].filter("id % 40 <> 0")}
    target = KeyedTable(spark, scratch_dir(spark, "late"), list(marts.mart_key("asset_strength", "linear")), 4)
    refresh.refresh("asset_strength", before, {"asset": tables["asset"]}, target, 0, "linear")
    keys = refresh.touched_keys("asset_strength", tables, {"condition": late}, "linear")
    by_region = refresh.touched_keys("asset_strength", tables, {"condition": late}, "product")
    assert 0 < keys.count() <= by_region.count()
    refresh.refresh("asset_strength", tables, {"condition": late}, target, 1, "linear")
    whole = marts.asset_strength(tables, "linear")
    assert sorted(map(tuple, target.read().select(*whole.columns).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    # withdrawn again: the condition before it applies
    refresh.refresh("asset_strength", before, {"condition": late}, target, 2, "linear")
    whole = marts.asset_strength(before, "linear")
    assert sorted(map(tuple, target.read().select(*whole.columns).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_a_late_condition_far_from_any_fact_touches_none(spark):
    t = Tables(spark, SF)
    long_ago = t["condition"].limit(1).withColumn("event_time", F.lit(dt.datetime(1990, 1, 1)).cast("timestamp_ntz")).withColumn("id", F.lit(-1).cast("long"))
    tables = {r: t[r] for r in ("asset", "asset_status", "equipment", "region", "condition")}
    tables["condition"] = tables["condition"].unionByName(long_ago)
    touched = refresh.touched_keys("asset_strength", tables, {"condition": long_ago}, "linear").collect()
    first = tables["condition"].filter("id <> -1").agg(F.min("event_time")).first()[0]
    assert len(touched) <= tables["asset_status"].filter(F.col("event_time") < F.lit(first)).select("asset_id").distinct().count()


def test_unknown_times_get_the_time_of_the_run(spark):
    t = Tables(spark, SF)
    mart = marts.supply_readiness(t).withColumn("event_time", F.lit(None).cast("timestamp_ntz"))
    now = F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")
    assert {r.event_time for r in marts.publish(mart, "supply_readiness", now).select("event_time").collect()} == {dt.datetime(2030, 1, 1)}
    assert {r.event_time for r in marts.publish(mart, "supply_readiness").select("event_time").collect()} == {None}


def test_marts_from_logs_reads_each_line_once_for_changes(spark, monkeypatch):
    """The changes that a batch merges come from one parse of its lines."""
    base, t = scratch_dir(spark, "once"), Tables(spark, SF)
    rows = {r: t[r].schema for r in sorted(refresh.feeds("supply_readiness"))}
    silver = {r: KeyedTable(spark, f"{base}/silver/{r}", ["id"], 2) for r in rows}
    mart = KeyedTable(spark, f"{base}/gold", marts.mart_key("supply_readiness", "product"), 2)
    for r in rows:
        image = F.to_json(F.struct(F.struct(*t[r].columns).alias("after"), F.lit("c").alias("op"), F.lit(1).alias("ts_ms")))
        t[r].select(image.alias("value")).write.text(f"{base}/log/{r}")
    parses, merge = [], KeyedTable.merge

    def seen(table, batch, *more, **named):
        if "/silver/" in table.path:
            parses.append(batch._jdf.queryExecution().optimizedPlan().toString().count("from_json("))
        return merge(table, batch, *more, **named)

    monkeypatch.setattr(KeyedTable, "merge", seen)
    lines = {r: ingest.text_stream(spark, f"{base}/log/{r}") for r in rows}
    jobs.marts_from_logs(spark, lines, rows, silver, {"supply_readiness": mart}, f"{base}/checkpoint", sink_types=False).awaitTermination()
    assert parses == [1] * len(rows)
    assert mart.read().count() == marts.supply_readiness({r: t[r] for r in rows}).count()


def test_lines_are_parsed_for_the_quarantine_only_if_some_do_not_decode(spark):
    base, t = scratch_dir(spark, "aside"), Tables(spark, SF)
    rows = {r: t[r].schema for r in sorted(refresh.feeds("supply_readiness"))}
    silver = {r: KeyedTable(spark, f"{base}/silver/{r}", ["id"], 2) for r in rows}
    mart = KeyedTable(spark, f"{base}/gold", marts.mart_key("supply_readiness", "product"), 2)
    for r in rows:
        image = F.to_json(F.struct(F.struct(*t[r].columns).alias("after"), F.lit("c").alias("op"), F.lit(1).alias("ts_ms")))
        t[r].select(image.alias("value")).write.text(f"{base}/log/{r}")
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(f"{base}/log/supply")

    def run(checkpoint):
        lines = {r: ingest.text_stream(spark, f"{base}/log/{r}") for r in rows}
        jobs.marts_from_logs(
            spark, lines, rows, silver, {"supply_readiness": mart}, f"{base}/{checkpoint}", quarantine=f"{base}/bad", sink_types=False
        ).awaitTermination()

    run("checkpoint")
    assert storage.list_names(spark, f"{base}/bad") == ["supply"]
    assert [r.value for r in spark.read.text(f"{base}/bad/supply").collect()] == ["not json"]
    storage.remove(spark, f"{base}/bad")
    storage.remove(spark, f"{base}/checkpoint/commits/0")  # a replay merges nothing, and still sets the line aside
    run("checkpoint")
    assert [r.value for r in spark.read.text(f"{base}/bad/supply").collect()] == ["not json"]
    assert mart.read().count() == marts.supply_readiness({r: t[r] for r in rows}).count()
