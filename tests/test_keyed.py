import datetime as dt

from pyspark.sql import functions as F

from sparkmart.operators import keyed, skew
from sparkmart.operators.quality import reference_violation_counts

T0 = dt.datetime(2024, 1, 1)


def at(h):
    return T0 + dt.timedelta(hours=h)


def test_latest_breaks_ties_and_ranks_null_time_last(spark):
    df = spark.createDataFrame(
        [(1, 10, at(1), "a"), (1, 11, at(1), "b"), (1, 12, None, "c"), (2, 20, None, "d")],
        "k int, id int, event_time timestamp_ntz, v string",
    )
    got = {r.k: r.v for r in keyed.latest_per_key(df, ["k"], ties=("id",)).collect()}
    assert got == {1: "b", 2: "d"}


def test_latest_keeps_whole_rows_with_nulls_and_maps(spark):
    df = spark.createDataFrame(
        [(1, at(1), None, {"a": 1}), (1, at(2), None, {"b": 2})],
        "k int, event_time timestamp_ntz, v string, m map<string,int>",
    )
    row = keyed.latest_per_key(df, ["k"]).collect()[0]
    assert row.v is None and row.m == {"b": 2} and row.event_time == at(2)
    assert keyed.latest_per_key(df, ["k"]).columns == df.columns


def test_latest_same_as_row_number(spark):
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("k"),
        F.col("id"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("event_time"),
    )
    a = keyed.latest_per_key(df, ["k"], ties=("id",))
    b = keyed.top_ranked(df, ["k"], [F.col("event_time").desc(), F.col("id").desc()])
    assert sorted(a.collect()) == sorted(b.collect())


def test_latest_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id", F.col("id").alias("event_time"))
    plan = keyed.latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")


def test_snapshot_time_fallback(spark):
    by_created = spark.createDataFrame([(1, at(1)), (1, at(2))], "k int, created_at timestamp_ntz")
    assert keyed.latest_snapshot(by_created, ["k"]).collect()[0].created_at == at(2)
    timeless = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    assert keyed.latest_snapshot(timeless, ["k"]).count() == 2


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int, id int, event_time timestamp_ntz")
    assert keyed.latest_per_key(df, ["k"]).count() == 0
    assert keyed.duplicate_keys(df, ["k"]).count() == 0


def test_gates_defaults_duplicates_orphans(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (1, 3.0)], "k int, v double")
    assert keyed.require_keys(df, ["k"]).count() == 2
    assert sorted(r.v for r in keyed.fill_defaults(df, {"v": 0.0}).collect()) == [0.0, 2.0, 3.0]
    assert [(r.k, r.copies) for r in keyed.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    parents = spark.createDataFrame([(2,)], "id int")
    assert keyed.orphans(df, "k", parents, "id").count() == 2


def test_a_task_counts_a_bounded_number_of_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "KEYS_A_TASK", 500, raising=False)
    monkeypatch.setattr(skew, "SPLIT_ROWS", 3000)
    df = spark.range(40_000).select((F.col("id") % 20_000).alias("k")).unionByName(spark.range(9000).select(F.lit(7).cast("long").alias("k")))
    found = keyed.duplicate_keys(df, ["k"])
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000 and sum(sizes) == 20_000
    assert {r.copies: r["count"] for r in found.groupBy("copies").count().collect()} == {2: 19_999, 9002: 1}

    class Ref:
        column, target = "p", "parent"

    class Child:
        key, references = ("id",), (Ref,)

    class Parent:
        key, references = ("id",), ()

    tables = {"child": df.select(F.lit(1).alias("id"), F.col("k").alias("p")), "parent": spark.range(10, 30_000)}
    specs = {"child": Child, "parent": Parent}
    assert [tuple(r) for r in reference_violation_counts(tables, specs).collect()] == [("child", "p", "parent", 9020, 10)]
    tables["child"] = tables["child"].where("p < 30")  # few keys, many parents
    assert [tuple(r) for r in reference_violation_counts(tables, specs).collect()] == [("child", "p", "parent", 9020, 10)]


def test_latest_n(spark):
    df = spark.createDataFrame([(i, at(i)) for i in range(10)], "id int, event_time timestamp_ntz")
    assert [r.id for r in keyed.latest_n(df, 3).collect()] == [9, 8, 7]
