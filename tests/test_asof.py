"""As-of joins against the range join they replace, with and without hot-key cuts."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkmart.session import settle
from sparkmart.operators.asof import Right, asof_join, asof_join_many, count_preceding

T0 = dt.datetime(2024, 1, 1)
LEFT = "id long, k string, at timestamp_ntz"
RIGHT = "id long, k string, seen timestamp_ntz, v double"


def minute(m):
    return None if m is None else T0 + dt.timedelta(minutes=m)


def frames(spark, left, right):
    l = spark.createDataFrame([(i, k, minute(m)) for i, k, m in left], LEFT)
    r = spark.createDataFrame([(i, k, minute(m), v) for i, k, m, v in right], RIGHT)
    # from files, so that their size is known and the plain plan is taken unless cuts are forced
    return settle(l.coalesce(1), "l"), settle(r.coalesce(1), "r")


def run(l, r, **kw):
    return asof_join(l, r, [("k", "k")], "at", "seen", {"rid": "id", "v": "v"}, **kw)


def found(df):
    return {r.id: r.rid for r in df.collect()}


@pytest.mark.parametrize("split_rows", [None, 1, 2])
def test_edges(spark, split_rows):
    l, r = frames(
        spark,
        [(1, "a", 10), (2, "a", 4), (3, None, 10), (4, "a", None), (5, "b", 10), (6, "a", 11)],
        [(1, "a", 5, 1.0), (2, "a", 10, 2.0), (3, "a", 10, 3.0), (4, None, 1, 9.0), (5, "a", None, 9.0), (6, "a", 12, 4.0)],
    )
    got = found(run(l, r, split_rows=split_rows))
    assert got == {1: 3, 2: None, 3: None, 4: None, 5: None, 6: 3}
    assert set(found(run(l, r, how="inner", split_rows=split_rows))) == {1, 6}
    forward = found(run(l, r, direction="forward", split_rows=split_rows))
    assert forward == {1: 3, 2: 1, 3: None, 4: None, 5: None, 6: 6}


def test_nearest_prefers_the_earlier_of_equal_gaps(spark):
    l, r = frames(spark, [(1, "a", 10), (2, "a", 19)], [(1, "a", 8, 0.0), (2, "a", 12, 0.0), (3, "a", 20, 0.0)])
    for split_rows in (None, 1):
        assert found(run(l, r, direction="nearest", split_rows=split_rows)) == {1: 1, 2: 3}


def random_frames(spark, seed, n=400):
    rng = random.Random(seed)

    def key():
        # a third of all rows share one key
        return "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])

    left = [(i, key(), rng.choice([None, *range(0, 300)])) for i in range(n)]
    # bursts: many rows at the same minute, so cuts meet ties
    right = [(i, key(), rng.choice([50, 51, 52, *range(0, 300)]), rng.random()) for i in range(n)]
    return frames(spark, left, right)


def naive(l, r, direction):
    pairs = l.alias("l").join(r.alias("r"), F.col("l.k") == F.col("r.k"), "left")
    gap = F.col("l.at") - F.col("r.seen")
    zero = F.expr("interval 0 seconds")
    keep = gap >= zero if direction == "backward" else gap <= zero
    pairs = pairs.withColumn("ok", F.coalesce(keep, F.lit(False)))
    order = F.col("r.seen").desc() if direction == "backward" else F.col("r.seen").asc()
    w = Window.partitionBy("l.id").orderBy(F.col("ok").desc(), order, F.col("r.id").desc())
    best = pairs.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    return {
        r.id: r.rid
        for r in best.select(F.col("l.id").alias("id"), F.when(F.col("ok"), F.col("r.id")).alias("rid")).collect()
    }


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("split_rows", [None, 3, 40])
def test_equals_range_join(spark, direction, split_rows):
    l, r = random_frames(spark, 7)
    assert found(run(l, r, direction=direction, split_rows=split_rows)) == naive(l, r, direction)


@pytest.mark.parametrize("split_rows", [None, 3])
def test_count_equals_range_join(spark, split_rows):
    l, r = random_frames(spark, 11)
    got = {
        x.id: x.preceding
        for x in count_preceding(l, r, [("k", "k")], "at", "seen", split_rows=split_rows).collect()
    }
    pairs = l.alias("l").join(
        r.alias("r"), (F.col("l.k") == F.col("r.k")) & (F.col("r.seen") <= F.col("l.at")), "left"
    )
    want = {
        x.id: x.n
        for x in pairs.groupBy(F.col("l.id").alias("id")).agg(F.count("r.id").alias("n")).collect()
    }
    assert got == want


@pytest.mark.parametrize("split_rows", [None, 5])
def test_many_sides_in_one_pass(spark, split_rows):
    l, r = random_frames(spark, 3)
    other = r.select((F.col("id") + 1000).alias("id"), "k", (F.col("seen") + F.expr("interval 7 minutes")).alias("seen"), "v")
    both = asof_join_many(
        l,
        ["k"],
        "at",
        [Right(r, ["k"], "seen", {"one": "id"}), Right(other, ["k"], "seen", {"two": "id"}, required=True)],
        split_rows=split_rows,
    )
    first, second = naive(l, r, "backward"), naive(l, other, "backward")
    want = {i: (first[i], second[i]) for i in first if second[i] is not None}
    assert {x.id: (x.one, x.two) for x in both.collect()} == want


def test_hot_key_is_cut_into_many_tasks(spark):
    """With one key, the join's window works on many groups, none much above the limit."""
    from sparkmart.operators import asof, skew

    l = spark.range(5000).select("id", F.lit("hot").alias("k"), (F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id"))).cast("timestamp_ntz").alias("at"))
    r = l.select("id", "k", F.col("at").alias("seen"))
    rows, keys = asof._stack(l, ["k"], "at", [Right(r, ["k"], "seen", {"rid": "id"})])
    hot = skew.hot_keys(rows, keys, 50)
    sliced = asof._slice(rows, keys, hot, 50)
    sizes = [x["count"] for x in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 10000 and len(sizes) > 150 and max(sizes) <= 200


@pytest.mark.parametrize("how", ["inner", "left"])
def test_many_to_one_join_splits_hot_keys(spark, how):
    from sparkmart.operators.skew import join_many_to_one

    _, many = random_frames(spark, 5)
    one = spark.createDataFrame([("hot", 1), ("a", 2), ("z", 3), (None, 4)], "k string, w int")
    one = settle(one.coalesce(1), "one")
    plain = sorted(map(tuple, many.join(one, ["k"], how).collect()), key=repr)
    for split_rows in (None, 10, 50, 10**6):
        got = join_many_to_one(many, one, ["k"], how, split_rows=split_rows)
        assert sorted(map(tuple, got.collect()), key=repr) == plain


def test_timestamps_with_zone(spark):
    l = spark.createDataFrame([(1, "a", minute(10))], "id long, k string, at timestamp")
    r = spark.createDataFrame([(1, "a", minute(9), 1.0)], "id long, k string, seen timestamp, v double")
    for split_rows in (None, 1):
        assert found(run(l, r, split_rows=split_rows)) == {1: 1}


def test_a_burst_within_a_hot_key_is_cut(spark):
    """Half of a key's rows lie within two seconds of a year."""
    from sparkmart.operators import asof, skew

    at = F.when(F.col("id") < 10_000, F.col("id") * 200).otherwise(F.lit(10**12) + F.col("id") * 3_000_000)
    l = spark.range(20_000).select("id", F.lit("hot").alias("k"), F.timestamp_micros(at).alias("at"))
    r = l.select("id", "k", F.col("at").alias("seen")).limit(0)
    rows, keys = asof._stack(l, ["k"], "at", [Right(r, ["k"], "seen", {"rid": "id"})])
    sliced = asof._slice(rows, keys, skew.hot_keys(rows, keys, 50), 50)
    sizes = [x["count"] for x in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 200


def test_more_hot_keys_than_a_list_would_hold(spark):
    l = spark.range(20_000).select("id", (F.col("id") % 5000).cast("string").alias("k"), F.timestamp_seconds("id").alias("at"))
    r = l.select("id", "k", F.col("at").alias("seen"), F.lit(1.0).alias("v"))
    got = run(settle(l, "l"), settle(r, "r"), split_rows=3)
    assert got.filter("rid = id").count() == 20_000


def test_rows_without_key_or_time_do_not_enter_the_exchange(spark):
    l, r = frames(spark, [(i, None, None) for i in range(50)] + [(50, "a", 3)], [(1, "a", 2, 0.5)])
    got = run(l, r, split_rows=1)
    assert found(got) == {**{i: None for i in range(50)}, 50: 1}
    assert "isnotnull(k" in got._jdf.queryExecution().optimizedPlan().toString().lower()
