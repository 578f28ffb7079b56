"""Feeds between versions, and results that take back what was undone, against a plain replay of the changes."""

import random

import pytest
from pyspark.sql import functions as F

from sparkmart.session import scratch_dir, scratch_scope, side_by_side
from sparkmart.sources import storage
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.streaming import retract
from sparkmart.streaming.retract import ChangeJoin, LatestOfGroup, merge_with_feed

COLUMNS = "id long, g string, at long, v string, _op string, _ts long, _seq long"


def frame(spark, rows, columns=COLUMNS):
    return spark.createDataFrame(rows, columns)


def table(spark, base, key=("id",), **more):
    return KeyedTable(spark, base, list(key), buckets=4, compact_after=2, **more)


def test_feed_between_versions(spark):
    t = table(spark, scratch_dir(spark, "feed"))
    t.merge(frame(spark, [(1, "a", 1, "x", "c", 1, 0), (2, "a", 1, "y", "c", 1, 0), (3, "b", 1, "z", "c", 1, 0)]), 0)
    t.merge(frame(spark, [(1, "b", 2, "x2", "u", 2, 0), (2, None, None, None, "d", 2, 0), (3, "late", 0, "l", "u", 0, 0), (9, None, None, None, "d", 2, 0)]), 1)
    t.merge(frame(spark, [(4, "c", 3, "n", "c", 3, 0)]), 2)
    read = lambda a, b: {r.id: (r.before and r.before.v, r.after and r.after.v) for r in t.change_feed(a, b).collect()}
    assert read(0, 1) == {1: (None, "x"), 2: (None, "y"), 3: (None, "z")}
    assert read(1, 2) == {1: ("x", "x2"), 2: ("y", None)}
    assert read(1, None) == {1: ("x", "x2"), 2: ("y", None), 4: (None, "n")}
    assert read(0, None) == {1: (None, "x2"), 3: (None, "z"), 4: (None, "n")}
    assert [t.version_of("default", b) for b in (0, 1, 2, 3)] == [1, 2, 3, None]
    assert t.version_of("other", 0) is None


def test_reads_near_values_and_grows(spark):
    t = table(spark, scratch_dir(spark, "near"), key=("g", "id"), bucket_by=["g"], tombstones=False)
    for b in range(5):
        t.merge(frame(spark, [(k, f"g{k % 6}", b, f"{b}-{k}", "u", b, 0) for k in range(b, 60)]), b)
    t.merge(frame(spark, [(k, f"g{k % 6}", 9, None, "d", 9, 0) for k in range(0, 60, 2)]), 5)
    want = {(k, f"{min(k, 4)}-{k}") for k in range(60) if k % 2 and k % 6 in (1, 2)}
    values = spark.createDataFrame([("g1",), ("g2",), ("none",)], "g string")
    near = t.read_near(values)
    assert {(r.id, r.v) for r in near.collect()} == want
    everything = sorted(map(tuple, t.read().collect()))
    t.grow(32)
    assert sorted(map(tuple, t.read().collect())) == everything
    assert {(r.id, r.v) for r in t.read_near(values).collect()} == want
    t.merge(frame(spark, [(1, "g1", 99, "new", "u", 99, 0)]), 6)
    assert [r.v for r in t.read().where("id = 1").collect()] == ["new"]
    assert "update_timestamp" in t.read(audit="update_timestamp").columns and "_version" not in t.read().columns


def test_forgets_deleted_keys_when_told(spark):
    t = KeyedTable(spark, scratch_dir(spark, "forget"), ["id"], buckets=1, compact_after=1, tombstones=False)
    for b in range(4):
        t.merge(frame(spark, [(b, "g", b, "v", "c", b, 0)] + [(b - 1, None, None, None, "d", b, 0)] * (b > 0)), b)
    kept = t._state(t.manifest()).collect()
    assert {r.id for r in t.read().collect()} == {3} and len(kept) <= 3


@pytest.mark.parametrize("seed", [1])
def test_latest_brings_back_the_row_before(spark, seed):
    rng, base = random.Random(seed), scratch_dir(spark, "latest")
    view = LatestOfGroup(table(spark, f"{base}/rows"), ["g"], ["at"], base)
    live, ts = {}, 0
    for batch in range(4):
        rows = []
        for _ in range(25):
            ts += 1
            key, op = rng.randrange(30), rng.choice("cuuud")
            row = (rng.choice(["a", "b", "c", None]), rng.randrange(50), f"v{ts}")
            rows.append((key, *(row if op != "d" else (None, None, None)), op, ts, 0))
            if op == "d":
                live.pop(key, None)
            else:
                live[key] = row
        if batch == 2:  # everything of one group goes
            for key in [k for k, r in live.items() if r[0] == "a"]:
                ts += 1
                rows.append((key, None, None, None, "d", ts, 0))
                del live[key]
        changes = frame(spark, rows)
        view.apply(changes, batch)
        if batch == 1:
            view.apply(changes, batch)  # delivered again
        want = {}
        for key, (g, at, v) in live.items():
            if g is not None and (g not in want or (at, key) > want[g][:2]):
                want[g] = (at, key, v)
        got = {r.g: (r.at, r.id, r.v) for r in view.latest.read().collect()}
        assert got == want
    assert view.members.table.read().count() == sum(r[0] is not None for r in live.values())


@pytest.mark.parametrize("seed", [1])
def test_join_follows_both_sides(spark, seed):
    rng, base = random.Random(seed), scratch_dir(spark, "join")
    join = ChangeJoin(table(spark, f"{base}/a", ["a_id"]), table(spark, f"{base}/b", ["b_id"]), ["k"], base)
    sides, ts = ({}, {}), 0
    for batch in range(4):
        parts = []
        for side, name in zip(sides, "ab"):
            rows = []
            for _ in range(0 if batch == 1 and name == "a" else 20):
                ts += 1
                key, op = rng.randrange(20), rng.choice("cuuud")
                row = (rng.choice([1, 2, 3, 4, None]), f"{name}{ts}")
                rows.append((key, *(row if op != "d" else (None, None)), op, ts, 0))
                if op == "d":
                    side.pop(key, None)
                else:
                    side[key] = row
            parts.append(frame(spark, rows, f"{name}_id long, k long, {name} string, _op string, _ts long, _seq long"))
        join.apply(*parts, batch)
        if batch == 1:
            versions = join.result.versions()
            join.apply(*parts, batch)  # delivered again
            assert join.result.versions() == versions
        want = {(a, b, k, x, y) for a, (k, x) in sides[0].items() for b, (j, y) in sides[1].items() if k is not None and k == j}
        got = {(r.a_id, r.b_id, r.k, r.a, r.b) for r in join.result.read().collect()}
        assert got == want


def test_a_step_that_broke_off_is_finished(spark):
    base = scratch_dir(spark, "broken")
    rows = table(spark, f"{base}/rows")
    view = LatestOfGroup(rows, ["g"], ["at"], base)
    view.apply(frame(spark, [(1, "a", 1, "x", "c", 1, 0), (2, "a", 2, "y", "c", 1, 0)]), 0)
    changes = frame(spark, [(2, None, None, None, "d", 2, 0)])
    merge_with_feed(rows, changes, 1, "latest")  # the first table has the batch, the others do not
    view.apply(changes, 1)
    assert [(r.g, r.v) for r in view.latest.read().collect()] == [("a", "x")]
    view.apply(frame(spark, [(1, None, None, None, "d", 3, 0)]).where(F.lit(True)), 2)
    assert view.latest.read().collect() == []


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_few_values_are_found_before_the_buckets_are_reduced(spark):
    t = table(spark, scratch_dir(spark, "few"), key=("g", "id"), bucket_by=["g"])
    for b in range(2):
        t.merge(frame(spark, [(k, f"g{k % 6}", b, f"{b}-{k}", "u", b, 0) for k in range(60)]), b)
    values = spark.createDataFrame([("g1",), ("none",)], "g string")
    near = t.read_near(values)
    assert "Aggregate" in plan(near) and "LeftSemi" in plan(near).split("Aggregate", 1)[1]
    assert {(r.id, r.v) for r in near.collect()} == {(k, f"1-{k}") for k in range(1, 60, 6)}
    rough = t.read_near(values, exact=False)
    assert {(r.id, r.v) for r in rough.collect() if r.g == "g1"} == {(k, f"1-{k}") for k in range(1, 60, 6)}


def test_a_feed_reduces_its_rows_once(spark):
    t = table(spark, scratch_dir(spark, "once"))
    t.merge(frame(spark, [(k, "a", k, "x", "c", 1, 0) for k in range(40)]), 0)
    changes = [(k, "b", k, "y", "u", 2, 0) for k in range(0, 40, 2)] + [(1, None, None, None, "d", 2, 0), (3, "a", 3, "late", "u", 0, 0), (77, "n", 1, "n", "c", 2, 0)]
    t.merge(frame(spark, changes), 1)
    feed = t.change_feed(1)
    assert plan(feed).count("Aggregate") == 1
    got = {r.id: (r.before and r.before.v, r.after and r.after.v, r.after and r.after.id) for r in feed.collect()}
    assert got == {**{k: ("x", "y", k) for k in range(0, 40, 2)}, 1: ("x", None, None), 77: (None, "n", 77)}


def test_a_finished_batch_is_not_worked_through_again(spark, monkeypatch):
    base = scratch_dir(spark, "done")
    view = LatestOfGroup(table(spark, f"{base}/rows"), ["g"], ["at"], base)
    changes = frame(spark, [(1, "a", 1, "x", "c", 1, 0)])
    side = lambda n: frame(spark, [(1, 1, n, "c", 1, 0)], f"{n}_id long, k long, {n} string, _op string, _ts long, _seq long")
    join = ChangeJoin(table(spark, f"{base}/a", ["a_id"]), table(spark, f"{base}/b", ["b_id"]), ["k"], f"{base}/join")
    view.apply(changes, 0)
    join.apply(side("a"), side("b"), 0)

    def again(*args):
        raise AssertionError("the batch was finished")

    monkeypatch.setattr(retract, "merge_with_feed", again)
    view.apply(changes, 0)
    join.apply(side("a"), side("b"), 0)
    assert [(r.a, r.b) for r in join.result.read().collect()] == [("a", "b")]


def test_scratch_of_actions_side_by_side_goes_with_the_step(spark):
    with scratch_scope(spark):
        paths = side_by_side(lambda: scratch_dir(spark, "one"), lambda: scratch_dir(spark, "two"))
        assert all(storage.exists(spark, p) for p in paths)
    assert not any(storage.exists(spark, p) for p in paths)


def test_near_rows_keep_their_column_order(spark):
    t = table(spark, scratch_dir(spark, "order"), key=("g", "id"), bucket_by=["g"])
    t.merge(frame(spark, [(1, "a", 1, "x", "c", 1, 0)]), 0)
    values = spark.createDataFrame([("a",)], "g string")
    assert t.read_near(values).columns == t.read_near(values, exact=False).columns == ["g", "id", "at", "v"]
