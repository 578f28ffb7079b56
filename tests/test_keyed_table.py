import pytest
from pyspark.sql import functions as F

from sparkmart.session import scratch_dir
from sparkmart.sources import keyed_table, storage
from sparkmart.sources.keyed_table import KeyedTable, upsert_rows

COLUMNS = "id long, v string, _op string, _ts long, _seq long"


def batch(spark, *rows):
    return spark.createDataFrame([(k, v, op, ts, 0) for k, v, op, ts in rows], COLUMNS)


@pytest.fixture
def table(spark):
    return KeyedTable(spark, scratch_dir(spark, "t"), ["id"], buckets=4, compact_after=2)


def state(t):
    return {r.id: r.v for r in t.read().collect()}


def test_unwritten_table_is_an_error(table):
    with pytest.raises(FileNotFoundError):
        table.read()


def test_merge_guard_and_tombstone(spark, table):
    table.merge(batch(spark, (1, "a", "c", 10), (2, "b", "c", 10)), 0)
    table.merge(batch(spark, (1, "late", "u", 5), (2, None, "d", 20), (3, "c", "c", 1)), 1)
    assert state(table) == {1: "a", 3: "c"}
    table.merge(batch(spark, (2, "revived?", "c", 15)), 2)
    assert state(table) == {1: "a", 3: "c"}
    table.merge(batch(spark, (2, "back", "c", 30)), 3)
    assert state(table) == {1: "a", 2: "back", 3: "c"}


def test_equal_time_goes_to_the_later_batch(spark, table):
    table.merge(batch(spark, (1, "a", "c", 10)), 0)
    table.merge(batch(spark, (1, "b", "u", 10)), 1)
    assert state(table) == {1: "b"}


def test_replayed_batch_changes_nothing(spark, table):
    assert table.merge(batch(spark, (1, "a", "c", 1)), 0)
    assert not table.merge(batch(spark, (1, "x", "u", 9)), 0)
    assert table.merge(batch(spark, (1, "b", "u", 9)), 0, writer="other")
    assert state(table) == {1: "b"} and len(table.versions()) == 2


def test_empty_batch_and_null_keys(spark, table):
    assert not table.merge(batch(spark), 0)
    assert not table.merge(batch(spark, (None, "a", "c", 1)), 1)
    assert table.versions() == []


def test_many_batches_compact_and_vacuum(spark, table):
    want = {}
    for b in range(8):
        rows = [((b * 3 + i) % 10, f"{b}-{i}", "u", b * 10 + i) for i in range(4)]
        table.merge(batch(spark, *rows), b)
        want.update({k: v for k, v, _, _ in rows})
        assert state(table) == want
    manifest = table.manifest()
    assert all(len(held) <= table.compact_after + 1 for held in manifest["buckets"].values())
    assert {str(v) for held in manifest["buckets"].values() for v in held} == set(manifest["folders"])
    before = table.read(version=table.versions()[-2]).count()
    assert table.vacuum(keep=2) > 0
    assert state(table) == want and table.read(version=table.versions()[-2]).count() == before
    assert len(table.versions()) == 2


def test_new_column_in_later_batch(spark, table):
    table.merge(batch(spark, (1, "a", "c", 1), (2, "b", "c", 1)), 0)
    table.merge(batch(spark, (2, "B", "u", 2)).withColumn("extra", F.lit(7)), 1)
    got = {r.id: (r.v, r.extra) for r in table.read().collect()}
    assert got == {1: ("a", None), 2: ("B", 7)}
    for b in range(2, 7):
        table.merge(batch(spark, (1, f"a{b}", "u", b), (2, f"b{b}", "u", b)).withColumn("extra", F.lit(b)), b)
    assert {r.id: r.extra for r in table.read().collect()} == {1: 6, 2: 6}


def test_created_stays_updated_moves(spark, table):
    table.merge(batch(spark, (1, "a", "c", 1)), 0)
    first = table.read(with_meta=True).collect()[0]
    table.merge(batch(spark, (1, "b", "u", 2)), 1)
    second = table.read(with_meta=True).collect()[0]
    assert second._created_at == first._created_at and second._updated_at > first._updated_at


def test_hot_key_in_a_batch_is_reduced_first(spark, table):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("id"),
        F.col("id").cast("string").alias("v"),
        F.lit("u").alias("_op"),
        F.col("id").alias("_ts"),
        F.lit(0).cast("long").alias("_seq"),
    )
    table.merge(rows, 0)
    got = state(table)
    assert got[1] == "4998" and len(got) == 3333


def test_two_writers_cannot_commit_one_version(spark, table):
    table.merge(batch(spark, (1, "a", "c", 1)), 0)
    with pytest.raises(RuntimeError):
        storage.create_text(spark, table._manifest_path(1), "{}")


def test_upsert_rows_orders_by_time(spark, table):
    import datetime as dt

    df = spark.createDataFrame(
        [(1, "old", dt.datetime(2024, 1, 1)), (1, "new", dt.datetime(2024, 1, 2))],
        "id long, v string, event_time timestamp_ntz",
    )
    table.merge(upsert_rows(df, "event_time"), 0)
    assert state(table) == {1: "new"}


def test_a_large_bucket_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(keyed_table, "SLICE_ROWS", 100)
    table = KeyedTable(spark, scratch_dir(spark, "large"), ["id"], buckets=2, compact_after=1)
    rows = spark.range(2000).selectExpr("id", "cast(id as string) v", "'c' _op", "1L _ts", "0L _seq")
    for b in range(3):  # the last merge writes the buckets anew
        table.merge(rows.withColumn("_ts", F.lit(b).cast("long")), b)
        files = table._scan(table.manifest(), [(k, v[-1]) for k, v in table.manifest()["buckets"].items()])
        per_file = [r[1] for r in files.groupBy(F.input_file_name()).count().collect()]
        assert sum(per_file) == 2000 and max(per_file) <= 150
    assert state(table) == {i: str(i) for i in range(2000)}


def test_an_update_that_changes_nothing_is_not_in_the_feed(spark, table):
    table.merge(batch(spark, (1, "a", "c", 1), (2, "b", "c", 1), (3, None, "c", 1)), 0)
    table.merge(batch(spark, (1, "a", "u", 2), (2, "c", "u", 2), (3, None, "u", 2)), 1)
    assert [(r.id, r.before.v, r.after.v) for r in table.change_feed(1).collect()] == [(2, "b", "c")]


def test_follow_gives_rows_and_changes_in_one_pass(spark):
    table = KeyedTable(spark, scratch_dir(spark, "follow"), ["id"], buckets=8, compact_after=1)
    table.merge(batch(spark, *[(i, f"a{i}", "c", 5) for i in range(40)]), 0)
    # changed, unchanged, late, deleted, new, new and gone at once; most buckets of the second step stay as they were
    table.merge(batch(spark, (1, "b", "u", 6), (2, "a2", "u", 6), (3, "late", "u", 1), (4, None, "d", 6), (50, "n", "c", 6), (51, None, "d", 6)), 1)
    table.merge(batch(spark, (4, "back", "c", 7), (50, None, "d", 7)), 2)
    table.merge(batch(spark, (1, "c", "u", 8), (60, "n", "c", 8)), 3)
    for version in (2, 3, 4):
        rows = table.follow(version - 1, version).collect()
        value = lambda r: r and r.v
        moved = sorted((r.id, value(r.before), value(r.after)) for r in rows if r._moved)
        feed = table.change_feed(version - 1, version).collect()
        assert moved == sorted((r.id, value(r.before), value(r.after)) for r in feed) != []
        assert all(r.before is None for r in rows if not r._moved)
        assert sorted((r.id, r.after.v) for r in rows if r.after) == sorted((r.id, r.v) for r in table.read(version).collect())


def test_a_layered_read_sorts_rows_once(spark, table):
    for b in range(2):
        table.merge(batch(spark, (1, f"a{b}", "u", b), (2, f"b{b}", "u", b)), b)
    plan = table.read()._jdf.queryExecution().sparkPlan().toString()
    assert state(table) == {1: "a1", 2: "b1"}
    assert plan.index("Exchange") > plan.rindex("Aggregate")  # rows move first, then one sort serves both steps of the aggregate


@pytest.mark.parametrize("modulus,few", [(5000, True), (100, False)])
def test_only_batches_that_repeat_keys_are_reduced_before_they_move(spark, table, monkeypatch, modulus, few):
    seen = []
    last = KeyedTable._last_changes
    monkeypatch.setattr(KeyedTable, "_last_changes", lambda self, *a: seen.append(1) or last(self, *a))
    rows = spark.range(6000).selectExpr(f"id % {modulus} id", "cast(id as string) v", "'u' _op", "id _ts", "0L _seq")
    table.merge(rows, 0)
    assert bool(seen) != few
    assert state(table) == {k: str(max(range(k, 6000, modulus))) for k in range(modulus)}
