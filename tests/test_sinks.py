import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.session import estimated_bytes, scratch_dir, settle
from sparkmart.sources import jdbc, lake, scan, storage, topics


def monthly(spark, *rows):
    return spark.createDataFrame([(i, dt.datetime(y, m, 1), v) for i, y, m, v in rows], "id long, at timestamp_ntz, v string")


def test_month_refresh_replaces_only_its_months(spark):
    path = scratch_dir(spark, "m") + "/t"
    lake.write_by_month(monthly(spark, (1, 2024, 1, "a"), (2, 2024, 2, "b")), path, "at", ["id"])
    lake.write_by_month(monthly(spark, (3, 2024, 2, "c")), path, "at", ["id"])
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "c")]
    plan = spark.read.parquet(path).filter("month = 202401")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_retention(spark):
    df = monthly(spark, (1, 2024, 1, "a"), (2, 2024, 3, "b"))
    asof = F.lit(dt.datetime(2024, 3, 5)).cast("timestamp_ntz")
    assert [r.id for r in lake.retain(df, "at", asof).collect()] == [2]
    path = scratch_dir(spark, "r") + "/t"
    lake.write_by_month(df, path, "at", ["id"])
    assert lake.drop_expired_months(spark, path, "202402") == ["202401"]
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]


def test_bulk_import_loads_each_file_once(spark):
    base = scratch_dir(spark, "b")
    root, target, log = f"{base}/marts", f"{base}/out", f"{base}/log"
    monthly(spark, (1, 2024, 1, "a")).write.parquet(f"{root}/one/run=1")
    spark.range(3).write.parquet(f"{root}/two/2024/01")
    assert lake.bulk_import(spark, root, target, log) == ["one", "two"]
    assert lake.bulk_import(spark, root, target, log) == []
    spark.range(3, 5).write.parquet(f"{root}/two/2024/02")
    assert lake.bulk_import(spark, root, target, log) == ["two"]
    assert spark.read.parquet(f"{target}/two").count() == 5
    assert spark.read.parquet(f"{target}/one").count() == 1
    # a run that failed before its commit is completed, and its rows count once
    storage.remove(spark, f"{log}/one/commits/0")
    storage.remove(spark, f"{target}/one/_spark_metadata/0")
    assert lake.bulk_import(spark, root, target, log) == ["one"]
    assert spark.read.parquet(f"{target}/one").count() == 1


def test_topics_round_trip_and_compact(spark):
    df = monthly(spark, (1, 2024, 1, "a"), (2, 2024, 1, None))
    sent = topics.to_keyed(df, ["id"]).withColumn("offset", F.lit(0))
    newer = topics.to_keyed(df.filter("id = 1").withColumn("v", F.lit("z")), ["id"]).withColumn("offset", F.lit(1))
    back = topics.from_keyed(topics.compact(sent.unionByName(newer), ["offset"]), df.schema)
    assert {r.id: r.v for r in back.collect()} == {1: "z", 2: None}


def test_scan_or_empty(spark):
    schema = T.StructType().add("id", "long")
    path = scratch_dir(spark, "s") + "/t"
    assert scan.scan_or_empty(spark, path, schema).schema == schema
    spark.range(4).write.parquet(path)
    assert scan.scan_or_empty(spark, path, schema).count() == 4
    assert scan.scan_latest_n(spark, path.rsplit("/", 1)[0], "t", 2).count() == 2


def test_storage_text(spark):
    path = scratch_dir(spark, "x") + "/a.txt"
    storage.create_text(spark, path, "héllo")
    assert storage.read_text(spark, path) == "héllo"
    with pytest.raises(RuntimeError):
        storage.create_text(spark, path, "again")
    assert storage.read_text(spark, path) == "héllo"


def test_settle_and_estimates(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    back = settle(df, "t")
    assert sorted(back.collect()) == sorted(df.collect())
    assert 0 < estimated_bytes(back) < 10_000


def test_jdbc_statements():
    columns, key, casts = ["id", "level", "price"], ["id"], {"price": "DECIMAL(19,4)"}
    merge = jdbc.merge_statement("t", "s", columns, key, casts)
    assert merge == (
        'MERGE INTO t t USING (SELECT "id" AS "id", "level" AS "level", '
        'CAST("price" AS DECIMAL(19,4)) AS "price" FROM s) s ON t."id" = s."id" '
        'WHEN MATCHED THEN UPDATE SET t."level" = s."level", t."price" = s."price" '
        'WHEN NOT MATCHED THEN INSERT ("id", "level", "price") VALUES (s."id", s."level", s."price")'
    )
    conflict = jdbc.on_conflict_statement("t", "s", columns, key, casts)
    assert conflict.endswith('ON CONFLICT ("id") DO UPDATE SET "level" = EXCLUDED."level", "price" = EXCLUDED."price"')
    assert jdbc.on_conflict_statement("t", "s", ["id"], key, {}).endswith("DO NOTHING")
    assert jdbc.replace_statements("t", "s", ["id"], {}) == [
        "DELETE FROM t",
        'INSERT INTO t ("id") SELECT "id" FROM s',
    ]


def test_extract_paths(spark):
    from sparkmart.functions.jsonval import extract_paths, iso_to_millis

    text = '{"op": "c", "after": {"id": "7", "n": {"x": 1.5}, "at": "2024-01-01T00:00:01.5Z"}}'
    df = spark.createDataFrame([(1, text), (2, "junk"), (3, None)], "row int, value string")
    paths = {"id": ("$.after.id", "string"), "x": ("$.after.n.x", "double"), "at": ("$.after.at", "string"), "op": ("$.op", "string")}
    out = extract_paths(df, "value", paths, "row").withColumn("at", iso_to_millis(F.col("at")))
    assert [tuple(r) for r in out.orderBy("row").collect()] == [
        (1, "7", 1.5, 1704067201500, "c"),
        (2, None, None, None, None),
        (3, None, None, None, None),
    ]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    with pytest.raises(ValueError):
        extract_paths(df, "value", {"a": ("$.x", "int"), "b": ("$.x.y", "int")})


def test_cast_split(spark):
    from sparkmart.functions.validate import REASONS, cast_split

    df = spark.createDataFrame([("1", "2.5"), ("x", "1"), (None, "y")], "a string, b string")
    clean, bad = cast_split(df, {"a": "int", "b": "decimal(19,4)"})
    assert [(r.a, float(r.b)) for r in clean.collect()] == [(1, 2.5)]
    assert sorted(r[REASONS] for r in bad.collect()) == [["a:int"], ["b:decimal(19,4)"]]


def test_scratch_follows_the_session(monkeypatch):
    from types import SimpleNamespace

    from sparkmart.session import scratch_root

    def session(folder, master):
        conf = SimpleNamespace(get=lambda key, default=None: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="a"))

    assert scratch_root(session("hdfs://shared/x/", "yarn")) == "hdfs://shared/x"
    with pytest.raises(RuntimeError):
        scratch_root(session(None, "yarn"))
    local = scratch_root(session(None, "local[2]"))
    assert local == scratch_root(session(None, "local[2]"))
