"""Append-style lake copies, month-partitioned marts, retention and bulk import."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.functions.timeval import month_key
from sparkmart.sources import storage
from sparkmart.streaming.metrics import BatchMetrics


def append(df: DataFrame, path: str, max_records_per_file: int = 0, fmt: str = "parquet") -> None:
    """Append rows; AQE sizes the files, ``max_records_per_file`` caps them."""
    df.hint("rebalance").write.format(fmt).option("maxRecordsPerFile", max_records_per_file).mode(
        "append"
    ).save(path)


def merge_into(spark: SparkSession, target: str, batch: DataFrame, key: Sequence[str]) -> None:
    """Upsert with the table format's own MERGE (the target must support it)."""
    batch.createOrReplaceTempView("_incoming")
    match = " AND ".join(f"t.`{k}` = s.`{k}`" for k in key)
    spark.sql(
        f"MERGE INTO {target} t USING _incoming s ON {match} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def write_by_month(df: DataFrame, path: str, time: str, order: Sequence[str]) -> None:
    """Replace the months present in ``df``, rows clustered by ``order`` inside each file.

    Rows are range-partitioned by month and order, so a month that holds most rows is written by
    many tasks while every file stays sorted and narrow in its min/max statistics.
    """
    monthly = df.withColumn("month", month_key(F.col(time)))
    (
        monthly.repartitionByRange("month", *order)
        .sortWithinPartitions("month", *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def retain(df: DataFrame, time: str, asof: Column, days: int = 30) -> DataFrame:
    """Rows not older than ``days`` before ``asof``."""
    return df.filter(F.col(time) >= asof - F.expr(f"interval {int(days)} days"))


def drop_expired_months(spark: SparkSession, path: str, first_kept: str) -> list[str]:
    """Remove the month folders before ``first_kept`` (``yyyyMM`` text); returns their months."""
    months = [n.split("=")[1] for n in storage.list_names(spark, path) if n.startswith("month=")]
    expired = [m for m in months if m < first_kept]
    for month in expired:
        storage.remove(spark, f"{path}/month={month}")
    return expired


def bulk_import(spark: SparkSession, root: str, target: str, log: str, max_files: int | None = None) -> list[str]:
    """Load every new file under ``root/<table>/`` into ``target/<table>``; returns the tables that got rows.

    One file stream per table folder, run until nothing new is left (``max_files`` at a time if given). Its checkpoint
    under ``log`` knows the loaded files and the sink's log the committed ones, so nothing is loaded twice, and a
    run that follows a failed one completes it. Read the target through Spark, which keeps to the committed files.
    """
    names = [n for n in storage.list_names(spark, root) if not n.startswith(("_", "."))]
    queries = {}
    with BatchMetrics(spark) as seen:
        try:
            for name in names:
                source = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{name}")
                files = spark.readStream.schema(source.schema).option("recursiveFileLookup", "true")
                # files may be older than those loaded before them
                files = files.option("pathGlobFilter", "*.parquet").option("maxFileAge", "36500d")
                if max_files is not None:
                    files = files.option("maxFilesPerTrigger", max_files)
                queries[name] = (
                    files.parquet(f"{root}/{name}")
                    .writeStream.format("parquet")
                    .option("checkpointLocation", f"{log}/{name}")
                    .trigger(availableNow=True)
                    .start(f"{target}/{name}")
                )
            for q in queries.values():
                q.awaitTermination()  # raises what failed
        finally:
            for q in queries.values():
                q.stop()
        return sorted(n for n, q in queries.items() if seen.rows(q))


def compact(spark: SparkSession, path: str, target: str, file_bytes: int = 128 << 20) -> None:
    """Write a folder of small parquet files anew, under another path, as files of about ``file_bytes``.

    Files are packed folder by folder (of a partition) in the order of their names, by their sizes; the rows of a
    pack go to one task and one file.  A file larger than ``file_bytes`` makes a pack of its own.  The old folder
    stays as it is: point readers to the new one and remove the old when none is left.
    """
    rows = spark.read.parquet(path)
    kept = [c for c in rows.columns]
    # the partition folder of a file, without its name
    folder = F.regexp_extract("_file", r"^(.*)/[^/]*$", 1)
    named = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"))
    files = named.select("_file", "_size").distinct().select("*", folder.alias("_folder"))
    before = Window.partitionBy("_folder").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    packs = files.select(
        "_file", "_folder", F.floor(F.coalesce(F.sum("_size").over(before), F.lit(0)) / F.lit(file_bytes)).alias("_pack")
    )
    partitioned = [f.split("=")[0] for f in _partition_names(spark, path)]
    dealt = named.join(packs, "_file")
    count = max(1, packs.select("_folder", "_pack").distinct().count())
    dealt = dealt.repartition(count, "_folder", "_pack")
    writer = dealt.select(*kept).write
    if partitioned:
        writer = writer.partitionBy(*partitioned)
    writer.parquet(target)


def _partition_names(spark: SparkSession, path: str) -> list[str]:
    """Names like ``month=202401`` of the first partition folder on each level."""
    found: list[str] = []
    while True:
        names = [n for n in storage.list_names(spark, "/".join([path, *found])) if "=" in n and not n.startswith(("_", "."))]
        if not names:
            return found
        found.append(names[0])
