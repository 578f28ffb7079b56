"""Keyed topics: JSON key and JSON value, last value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators.cdc import TIME_FORMATS


def to_keyed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select(
        F.to_json(F.struct(*key), TIME_FORMATS).alias("key"),
        F.to_json(F.struct(*df.columns), TIME_FORMATS).alias("value"),
    )


def compact(keyed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Last value per key by ``order``, as a compacted topic would keep it."""
    last = F.max_by("value", F.struct(*order, "value")).alias("value")
    return keyed.groupBy("key").agg(last)


def from_keyed(keyed: DataFrame, schema: T.StructType) -> DataFrame:
    return keyed.select(F.from_json("value", schema).alias("_v")).select("_v.*")


def write_kafka(keyed: DataFrame, servers: str, topic: str) -> None:
    """Write to a broker; needs the Kafka connector jar on the session."""
    keyed.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def read_kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, fail_on_loss: bool = True
) -> DataFrame:
    """Change-log stream of one topic from its start; needs the Kafka connector jar.

    Records keep partition and offset, which order the changes of a key (a key stays in its partition).
    A micro-batch takes all there is unless ``max_offsets`` bounds it.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(F.col("value").cast("string").alias("value"), "partition", "offset")
