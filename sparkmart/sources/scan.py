"""Batch readers of silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkmart.operators.keyed import latest_n
from sparkmart.sources import storage


def scan_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet", suffix: str = "") -> DataFrame:
    """One table of a lake folder; ``fmt`` may be any installed format (parquet, orc, delta…)."""
    return spark.read.format(fmt).load(f"{base}/{name}{suffix}")


def scan_latest_n(spark: SparkSession, base: str, name: str, n: int, suffix: str = "") -> DataFrame:
    """Reduced run: only the newest ``n`` rows of a table."""
    return latest_n(scan_table(spark, base, name, suffix=suffix), n)


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``; an empty frame of the declared schema if the path is absent.

    Only a missing path is tolerated; any other fault is raised.
    """
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)
