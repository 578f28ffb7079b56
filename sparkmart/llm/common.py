"""What several operators of this subpackage share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.session import settle

# A word is a run of code points that are not ASCII white space. `bytes.split()` cuts UTF-8 at
# the same six characters, so tasks that run Python agree with the expressions.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often (or per element) it is used."""
    return F.transform(F.array(value), body)[0]


def numbered(df: DataFrame, label: str, column: str = "_row") -> DataFrame:
    """The rows with a unique number, written once so that every later read sees the same numbers."""
    return settle(df.withColumn(column, F.monotonically_increasing_id()), label)


def running_sums(
    df: DataFrame, group: Sequence[str], order: Sequence[str], measures: Sequence[str], label: str
) -> DataFrame:
    """Add ``<measure>_before`` (sum over the earlier rows of the group) and ``rows_before``.

    Rows are range-partitioned by group and order and written with the number of their partition;
    totals per partition and group give each partition its offset, and a window adds what lies
    before a row within its partition. No task sees more than one range, however large a group is.
    Group columns must not be null. Rows that tie in all order columns are told apart by an
    arbitrary number, so that a value repeated in a third of the rows still spreads.
    """
    keys = [*group, *order, "_tie"]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
    placed = settle(ranged.withColumn("_part", F.spark_partition_id()), label)
    values = [*measures, "rows"]
    totals = placed.groupBy(*group, "_part").agg(
        *[F.sum(m).alias(f"_{m}_total") for m in measures], F.count(F.lit(1)).alias("_rows_total")
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        "_part",
        *[F.coalesce(F.sum(f"_{m}_total").over(earlier), F.lit(0)).alias(f"_{m}_offset") for m in values],
    )
    own = Window.partitionBy(*group, "_part").orderBy(*order, "_tie")
    within = own.rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.select(
            "*",
            *[F.coalesce(F.sum(m).over(within), F.lit(0)).alias(f"_{m}_within") for m in measures],
            (F.row_number().over(own) - 1).cast("long").alias("_rows_within"),
        )
        .join(offsets, [*group, "_part"])
        .select(
            *df.columns,
            *[(F.col(f"_{m}_offset") + F.col(f"_{m}_within")).alias(f"{m}_before") for m in values],
        )
    )


def shared_value(spark: SparkSession, value):
    """A broadcast of a bounded value, and a function that reads it in a task (code included)."""
    from pyspark import cloudpickle

    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def texts_of(batch, column: str = "text"):
    """UTF-8 bytes of a text column, one at a time; nulls are empty."""
    import pyarrow as pa

    for value in batch.column(column).cast(pa.large_binary()):
        yield value.as_py() or b""
