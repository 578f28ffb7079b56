"""Contiguous shards of near-equal bytes, from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import running_sums
from sparkmart.session import settle


def byte_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Cut the documents, in the order of their ids, into contiguous shards of near-equal bytes.

    The size of a document is the UTF-8 bytes of its text plus one (null text: one). Prefix sums
    of the sizes come from per-partition totals; a document belongs to the shard in whose equal
    share of the total its first byte falls, so a shard is off by one document at most at
    either end. ``slot`` counts from 0 within a shard, in the order of the ids.

    Null ids come first; equal ids are ordered by checksum and size, and equal rows arbitrarily
    (the result is the same). Empty table: no rows. With fewer documents than shards, or one
    document larger than a share, some shards stay empty. Other columns are not read, so their
    names cannot clash.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    placed = settle(running_sums(sized, [], order, ["size"], "shard-ranges"), "shard-places")
    total = placed.agg(F.max(F.col("size_before") + F.col("size")))
    cut = placed.withColumn("_total", total.scalar()).withColumn(
        "shard", F.expr(f"int(size_before * {shards} div _total)")
    )
    first = cut.groupBy("shard").agg(F.min("rows_before").alias("first_row"))
    # at most `shards` rows
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rows_before") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
