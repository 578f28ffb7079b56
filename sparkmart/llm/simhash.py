"""Near-duplicates by SimHash fingerprints that meet in the middle of their Hamming balls."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import texts_of
from sparkmart.llm.components import connected_components
from sparkmart.session import settle

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4  # differing bits at which two fingerprints still link
_BLOCK = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: bytes) -> int:
    """64 bits; a bit is 1 if it is set in over half of the shingles' hashes (repeats included)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    starts = starts.tolist()
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ends = starts[SHINGLE_WORDS:] if len(words) >= SHINGLE_WORDS else starts[-1:]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts[:n], ends)], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """64 bits; a bit is 1 if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``fp`` (as a signed long) of every text, with the carried columns."""
    rows = docs.select(*carry, "text")
    schema = rows.drop("text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t) for t in texts_of(batch)], np.uint64).view(np.int64)
            kept = [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fps, pa.int64())], names=[*carry, "fp"])

    return rows.mapInArrow(run, schema)


def _ball(bits: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` set bits, as signed longs."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(range(bits), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _variants(value: Column, bits: int, radius: int) -> Column:
    return F.transform(F.lit(np.array(_ball(bits, radius), np.int64)), lambda m: value.bitwiseXOR(m))


def _spread(fps: DataFrame) -> DataFrame:
    """The few narrow rows over all tasks, before each becomes many."""
    return fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints that keep all within RADIUS bits connected.

    Full ball: a fingerprint emits every variant within half the radius (2,081 of them), and two meet in a
    variant exactly if they differ in RADIUS bits at most; so all that meet are linked, to the least
    of them, without comparing pairs. (A variant is within two bits of 2,081 values, which bounds a group.)

    To emit that many rows only where something can meet, the same is done first with the two halves
    of the fingerprint: one half differs in at most RADIUS / 2 bits, and its ball has half that
    radius (33 variants a half). Where just two fingerprints meet there, the pair is verified by its bits;
    where more do, all of them go on to the full ball. No group is gathered or compared pair by pair.
    """
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    radius = (RADIUS // 2 + 1) // 2
    keys = F.concat(
        _variants(low, 32, radius), F.transform(_variants(high, 32, radius), lambda v: v.bitwiseOR(F.lit(1 << 32)))
    )
    halves = _spread(fps).select("fp", F.explode(keys).alias("key"))
    met = settle(
        halves.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
        .where("n > 1"),
        "simhash-met",
    )
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS
    pairs = met.where((F.col("n") == 2) & near).select("u", "v")
    # written first, so that the planner knows the true size of this side and moves the other only if it must
    keys_met = settle(met.where("n > 2").select("key"), "simhash-keys")
    crowded = settle(halves.join(keys_met, "key", "left_semi").select("fp").distinct(), "simhash-crowded")
    balls = _spread(crowded).select("fp", F.explode(_variants(F.col("fp"), 64, RADIUS // 2)).alias("variant"))
    stars = balls.groupBy("variant").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where("size(fps) > 1")
    spokes = stars.select(F.col("fps")[0].alias("u"), F.explode(F.slice("fps", 2, 1 << 30)).alias("v"))
    return pairs.unionByName(spokes).distinct()


def _components(rows: DataFrame, first: Column) -> DataFrame:
    """``fp, first``: the least ``first`` value of the component of each fingerprint."""
    classes = settle(rows.groupBy("fp").agg(F.min(first).alias("own")), "simhash-classes")
    roots = connected_components(fingerprint_links(classes.select("fp")))
    placed = settle(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")),
        "simhash-roots",
    )
    least = placed.groupBy("root").agg(F.min("own").alias("first"))
    return placed.join(least, "root").select("fp", "first")


def near_duplicate_components(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Documents link if their fingerprints differ in four bits at most; the component is named after the
    smallest id that links reach. Null or empty text: fingerprint zero, which links like any other.
    Null ids belong to components, but name one (as null) only where no other id is in it. Repeated rows
    stay, each with its component. Empty table: no rows. Other columns are not read. A very long text is held whole by
    its task, with its words.
    """
    rows = settle(fingerprints(docs), "simhash-rows")
    # copies share a fingerprint: a large group is one row of the classes, and its skewed side is split
    return rows.join(_components(rows, F.col("doc_id")), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id")
    )
