"""One document of each group of near copies: five-word shingles, SimHash balls, bands of minima, true Jaccard similarity."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import numbered, texts_of
from sparkmart.llm.components import connected_components
from sparkmart.llm.simhash import fingerprint_links, majority
from sparkmart.session import scratch_dir, scratch_scope, settle

SHINGLE_WORDS = 5
PERCENT = 80  # least Jaccard similarity of two sets of shingles that link, in percent
BANDS, BAND_ROWS = 20, 6  # two sets of similarity 0.8 share a band with probability 0.998, of 0.9 with 0.9999999
CROWD = 32  # rows of a band that are all compared with each other; those of larger ones meet in `_prefix_candidates`
PORTION = 256  # pairs that are verified at a time, for each row that is left
SEED = 42
_BLOCK = 1 << 12  # shingles that are permuted at a time
_NUMBERS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS), np.uint64)
_FLIP, _FACTOR = _NUMBERS[0], _NUMBERS[1] | np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words; a shorter text is one shingle, an empty one none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    starts = starts.tolist()
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ends = starts[SHINGLE_WORDS:] if len(words) >= SHINGLE_WORDS else starts[-1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts[:n], ends)], np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """A signed long per band: the hash of the minima of its permutations."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        np.minimum(least, ((hashes[at : at + _BLOCK, None] ^ _FLIP) * _FACTOR).min(axis=0), out=least)
    rows = least.astype("<u8").reshape(BANDS, BAND_ROWS)
    keys = np.array([xxhash.xxh64_intdigest(r.tobytes(), band) for band, r in enumerate(rows)], np.uint64)
    return keys.view(np.int64).tolist()


def _signatures(rows: DataFrame) -> DataFrame:
    """``doc_id, row, set`` (128 bits that name the set of shingles), its size ``n``, fingerprint ``fp`` and ``bands``."""
    schema = rows.select(
        "doc_id",
        F.col("_copy_row").alias("row"),
        F.lit(b"").alias("set"),
        F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("long").alias("fp"),
        F.array(F.lit(0).cast("long")).alias("bands"),
    ).schema

    def run(batches):
        for batch in batches:
            sets, sizes, prints, keys = [], [], [], []
            for text in texts_of(batch):
                hashes = shingles(text)
                sets.append(xxhash.xxh128_digest(hashes.tobytes(), SEED))
                sizes.append(len(hashes))
                prints.append(majority(hashes))
                keys.append(bands(hashes))
            fps = pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())
            made = [pa.array(sets, pa.binary()), pa.array(sizes, pa.int64()), fps, pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_copy_row"), *made], names=["doc_id", "row", "set", "n", "fp", "bands"]
            )

    return rows.select("doc_id", "_copy_row", "text").mapInArrow(run, schema)


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``row, hashes`` of the wanted rows."""
    texts = rows.select(F.col("_copy_row").alias("row"), "text").join(wanted, "row", "left_semi")

    def run(batches):
        for batch in batches:
            for i, text in enumerate(texts_of(batch)):
                hashes = pa.array([shingles(text).view(np.int64)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, 1), hashes], names=["row", "hashes"])

    return texts.mapInArrow(run, "row long, hashes array<long>")


def _alike_in_size(u: Column, v: Column) -> Column:
    """False only where the sizes of two sets rule out the similarity."""
    return F.least(u, v) * 100 >= F.greatest(u, v) * PERCENT


def _members(alive: DataFrame) -> DataFrame:
    return alive.select(F.explode("bands").alias("key"), "row", "n", "no_id", "doc_id")


def _met(members: DataFrame, left: DataFrame, differ: Column) -> DataFrame:
    """Pairs ``u < v`` of rows that meet under a key (``left``: key, a, a_n)."""
    met = members.join(left, "key").where(differ & _alike_in_size(F.col("a_n"), F.col("n")))
    return met.select(F.least("a", "row").alias("u"), F.greatest("a", "row").alias("v")).distinct()


def _apart(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What a step builds, written; what it wrote on the way goes with it."""
    path = f"{scratch_dir(spark, label)}/rows"
    with scratch_scope(spark):
        made = build()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _print_candidates(alive: DataFrame) -> DataFrame:
    """Rows of one fingerprint with the first of them, and the first rows of fingerprints that link (`fingerprint_links`)."""
    first = F.min(F.struct("no_id", "doc_id", F.col("row").alias("a"), F.col("n").alias("a_n"))).alias("first")
    prints = settle(alive.groupBy("fp").agg(first).select("fp", "first.a", "first.a_n"), "copies-prints")
    same = alive.join(prints, "fp").where(F.col("row") != F.col("a")).select("a", "a_n", F.col("row").alias("b"), F.col("n").alias("b_n"))
    linked = fingerprint_links(prints.select("fp"))
    linked = linked.join(prints.withColumnRenamed("fp", "u"), "u")
    linked = linked.join(prints.select(F.col("fp").alias("v"), F.col("a").alias("b"), F.col("a_n").alias("b_n")), "v")
    met = same.unionByName(linked.select("a", "a_n", "b", "b_n")).where(_alike_in_size(F.col("a_n"), F.col("b_n")))
    return met.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def _hub_candidates(alive: DataFrame, order: list[Column]) -> DataFrame:
    """Each row with the first of each of its bands in this order."""
    members = _members(alive)
    first = F.min(F.struct(*order, F.col("row").alias("a"), F.col("n").alias("a_n"))).alias("first")
    hubs = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), first).where("size > 1")
    return _met(members, hubs.select("key", "first.a", "first.a_n"), F.col("a") != F.col("row"))


def _all_met(members: DataFrame) -> DataFrame:
    """All pairs under each key, for keys that few rows have."""
    left = members.select("key", F.col("row").alias("a"), F.col("n").alias("a_n"))
    return _met(members, left, F.col("a") < F.col("row"))


def _crowds(members: DataFrame) -> DataFrame:
    """Bands that more than CROWD rows have, with their ``size``."""
    return members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CROWD)


def _central_candidates(alive: DataFrame) -> DataFrame:
    """Each row of a crowded band with the row of it whose bands hold the most rows: the text that the others are copies of."""
    members = settle(_members(alive), "copies-members")
    crowded = members.join(settle(_crowds(members), "copies-sizes"), "key")
    crowded = settle(crowded.join(crowded.groupBy("row").agg(F.sum("size").alias("met")), "row"), "copies-crowded")
    first = F.min(F.struct((-F.col("met")).alias("met"), "no_id", "doc_id", F.col("row").alias("a"), F.col("n").alias("a_n"))).alias("first")
    hubs = crowded.groupBy("key").agg(first).select("key", "first.a", "first.a_n")
    return _met(crowded.select(*members.columns), hubs, F.col("a") != F.col("row"))


def _close_candidates(alive: DataFrame, rows: DataFrame) -> DataFrame:
    """All pairs of rows that share a band of at most CROWD rows, and every pair of rows of larger bands that can have the similarity."""
    members = settle(_members(alive), "copies-members")
    sizes = settle(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "copies-sizes")
    pairs = _all_met(members.join(sizes.where(F.col("size") <= CROWD), "key", "left_semi"))
    crowded = members.join(sizes.where(F.col("size") > CROWD), "key", "left_semi").select("row").distinct()
    crowded = settle(crowded, "copies-crowded")
    return pairs if crowded.isEmpty() else pairs.unionByName(_prefix_candidates(crowded, rows)).distinct()


def _prefix_candidates(crowded: DataFrame, rows: DataFrame) -> DataFrame:
    """A superset of the pairs of these rows with the similarity, without comparing all with all: no such pair is left out.

    What crowds a band is what many texts have in common, so all sets list their shingles in one order, those of the fewest
    rows first. Sets of ``a`` and ``b`` shingles with the similarity have ``PERCENT * (a + b) / (100 + PERCENT)`` in common, all of
    them from the first common one on; so that one stands early in both, among the first fifth of the larger (at 80 percent)
    and the first ninth of the smaller. Rows meet under these shingles, and only where enough follows on both
    sides. Pages of one template have their own shingles there, unless these are so few that the pages are near copies.
    """
    sets = _sets(rows, crowded).select("row", F.size("hashes").alias("n"), F.explode("hashes").alias("key"))
    sets = settle(sets, "copies-shingles")
    # a shingle that one row has comes before all others and meets nothing: counted, not moved
    shared = sets.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    listed = sets.join(shared, "key").groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("held", "key"))).alias("list"))
    alone = F.col("n") - F.size("list")
    early = F.greatest(F.floor(F.col("n") * (100 - PERCENT) / 100).cast("int") + 1 - alone, F.lit(0))
    placed = listed.select("row", "n", alone.alias("alone"), F.posexplode(F.slice("list", F.lit(1), early)).alias("pos", "shingle"))
    places = settle(placed.select("shingle.key", "row", "n", (F.col("alone") + F.col("pos") + 1).alias("place")), "copies-places")
    left = places.where((F.col("place") - 1) * (100 + PERCENT) <= F.col("n") * (100 - PERCENT))
    left = left.select("key", F.col("row").alias("a"), F.col("n").alias("a_n"), F.col("place").alias("a_place"))
    follow = F.least(F.col("a_n") - F.col("a_place"), F.col("n") - F.col("place"))
    smaller = (F.col("a_n") < F.col("n")) | ((F.col("a_n") == F.col("n")) & (F.col("a") < F.col("row")))
    enough = (follow + 1) * (100 + PERCENT) >= (F.col("a_n") + F.col("n")) * PERCENT
    return _met(places, left, smaller & enough)


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose sets of shingles have the similarity."""
    wanted = pairs.select(F.col("u").alias("row")).unionByName(pairs.select(F.col("v").alias("row"))).distinct()
    sets = settle(_sets(rows, settle(wanted, "copies-wanted")), "copies-sets")
    both = pairs.join(sets.select(F.col("row").alias("v"), F.col("hashes").alias("v_hashes")), "v")
    both = both.join(sets.select(F.col("row").alias("u"), F.col("hashes").alias("u_hashes")), "u")
    common = F.size(F.array_intersect("u_hashes", "v_hashes"))
    either = F.size("u_hashes") + F.size("v_hashes")  # the common ones twice
    return both.where(common * (100 + PERCENT) >= either * PERCENT).select("u", "v")


def _new_pairs(candidates: Callable[[DataFrame], DataFrame], alive: DataFrame, tested: DataFrame | None) -> DataFrame:
    pairs = candidates(alive)
    return pairs if tested is None else pairs.join(tested, ["u", "v"], "left_anti")


def _without_copies(alive: DataFrame, pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows, and of those that pairs with the similarity connect only the first."""
    roots = connected_components(settle(_verified(pairs, rows), "copies-links"))
    placed = settle(alive.select("row", "no_id", "doc_id").join(roots.withColumnRenamed("node", "row"), "row"), "copies-roots")
    stays = placed.groupBy("root").agg(F.min(F.struct("no_id", "doc_id", "row")).alias("first"))
    gone = settle(placed.select("row").join(stays.select(F.col("first.row").alias("row")), "row", "left_anti"), "copies-gone")
    return alive.join(gone, "row", "left_anti").select(*alive.columns)


def keep_one_of_near_copies(docs: DataFrame) -> DataFrame:
    """The documents, as they came, without near copies of one that stays.

    Two documents are near copies if the sets of their five-word shingles (ASCII lower case) have a Jaccard
    similarity of 0.8 or more. Equal sets are reduced by an aggregate. The others meet first in the Hamming balls of the
    SimHash fingerprints of their shingles, linked and reduced by components as in ``simhash``. Balls of four bits do not
    reach down to 0.8, so what is left meets where the minima of a band of permutations agree. Every pair that links, in
    balls or bands, is verified by its true similarity.

    In bands, all of a band meet one of them only, and of the documents that verified links connect just the smallest id
    (nulls last, then any) stays: in crowded bands the most central row, then in all the smallest id, then one by hash. So
    a large group of copies shrinks by as many pairs as it has rows. Then what is
    left of small bands meets all of it, and in bands of many rows all those meet that can be near copies
    (`_prefix_candidates`): no pair of a band is left out. Where they are many, pairs are verified in portions, so that
    their sets take disk in proportion to the rows. Each
    document that goes is connected by verified links to one that stays. Null or empty text: an empty set, equal to
    any other. Repeated rows are copies. Very long texts: one task holds the text and its shingles. Other columns, whatever their
    names, come back as they were. Empty table: no rows.
    """
    # the row as one column, so that no name of its columns can clash; of it, scans read what they need
    spark = docs.sparkSession
    held = numbered(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("held")), "copies-docs", "_copy_row")
    rows = held.select("held.doc_id", "held.text", "_copy_row")
    marked = settle(_signatures(rows), "copies-rows")
    place = [F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")]
    least = F.min(F.struct(*place, "row", "n", "fp", "bands")).alias("first")
    alive = settle(marked.groupBy("set").agg(least).select("first.*"), "copies-classes")
    tested = None
    by_id, mixed = [F.col("no_id"), F.col("doc_id")], [F.xxhash64("row").alias("mixed")]
    for candidates in (
        _print_candidates,
        _central_candidates,  # before the rounds that may take the text from amid its copies, which then link to none
        lambda left: _hub_candidates(left, by_id),
        lambda left: _hub_candidates(left, mixed),
        lambda left: _close_candidates(left, rows),
    ):
        pairs = _apart(spark, partial(_new_pairs, candidates, alive, tested), "copies-pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        met = pairs.count()
        portions = max(1, -(-met // (PORTION * alive.count()))) if met else 0
        for portion in range(portions):
            part = pairs
            if portions > 1:
                part = pairs.where(F.pmod(F.xxhash64("u", "v"), F.lit(portions)) == portion)
                for end in ("u", "v"):  # what went with an earlier portion has no pairs left
                    part = part.join(alive.select(F.col("row").alias(end)), end, "left_semi")
                part = _apart(spark, partial(part.select, "u", "v"), "copies-part")
            alive = _apart(spark, partial(_without_copies, alive, part, rows), "copies-alive")
    gone = settle(marked.select("row").join(alive.select("row"), "row", "left_anti"), "copies-gone")
    return held.join(gone.withColumnRenamed("row", "_copy_row"), "_copy_row", "left_anti").select("held.*")
