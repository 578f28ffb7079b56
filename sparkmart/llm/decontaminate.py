"""Benchmark decontamination by spaced seeds that tolerate substituted words."""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.common import shared_value, texts_of
from sparkmart.session import settle

WINDOW = 13  # words of an overlap
SIMILARITY_PCT = 80  # share of them that must be equal, place by place
SEED_WEIGHT = 6  # words that a seed looks at
MIN_ITEM_WORDS = 5  # shorter items cannot be told from chance and are not searched
BLOCK_WORDS = 1_000_000  # benchmark words that one pass over the documents searches for (bounds the broadcast)
PIECE_WORDS = 50_000  # longer items are searched in overlapping pieces
BLOOM_BITS = 22

# ASCII punctuation separates words, so that changed punctuation is no substitution
_PLAIN = bytes.maketrans(string.punctuation.encode() + string.ascii_uppercase.encode(), b" " * len(string.punctuation) + string.ascii_lowercase.encode())


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def errors_in(window: int) -> int:
    return window - -(-window * SIMILARITY_PCT // 100)


def seed_masks(window: int, errors: int, weight: int) -> list[tuple[int, ...]]:
    """Masks such that any placing of the errors in a window leaves one mask free of them.

    Greedy cover: again and again the mask (the shortest of equals) that is free of errors in most of the
    placings not yet covered. A mask lists the looked-at places, from 0; the places between are ignored.
    """
    placings = [frozenset(p) for p in itertools.combinations(range(window), errors)]
    masks = [
        (0, *inner, span - 1)
        for span in range(weight, window + 1)
        for inner in itertools.combinations(range(1, span - 1), weight - 2)
    ]

    def free(mask: tuple[int, ...]) -> set[int]:
        shifts = [{at + x for x in mask} for at in range(window - mask[-1])]
        return {i for i, p in enumerate(placings) if any(not (s & p) for s in shifts)}

    covers = {m: free(m) for m in masks}
    left, chosen = set(range(len(placings))), []
    while left:
        best = max(masks, key=lambda m: (len(covers[m] & left), -m[-1], [-x for x in m]))
        chosen.append(best)
        left -= covers[best]
    return chosen


def masks_for(window: int) -> list[tuple[int, ...]]:
    errors = errors_in(window)
    if window >= WINDOW:
        return seed_masks(WINDOW, errors_in(WINDOW), SEED_WEIGHT)
    # errors cut a short window into errors + 1 runs, of which the longest has at least this many words
    return [tuple(range(-(-(window - errors) // (errors + 1))))]


class Block:
    """Seeds and words of a bounded part of the benchmark, ready for look-ups by many documents."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        words = sorted({w for _, ws in items for w in ws})
        self.words = words
        ids = {w: i + 1 for i, w in enumerate(words)}
        self.item_ids = [k for k, _ in items]
        self.lengths = np.array([len(ws) for _, ws in items], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.tokens = np.array([ids[w] for _, ws in items for w in ws], np.int64)
        rng = np.random.default_rng(42)
        self.codes = rng.integers(1, 2**63, len(words) + 1, dtype=np.uint64)
        self.odd = rng.integers(1, 2**62, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.windows = np.minimum(self.lengths, WINDOW)
        self.seeds = []  # (mask, Bloom bits, sorted keys, places of the keys)
        keys = self.codes[self.tokens]
        item_of = np.repeat(np.arange(len(items)), self.lengths)
        classes: dict[tuple[int, ...], set[int]] = {}
        for window in {int(w) for w in self.windows}:
            for mask in masks_for(window):
                classes.setdefault(mask, set()).add(window)
        for mask, windows in classes.items():
            hashed = self.hashes(keys, mask)
            at = np.arange(len(hashed))
            inside = at + mask[-1] < self.ends[item_of[at]]
            at = at[inside & np.isin(self.windows[item_of[at]], list(windows))]
            at = at[np.argsort(hashed[at], kind="stable")]
            bloom = np.zeros(1 << BLOOM_BITS, bool)
            bloom[hashed[at] >> np.uint64(64 - BLOOM_BITS)] = True
            self.seeds.append((mask, bloom, hashed[at], at))
        self.item_of = item_of

    def hashes(self, codes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
        n = len(codes) - mask[-1]
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for place, odd in zip(mask, self.odd):
            out += codes[place : place + n] * odd
        return out ^ (out >> np.uint64(31)) * self.odd[-1]

    def vocabulary(self) -> dict[bytes, int]:
        return {w: i + 1 for i, w in enumerate(self.words)}

    def overlaps(self, tokens: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item, first word, word after the last, best share of the item) of each run of words that overlaps an item."""
        codes = self.codes[tokens]
        found = []
        for mask, bloom, keys, places in self.seeds:
            hashed = self.hashes(codes, mask)
            at = np.flatnonzero(bloom[hashed >> np.uint64(64 - BLOOM_BITS)])
            low = np.searchsorted(keys, hashed[at], "left")
            count = np.searchsorted(keys, hashed[at], "right") - low
            if count.sum():
                at, low, count = at[count > 0], low[count > 0], count[count > 0]
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                found.append(np.stack([np.repeat(at, count), places[np.repeat(low, count) + step]]))
        if not found:
            return []
        at, place = np.concatenate(found, axis=1)
        # one look per diagonal of an item and stretch of near hits
        item, shift = self.item_of[place], at - place
        order = np.lexsort((at, shift, item))
        at, item, shift = at[order], item[order], shift[order]
        new = np.ones(len(at), bool)
        new[1:] = (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (at[1:] - at[:-1] > 2 * WINDOW)
        covered: dict[int, list[tuple[int, int, float]]] = {}
        firsts = np.flatnonzero(new)
        for a, b in zip(firsts, [*firsts[1:], len(at)]):
            k, d, window = item[a], shift[a], int(self.windows[item[a]])
            low = max(at[a] - WINDOW, self.ends[k] - self.lengths[k] + d, 0)
            high = min(at[b - 1] + 2 * WINDOW, self.ends[k] + d, len(tokens))
            if high - low < window:
                continue
            same = np.concatenate([[0], np.cumsum(tokens[low:high] == self.tokens[low - d : high - d])])
            equal = same[window:] - same[:-window]
            starts = np.flatnonzero(equal >= window - errors_in(window))
            if len(starts):
                best = float(equal.max()) / window
                covered.setdefault(int(k), []).extend((int(low + s), int(low + s) + window, best) for s in starts)
        out = []
        for k, spans in covered.items():
            best = max(s[2] for s in spans)
            merged: list[list[int]] = []
            for start, end, _ in sorted(spans):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([start, end])
            out += [(k, start, end, best) for start, end in merged]
        return out


def benchmark_blocks(benchmark: DataFrame) -> Iterator[Block]:
    """Parts of the benchmark of at most BLOCK_WORDS words (and one piece), read one after the other."""
    held, size = [], 0
    for item_id, text in benchmark.select("item_id", "text").toLocalIterator():
        words = plain_words((text or "").encode())
        for start in range(0, max(1, len(words) - WINDOW + 1), PIECE_WORDS):
            piece = words[start : start + PIECE_WORDS + WINDOW - 1]
            if len(piece) >= MIN_ITEM_WORDS:
                held.append((item_id, piece))
                size += len(piece)
            if size >= BLOCK_WORDS:
                yield Block(held)
                held, size = [], 0
    if held:
        yield Block(held)


def _search(block: Block, batch: pa.RecordBatch, ids: dict[bytes, int]):
    known = ids.get
    for text in texts_of(batch):
        words = plain_words(text)
        tokens = np.fromiter((known(w, 0) for w in words), np.int64, len(words))
        yield block.overlaps(tokens) if len(words) >= MIN_ITEM_WORDS else []


HIT_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
    ]
)


def _covered_words(spans):
    """Words in the union of spans that come sorted by their start."""
    step = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("words"), F.lit(-1).cast("long").alias("reach")),
        lambda held, x: F.struct(
            (held["words"] + F.greatest(x["end"] - F.greatest(x["start"], held["reach"]), F.lit(0))).alias("words"),
            F.greatest(held["reach"], x["end"]).alias("reach"),
        ),
    )
    return step["words"]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Which documents contain words of which benchmark items.

    Words are lower-cased and split at ASCII white space and punctuation. A document overlaps an item
    if 13 words in a row (all of a shorter item) agree in at least 80 percent of the places. Masks of six
    looked-at places in 13, chosen so that no two substitutions hit them all, hash every place of both
    sides; equal hashes are looked up in the broadcast part of the benchmark, and the words around a hit decide.

    One row per document id and item id: the first overlapping word, the number of words in
    overlaps, the best share of equal words. Null or empty text on either side: no overlap. Items
    under five words are not searched; longer ones than PIECE_WORDS are searched in overlapping pieces, whose overlaps are
    put together. Rows with the same id count as one document, with the largest figures of its texts. Null ids are an id. Empty tables: no
    rows. Other columns are not read. A benchmark beyond BLOCK_WORDS words is searched in blocks, one
    pass over the documents each, so neither the broadcast nor a task grows with it. A very long text is held whole by its task.
    """
    spark = docs.sparkSession
    found = spark.createDataFrame([], HIT_SCHEMA)
    rows_in = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    for block in benchmark_blocks(benchmark):
        shared = shared_value(spark, block)

        def hits(batches, shared=shared):
            part = shared()
            ids = part.vocabulary()
            for batch in batches:
                who = zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist())
                rows = [
                    (doc, key, part.item_ids[k], *rest)
                    for (doc, key), over in zip(who, _search(part, batch, ids))
                    for k, *rest in over
                ]
                if rows:
                    kinds = [pa.int64()] * 5 + [pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=HIT_SCHEMA.names
                    )

        found = found.unionByName(rows_in.mapInArrow(hits, HIT_SCHEMA))
    # the spans of one text and item, from all pieces and blocks: at most as many as the text has words
    per_text = found.groupBy("doc_id", "item_id", "text_key").agg(
        F.min("start").alias("first_word"),
        _covered_words(F.sort_array(F.collect_set(F.struct("start", "end")))).alias("n_words"),
        F.max("similarity").alias("similarity"),
    )
    return per_text.groupBy("doc_id", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("n_words").alias("n_words"), F.max("similarity").alias("similarity")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no benchmark item, as they came; cases as in ``contaminated``.

    What one block of the benchmark leaves is written before the next one is searched, so a task holds one block.
    """
    spark, searched = docs.sparkSession, False
    for block in benchmark_blocks(benchmark):
        shared = shared_value(spark, block)

        def clean(batches, shared=shared):
            part = shared()
            ids = part.vocabulary()
            for batch in batches:
                yield batch.filter(pa.array([not over for over in _search(part, batch, ids)], pa.bool_()))

        docs = settle(docs, "clean-so-far") if searched else docs
        docs, searched = docs.mapInArrow(clean, docs.schema), True
    return docs
