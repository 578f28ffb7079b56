"""Long repeated passages, by longest-previous-factor arrays over the suffixes of a corpus.

The suffix order of the whole corpus is never laid out at once. Two places are only compared if
they share an anchor: the least hash of a 200-byte string within each 400-byte window. The choice looks at nothing
but the window, so equal windows have equal anchors at equal offsets, and every suffix that
matters is in one class of its anchor. Classes are what is distributed and sorted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import texts_of
from sparkmart.session import settle

LENGTH = 400  # bytes of a match
ANCHOR = 200  # bytes that an anchor's hash covers
PIECE = 1 << 19  # window starts of a text that are hashed at a time
CLASS_LIMIT = 4000  # different surroundings of one anchor that are sorted in one task; beyond, see `_hot_spans`
BUCKET_SEGMENTS = 2000  # segments per sorting task, about 1.2 MB of text
WORDS = 50  # words of a passage that is looked for in other documents
STRING = 26  # words of the strings that stand for passages
SPAN_BITS = 10  # a segment's place is its first window start, shifted, plus its number of windows

_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier, base of the rolling hash
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Roller:
    """Hashes of substrings: differences of prefix sums of byte codes times powers, modulo 2**64."""

    def __init__(self):
        rng = np.random.default_rng(400)
        self.codes = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        n = PIECE + LENGTH
        self.up, self.down = _powers(_ODD, n), _powers(_INVERSE, n)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[: len(data)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (sums[end] - sums[start]) * self.down[start]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)  # fixed value: a mixing multiplier
        return x ^ (x >> np.uint64(32))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row, from running minima of blocks to both sides."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def text_anchors(text: bytes, roller: Roller):
    """(anchor hash, segment hash, first window, number of windows) arrays, piece by piece.

    A segment is what the windows of one anchor cover together; windows next to each other mostly
    share their anchor (the leftmost, where hashes tie).
    """
    low = np.uint64((1 << 24) - 1)
    for at in range(0, max(0, len(text) - LENGTH + 1), PIECE):
        data = np.frombuffer(text, np.uint8)[at : at + PIECE + LENGTH - 1]
        sums = roller.sums(data)
        start = np.arange(len(data) - ANCHOR + 1)
        hashed = roller.hashes(sums, start, start + ANCHOR)
        ranked = (hashed & ~low) | start.astype(np.uint64)
        owner = (_sliding_min(ranked, LENGTH - ANCHOR + 1) & low).astype(np.int64)
        change = np.flatnonzero(np.diff(owner)) + 1
        first = np.concatenate([[0], change])
        count = np.diff(np.concatenate([first, [len(owner)]]))
        segment = roller.hashes(sums, first, first + count - 1 + LENGTH)
        yield hashed[owner[first]], segment, first + at, count


def _keyed(docs: DataFrame, unique_ids: bool) -> DataFrame:
    """``doc_id, doc, text``; ``doc`` stands for a document, rows equal in id and text share it."""
    doc = F.col("doc_id").cast("long") if unique_ids else F.xxhash64("doc_id", "text")
    return docs.select("doc_id", doc.alias("doc"), "text")


def _anchors(keyed: DataFrame) -> DataFrame:
    names = ["anchor", "segment", "doc", "place"]

    def run(batches):
        roller = Roller()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in names]
            for doc, text in zip(batch.column("doc").to_pylist(), texts_of(batch)):
                for anchor, segment, first, count in text_anchors(text, roller):
                    row = (anchor.view(np.int64), segment.view(np.int64), np.full(len(first), doc), (first << SPAN_BITS) | count)
                    for held, part in zip(parts, row):
                        held.append(part)
            if parts[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p), pa.int64()) for p in parts], names=names)

    return settle(keyed.mapInArrow(run, ", ".join(f"{n} long" for n in names)), "repeat-anchors")


def longest_previous(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes have a match of LENGTH bytes at an earlier, and at a later, of the ``starts``.

    Suffixes are ranked by prefix doubling (8, 16, ... 256 bytes, then 384 and 400). In suffix order, with
    suffixes that agree in LENGTH bytes standing by position, the previous smaller position of a suffix is its
    neighbour before it and the next smaller one lies beyond all that agree; so its longest previous factor
    reaches LENGTH exactly if that neighbour agrees. The longest next factor mirrors it.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(LENGTH, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]

    def dense(keys: np.ndarray) -> np.ndarray:
        return np.unique(keys, return_inverse=True)[1].astype(np.int64)

    ranks, width = {8: dense(key)}, 8
    while width < 256:
        after = np.zeros(n, np.int64)
        after[: n - width] = ranks[width][width:] if n > width else 0
        ranks[2 * width] = dense(ranks[width] * n + after)
        if width > 16 and width < 128:
            del ranks[width]
        width *= 2
    rank = dense(ranks[256][starts] * n + ranks[128][starts + 256])
    rank = rank * n + ranks[16][starts + 384]
    order = np.lexsort((starts, rank))
    agrees = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    earlier[order[1:]] = agrees
    later[order[:-1]] = agrees
    return earlier, later


def _spans_of_bucket(rows: pd.DataFrame, keep_first: bool) -> pd.DataFrame:
    """Covered spans of the segments in one bucket of anchor classes."""
    rows = rows.sort_values(["doc", "place"], kind="stable")
    place = rows["place"].to_numpy()
    firsts, counts = place >> SPAN_BITS, place & ((1 << SPAN_BITS) - 1)
    data = np.frombuffer(b"".join(rows["body"]), np.uint8)
    sizes = counts - 1 + LENGTH
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(rows)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    earlier, later = longest_previous(data, base[owner] + inside)
    covered = np.flatnonzero(earlier if keep_first else earlier | later)
    owner, start = owner[covered], firsts[owner[covered]] + inside[covered]
    new = np.ones(len(covered), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(covered)]]) - 1 if len(begin) else begin
    return pd.DataFrame({"doc": rows["doc"].to_numpy()[owner[begin]], "start": start[begin], "end": start[end] + LENGTH})


def _surroundings(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text of segments (``body``), or for those of hot anchors the hashes of their windows."""
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "place", "hot")).alias("places"))
    joined = keyed.join(per_doc, "doc").select("doc_id", "doc", "text", "places")
    kinds = [("anchor", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("body", pa.large_binary()), ("windows", pa.list_(pa.int64()))]
    names = [n for n, _ in kinds]

    def run(batches):
        roller = Roller()
        for batch in batches:
            for doc, places, text in zip(batch.column("doc").to_pylist(), batch.column("places").to_pylist(), texts_of(batch)):
                out: list[tuple] = []
                for p in places:
                    first, count = p["place"] >> SPAN_BITS, p["place"] & ((1 << SPAN_BITS) - 1)
                    body, windows = text[first : first + count - 1 + LENGTH], None
                    if p["hot"]:
                        sums, at = roller.sums(np.frombuffer(body, np.uint8)), np.arange(count)
                        windows, body = roller.hashes(sums, at, at + LENGTH).view(np.int64).tolist(), None
                    out.append((p["anchor"], doc, p["place"], body, windows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), kinds)], names=names)

    return joined.mapInArrow(run, "anchor long, doc long, place long, body binary, windows array<long>")


def _hot_spans(found: DataFrame, keep_first: bool) -> DataFrame:
    """Spans of anchors with too many surroundings to sort in one task.

    Their windows go out one by one under the hash of all their 400 bytes (with that of the anchor,
    128 bits); equal windows are counted, which is summed before the exchange.
    """
    windows = found.where("windows is not null").select(
        "anchor", "doc", F.shiftright("place", SPAN_BITS).alias("first"), F.posexplode("windows").alias("i", "window")
    ).withColumn("start", F.col("first") + F.col("i"))
    place = F.struct("doc", "start")
    equal = (
        windows.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).where("n > 1")
    )
    hit = windows.join(equal, ["anchor", "window"])
    if keep_first:
        hit = hit.where(F.col("least") != place)
    return hit.select("doc", "start", (F.col("start") + LENGTH).alias("end"))


def repeated_spans(docs: DataFrame, keep_first: bool = False, unique_ids: bool = False) -> DataFrame:
    """``doc, start, end``: byte spans covered by 400-byte strings that also start elsewhere.

    With ``keep_first`` only where an earlier copy exists; the order is that of ``doc`` (the ids themselves if
    they are unique, else a hash of id and text) and of the places within a text. Spans may touch or overlap.

    Segments that are equal as a whole are counted, not moved. The rest of a class, if any, is fetched
    as text and sorted; classes are dealt out by the hash of their anchor, about BUCKET_SEGMENTS segments to a task.
    """
    keyed = _keyed(docs, unique_ids)
    anchors = _anchors(keyed)
    segments = settle(
        anchors.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "place")).alias("least")),
        "repeat-segments",
    )
    classes = segments.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.count(F.when(F.col("n") == 1, 1)).alias("single")
    )
    open_ = classes.where("kinds > 1" if keep_first else "kinds > 1 and single > 0")
    wanted = settle(
        segments.join(open_, "anchor").select("anchor", "least.*", (F.col("kinds") > CLASS_LIMIT).alias("hot")), "repeat-open"
    )
    copies = anchors.join(segments.where("n > 1").select("anchor", "segment", "least"), ["anchor", "segment"])
    if keep_first:
        copies = copies.where(F.struct("doc", "place") != F.col("least"))
    first = F.shiftright("place", SPAN_BITS)
    length = F.col("place").bitwiseAND(F.lit((1 << SPAN_BITS) - 1)) - 1 + LENGTH
    whole = copies.select("doc", first.alias("start"), (first + length).alias("end"))
    found = settle(_surroundings(keyed, wanted), "repeat-texts")
    buckets = max(1, -(-wanted.where("not hot").count() // BUCKET_SEGMENTS))
    sorted_ = (
        found.where("body is not null")
        .select((F.pmod(F.xxhash64("anchor"), F.lit(buckets))).alias("bucket"), "doc", "place", "body")
        .groupBy("bucket")
        .applyInPandas(lambda rows: _spans_of_bucket(rows, keep_first), "doc long, start long, end long")
    )
    return whole.unionByName(sorted_).unionByName(_hot_spans(found, keep_first))


_BLANKS = np.isin(np.arange(256), [32, *range(9, 14)])


def _word_hashes(text: bytes, roller: Roller) -> np.ndarray:
    """A hash of each word (between ASCII white space), from pieces of the text that end with a word."""
    found, at = [np.zeros(0, np.uint64)], 0
    data = np.frombuffer(text, np.uint8)
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not _BLANKS[data[end]]:  # to the end of the word
            end += 1
        part = data[at:end]
        inside = ~_BLANKS[part]
        first = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
        if len(first):
            lengths = np.diff(np.append(first, len(part)))
            part, inside = part[first[0] :], inside[first[0] :]
            place = np.arange(len(part)) - np.repeat(first - first[0], lengths)
            up = roller.up if len(part) <= len(roller.up) else _powers(_ODD, len(part))
            codes = np.where(inside, roller.codes[part] * up[place], np.uint64(0))
            found.append(np.add.reduceat(codes, first - first[0]))
        at = end
    return np.concatenate(found)


def passage_strings(text: bytes, roller: Roller) -> np.ndarray:
    """Hashes of the strings of STRING words that stand for the passages of WORDS words: in each, the least."""
    words = _word_hashes(text, roller)
    found = [np.zeros(0, np.uint64)]
    for at in range(0, max(0, len(words) - WORDS + 1), PIECE):
        part = words[at : at + PIECE + WORDS - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * roller.up[: len(part)], out=sums[1:])
        start = np.arange(len(part) - STRING + 1)
        found.append(np.unique(_sliding_min(roller.hashes(sums, start, start + STRING), WORDS - STRING + 1)))
    return np.concatenate(found)


def shared_passages(keyed: DataFrame) -> DataFrame:
    """The ``doc``s of which a passage of WORDS words is in another document too, word for word.

    Equal passages have the same least string of STRING words, so none is missed; strings are told apart by 64
    bits, and passages that share no more than such a string (26 to 49 words) are found as well.
    """

    def run(batches):
        roller = Roller()
        for batch in batches:
            found = [passage_strings(text, roller).view(np.int64) for text in texts_of(batch)]
            owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
            if len(owner):
                columns = [pa.array(np.concatenate(found)), batch.column("doc").take(pa.array(owner))]
                yield pa.RecordBatch.from_arrays(columns, names=["string", "doc"])

    strings = keyed.select("doc", "text").mapInArrow(run, "string long, doc long")
    # summed before the exchange; read twice and not written, as the texts are near and the strings many
    shared = strings.groupBy("string").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least <> most")
    return strings.join(settle(shared.select("string"), "repeat-shared"), "string", "left_semi").select("doc").distinct()


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, keep_first: bool, unique_ids: bool) -> DataFrame:
    # rows equal in id and text give the same spans: distinct, so that a list is bounded by its text
    spans = repeated_spans(docs, keep_first, unique_ids).distinct()
    per_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return _keyed(docs, unique_ids).join(per_doc, "doc", "left").select("doc_id", "doc", "text", "spans")


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def repeat_digests(docs: DataFrame, keep_first: bool = False, unique_ids: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, shared_passage`` of every document after removal.

    Every byte covered by a 400-byte string that also starts elsewhere (same document included, overlaps
    count) is removed. Null text: like an empty one, nothing to remove. Equal rows are copies of each
    other. Null ids are ids like others. Texts under 400 bytes keep all. Empty table: no rows. Other columns
    are not read. ``shared_passage`` is 1 if a passage of 50 words is in another document too (by id and text), whatever its
    length in bytes (see ``shared_passages``), else 0. Very long texts are hashed in pieces; a long run of one repeated character has an anchor per
    byte, which takes space in proportion to the run.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for spans, text in zip(batch.column("spans").to_pylist(), texts_of(batch)):
                merged = _merged(spans)
                kept = _kept(text, merged)
                rows.append((len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(c) for c in zip(*rows)]
            if rows:
                names = ["doc_id", "doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("doc"), *columns], names=names)

    schema = docs.select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in ("doc", "n_bytes", "n_removed", "n_spans")],
        F.lit("").alias("kept_sha256"),
    ).schema
    digests = _with_spans(docs, keep_first, unique_ids).mapInArrow(run, schema)
    shared = shared_passages(_keyed(docs, unique_ids)).withColumn("shared_passage", F.lit(1))
    return digests.join(shared, "doc", "left").drop("doc").fillna(0, ["shared_passage"])


def remove_repeats(docs: DataFrame, keep_first: bool = True, unique_ids: bool = False) -> DataFrame:
    """``doc_id, text`` without repeated passages; characters cut in the middle of their bytes go too."""

    def run(batches):
        for batch in batches:
            texts = [
                _kept(text, _merged(spans)).decode("utf-8", "ignore")
                for spans, text in zip(batch.column("spans").to_pylist(), texts_of(batch))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return _with_spans(docs, keep_first, unique_ids).mapInArrow(run, docs.select("doc_id", F.lit("").alias("text")).schema)
