"""Encoding and decoding with merge-type vocabularies of pieces, by a score-ordered agenda of symbol pairs."""

from __future__ import annotations

import hashlib
import re
import string
from heapq import heapify, heappop, heappush
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import texts_of

MARK = "▁"  # fixed value: what stands for a blank in a piece
MAX_MODEL = 64 << 20  # bytes of a model that is sent to the tasks
GROUP = 1 << 20  # bytes of text that are held as ids at a time (one text at least)
HELD_CHUNKS = 1 << 20  # chunks whose ids a worker remembers, about 300 MB
HELD_LENGTH = 48  # characters of a chunk that is remembered


class PieceCoder:
    """A vocabulary as tables, and the merges of one text after the other.

    The model must be of the merge type without normalisation and without user-defined pieces; whether a result is
    the library's is checked with it (``agrees``). No piece that merges may hold a blank behind another character
    for texts to be cut at blanks; else (and between blanks) a text is one chunk.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        self.unused: set[str] = set()
        self.byte_ids: dict[int, int] = {}
        self.texts: list[str | int | None] = []  # of an id: characters, a byte, or nothing
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.texts.append(int(piece[3:5], 16))
            elif lib.is_control(i) or lib.is_unknown(i):
                self.texts.append(None)
            else:
                self.ids[piece] = i
                self.cost[piece] = -lib.get_score(i)
                self.texts.append(piece.replace(MARK, " "))
                if lib.is_unused(i):
                    self.unused.add(piece)
        self.numbers = list(map(str, range(len(self.texts))))
        self.unknown = lib.unk_id()
        self.unknown_text = lib.decode([self.unknown])
        first = lib.encode("a", out_type=str)
        self.prefix = " " if first and first[0].startswith(MARK) else ""
        self.cut = re.compile(self._chunk_pattern())
        self.held: dict[str, str] = {}

    def _chunk_pattern(self) -> str:
        """What parts texts into chunks that no merge can leave: every merge makes a piece of the vocabulary, so
        two characters that are neighbours in no piece are never merged across.
        """
        merging = [p for p in self.ids if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in merging):
            return r"[\s\S]+"
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in merging))
        beside = {pair for p in merging for pair in zip(p, p[1:])}
        near = {pair for pair in beside if any(c.isalnum() for c in pair) and any(c in string.punctuation for c in pair)}
        # the few word characters beyond ASCII that stand beside a sign in some piece, and signs beside the others
        odd = {c for pair in near for c in pair if c.isalnum() and not c.isascii()}
        worded = {c for pair in near if not odd & set(pair) for c in pair}
        odd_ones = re.escape("".join(sorted(odd)))
        signs = re.escape("".join(c for c in string.punctuation if c not in worded and c != "_"))
        # words, then signs that stand beside no word character in any piece, unless what follows may join them
        runs = [rf"[^\W_{odd_ones}]++"] + ([f"[{signs}]++"] if signs else [])
        unjoined = "|".join(f"{run}(?![_{odd_ones}]|[^\\w {alone}{signs}])" for run in runs)
        return f" *+(?:{unjoined}|[^ {alone}]+)| +" + (f"|[{alone}]" if alone else "")

    def merges(self, text: str) -> list[str]:
        """Pieces of a chunk: the pair with the best score merges first, the leftmost among equals."""
        cost_of, unused, n = self.cost.get, self.unused, len(text)
        # symbols are spans of the text, known by their first character; 0 and -1 stand for no span that could merge
        before, after = list(range(-1, n - 1)), [*range(1, n + 1), 0]
        parts: dict[str, tuple[str, str]] = {}
        pairs = map(cost_of, map(add, text, text[1:]))
        agenda = [(known, i, i + 2) for i, known in enumerate(pairs) if known is not None]
        heapify(agenda)
        while agenda:
            _, left, end = heappop(agenda)
            right = after[left]
            if after[right] != end:
                continue  # symbols only grow: one of the two has merged with another since
            if unused and text[left:end] in unused:
                parts[text[left:end]] = (text[left:right], text[right:end])
            after[left], after[right] = end, -1
            if end < n:
                before[end] = left
                upto = after[end]
                known = cost_of(text[left:upto])
                if known is not None:
                    heappush(agenda, (known, left, upto))
            ahead = before[left]
            if ahead >= 0:
                known = cost_of(text[ahead:end])
                if known is not None:
                    heappush(agenda, (known, ahead, end))
        found, left = [], 0
        while left < n:
            end = after[left]
            found.append(text[left:end])
            left = end
        while parts and any(s in parts for s in found):  # pieces not to be used fall back to what they came from
            found = [x for s in found for x in (parts[s] if s in parts else (s,))]
        return found

    def chunk_ids(self, chunk: str) -> list[int]:
        found = self.merges(chunk.replace(" ", MARK))
        out = list(map(self.ids.get, found))
        if None not in out:
            return out
        out = []
        for piece in found:
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8"))
            else:
                out.append(self.unknown)
        return out

    def chunks(self, text: str) -> list[str]:
        return self.cut.findall(self.prefix + text.replace(MARK, " ")) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for chunk in self.chunks(text) for i in self.chunk_ids(chunk)]

    def plain(self, ids: list[int]) -> str:
        """Characters of the pieces; runs of bytes as UTF-8."""
        parts = [self.texts[i] for i in ids]
        try:
            return "".join(parts)
        except TypeError:  # bytes, or pieces without characters
            pass
        out: list[str] = []
        run = bytearray()
        for i, held in zip(ids, parts):
            if isinstance(held, int):
                run.append(held)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(held if held is not None else self.unknown_text if i == self.unknown else "")
        return "".join(out) + run.decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the blank that encoding puts before a text."""
        text = self.plain(ids)
        return text[1:] if self.prefix and text.startswith(" ") else text

    def _of_chunk(self, chunk: str) -> tuple[str, str]:
        """The ids of a chunk, joined by commas, and what they decode to; remembered if that is the chunk itself."""
        ids = self.chunk_ids(chunk)
        joined, plain = ",".join([self.numbers[i] for i in ids]), self.plain(ids)
        if len(chunk) <= HELD_LENGTH and plain == chunk:
            if len(self.held) >= HELD_CHUNKS:
                self.held.clear()
            self.held[chunk] = joined
        return joined, plain

    def text_digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by commas, and what they decode to, chunk by chunk."""
        parts = self.chunks(text)
        if not parts:
            return 0, "", ""
        found = list(map(self.held.get, parts))
        if None in found:
            for at, known in enumerate(found):
                if known is None:
                    chunk = parts[at]
                    known = self.held.get(chunk)  # it may have come earlier in this text
                    found[at], parts[at] = self._of_chunk(chunk) if known is None else (known, chunk)
        joined, plain = ",".join(found), "".join(parts)
        return joined.count(",") + 1, joined, plain[1:] if self.prefix and plain.startswith(" ") else plain


def _coder(df: DataFrame, model_path: str):
    """A function that gives the tasks their coder; the model goes to them whole (its size is checked)."""
    with open(model_path, "rb") as file:
        model = file.read(MAX_MODEL + 1)
    if len(model) > MAX_MODEL:
        raise ValueError(f"a model of more than {MAX_MODEL} bytes")
    held = df.sparkSession.sparkContext.broadcast({"model": model})

    def coder() -> PieceCoder:
        kept = held.value  # a worker keeps it from task to task, and with it the coder and what it remembers
        if "coder" not in kept:
            kept["coder"] = PieceCoder(kept["model"])
        return kept["coder"]

    return coder


def _groups(texts):
    """Texts in lists of about GROUP bytes."""
    group, size = [], 0
    for text in texts:
        group.append(text.decode("utf-8"))
        size += len(text)
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, agrees`` of every document.

    The ids are those of the agenda; ``agrees`` tells whether the library, asked for each group of texts of an Arrow
    batch, gives the same ids and decodes them to the same text. Null text: like an empty one, no ids (digests of
    nothing). Null ids and repeated rows get a row each. A very long text is held whole by its task, with its ids as
    text; other texts are handled in groups of GROUP bytes. Empty table: no rows. Other columns are not read.
    """
    make = _coder(docs, model_path)

    def run(batches):
        coder = make()
        for batch in batches:
            rows = []
            for group in _groups(texts_of(batch)):
                theirs = coder.library.encode(group, num_threads=1)
                decoded = coder.library.decode(theirs, num_threads=1)
                for text, ids, back in zip(group, theirs, decoded):
                    n, joined, plain = coder.text_digest(text)
                    same = n == len(ids) and joined == ",".join([coder.numbers[i] for i in ids]) and plain == back
                    digest = hashlib.sha256(joined.encode()).hexdigest()
                    rows.append((n, digest, hashlib.sha256(plain.encode()).hexdigest(), same))
            if rows:
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in zip(*rows)]], names=names)

    schema = docs.select(
        "doc_id", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"),
        F.lit("").alias("decoded_sha256"), F.lit(True).alias("agrees"),
    ).schema
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids`` (array of int) of every document; null and empty texts have an empty array."""
    make = _coder(docs, model_path)

    def run(batches):
        coder = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = [coder.encode(t.decode("utf-8")) for t in texts_of(part)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    schema = docs.select("doc_id", F.lit(None).cast("array<int>").alias("ids")).schema
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_pieces(tokens: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, ids``; null ids give a null text, null entries are passed over."""
    make = _coder(tokens, model_path)

    def run(batches):
        coder = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                lists = part.column("ids").to_pylist()
                texts = [None if x is None else coder.decode([i for i in x if i is not None]) for x in lists]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, tokens.select("doc_id", F.lit(None).cast("string").alias("text")).schema)
