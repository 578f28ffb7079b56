"""Log-probabilities of texts under a smoothed n-gram model, walked as a weighted backoff automaton.

The model is never in one place. Documents are cut into chunks of bounded size; each chunk asks for
the n-grams it contains, and the same exchange that brings the questions together brings the training counts
(a question carries how often the chunk's own training texts have the n-gram). A task adds up the counts
of its share of the n-grams and answers. The answers of a chunk make the part of the automaton that its texts can
reach, which is walked once from left to right.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import texts_of
from sparkmart.session import settle

ORDER = 2  # words of the longest n-gram
PRIOR = 500.0  # weight of the shorter context against the counts of a longer one (Dirichlet); best of 5 to 5000 on held-out texts
CHUNK_BYTES = 3 << 20  # text of a chunk, about
ASKED_PER_TASK = 1_000_000  # n-grams that a counting task handles at a time, about
PIECE = 1 << 22  # bytes of a text that are cut into words at a time
END, BEGIN = 0, 1  # local numbers of the marks; words count from 2
_MARKS = np.array([xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" begin")], np.uint64)  # no words: they have a blank


def _packed(values: np.ndarray, width: int) -> bytes:
    """Low ``width`` bytes of whole numbers, byte by byte of their places, compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return pa.compress(np.ascontiguousarray(planes.T).tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unpacked(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        flat = pa.decompress(data, n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(flat, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def _key_width(order: int) -> int:
    """Single words keep all 64 bits, as counts of words are exact; longer n-grams 48 within their task."""
    return 8 if order == 1 else 6


class Chunk:
    """Documents as numbers of their words, each begun and ended by a mark."""

    def __init__(self, doc_ids, held, lengths, tokens, words):
        self.doc_ids, self.held, self.lengths = doc_ids, np.asarray(held, bool), np.asarray(lengths, np.int64)
        self.tokens, self.words = tokens, words  # without begin marks; hashes of the local numbers

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with both marks, and the document of each."""
        full = self.lengths + 1
        doc = np.repeat(np.arange(len(full)), full)
        out = np.full(full.sum(), BEGIN, np.int64)
        begins = np.cumsum(full) - full
        inside = np.ones(len(out), bool)
        inside[begins] = False
        out[inside] = self.tokens
        return out, doc

    def grams(self):
        """For each order: the distinct n-grams' hashes, the one that ends at each place (-1: none), and its count in training."""
        tokens, doc = self.stream()
        learn = ~self.held[doc] if len(doc) else np.zeros(0, bool)
        single = self.words[tokens]
        hashes, valid = single, np.ones(len(tokens), bool)
        for order in range(1, ORDER + 1):
            if order > 1:
                longer = np.zeros_like(single)
                longer[1:] = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ single[1:]  # fixed value: an odd multiplier
                longer ^= longer >> np.uint64(32)
                longer *= np.uint64(0xD6E8FEB86659FD93)  # fixed value: a mixing multiplier
                longer ^= longer >> np.uint64(32)
                before = np.zeros_like(valid)
                before[1:] = valid[:-1] & (doc[1:] == doc[:-1])
                hashes, valid = longer, before
            places = np.flatnonzero(valid)
            distinct, inverse = np.unique(hashes[places], return_inverse=True)
            at = np.full(len(tokens), -1, np.int64)
            at[places] = inverse
            counts = np.bincount(inverse[learn[places]], minlength=len(distinct)) if len(places) else np.zeros(0, np.int64)
            yield order, distinct, at, counts.astype(np.uint64)


CHUNK_SCHEMA = "chunk long, doc_ids array<long>, held array<boolean>, lengths array<int>, n_words long, tokens binary, n_vocab long, vocab binary, asked array<long>"


def _chunks(docs: DataFrame, held: Column) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"), "text")
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    names = [part.split()[0] for part in CHUNK_SCHEMA.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        class Numbers(dict):
            def __missing__(self, word):
                self[word] = number = len(self) + 2
                return number

        part, made = TaskContext.get().partitionId(), 0
        ids, marks, lengths, tokens, numbers, size = [], [], [], [], Numbers(), 0

        def packed():
            vocab = np.concatenate([_MARKS, np.array([xxhash.xxh64_intdigest(w) for w in numbers], np.uint64)])
            stream = np.concatenate(tokens)
            asked = [len(g[1]) for g in Chunk(ids, marks, lengths, stream, vocab).grams()]
            row = [(part << 32) | made, ids, marks, lengths, len(stream), _packed(stream, 4), len(vocab), _packed(vocab, 8), asked]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            for doc, mark, text in zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), texts_of(batch)):
                n, at = 0, 0
                while at < len(text):
                    end = at + PIECE
                    if end < len(text):  # go on to the end of a word
                        rest = text[end : end + 64].split(None, 1)
                        while rest and not text[end : end + 1].isspace() and end < len(text):
                            end += 1
                    words = text[at:end].lower().split()
                    tokens.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                    n, at = n + len(words), end
                tokens.append(np.array([END]))
                ids.append(doc)
                marks.append(mark)
                lengths.append(n + 1)
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield packed()
                    made += 1
                    ids, marks, lengths, tokens, numbers, size = [], [], [], [], Numbers(), 0
        if ids:
            yield packed()

    return settle(rows.mapInArrow(run, CHUNK_SCHEMA), "lm-chunks")


def _read_chunk(row) -> Chunk:
    tokens = _unpacked(row["tokens"], row["n_words"], 4).astype(np.int64)
    return Chunk(row["doc_ids"], row["held"], row["lengths"], tokens, _unpacked(row["vocab"], row["n_vocab"], 8))


def _shares(distinct: np.ndarray, tasks: int) -> list[np.ndarray]:
    """Which n-grams go to which of the counting tasks of their order, by their upper bits."""
    share = (distinct >> np.uint64(48)).astype(np.int64) % tasks
    order = np.argsort(share, kind="stable")
    return np.split(order, np.cumsum(np.bincount(share, minlength=tasks))[:-1])


def _questions(chunks: DataFrame, tasks: list[int]) -> DataFrame:
    """One row per chunk, order and counting task: the n-grams asked for and their counts in the chunk."""
    names = ["order", "task", "chunk", "n", "keys", "counts"]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for order, distinct, _, counts in _read_chunk(row).grams():
                    width = _key_width(order)
                    rows = [
                        (order, task, row["chunk"], len(at), _packed(distinct[at], width), _packed(counts[at], 4))
                        for task, at in enumerate(_shares(distinct, tasks[order - 1]))
                        if len(at)
                    ]
                    if rows:
                        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return chunks.mapInArrow(run, "order int, task int, chunk long, n long, keys binary, counts binary")


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts over all chunks for each chunk's questions, and how many n-grams occur in training."""
    order = int(rows["order"].iloc[0])
    width = _key_width(order)
    sizes = rows["n"].to_numpy()
    keys = np.concatenate([_unpacked(k, n, width) for k, n in zip(rows["keys"], sizes)])
    counts = np.concatenate([_unpacked(c, n, 4) for c, n in zip(rows["counts"], sizes)])
    distinct, inverse = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, inverse, counts)
    answers = np.split(total[inverse], np.cumsum(sizes)[:-1])
    seen = np.zeros(len(rows), np.int64)
    seen[0] = np.count_nonzero(total)
    return pd.DataFrame(
        {"order": rows["order"], "task": rows["task"], "chunk": rows["chunk"], "n": sizes, "counts": [_packed(a, 5) for a in answers], "seen": seen}
    )


class Automaton:
    """The part of the model that a chunk can reach.

    A state is a context: nothing (state 0), or an n-gram of less than ORDER words seen in training.
    Its arcs are the n-grams that continue it, weighted with their smoothed log10 probability; its failure arc
    leads to the context without its first word, weighted with the log10 share left to shorter contexts.
    """

    def __init__(self, chunk: Chunk, counts: list[np.ndarray], n_train: int, n_vocab: int):
        tokens, _ = chunk.stream()
        self.width = len(chunk.words)
        self.arcs: dict[int, int] = {}
        self.weights: list[float] = []
        self.targets: list[int] = []
        self.failure, self.back = [0.0], [0]
        self.unknown = float(-np.log10(n_train + n_vocab + 1))
        shorter = None  # (place of each n-gram end, probabilities, counts, state numbers) of the order below
        for (order, distinct, at, _), count in zip(chunk.grams(), counts):
            count = count.astype(float)
            some = np.zeros(len(distinct), np.int64)
            places = np.flatnonzero(at >= 0)
            some[at[places]] = places  # one place of each n-gram
            last = tokens[some]
            if order == 1:
                p = (count + 1) / (n_train + n_vocab + 1)
                source, after = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
                arc = (count > 0) & (last != BEGIN)
                lower = np.zeros(len(distinct), np.int64)
            else:
                at_, p_, count_, state_ = shorter
                context, suffix = at_[some - 1], at_[some]
                p = (count + PRIOR * p_[suffix]) / (count_[context] + PRIOR)
                source, after = state_[context], state_[suffix]
                arc = count > 0
                lower = after
            state = np.zeros(len(distinct), np.int64)
            if order < ORDER:  # n-grams seen in training are contexts themselves
                seen = np.flatnonzero(count > 0)
                state[seen] = len(self.back) + np.arange(len(seen))
                self.failure += np.log10(PRIOR / (count[seen] + PRIOR)).tolist()
                self.back += lower[seen].tolist()
                after = state
            arc = np.flatnonzero(arc)
            first = len(self.weights)
            self.weights += np.log10(p[arc]).tolist()
            self.targets += after[arc].tolist()
            keys = (source[arc] * self.width + last[arc]).tolist()
            self.arcs.update(zip(keys, range(first, first + len(keys))))
            if order == 1:
                self.single, self.single_at, self.log_single = count, at, np.log10(p)
                begin = np.flatnonzero(last == BEGIN)
                self.start = int(state[begin[0]]) if len(begin) else 0
            shorter = (at, p, count, state)

    def walk(self, words: list[int]) -> float:
        """Log10 probability of a text: one pass, following failure arcs until the word has an arc."""
        find, width, weights, targets, failure, back = self.arcs.get, self.width, self.weights, self.targets, self.failure, self.back
        state, score = self.start, 0.0
        for word in words:
            arc = find(state * width + word)
            while arc is None and state:
                score += failure[state]
                state = back[state]
                arc = find(state * width + word)
            if arc is None:
                score += self.unknown
            else:
                score += weights[arc]
                state = targets[arc]
        return score


def _scored(key, chunks: pd.DataFrame, answers: pd.DataFrame, tasks: list[int], n_train: int, n_vocab: int) -> pd.DataFrame:
    chunk = _read_chunk(chunks.iloc[0])
    counts = []
    for order, distinct, _, _ in chunk.grams():
        told = answers[answers["order"] == order].set_index("task")
        out = np.zeros(len(distinct), np.uint64)
        for task, at in enumerate(_shares(distinct, tasks[order - 1])):
            if len(at):
                out[at] = _unpacked(told.at[task, "counts"], len(at), 5)
        counts.append(out)
    model = Automaton(chunk, counts, n_train, n_vocab)
    tokens, doc = chunk.stream()
    real = np.flatnonzero(tokens != BEGIN)
    single, n = model.single_at[real], len(chunk.lengths)
    ends = np.cumsum(chunk.lengths)
    words = chunk.tokens
    return pd.DataFrame(
        {
            "doc_id": pd.array(chunk.doc_ids, "Int64"),
            "held_out": chunk.held,
            "n_tokens": chunk.lengths,
            "n_known": np.bincount(doc[real], model.single[single] > 0, minlength=n).astype(np.int64),
            "train_tokens": np.full(n, n_train, np.int64),
            "base_score": np.bincount(doc[real], model.log_single[single], minlength=n),
            "score": [model.walk(words[a:b].tolist()) for a, b in zip(ends - chunk.lengths, ends)],
        }
    )


def lm_scores(docs: DataFrame, held: Column) -> DataFrame:
    """Score all texts under a model of those that are not held out.

    A text is its lower-cased words and an end mark. Words are smoothed by adding one; a longer n-gram
    mixes its relative count with the shorter one's probability, which counts like PRIOR more occurrences of the context.
    One row per document: ``doc_id, held_out, n_tokens, n_known`` (tokens seen in training), ``train_tokens,
    base_score`` (log10, single words only), ``score`` (log10, the automaton).

    Null or empty text: the end mark alone. Null ``held``: learnt from. Null ids and repeated rows each have
    their row. Nothing to learn from: every token has probability one, as the vocabulary is empty. Empty table: no
    rows. Other columns are not read. A text of any length is in one chunk, as numbers of 8 bytes a word.
    """
    chunks = _chunks(docs, held)
    spread = F.explode(F.arrays_zip("held", "lengths"))
    n_train = chunks.select(spread.alias("x")).where("not x.held").agg(F.sum("x.lengths")).first()[0] or 0
    asked = chunks.agg(*[F.sum(F.col("asked")[i]) for i in range(ORDER)]).first()
    tasks = [min(1 << 16, max(1, -(-(n or 0) // ASKED_PER_TASK))) for n in asked]
    answers = (
        _questions(chunks, tasks)
        .groupBy("order", "task")
        .applyInPandas(_answer, "order int, task int, chunk long, n long, counts binary, seen long")
    )
    answers = settle(answers, "lm-answers")
    n_vocab = answers.where("order = 1").agg(F.sum("seen")).first()[0] or 0
    n_vocab -= 1 if n_train else 0  # the begin mark is no token
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(lambda key, left, right: _scored(key, left, right, tasks, n_train, n_vocab), result)
    )
