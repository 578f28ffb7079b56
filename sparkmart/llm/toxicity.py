"""Toxicity: a linear classifier on character n-grams scaled by naive-Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import shared_value, texts_of
from sparkmart.session import settle

ORDERS = (3, 4, 5)  # characters of an n-gram
HASH_BITS = 20  # n-grams are hashed to this many bits
MAX_TRAIN = 12_000  # labelled ids, and then labelled texts, in the order of a hash, that the classifier learns from
POOL = 12_000  # n-grams from which it may choose, those whose ratio is farthest from chance
FEATURES = (500, 2_000, 6_000)  # how many of them it may use
RIDGES = (1.0, 10.0)  # and how strongly their factors are held back; both are chosen by cross-validation
FOLDS = 3
MIN_DOCS = 5  # an n-gram must be in this many training texts
SMOOTHING = 1.0
STEPS = 200
THRESHOLD = 0.3
PIECE = 1 << 20  # characters of a text that are hashed at a time

# digits and ASCII punctuation count as blanks, so that words keep their n-grams amid symbols
_BLANK = bytes(b for b in range(128) if not chr(b).isalpha())
_PLAIN = bytes.maketrans(_BLANK + bytes(range(65, 91)), b" " * len(_BLANK) + bytes(range(97, 123)))


def ngram_ids(text: bytes):
    """Hashes of the character n-grams of the plain text, in arrays, with repeats."""
    plain = b" " + b" ".join(text.translate(_PLAIN).split()) + b" "
    chars = np.frombuffer(plain.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    for at in range(0, len(chars), PIECE):
        part = chars[at : at + PIECE + max(ORDERS) - 1]
        for n in ORDERS:
            count = len(part) - n + 1
            if count <= 0:
                continue
            key = np.full(count, n, np.uint64)
            for i in range(n):
                key = (key * np.uint64(0x100000001B3)) ^ part[i : i + count]  # fixed value: the FNV prime
            key *= np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier
            yield (key >> np.uint64(64 - HASH_BITS)).astype(np.int64)


@dataclass
class Model:
    """Weight of each n-gram hash (log-count ratio times learnt factor; zero if not used) and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        used = [ids[self.weights[ids] != 0] for ids in ngram_ids(text)]
        present = np.unique(np.concatenate(used)) if used else np.zeros(0, np.int64)
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[present].sum(), -500, 500))))


def _sample(labels: DataFrame, learn: Column) -> DataFrame:
    """At most MAX_TRAIN labelled ids, chosen by a hash; an id with any toxic label is toxic."""
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    ids = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)


def _counts(rows: DataFrame) -> np.ndarray:
    """Texts with each n-gram, by class: a 2 x 2**HASH_BITS table, summed by Spark."""

    def run(batches):
        held = np.zeros((2, 1 << HASH_BITS), np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), texts_of(batch)):
                ids = list(ngram_ids(text))
                if ids:
                    held[int(toxic > 0), np.unique(np.concatenate(ids))] += 1
        at = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, held[0, at], held[1, at])], names=["id", "clean", "toxic"])

    counted = rows.select("toxic", "text").mapInArrow(run, "id long, clean long, toxic long")
    summed = counted.groupBy("id").agg(F.sum("clean"), F.sum("toxic")).where(F.col("sum(clean)") + F.col("sum(toxic)") >= MIN_DOCS)
    out = np.zeros((2, 1 << HASH_BITS), np.int64)
    table = summed.toArrow()  # at most 2**HASH_BITS rows
    out[:, table.column(0).to_numpy()] = [table.column(1).to_numpy(), table.column(2).to_numpy()]
    return out


def _ratios(clean: np.ndarray, toxic: np.ndarray, totals: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratio of each n-gram towards the toxic class, and how many standard errors it is from chance."""
    p, q = SMOOTHING + toxic, SMOOTHING + clean
    ratio = np.log((p / totals[1]) / (q / totals[0]))
    # only what speaks for the toxic class: a clean text is one in which none of it is found
    return ratio, np.where(clean + toxic >= MIN_DOCS, ratio / np.sqrt(1 / p + 1 / q), -1)


@dataclass
class Sample:
    """Training texts: class, fold, and the n-grams of the pool in each (as slots, one array after the other)."""

    y: np.ndarray
    fold: np.ndarray
    lengths: np.ndarray
    slots: np.ndarray

    def part(self, rows: np.ndarray) -> Sample:
        return Sample(self.y[rows], self.fold[rows], self.lengths[rows], self.slots[np.repeat(rows, self.lengths)])

    def only(self, chosen: np.ndarray, size: int) -> Sample:
        """With the chosen slots only, numbered anew."""
        new = np.full(size, -1)
        new[chosen] = np.arange(len(chosen))
        row = np.repeat(np.arange(len(self.y)), self.lengths)
        mapped = new[self.slots]
        used = mapped >= 0
        return Sample(self.y, self.fold, np.bincount(row[used], minlength=len(self.y)), mapped[used])


def _vectors(rows: DataFrame, slots: np.ndarray) -> Sample:
    spark = rows.sparkSession
    table = shared_value(spark, slots)

    def run(batches):
        slot_of = table()
        for batch in batches:
            found = []
            for text in texts_of(batch):
                parts = [slot_of[ids] for ids in ngram_ids(text)]
                slots_ = np.unique(np.concatenate([p[p >= 0] for p in parts])) if parts else np.zeros(0, np.int32)
                found.append(slots_.astype("<i4").tobytes())
            columns = [batch.column("toxic"), batch.column("fold"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "fold", "slots"])

    # at most MAX_TRAIN rows
    got = rows.select("toxic", "fold", "text").mapInArrow(run, "toxic int, fold int, slots binary").toArrow()
    parts = [np.frombuffer(x.as_py(), "<i4") for x in got.column("slots")]
    return Sample(
        (got.column("toxic").to_numpy() > 0).astype(float),
        got.column("fold").to_numpy(),
        np.array([len(p) for p in parts], np.int64),
        np.concatenate(parts) if parts else np.zeros(0, np.int32),
    )


def _fit(sample: Sample, ratio: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on presence times ratio, by Adam steps over all rows."""
    y, lengths, slots = sample.y, sample.lengths, sample.slots
    row = np.repeat(np.arange(len(y)), lengths)
    x = ratio[slots]
    w, bias = np.zeros(len(ratio)), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    mean_w, mean_b, step_w, step_b = 0.0, 0.0, np.zeros(len(ratio)), 0.0
    for step in range(1, STEPS + 1):
        margin = bias + np.bincount(row, x * w[slots], minlength=len(y))
        error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y
        grad_w = np.bincount(slots, error[row] * x, minlength=len(ratio)) + ridge * w
        grad_b = error.sum()
        # Adam, full batch: the scale of a coordinate's gradient does not matter
        mean_w, mean_b = 0.9 * mean_w + 0.1 * grad_w, 0.9 * mean_b + 0.1 * grad_b
        step_w, step_b = 0.999 * step_w + 0.001 * grad_w**2, 0.999 * step_b + 0.001 * grad_b**2
        a, b = 1 - 0.9**step, 1 - 0.999**step
        w = w - 0.05 * (mean_w / a) / (np.sqrt(step_w / b) + 1e-9)
        bias = bias - 0.05 * (mean_b / a) / (np.sqrt(step_b / b) + 1e-9)
    return w, float(bias)


def _fold_losses(sample: Sample, size: int, totals: tuple[float, float], fold: int, features: int) -> list[float]:
    """Log loss on one fold, for each ridge, of a model that has counted, chosen and learnt on the others."""
    rest = sample.part(sample.fold != fold)
    share = len(rest.y) / len(sample.y)
    owner = np.repeat(rest.y, rest.lengths)
    toxic = np.bincount(rest.slots, owner, size)
    clean = np.bincount(rest.slots, 1 - owner, size)
    ratio, chance = _ratios(clean, toxic, (totals[0] * share, totals[1] * share))
    chosen = np.argsort(-chance, kind="stable")[:features]
    chosen = chosen[chance[chosen] > 0]
    held = sample.part(sample.fold == fold).only(chosen, size)
    row = np.repeat(np.arange(len(held.y)), held.lengths)
    out = []
    for ridge in RIDGES:
        learnt, bias = _fit(rest.only(chosen, size), ratio[chosen], ridge)
        margin = bias + np.bincount(row, (ratio[chosen] * learnt)[held.slots], minlength=len(held.y))
        out.append(float(np.logaddexp(0, np.where(held.y > 0, -margin, margin)).sum()))
    return out


def _strength(spark: SparkSession, sample: Sample, size: int, totals: tuple[float, float]) -> tuple[int, float]:
    """The number of n-grams and the ridge with the least loss over all folds; each fold and number is a task's row."""
    shared = shared_value(spark, (sample, size, totals))

    def run(batches):
        known = shared()
        for batch in batches:
            cells = zip(batch.column("fold").to_pylist(), batch.column("features").to_pylist())
            losses = pa.array([_fold_losses(*known, *cell) for cell in cells], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("features"), losses], names=["features", "losses"])

    cells = spark.createDataFrame([(k, n) for k in range(FOLDS) for n in FEATURES], "fold int, features int")
    total = {n: np.zeros(len(RIDGES)) for n in FEATURES}
    spread = cells.repartition(len(FEATURES) * FOLDS, "fold", "features")
    for row in spread.mapInArrow(run, "features int, losses array<double>").collect():
        total[row.features] += np.array(row.losses)
    return min(((n, ridge) for n in FEATURES for ridge in RIDGES), key=lambda c: total[c[0]][RIDGES.index(c[1])])


def _training_rows(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """One row per labelled id and text, however often it occurs; at most MAX_TRAIN, in the order of a hash."""
    sample = F.broadcast(_sample(labels, learn))
    held = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    once = held.groupBy("doc_id", F.xxhash64("text").alias("_hash")).agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))
    order = F.xxhash64("doc_id", "_hash")
    fold = F.pmod(F.xxhash64("_hash", "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    return once.orderBy(order, "doc_id", "_hash").limit(MAX_TRAIN).select("toxic", "text", fold)


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Learn from the labelled rows for which ``learn`` (an expression on ``doc_id``) holds.

    A bounded sample of labels picks the texts, which are read where they are (the ids are broadcast: at most
    MAX_TRAIN); rows equal in id and text count once. Spark sums the counts per class and tries each strength on held
    folds of the training rows; the driver holds tables of 2**HASH_BITS numbers and the
    n-grams of the pool in the sample. Without labelled texts every score is 0.5; with one class only, the
    smoothed share of that class.
    """
    rows = settle(_training_rows(docs, labels, learn), "toxicity-sample")
    clean, toxic = _counts(rows)
    totals = (float((SMOOTHING + clean).sum()), float((SMOOTHING + toxic).sum()))
    ratio, chance = _ratios(clean, toxic, totals)
    pool = np.argsort(-chance, kind="stable")[:POOL]
    pool = pool[chance[pool] > 0]
    slots = np.full(1 << HASH_BITS, -1, np.int32)
    slots[pool] = np.arange(len(pool))
    sample = _vectors(rows, slots)
    y, weights = sample.y, np.zeros(1 << HASH_BITS)
    if 0 < y.sum() < len(y) and len(pool):
        features, ridge = _strength(docs.sparkSession, sample, len(pool), totals)
        chosen = pool[:features]
        learnt, bias = _fit(sample.only(np.arange(len(chosen)), len(pool)), ratio[chosen], ridge)
        weights[chosen] = ratio[chosen] * learnt
    else:
        bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    return Model(weights, bias)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; learns from labels that are not held out.

    Only the text is an input of a score. Null or empty text: no n-grams, the score of the bias alone.
    Null ids are not held out and have no label. Repeated rows and ids get a score each. No labels:
    0.5 for all. Empty documents: no rows. Other columns are not read. A very long text is held whole by its task and
    hashed in pieces.
    """
    model = shared_value(docs.sparkSession, train(docs, labels, ~held_out()))

    def run(batches):
        scorer = model()
        for batch in batches:
            scores = np.array([scorer.score(t) for t in texts_of(batch)], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    schema = rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return rows.mapInArrow(run, schema)
