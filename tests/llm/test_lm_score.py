import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import sparkmart.llm.lm_score as lm
from sparkmart.llm.lm_score import lm_scores

SCHEMA = "doc_id long, text string, held_out boolean, score string"
def held_column():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def held_of(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def brute(rows, order, prior):
    """Interpolated probabilities straight from dictionaries of counts."""
    texts = [(d, ["<s>"] + [w.decode() for w in (t or "").encode().lower().split()] + ["</s>"]) for d, t in rows]
    counts = Counter()
    for doc, words in texts:
        if not held_of(doc):
            for n in range(1, order + 1):
                counts.update(tuple(words[i - n + 1 : i + 1]) for i in range(n - 1, len(words)))
    single = {g[0]: c for g, c in counts.items() if len(g) == 1 and g[0] != "<s>"}
    total, vocab = sum(single.values()), len(single)

    def p(gram):
        if len(gram) == 1:
            return (single.get(gram[0], 0) + 1) / (total + vocab + 1)
        return (counts[gram] + prior * p(gram[1:])) / (counts[gram[:-1]] + prior)

    out = []
    for doc, words in texts:
        tokens = range(1, len(words))
        score = sum(math.log10(p(tuple(words[max(0, i - order + 1) : i + 1]))) for i in tokens)
        base = sum(math.log10(p((words[i],))) for i in tokens)
        known = sum(words[i] in single for i in tokens)
        out.append((doc, held_of(doc), len(words) - 1, known, total, base, score))
    return out


def rows_for(seed):
    import random

    rng = random.Random(seed)
    words = ["a", "B", "ä", "cc", "d.", "e\x85f", "g\x1ch"]
    rows = [(k, rng.choice([" ", "\n", "\t "]).join(rng.choice(words) for _ in range(rng.randrange(30)))) for k in range(60)]
    return [*rows, (None, "a b"), (None, None), (7, ""), (7, rows[3][1]), (7, rows[3][1]), (99, "never seen " * 2000)]


@pytest.mark.parametrize("order,chunk,asked", [(2, 1 << 24, 2_000_000), (2, 200, 20), (3, 300, 50)])
def test_against_dictionaries(spark, order, chunk, asked, monkeypatch):
    monkeypatch.setattr(lm, "ORDER", order)
    monkeypatch.setattr(lm, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(lm, "ASKED_PER_TASK", asked)
    monkeypatch.setattr(lm, "PIECE", 64)
    rows = rows_for(order)
    df = spark.createDataFrame([(*r, True, "x") for r in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in lm_scores(df, held_column()).collect()), key=repr)
    want = sorted(brute(rows, order, lm.PRIOR), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_probabilities_of_a_context_add_up(spark):
    rows = [(k, t) for k, t in enumerate(["a b", "a a b", "b", "a"]) if not held_of(k)]
    vocab = ["a", "b", "unknown"]
    asked = [(1000 + i, w) for i, w in enumerate(vocab)]
    asked = [(next(k for k in range(1000 * (i + 1), 10**6) if held_of(k)), w) for i, (_, w) in enumerate(asked)]
    df = spark.createDataFrame([(*r, True, "x") for r in [*rows, *asked]], SCHEMA)
    got = {r.doc_id: r for r in lm_scores(df, held_column()).collect()}
    # first words after the begin mark; the end mark's share comes from an empty text
    empty = spark.createDataFrame([(*r, True, "x") for r in [*rows, (asked[0][0], "")]], SCHEMA)
    end = next(r for r in lm_scores(empty, held_column()).collect() if r.held_out)
    counts = brute([*rows, *asked], 2, lm.PRIOR)
    assert {r[0]: pytest.approx(r[6]) for r in counts} == {k: r.score for k, r in got.items()}
    assert end.score < 0


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(2, "a b", True, "x")], SCHEMA)
    assert lm_scores(df.limit(0), held_column()).collect() == []
    row = lm_scores(df, F.lit(True)).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)
