"""Ranked search against scores of every document and query, one by one."""

import math
import random
import re
from collections import Counter

import pytest

import sparkmart.llm.strata as strata
from sparkmart.llm.strata import build_index, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, counts, size in held:
            m = 25 + 75 * size * n // total
            score = 0
            for t in terms(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "Ünder", "x1", "日本"] * 4 + [f"w{i}" for i in range(60)]
    text = lambda n: rng.choice([" ", ", ", "-", "\n"]).join(rng.choice(words) for _ in range(n))
    docs = [(k, text(rng.choice([1, 2, 3, 5, 5, 5, 8, 40, 200]))) for k in range(160)]
    docs += [(500 + k, docs[7][1]) for k in range(15)]  # ties
    docs += [(None, docs[7][1]), (3, docs[7][1]), (3, docs[7][1]), (900, None), (901, ""), (902, "?! \x7f"), (903, "the " * 9000)]
    items = [(k, text(rng.randrange(1, 25))) for k in range(12)]
    items += [(20, docs[7][1]), (20, docs[7][1]), (None, "the x1 x1"), (21, None), (22, ""), (23, "nowhere"), (24, "the")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(*r, 1.0, "a") for r in docs], "doc_id long, text string, score double, piece string")
    q = spark.createDataFrame([(*r, 1, "t") for r in items], "item_id long, text string, query int, term string")
    return d.repartition(3), q.repartition(2)


@pytest.mark.parametrize("seed,piece,block", [(0, 2048, 1 << 18), (1, 7, 1 << 18), (2, 20, 60)])
def test_against_every_pair(spark, monkeypatch, seed, piece, block):
    monkeypatch.setattr(strata, "PIECE_DOCS", piece)
    monkeypatch.setattr(strata, "BLOCK_TERMS", block)
    monkeypatch.setattr(strata, "VISIT_DOCS", 4)
    docs, items = corpus(seed)
    d, q = frames(spark, docs, items)
    got = search(build_index(d), q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_large_sums_are_exact(spark, monkeypatch):
    monkeypatch.setattr(strata, "EXACT", 0)
    docs, items = corpus(3)
    d, q = frames(spark, docs, items)
    assert sorted(map(tuple, search(build_index(d), q, 3).collect()), key=str) == brute(docs, items, 3)


def test_pieces_are_bounded_and_hold_neighbouring_strata(spark, monkeypatch):
    monkeypatch.setattr(strata, "PIECE_DOCS", 10)
    docs, items = corpus(4)
    d, _ = frames(spark, docs, items)
    index = build_index(d)
    pieces = index.rows.where("term is null").selectExpr("size(ids) as n", "strata[0].m as lo", "strata[size(strata)-1].m as hi").collect()
    assert max(p.n for p in pieces) <= 10 and sum(p.n for p in pieces) == index.documents
    ordered = sorted(pieces, key=lambda p: (p.lo, p.hi))
    assert all(a.hi <= b.lo for a, b in zip(ordered, ordered[1:]))


def test_terms_of_a_row_are_one_text(spark):
    docs, items = corpus(6)
    d, _ = frames(spark, docs, items)
    rows = strata._terms(d, "doc_id")
    assert dict(rows.dtypes)["terms"] == "string" and dict(rows.dtypes)["tfs"] == "array<int>"
    got = sorted((str(r.id), r.n, sorted(zip(r.terms.split(" "), r.tfs))) for r in rows.collect())
    assert got == sorted((str(i), len(terms(t)), sorted(Counter(terms(t)).items())) for i, t in docs if terms(t))


def test_empty_tables(spark):
    d, q = frames(spark, *corpus(5))
    assert search(build_index(d.limit(0)), q).collect() == []
    assert search(build_index(d.where("doc_id = 901")), q).collect() == []
    assert search(build_index(d), q.limit(0)).collect() == []
