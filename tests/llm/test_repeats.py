import hashlib
from collections import defaultdict

import pytest

import sparkmart.llm.repeats as repeats
from sparkmart.llm.repeats import LENGTH, remove_repeats, repeat_digests

SCHEMA = "doc_id long, text string, doc long, spans string"


def brute(rows, keep_first=False):
    """Every window of every text against all others."""
    places = defaultdict(list)
    texts = [(t or "").encode() for _, t in rows]
    for k, t in enumerate(texts):
        for i in range(len(t) - LENGTH + 1):
            places[t[i : i + LENGTH]].append((k, i))
    covered = [bytearray(len(t)) for t in texts]
    for where in places.values():
        for k, i in (sorted(where)[1:] if keep_first else where) if len(where) > 1 else ():
            covered[k][i : i + LENGTH] = b"\1" * LENGTH
    out = []
    for (doc, _), t, c in zip(rows, texts, covered):
        kept = bytes(b for b, x in zip(t, c) if not x)
        spans = sum(c[i] and (i == 0 or not c[i - 1]) for i in range(len(c)))
        out.append((doc, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out, [bytes(b for b, x in zip(t, c) if not x) for t, c in zip(texts, covered)]


def corpus(seed):
    import random

    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "Straße", "é"]) + str(rng.randrange(300))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, rows = text(120), []
    base = text(400)
    for k in range(14):
        rows.append((k, text(rng.randrange(1, 60)) + passage[: rng.randrange(300, len(passage))] + text(30)))
    for k in range(14, 20):  # near copies
        words = base.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((k, " ".join(words)))
    exact = text(100)
    rows += [(20, exact), (21, exact), (21, exact), (None, exact), (22, None), (23, ""), (24, "z" * 1500)]
    rows += [(25, text(90) + " " + passage[100:700] + " " + passage[100:700]), (26, text(200))]
    # a match of exactly the length, and one byte short of it
    rows += [(27, "A" + passage[50 : 50 + LENGTH] + "B"), (28, "C" + rows[26][1][: LENGTH - 1] + "D")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed,limit", [(0, 4000), (1, 4000), (2, 2)])
def test_against_all_windows(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(repeats, "CLASS_LIMIT", limit)  # 2: nearly all classes are hot
    rows = corpus(seed)
    got = [tuple(r)[:5] for r in repeat_digests(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows)[0], key=repr)
    assert sum(r[2] for r in got) > 5000


@pytest.mark.parametrize("limit", [4000, 2])
def test_keeps_the_first_copy(spark, limit, monkeypatch):
    monkeypatch.setattr(repeats, "CLASS_LIMIT", limit)
    seen, rows = set(), []
    for doc, text in corpus(3):  # unique ids, in order
        if doc is not None and doc not in seen:
            seen.add(doc)
            rows.append((doc, text))
    got = {r.doc_id: r.text for r in remove_repeats(frame(spark, rows), unique_ids=True).collect()}
    want = {doc: kept.decode("utf-8", "ignore") for (doc, _), kept in zip(rows, brute(rows, keep_first=True)[1])}
    assert got == want


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    rows = [(1, "".join(chr(97 + i * i % 23) + str(i) for i in range(900))), (2, "x" + "".join(chr(97 + i * i % 23) + str(i) for i in range(300, 800)))]
    got = [tuple(r)[:5] for r in repeat_digests(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows)[0])


def test_empty(spark):
    assert repeat_digests(frame(spark, [(1, "a")]).limit(0)).collect() == []
    assert [r.n_removed for r in repeat_digests(frame(spark, [(1, None)])).collect()] == [0]


def shared_by_brute_force(rows, words):
    """Documents (by id and text) that hold a run of ``words`` words which another one holds too."""
    held = defaultdict(set)
    for row in set(rows):
        parts = (row[1] or "").encode().split()
        for i in range(len(parts) - words + 1):
            held[tuple(parts[i : i + words])].add(row)
    return {row for others in held.values() if len(others) > 1 for row in others}


@pytest.mark.parametrize("seed,piece", [(0, 1 << 19), (1, 333), (4, 60)])
def test_passages_of_other_documents(spark, monkeypatch, seed, piece):
    import random

    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(["a", "bb", "é", "ccc"]) + str(rng.randrange(99)) + rng.choice([" ", "\n", " \t"]) for _ in range(n))
    passages = [text(n) for n in (20, 25, 50, 51, 60, 120)]
    rows = [(k, text(rng.randrange(0, 200)) + rng.choice(passages) + text(rng.randrange(0, 200))) for k in range(40)]
    inside = text(70)
    rows += [(90, inside + text(9) + inside), (91, text(300)), (92, None), (93, "x" * 3000), (94, passages[5]), (94, passages[5]), (None, text(60))]
    got = {(r.doc_id, r.n_bytes): r.shared_passage for r in repeat_digests(frame(spark, rows)).collect()}
    whole, short = shared_by_brute_force(rows, 50), shared_by_brute_force(rows, 26)
    for row in rows:
        said = got[row[0], len((row[1] or "").encode())]
        assert said == 1 if row in whole else (said == 0 or row in short)
    assert got[90, len(rows[40][1].encode())] == 0 and len(whole) > 20
