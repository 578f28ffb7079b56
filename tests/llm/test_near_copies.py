"""The pipeline's stage of near copies: recall on planted pairs, precision by true similarity, crowded groups."""

import random

import numpy as np
import pytest

import sparkmart.llm.near_copies as near_copies
from corpus_pipeline import near_duplicates
from sparkmart.llm.mixing import mix
from sparkmart.llm.simhash import RADIUS, majority

SCHEMA = "doc_id long, text string, lang string, row long"


def stage(spark, rows):
    df = spark.createDataFrame([(d, t, "en", 7) for d, t in rows], SCHEMA).repartition(4)
    out = near_duplicates(spark, df, "")
    assert out.columns == df.columns
    return [(r.doc_id, r.text) for r in out.collect()]


def similarity(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in ((a or "").lower().split(), (b or "").lower().split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def some(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def changed(rng, words, k):
    words = list(words)
    for i in rng.sample(range(len(words)), k):
        words[i] = f"x{rng.randrange(10**9)}"
    return words


@pytest.mark.parametrize("low,high", [(0.80, 0.85), (0.85, 0.90), (0.90, 0.955)])
def test_recall_of_planted_pairs(spark, low, high):
    rng, rows, near = random.Random(int(low * 100)), [], 0
    while near < 100:
        words = some(rng, rng.choice([120, 200, 400, 1000]))
        a, b = " ".join(words), " ".join(changed(rng, words, rng.randrange(1, 24)))
        if low <= similarity(a, b) < high:
            rows += [(2 * near, a), (2 * near + 1, b.upper())]
            near += 1
    kept = {d for d, _ in stage(spark, rows)}
    assert all(2 * i in kept for i in range(near))
    assert sum(2 * i + 1 not in kept for i in range(near)) >= 0.97 * near


def test_pairs_below_stay(spark):
    rng, rows = random.Random(9), []
    while len(rows) < 120:
        words = some(rng, rng.choice([120, 400]))
        a, b = " ".join(words), " ".join(changed(rng, words, rng.randrange(3, 30)))
        if 0.6 <= similarity(a, b) < 0.795:
            rows += [(len(rows), a), (len(rows) + 1, b)]
    assert len(stage(spark, rows)) == len(rows)


def test_crowded_groups_leave_no_near_copies(spark):
    rng, rows = random.Random(10), []
    for group in range(3):  # copies of one text, not all near each other
        words = some(rng, 200)
        rows += [(1000 * group + i, " ".join(changed(rng, words, rng.choice([1, 2, 3, 4])))) for i in range(60)]
    odd = [(None, None), (None, ""), (9008, ""), (9009, "a b"), (9009, "A  b"), (None, "a b"), (9010, "x\x85y z\x1c w " * 4000)]
    got = stage(spark, rows + odd)
    assert sorted(d for d, _ in got if d is None or d > 9000) == [9008, 9009, 9010]
    left = [t for d, t in got if d < 9000]
    assert all(similarity(a, b) < 0.8 for i, a in enumerate(left) for b in left[:i])
    by_id = dict(rows)
    for d, t in rows:
        if t not in left:  # connected to one that stays
            assert any(similarity(t, by_id[o]) >= 0.8 for o in by_id if o // 1000 == d // 1000 and o != d)
    assert stage(spark, []) == []


def template_pages(rng, n):
    """Pages with one template: 400 words in common, 90 of their own."""
    common = " ".join(some(rng, 400))
    return [(i, common + " " + " ".join(f"own{i}x{k}" for k in range(90))) for i in range(n)]


def test_pages_of_one_template_do_not_meet_in_pairs(spark, monkeypatch):
    counted = []
    verified = near_copies._verified

    def watched(pairs, rows):
        counted[-1] += pairs.count()
        return verified(pairs, rows)

    monkeypatch.setattr(near_copies, "_verified", watched)
    for n in (300, 600, 1200):
        counted.append(0)
        assert len(stage(spark, template_pages(random.Random(3), n))) == n
    assert counted[2] <= 2.5 * counted[1] <= 6.25 * counted[0] and counted[2] < 60 * 1200


@pytest.mark.parametrize("low,high", [(0.80, 0.87), (0.87, 0.955)])
def test_near_copies_amid_a_template_are_found(spark, low, high):
    rng = random.Random(int(100 * low))
    rows, near = template_pages(rng, 300), 0
    while near < 60:
        page = rows[near][1].split()
        other = page[:400] + changed(rng, page[400:], rng.randrange(1, 30))
        for i in rng.sample(range(400), rng.randrange(0, 6)):
            other[i] = f"z{rng.randrange(10**9)}"
        text = " ".join(other)
        if low <= similarity(rows[near][1], text) < high:
            rows.append((1000 + near, text))
            near += 1
    kept = {d for d, _ in stage(spark, rows)}
    assert kept >= set(range(300)) and sum(1000 + k not in kept for k in range(near)) >= 0.9 * near


def block_pages(rng, n, near):
    """Pages of 25 blocks in one of two variants each, most of them different, and near copies with other variants of two blocks."""
    codes = []
    while len(codes) < n:
        code = [rng.randrange(2) for _ in range(25)]
        if all(sum(a != b for a, b in zip(code, other)) > 7 for other in codes):
            codes.append(code)
    copies = [[c ^ (k in (2 * i % 25, (2 * i + 7) % 25)) for k, c in enumerate(codes[i])] for i in range(near)]
    block = [[" ".join(f"b{k}v{v}x{i}" for i in range(8)) for v in (0, 1)] for k in range(25)]
    gap = [" ".join(f"gap{k}x{i}" for i in range(6)) for k in range(25)]
    return [(i, " ".join(f"{gap[k]} {block[k][c]}" for k, c in enumerate(code))) for i, code in enumerate(codes + copies)]


def test_near_copies_of_a_crowded_band_need_no_rare_shingle(spark, monkeypatch):
    # one band holds all rows, fingerprints tell nothing, and each shingle is in a third of the rows at least
    monkeypatch.setattr(near_copies, "bands", lambda hashes: [7])
    monkeypatch.setattr(near_copies, "majority", lambda hashes: int(hashes.sum()))
    monkeypatch.setattr(near_copies, "PORTION", 8)  # verified in portions
    rows = block_pages(random.Random(14), 110, 30)
    texts = [t for _, t in rows]
    near = [(i, j) for j in range(140) for i in range(j) if similarity(texts[i], texts[j]) >= 0.8]
    assert set(near) >= {(i, 110 + i) for i in range(30)}
    kept = {d for d, _ in stage(spark, rows)}
    assert not any(i in kept and j in kept for i, j in near)
    linked = {d for pair in near for d in pair}
    assert kept >= set(range(140)) - linked and all(any(d in pair for pair in near) for d in set(range(140)) - kept)


def test_prefixes_leave_no_pair_out(spark):
    rng, rows = random.Random(15), [(0, ""), (1, "a"), (2, "a b c d e"), (3, "a b c d e f"), (4, "b c d e f g"), (5, "a b c d e f g")]
    bases = [[f"w{rng.randrange(40)}" for _ in range(n)] for n in (6, 9, 15, 30, 31, 60, 100)]
    for base in bases:
        for _ in range(25):
            words = base[: rng.randrange(len(base) * 3 // 4, len(base) + 1)] + some(rng, rng.randrange(3))
            rows.append((len(rows), " ".join(changed(rng, words, rng.randrange(0, 1 + len(words) // 15)))))
    df = spark.createDataFrame(rows, "_copy_row long, text string").repartition(4)
    ids = df.select(near_copies.F.col("_copy_row").alias("row"))
    got = {(r.u, r.v) for r in near_copies._prefix_candidates(ids, df).collect()}
    wanted = {
        (i, j)
        for j, b in rows
        for i, a in rows[:j]
        if a != b and a and b and 0.8 <= similarity(a, b) < 1
    }
    assert len(wanted) > 200 and got >= wanted and all(u < v for u, v in got)
    assert len(got) < len(rows) * (len(rows) - 1) / 4


def test_a_crowd_around_one_text_meets_it_first(spark, monkeypatch):
    # copies of a text, each changed apart, are near it but not each other; its id is the last
    rng, counted = random.Random(16), []
    words = some(rng, 300)
    rows = [(i, " ".join(changed(rng, words, 5))) for i in range(120)] + [(500, " ".join(words))]
    verified = near_copies._verified

    def watched(pairs, rows):
        counted.append(pairs.count())
        return verified(pairs, rows)

    monkeypatch.setattr(near_copies, "_verified", watched)
    left = [t for _, t in stage(spark, rows)]
    assert all(similarity(a, b) < 0.8 for i, a in enumerate(left) for b in left[:i])
    assert len(left) <= 3 and sum(counted) < 121 * 120 / 4


def test_columns_with_the_names_used_inside(spark):
    names = ["held", "_copy_row", "row", "n", "key", "bands", "u", "_mix_row", "_epoch", "epochs", "size"]
    rows = [(k, f"word{k} " * 3, "s", *[f"{name}{k}" for name in names]) for k in range(20)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    for out in (near_copies.keep_one_of_near_copies(df), mix(df)):
        assert out.columns == df.columns
        assert {tuple(r) for r in out.collect()} <= set(rows)
    assert sorted(map(tuple, near_copies.keep_one_of_near_copies(df).collect())) == sorted(rows)


def test_fingerprints_link_and_each_link_is_verified(spark, monkeypatch):
    # no two rows share a band, so what goes has met in the balls of fingerprints
    monkeypatch.setattr(near_copies, "bands", lambda hashes: [int(hashes.sum() >> np.uint64(1))] if len(hashes) else [0])
    rng, rows = random.Random(12), []
    for i in range(40):
        words = " ".join(some(rng, 1200))
        rows += [(2 * i, words + " end"), (2 * i + 1, words + " other")]
    fps = [majority(near_copies.shingles(t.encode())) for _, t in rows]
    assert all((a ^ b).bit_count() <= RADIUS for a, b in zip(fps[::2], fps[1::2]))
    rows += [(100, "a b"), (101, "a b c"), (102, None), (103, "")]
    assert sorted(d for d, _ in stage(spark, rows)) == [2 * i for i in range(40)] + [100, 101, 102]
    # one fingerprint for all: only texts with the similarity go
    monkeypatch.setattr(near_copies, "majority", lambda hashes: 7)
    kept = sorted(d for d, _ in stage(spark, rows))
    assert [d for d in kept if d % 2 == 0] == [2 * i for i in range(40)] + [100, 102] and 101 in kept
