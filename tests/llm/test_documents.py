"""Operators on documents against brute force, with nulls, repeats, ties, extra columns and empty tables."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import sparkmart.llm.decontaminate as decon
from sparkmart.llm.components import connected_components
from sparkmart.llm.decontaminate import contaminated, decontaminate, errors_in, plain_words, seed_masks
from sparkmart.llm.mixing import mix, mix_plan
from sparkmart.llm.outliers import keep_good, quality_verdicts
from sparkmart.llm.sharding import byte_shards
from sparkmart.llm.simhash import RADIUS, near_duplicate_components

# names that operators use themselves
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, _row string, shard int, kept string, fp string"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, lg, s, 0, 1, "r", 2, "k", "f") for d, t, lg, s in rows], SCHEMA).repartition(3)


def words(text):
    return (text or "").encode().split()


ODD = [
    (None, None, None, None),
    (None, "", "en", None),
    (1, "a b c", None, "s1"),
    (1, "a b c", None, "s1"),
    (2, "x\x85y z\x1c w " * 4000, "en", "s2"),
    (3, "ä ö\tü\n\nß", "de", ""),
]


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(n):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40, 160)))
        rows.append((k, text, rng.choice(["en", "de"]), f"s{rng.choice([0, 0, 0, 1, 2, 3, 4])}"))
    return rows


# -- sharding ------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [ODD, corpus(1), [(7, "same text", "en", "s")] * 50, [(1, "long " * 9999, "en", "s"), (2, "a", "en", "s")]])
def test_shards(spark, rows):
    got = byte_shards(docs(spark, rows)).collect()
    size = lambda t: len((t or "").encode()) + 1
    line = sorted((d is not None, d or 0, zlib.crc32((t or "").encode()), size(t)) for d, t, _, _ in rows)
    total, before, slots, want = sum(x[3] for x in line), 0, Counter(), []
    for some, d, crc, n in line:
        shard = before * 8 // total
        want.append((d if some else None, n, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += n
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_shards_of_nothing(spark):
    assert byte_shards(docs(spark, ODD).limit(0)).collect() == []


# -- mixing --------------------------------------------------------------------------------------


def targets(sizes):
    """Resharing round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return {**{s: 2.0 * sizes[s] for s in full}, **share}
        full |= over


@pytest.mark.parametrize("rows", [ODD, corpus(2), [(7, "same text here", "en", "s")] * 40 + corpus(3, 20)])
def test_mix(spark, rows):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    goal = targets(sizes)
    by_source = defaultdict(list)
    rows_ = [(i, t, lg, s) for i, (_, t, lg, s) in enumerate(rows)]  # to tell sources apart
    for r in mix_plan(docs(spark, rows_)).collect():
        by_source[rows[r.doc_id][3]].append(r)
        assert r.size == len(words(rows[r.doc_id][1])) and 0 <= r.taken <= 2 * r.size
    for source, got in by_source.items():
        assert got[0].source_size == sizes[source] and got[0].target == pytest.approx(goal[source])
        assert sum(r.taken for r in got) == math.floor(got[0].target)
    plan = lambda: sorted(map(tuple, mix_plan(docs(spark, rows)).collect()), key=repr)
    assert plan() == plan()  # whatever the partitions
    mixed = mix(docs(spark, rows))
    assert mixed.columns == docs(spark, rows).columns
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r.source] += len(words(r.text))
    longest = {s: max(len(words(t)) for _, t, _, s_ in rows if s_ == s) for s in sizes}
    for source in sizes:
        assert abs(taken[source] - goal[source]) <= longest[source] / 2 + 1


def test_mix_of_nothing(spark):
    assert mix(docs(spark, ODD).limit(0)).collect() == []
    assert mix_plan(docs(spark, [(1, "", "en", "s")])).collect()[0].taken == 0


# -- quality -------------------------------------------------------------------------------------


def statistics(text):
    ws = words(text)
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    counts, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            inside.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if words(x)]
    chars = sum(len(w.decode()) for w in ws)
    return len(ws), chars, sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_quality(spark):
    clean = corpus(4, 400)
    repeated = [(1000 + i, "\n".join([f"line {i} of a page with many words in it"] * 3 + [f"u{i}{j}" for j in range(60)]), "en", "s0") for i in range(3)]
    junk = [(2000 + i, " ".join(f"w{j}###%%%" for j in range(i, i + 90)), "de", "s0") for i in range(12)]
    loop = [(3000, "a b c d " * 40, "en", "s1")]
    rows = clean + repeated + junk + loop + ODD
    got = quality_verdicts(docs(spark, rows)).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = sorted(((d, *statistics(t)) for d, t, _, _ in rows), key=repr)
    assert sorted(((r.doc_id, *[r[f] for f in fields]) for r in got), key=repr) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    by_id = {r.doc_id: r for r in got}
    assert not any(by_id[d].kept for d, *_ in junk)
    assert all(by_id[d].kept for d, *_ in clean if not by_id[d].base_failed and d not in (1, 2, 3))
    kept = keep_good(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert quality_verdicts(docs(spark, rows).limit(0)).collect() == [] == keep_good(docs(spark, rows).limit(0)).collect()


def test_quality_without_any_good_text(spark):
    assert [r.kept for r in quality_verdicts(docs(spark, ODD[:2])).collect()] == [False, False]


# -- near duplicates -----------------------------------------------------------------------------


def fingerprint(text):
    ws = words((text or "").lower() if (text or "").isascii() else "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not ws:
        return 0
    shingles = [b" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark):
    rng = random.Random(5)
    rows = corpus(5, 40) + ODD
    for base in range(3):  # many near copies of one text: crowded groups
        ws = rows[base][1].split(" ")
        for i in range(40):
            copy = list(ws)
            copy[rng.randrange(len(ws))] = f"new{i % 7}"
            rows.append((100 + 50 * base + i, " ".join(copy), "en", "s"))
    got = near_duplicate_components(docs(spark, rows)).collect()
    prints = [fingerprint(t) for _, t, _, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= RADIUS:
            root[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            k = find(i)
            least[k] = d if least[k] is None else min(d, least[k])
    want = [(d, f"{prints[i]:016x}", least[find(i)]) for i, (d, *_) in enumerate(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert near_duplicate_components(docs(spark, rows).limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}


# -- decontamination -----------------------------------------------------------------------------


def covered(doc, item):
    """Words of the document in any window, on any diagonal, with enough words equal to the item's."""
    d, b = plain_words((doc or "").encode()), plain_words((item or "").encode())
    window, out = min(13, len(b)), set()
    if len(b) < 5:
        return out
    for i in range(len(d) - window + 1):
        for j in range(len(b) - window + 1):
            if sum(x == y for x, y in zip(d[i : i + window], b[j : j + window])) >= window - errors_in(window):
                out.update(range(i, i + window))
    return out


@pytest.mark.parametrize("block,piece", [(1_000_000, 50_000), (30, 20)])
def test_decontamination(spark, block, piece, monkeypatch):
    monkeypatch.setattr(decon, "BLOCK_WORDS", block)
    monkeypatch.setattr(decon, "PIECE_WORDS", piece)
    rng = random.Random(8)
    vocabulary = ["The", "of", "and", "a"] + [f"v{i}" for i in range(60)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(n))) for i, n in enumerate([4, 5, 6, 9, 12, 13, 14, 30, 40, 55])] + [(90, None), (91, ""), (None, " ".join(some(20)))]
    rows = [(i, t, "en", "s") for i, (_, t) in enumerate([(0, " ".join(some(60))) for _ in range(20)])] + ODD[:3]
    for k in range(40):
        passage = rng.choice(items[1:10])[1].split(" ")
        start = rng.randrange(max(1, len(passage) - 13))
        passage = passage[start : start + rng.randrange(5, 30)]
        for _ in range(rng.randrange(4)):
            passage[rng.randrange(len(passage))] = rng.choice(["zz", "The"])
        rows.append((200 + k, " ".join(some(9)) + ", " + " ".join(passage).upper() + "! " + " ".join(some(9)), "en", "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated(docs(spark, rows), bench).collect()
    got = {(r.doc_id, r.item_id): (r.n_words, r.first_word) for r in found}
    words = {(d, i): covered(t, b) for d, t, _, _ in rows for i, b in items}
    want = {key: (len(w), min(w)) for key, w in words.items() if w}
    assert got == want and len(want) > 15 and len(found) == len(got)
    kept = decontaminate(docs(spark, rows), bench)
    assert kept.columns == docs(spark, rows).columns
    bad = {d for d, _ in want}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, *_ in rows if d not in bad)
    assert contaminated(docs(spark, rows), bench.limit(0)).collect() == []
    assert contaminated(docs(spark, rows).limit(0), bench).collect() == []


@pytest.mark.parametrize("window,errors,weight", [(13, 2, 6), (13, 2, 5), (10, 1, 5)])
def test_masks_lose_nothing(window, errors, weight):
    masks = seed_masks(window, errors, weight)
    for placing in itertools.combinations(range(window), errors):
        assert any(not {at + x for x in m} & set(placing) for m in masks for at in range(window - m[-1]))
    assert np.all([m[0] == 0 and len(m) == weight for m in masks])
