"""Toxicity, host reputation, and the contracts of queries and pipeline."""

import random
import zlib

import numpy as np
import pytest

import sparkmart.llm.toxicity as toxicity

from sparkmart.llm import ORACLES, QUERIES
from sparkmart.llm.host_reputation import judge_urls
from sparkmart.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score double, toxic int"


def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(1)
    vocabulary = [f"{a}{b}{c}" for a in ("ba", "ke", "lo", "mi", "nu") for b in ("ra", "se", "ti") for c in ("n", "m", "")]
    rows, labels = [], []
    for k in range(900):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 80))]
        toxic = k % 5 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["Grubble", "snorkish!!", "GRUBBLE###"])
        rows.append((k, " ".join(text), 0.0, 0))
        labels.append((k, 1, int(toxic)))
    rows += [(None, None, 0.0, 0), (5000, "", 0.0, 0), (5001, "grubble " * 50_000, 0.0, 0), (5, rows[5][1], 0.0, 0)]
    labels += [(None, 1, 1), (7, None, None), (9999, 0, 1)]
    frame = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity_scores(frame, marks).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    known = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.held_out]
    assert sum(r.predicted != int(r.doc_id % 5 == 0) for r in known) <= 0.02 * len(known)
    assert next(r for r in got if r.doc_id == 5001).predicted == 1
    assert next(r for r in got if r.doc_id == 5000).predicted == 0
    # no labels, no documents
    assert {r.score for r in toxicity_scores(frame, marks.limit(0)).collect()} == {0.5}
    assert toxicity_scores(frame.limit(0), marks).collect() == []


def area_under_curve(scores, truth):
    good, bad = [s for s, t in zip(scores, truth) if t], [s for s, t in zip(scores, truth) if not t]
    return sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("sf,least,found", [("sf0.01", 0.9, 0.6), ("sf0.1", 0.96, 0.8)])
def test_toxicity_of_the_tables(spark, sf, least, found):
    """A model at every size: held-out labels are told apart, and few clean texts are called toxic."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    marked = labels.groupBy("doc_id").agg({"toxic": "max"}).withColumnRenamed("max(toxic)", "toxic")
    got = toxicity_scores(docs, labels).where("held_out").join(marked, "doc_id").where("toxic is not null").collect()
    assert area_under_curve([r.score for r in got], [r.toxic for r in got]) >= least
    toxic, clean = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert sum(r.predicted for r in toxic) >= found * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def toxic_words(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "nu") for b in ("ra", "se", "ti")]
    texts = [[rng.choice(words) for _ in range(20)] for _ in range(n)]
    for k in range(0, n, 4):
        texts[k][rng.randrange(20)] = "snorkish"
    return [(k, " ".join(t), 0.0, 0) for k, t in enumerate(texts)], [(k, 1, int(k % 4 == 0)) for k in range(n)]


def test_a_repeated_id_does_not_crowd_out_the_others(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TRAIN", 300)
    rows, labels = toxic_words(3, 400)
    first = next(k for k in range(1, 400) if zlib.crc32(str(k).encode()) % 4 != 2 and k % 4)
    frame = spark.createDataFrame([rows[first]] * 2000 + rows, DOCS).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity._training_rows(frame, marks, ~toxicity.held_out()).count() <= 300
    held = [r for r in toxicity_scores(frame, marks).collect() if r.held_out]
    assert sum(r.predicted for r in held if r.doc_id % 4 == 0) >= 0.95 * sum(r.doc_id % 4 == 0 for r in held)
    assert not any(r.predicted for r in held if r.doc_id % 4)


def test_counts_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MIN_DOCS", 1)
    rows, labels = toxic_words(4, 60)
    rows += [(rows[5][0], rows[5][1], 0.0, 0), (rows[5][0], None, 0.0, 0), (rows[7][0], "snorkish", 0.0, 0)]
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    marks = spark.createDataFrame([*labels, (7, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity._counts(toxicity._training_rows(frame, marks, ~toxicity.held_out()))
    want = np.zeros_like(got)
    for doc, text in {(r[0], r[1] or "") for r in rows}:
        if zlib.crc32(str(doc).encode()) % 4 != 2:
            plain = " " + " ".join("".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).split()) + " "
            grams = {plain[i : i + n] for n in toxicity.ORDERS for i in range(len(plain) - n + 1)}
            ids = {hash_of(g) for g in grams}
            want[int(doc % 4 == 0 or doc == 7), sorted(ids)] += 1
    assert (got == want).all()


def hash_of(gram):
    key = len(gram)
    for c in gram:
        key = (key * 0x100000001B3 ^ ord(c)) % (1 << 64)
    return (key * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - toxicity.HASH_BITS)


def test_urls(spark):
    urls = {
        1: ("https://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
        2: ("http://example.org/en/1x?q=/es/", "example.org", "/en/1x", "example.org/en/1", "block"),
        3: ("http://example.org", "example.org", "", None, None),
        4: ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        5: ("ftp://x.com/fr/#a://b", "x.com", "/fr/", "com/fr/", "allow"),
        6: ("//x.com/de/", "", "", None, None),
        7: (None, "", "", None, None),
        8: ("http://x.com?u=http://y.org/", "x.com", "", None, None),
        9: ("http://shop.co.uk:80/a\nb", "shop.co.uk:80", "/a\nb", None, None),
    }
    rows = [(k, v[0], "html", "x") for k, v in urls.items()]
    rows += [(100 + i, "http://bad.net/x", "", "") for i in range(30)]
    rows += [(None, "http://x.com/de/2", "", ""), (5, urls[5][0], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    rules = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
    got = judge_urls(pages, rules).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id in urls:
            _, host, path, rule, verdict = urls[r.page_id]
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert verdict in (None, r.verdict) and r.verdict in ("allow", "block")
    assert judge_urls(pages.limit(0)).collect() == []


def test_reputation_follows_labels_and_shrinks(spark):
    rows = [(i, f"http://a.good.net/ok/{i}", "") for i in range(50)] + [(50, "http://a.good.net/other", ""), (51, "http://new.good.net/other", "")]
    rows += [(100 + i, f"http://a.evil.net/no/{i}", "") for i in range(50)] + [(150, "http://a.evil.net/other", ""), (151, "http://new.evil.net/other", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in judge_urls(pages, (("net/ok/", "allow"), ("net/no/", "block"))).collect()}
    assert (got[50], got[150]) == ("allow", "block")
    assert (got[51], got[151]) == ("allow", "block")  # hosts without labels lean on their domain


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_sql(spark, name):
    from oracle import compare, connect

    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_pipeline_keeps_columns_and_runs(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and now, name
        assert stage(spark, before.limit(0), SF).count() == 0, name
        ids = now
    shards = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in shards} == ids and {r.shard for r in shards} == set(range(8))
    totals = [sum(r.size for r in shards if r.shard == k) for k in range(8)]
    assert max(totals) - min(totals) <= 2 * max(r.size for r in shards)
