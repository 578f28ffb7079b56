"""Piece encoding against the library it must agree with, and against a plain merge loop."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

import sparkmart.llm.pieces as pieces
from sparkmart.llm.pieces import PieceCoder, decode_pieces, encode_pieces, piece_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "a", " a", "Hello  wor\tld\n\n ▁x 你好 \x00 \U0001f600 é ﬁ Ａ", "<s> </s> <unk> <0x0A>",
    "▁▁", "a▁b", "\n", "\r\n \t x", "   lead and trail   ", "aaaa" * 5000, " " * 3000, "日本語" * 800, "é ‍﻿",
]


def plain_merges(coder, text):
    """The same merges without an agenda: look at all neighbours again after each merge."""
    symbols = list(text)
    while True:
        known = [(coder.cost[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in coder.cost]
        if not known:
            return symbols
        at = min(known)[1]
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]


def some_texts():
    rng = random.Random(13)
    kinds = ["abcdefghij ", "etaoin \n", "àéîö ss", "0123456789.,-", "你好世界 ", "▁ \t", "({[]})=;\n  ", "\U0001f600\U0001f1e9\U0001f1ea‍ "]
    return ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(1, 300))) for _ in range(400)]


def test_agenda_equals_library():
    with open(PATH, "rb") as file:
        coder = PieceCoder(file.read())
    for text in TEXTS + some_texts():
        ids = coder.library.encode(text)
        assert coder.encode(text) == ids, text[:80]
        assert coder.decode(ids) == coder.library.decode(ids)
        assert coder.text_digest(text) == (len(ids), ",".join(map(str, ids)), coder.library.decode(ids))
    for text in some_texts()[:60]:
        assert coder.merges(text) == plain_merges(coder, text)


def test_a_remembered_chunk_is_its_ids_as_text():
    with open(PATH, "rb") as file:
        coder = PieceCoder(file.read())
    for text in TEXTS + some_texts():
        assert coder.text_digest(text) == coder.text_digest(text)
    for chunk, ids in coder.held.items():  # no second copy of the chunk: only what decodes to itself is remembered
        assert ids == ",".join(map(str, coder.chunk_ids(chunk))) and coder.plain(coder.chunk_ids(chunk)) == chunk
    coder.held.clear()
    coder.byte_ids = {}  # unknown signs do not decode to themselves
    n, ids, plain = coder.text_digest("a \U000e0041 a \U000e0041")
    assert n == ids.count(",") + 1 and coder.unknown_text in plain and not any("\U000e0041" in c for c in coder.held)


def test_ids_that_no_text_has():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    with open(PATH, "rb") as file:
        coder = PieceCoder(file.read())
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(1, 12))]
        try:
            theirs = library.decode(ids)
        except UnicodeDecodeError:
            continue
        if "�" not in theirs:  # bytes that are no text: how many signs stand for them is not fixed
            assert coder.decode(ids) == theirs


def test_pieces_not_to_be_used_fall_apart():
    with open(PATH, "rb") as file:
        coder = PieceCoder(file.read())
    whole = coder.merges("▁the")
    assert whole == ["▁the"]
    coder.unused.add("▁the")
    assert "".join(coder.merges("▁the")) == "▁the" and len(coder.merges("▁the")) > 1


@pytest.mark.parametrize("held", [1 << 18, 2])
def test_documents(spark, monkeypatch, held):
    monkeypatch.setattr(pieces, "HELD_CHUNKS", held)
    monkeypatch.setattr(pieces, "GROUP", 500)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(k, t, "ids", 1) for k, t in enumerate(TEXTS + some_texts()[:60])]
    rows += [(None, "no id", "x", 2), (9000, None, None, None), (3, "twice", "", 0), (3, "twice", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, agrees int").repartition(3)
    got = piece_digests(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
    want = []
    for doc, text, *_ in rows:
        ids = library.encode(text or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.append((doc, len(ids), *sha, True))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    tokens = encode_pieces(docs, PATH)
    back = {(r.doc_id, r.text) for r in decode_pieces(tokens, PATH).collect()}
    assert back == {(doc, library.decode(library.encode(text or ""))) for doc, text, *_ in rows}
    assert piece_digests(docs.limit(0), PATH).collect() == []


def test_odd_id_lists(spark):
    tokens = spark.createDataFrame([(1, None), (2, []), (None, [None, 29872]), (2, [])], "doc_id long, ids array<int>")
    got = sorted(((r.doc_id or 0), r.text) for r in decode_pieces(tokens, PATH).collect() if r.doc_id != 1)
    assert [g[0] for g in got] == [0, 2, 2] and got[1][1] == ""
    assert [r.text for r in decode_pieces(tokens.where("doc_id = 1"), PATH).collect()] == [None]


def test_no_model(spark):
    with pytest.raises(OSError):
        encode_pieces(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "/nowhere/model")
