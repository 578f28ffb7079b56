from collections import defaultdict

import pytest

from sparkmart.llm.quotes import reply_ordered

SCHEMA = "conv_id long, turn long, role string, text string, position long, _row string"


def rows_of(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    return {(r.conv_id, r.turn, r.role): r for r in reply_ordered(df).collect()}


THREAD = [
    (1, 0, "a", "Shall we meet on Monday?\nOr on Tuesday?"),
    (1, 1, "b", "A different matter: the report is late."),
    (1, 2, "c", "On Friday a wrote:\n> shall  WE meet on monday?\n\nYes, gladly."),
    (1, 3, "d", "> A different matter: the report is late.\nIt came today."),
    (1, 4, "a", ">> Shall we meet on Monday?\n> Yes, gladly.\nThen it is settled."),
    (1, 5, "e", "> nobody ever said this\nIndeed."),
    (2, 0, "a", "> Shall we meet on Monday?\nAnother conversation."),
]


def test_links_levels_and_order(spark):
    got = rows_of(spark, THREAD)
    assert got[1, 2, "c"].reply_to == 0 and got[1, 2, "c"].text == "Yes, gladly."
    assert got[1, 3, "d"].reply_to == 1
    # the shallowest passage decides: level 1 quotes turn 2, level 2 turn 0
    last = got[1, 4, "a"]
    assert (last.reply_to, last.thread, last.depth, last.n_quotes, last.n_linked) == (2, 0, 2, 2, 2)
    # unknown passages are removed and link nothing; other conversations are not searched
    assert got[1, 5, "e"].reply_to is None and got[1, 5, "e"].n_quotes == 1 and got[1, 5, "e"].text == "Indeed."
    assert got[2, 0, "a"].reply_to is None and got[2, 0, "a"].depth == 0
    order = sorted((r for k, r in got.items() if k[0] == 1), key=lambda r: r.position)
    assert [r.position for r in order] == list(range(6))
    assert [r.turn for r in order] == [0, 2, 4, 1, 3, 5]


def test_nulls_repeats_and_empty(spark):
    rows = [
        (None, None, None, None),
        (None, 0, "a", "x"),
        (3, 0, "a", "same words"),
        (3, 0, "a", "same words"),
        (3, 1, "b", "> same words\n" + "> same words\n" * 3000),
    ]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)
    got = reply_ordered(df).collect()
    assert len(got) == 5
    assert sorted(r.position for r in got if r.conv_id == 3) == [0, 1, 2]
    reply = next(r for r in got if r.role == "b")
    assert reply.reply_to == 0 and reply.text == "" and reply.n_quotes == 1
    assert reply_ordered(df.limit(0)).collect() == []


def brute(rows):
    """Parent of each message by searching its passages, as text, in all earlier ones; lines where no text has them."""
    plain = lambda s: " ".join(s.lower().split())
    own = {(c, t): [x for x in other.split("\n") if not x.lstrip(" \t").startswith(">")] for c, t, _, other in rows}
    out = {}
    for conv, turn, role, text in rows:
        passages, level = [], 0
        for line in text.split("\n"):
            depth, rest = 0, line
            while rest.lstrip(" \t").startswith(">"):
                rest, depth = rest.lstrip(" \t")[1:], depth + 1
            if not plain(rest):
                continue
            if depth and depth != level:
                passages.append((depth, []))
            level = depth
            if depth:
                passages[-1][1].append(plain(rest))
        best = []
        for depth, lines in passages:
            whole = [t for (c, t), said in own.items() if c == conv and t < turn and f" {' '.join(lines)} " in f" {plain(' '.join(said))} "]
            if whole:
                best.append((-depth, (sum(map(len, lines)), max(whole))))
                continue
            votes = defaultdict(int)
            for line in lines:
                first = min((t for (c, t), said in own.items() if c == conv and line in map(plain, said)), default=turn)
                if first < turn:
                    votes[first] += len(line)
            if votes:
                best.append((-depth, max((n, t) for t, n in votes.items())))
        out[conv, turn, role] = max(best)[1][1] if best else None
    return out


def test_the_message_that_holds_the_whole_passage(spark):
    rows = [
        (1, 0, "a", "Hello all,\nThanks in advance"),
        (1, 1, "b", "Hello all,\nThe fix\nThanks in advance"),
        (1, 2, "c", "> Hello all,\n> The fix\n> Thanks in advance\nIt works."),
        # another width, and the middle of a line
        (1, 3, "d", "> hello all, the\n> fix   thanks\n> in advance\nSame here."),
        (1, 4, "e", "> fix Thanks\nWhich one?"),
        # said by two: the latest of them; and one that only says it in a quote does not hold it
        (1, 5, "f", ">> Hello all,\n> Same here.\nAgreed."),
        (1, 6, "g", "> Hello all, The fix Thanks in\n> advance and more\nHm."),
        (1, 7, "h", "> The fix\n\n> Thanks in advance\nOne passage with a blank line."),
    ]
    got = {t: r.reply_to for (_, t, _), r in rows_of(spark, rows).items()}
    assert got == {k: v for (_, k, _), v in brute(rows).items()}
    assert (got[2], got[3], got[4], got[5], got[7]) == (1, 1, 1, 3, 1)


@pytest.mark.parametrize("seed", range(3))
def test_passages_by_brute_force(spark, seed):
    """Longer texts of few words, quoted at other widths, at several levels, whole or in part."""
    import random

    rng = random.Random(seed)
    words = "yes no we go to it and the".split()
    rows = []
    for conv in range(5):
        said = []
        for turn in range(9):
            text = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 5))]
            lines = list(text)
            for level in range(rng.randrange(0, 3)):
                if said:
                    source = " ".join(rng.choice(said)).split()
                    a = rng.randrange(len(source))
                    cut, width = source[a : a + rng.randrange(1, 20)], rng.randrange(1, 6)
                    quoted = [">" * (level + 1) + " " + "  ".join(cut[i : i + width]) for i in range(0, len(cut), width)]
                    lines = quoted + lines
            said.append(text)
            rows.append((conv, turn, "u", "\n".join(lines)))
    want = brute(rows)
    assert {k: r.reply_to for k, r in rows_of(spark, rows).items()} == want
    assert sum(v is not None for v in want.values()) > 10


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    import random

    rng = random.Random(seed)
    said = ["alpha beta", "gamma", "delta epsilon zeta", "eta", "theta iota"]
    rows = []
    for conv in range(6):
        for turn in range(8):
            lines = [rng.choice(["", "", "> ", ">> ", "> > > "]) + rng.choice(said) for _ in range(4)]
            rows.append((conv, turn, "u", "\n".join(lines)))
    want = brute(rows)
    got = {k: r.reply_to for k, r in rows_of(spark, rows).items()}
    assert got == want
