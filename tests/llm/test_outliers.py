"""Robust outliers where junk that passes the base rules holds up to 45 percent of a language and source."""

import random

import pytest

from sparkmart.llm.outliers import quality_verdicts

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("copies", [False, True])
def test_much_junk(spark, copies):
    rng, rows, junk_ids = random.Random(11), [], set()
    for share in (0, 26, 30, 33, 40, 45):
        for i in range(400):
            doc, junk = 1000 * share + i, i < 4 * share
            same = random.Random(share) if copies and junk else rng
            words = [f"w{same.randrange(400)}" for _ in range(same.randrange(60, 160))]
            if junk:
                words = [w + "#%" * same.randrange(1, 3) for w in words]
                junk_ids.add(doc)
            elif rng.random() < 0.3:
                words[rng.randrange(len(words))] += "&"
            rows.append((doc, " ".join(words), "en", f"junk {share}"))
    got = quality_verdicts(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == junk_ids
