"""Language-model scores against brute force over exact words."""

from __future__ import annotations

import collections
import math
import random
import re

import pytest

from buyerlens.llm import lm_score

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus() -> list[tuple[int | None, str | None]]:
    """4,000 different words, most of them in one text or two, and some in nearly all; copies, blanks and a single word."""
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choice((f"the{rng.randrange(5)}", f"Word{rng.randrange(5000)}")) for _ in range(60))) for k in range(200)]
    rows += [(1000, rows[3][1]), (rows[4][0], rows[4][1]), (None, "word1 once-only word1 once-only"), (1001, None), (1002, " \t"), (1003, "lonely")]
    return [*rows, (1004, "pair-a pair-b"), (1005, "x pair-a pair-b pair-a pair-b y"), (1006, "lonely pair-a")]


def expected(rows) -> list[tuple]:
    texts = [[w.lower() for w in WORD.findall(t or "")] for _, t in rows]
    single = collections.Counter(w for t in texts for w in t)
    pairs = collections.Counter(p for t in texts for p in zip(t, t[1:]))
    total, out = sum(single.values()), []
    for (doc_id, _), t in zip(rows, texts):
        own = collections.Counter(zip(t, t[1:]))
        score = math.log(single[t[0]] / total) if t else None
        for (a, b), n in own.items():
            others = pairs[a, b] - n
            score += n * math.log(others / single[a] if others else lm_score.BACKOFF * single[b] / total)
        out.append((doc_id if doc_id is not None else -1, len(t), score))
    return sorted(out, key=str)


@pytest.mark.parametrize("vocabulary", [0, 4, 300, 1 << 20])
def test_scores_are_those_of_exact_words(spark, vocabulary):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id if r.doc_id is not None else -1, r.n_words, r.log_score) for r in lm_score.lm_scores(docs, vocabulary).collect()), key=str)
    want = expected(rows)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for a, b in zip(got, want):
        assert a[2] == b[2] or a[2] == pytest.approx(b[2], rel=1e-9), (a, b)


def test_a_vocabulary_numbers_the_words_it_holds():
    rng = lm_score.np.random.default_rng(1)
    words = lm_score.np.unique(rng.integers(0, 1 << 63, 5000).astype(lm_score.U) * lm_score.U(2))
    found = lm_score._Vocabulary(words, lm_score.np.arange(len(words)) + 1, 10**9)
    assert found.numbers(words).tolist() == list(range(len(words)))[::-1]
    assert (found.numbers(words + lm_score.U(1)) == -1).all()
