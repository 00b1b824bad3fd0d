"""Operator 5: scores don't depend on how the input lies in partitions."""

import random

import pytest

pytest.importorskip("tickerloom.llm")

from tickerloom.llm import lm_score  # noqa: E402


def test_scores_are_the_same_in_any_layout(spark, monkeypatch):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    rows = []
    for i in range(600):
        at, words = rng.randrange(300), []
        for _ in range(rng.randrange(1, 120)):
            at = (at * 7 + rng.randrange(4)) % 300  # the next word follows from the last but for a few bits
            words.append(vocabulary[at])
        rows.append((i, " ".join(words)))
    rows += [(None, "a b"), (700, None), (700, ""), (5, rows[5][1]), (5, "another text of one id")]
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 5000)
    found = []
    for parts in (1, 3, 16):
        rng.shuffle(rows)
        got = lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), 50, 20).collect()
        found.append(sorted(((r.doc_id or -1, r.n_tokens, r.n_known, r.held_out, round(r.base_score, 6)), r.score) for r in got))
    for other in found[1:]:
        assert [x[0] for x in other] == [x[0] for x in found[0]]
        assert max(abs(a[1] - b[1]) / a[0][1] for a, b in zip(found[0], other, strict=True)) < 1e-6
    held = [(k[4], s, k[1]) for k, s in found[0] if k[3]]
    assert sum(s for _, s, _ in held) / sum(n for _, _, n in held) > sum(b for b, _, _ in held) / sum(n for _, _, n in held)
