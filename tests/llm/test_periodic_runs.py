"""Operator 11 against plain loops over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

pytest.importorskip("tickerloom.llm")

from tickerloom.llm import periodic_runs  # noqa: E402
from tickerloom.llm.tables import table  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(s):
    """Every maximal stretch of each period, smaller periods first."""
    out = {}
    for q in range(1, len(s) // 3 + 1):
        i = 0
        while i + q < len(s):
            if s[i] != s[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(s) and s[i] == s[i + q]:
                i += 1
            length = i - a + q
            if length >= max(24, 3 * q):
                out.setdefault((a, length), q)
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(i, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(i).encode())
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def expected(i, words):
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return (i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def sequences():
    rng = random.Random(8)
    out = [[], [1], [7] * 200, [1, 2] * 60 + [1], list(range(50)), [1] * 23, [1] * 24]
    for _ in range(150):
        s = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.randrange(4)
            if kind == 0:
                s += [rng.randrange(1000) for _ in range(rng.randrange(60))]
            elif kind == 1:
                s += [rng.randrange(2) for _ in range(rng.randrange(100))]
            else:
                root = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.choice([1, 2, 5, 7, 8, 9, 11, 12, 13, 17, 18, 19, 27, 28, 40, 63, 64, 100]))]
                if kind == 3:  # roots that nearly repeat themselves
                    root = root * 2 + root[: len(root) // 2]
                s += (root * 9)[: int(len(root) * rng.choice([2.5, 2.9, 3, 3.1, 4, 6]))]
        out.append(s)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    return [*out, fib[-1]]


def test_runs_match_plain_loops():
    s = sequences()
    expect = [plain_runs(x) for x in s]
    assert sum(len(x) for x in expect) > 200 and {q for x in expect for _, _, q in x} >= {1, 8, 9, 12, 13, 27, 28, 63, 64, 100}
    assert periodic_runs.find_runs([np.array(x, np.int64) for x in s]) == expect
    assert [periodic_runs.find_runs([np.array(x, np.int64)])[0] for x in s[:40]] == expect[:40]


def test_a_very_long_text_takes_little_time():
    rng = np.random.default_rng(1)
    root = rng.integers(0, 1000, 50_000)
    s = np.concatenate([np.tile(root, 4), np.tile(np.arange(9), 50_000), np.zeros(300_000, np.int64), rng.integers(0, 1000, 200_000)])
    found = periodic_runs.find_runs([s])[0]
    assert {(200_000, 50_000), (450_001, 9), (300_000, 1)} <= {(n, q) for _, n, q in found} and (0, 200_000, 50_000) in found


def test_query_matches_plain_loops_on_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    vocabulary = ["a", "é", "ß", "word", "Word", "x,", "数", "1"]
    texts = [" ".join(rng.choice(vocabulary[:k]) for _ in range(rng.randrange(0, 220))) for k in (1, 2, 3, 5, 8, 8, 8) for _ in range(25)]
    texts += ["the line\n" * 40, "a b c d e f g h i j\tk " * 9, None, "", " \x0b\f\r\n\t ", "x" * 200_000, "one two three " * 20_000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4]), (None, None)]
    spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, runs int, collapsed string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic_runs.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = [(i, t) for i, t in rows if len(t or "") < 100_000]
    expect = [expected(i, WORD.findall(t or "") if i is None else planted(i, t)) for i, t in short]
    long_ids = {i for i, t in rows if len(t or "") >= 100_000}
    found = [tuple(r) for r in got.collect()]
    assert sorted((r for r in found if r[0] not in long_ids), key=str) == sorted(expect, key=str)
    assert {r[0]: r[4] for r in found if r[0] in long_ids} == {180: None, 181: 3}
    assert sum(r[1] > 0 for r in expect) > 20


def test_operator_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c " * 10, "k", None)], "doc_id long, text string, lang string, n_words int")
    row = periodic_runs.periodic_runs(docs).collect()[0]
    assert (row.doc_id, row.lang, row.n_words, row.collapsed) == (1, "k", 30, "a b c") and [tuple(x) for x in row.runs] == [(0, 30, 3)]
    assert periodic_runs.periodic_runs(docs.where("1 = 0")).collect() == []


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_query_matches_plain_loops_on_the_test_tables(spark):
    at = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, at, "documents").select("doc_id", "text").collect() if len(r.text or "") < 9000]
    found = {r[0]: tuple(r) for r in periodic_runs.op11_periodic_runs(spark, at).collect()}
    assert len(docs) > 150
    for i, t in docs:
        assert found[i] == expected(i, planted(i, t))
