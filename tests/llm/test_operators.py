"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("tickerloom.llm")

from tickerloom.llm import decontaminate, language_id, lm_score, media, packing, quality, relative_lz, secret_scan, simhash_dedup, substring_dedup, token_counts  # noqa: E402
from tickerloom.llm import words as W  # noqa: E402
from tickerloom.llm import components as components_module  # noqa: E402
from tickerloom.llm.components import components  # noqa: E402

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, block int, fp long, label string"


def texts() -> list[tuple]:
    """Random prose over a small vocabulary, so that runs repeat, with every odd case."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    long = " ".join(rng.choice(vocabulary) for _ in range(20_000))
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    rows = []
    for i in range(60):
        body = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 120)))
        if i % 5 == 0:
            body = f"{body} {passage}\n{body}"
        rows.append((i * 3, body.title() if i % 7 == 0 else body))
    rows += [(1000, None), (1001, ""), (1002, " \t\n\r\x0b\f "), (1003, long), (1004, long), (1004, long), (None, passage), (7, passage), (1005, " x　 😀 1"), (1006, "1234 !!")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if n % 9 == 0 else ("aa", "bb")[n % 2], None if n % 4 == 0 else f"src/{n % 3}", None if t is None else len(t), "x", 1, 2, "y") for n, (i, t) in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def empty(docs):
    return docs.where("1 = 0")


def same(got, expected):
    assert collections.Counter(got) == collections.Counter(expected)


def test_words_and_hashes():
    t = ["Ab  c\té", None, "", "x" * 3000, "Ab c"]
    w = W.Words(pa.array(t), W.SPACE_WORD, lower=True)
    assert np.diff(w.first).tolist() == [3, 0, 0, 1, 2]
    h = w.hashes()
    assert h[0] == h[4] and h[1] == h[5] and len(set(h.tolist())) == 4
    assert W.sliding_min(np.array([5, 3, 4, 9, 1, 7], np.uint64), 3).tolist() == [3, 3, 1, 1]


def thue_morse(n: int) -> tuple[str, str]:
    """Two words that any polynomial hash modulo a power of two takes for one."""
    bits = [i.bit_count() % 2 for i in range(n)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def test_hashes_tell_structured_words_apart_and_codes_compare_words(monkeypatch):
    long = [x for n in (64, 200, 256, 257, 1024, 2048) for x in thue_morse(n)]
    w = W.Words(pa.array([" ".join(long), " ".join(long)]), W.SPACE_WORD)
    assert len(set(w.hashes().tolist())) == len(long)
    hashes = W.span_hashes
    monkeypatch.setattr(W, "span_hashes", lambda b, s, e, seed=0: hashes(b, s, e, seed) & np.uint64(15 if seed < 2 else 2**64 - 1))
    _, code = w.codes()
    assert len(set(code.tolist())) == len(long) and (code[: len(long)] == code[len(long) :]).all()


def naive_factors(runs: list[list], ids: list[int], size: int) -> set:
    """(run, start, length) of greedy factors, by scanning every reference for every cursor."""
    out = set()
    for r, own in enumerate(runs):
        at = 0
        while at + size <= len(own):
            best = None
            for i, other in sorted((ids[k], other) for k, other in enumerate(runs) if ids[k] < ids[r]):
                for p in range(len(other) - size + 1):
                    n = 0
                    while at + n < len(own) and p + n < len(other) and own[at + n] == other[p + n]:
                        n += 1
                    if n >= size and best is None:  # the earliest reference that has the window
                        best = (i, n)
            if best is None:
                at += 1
            else:
                out.add((r, at, best[1]))
                at += best[1] - size + 1
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_relative_lz_matches_a_naive_parser(monkeypatch, weak):
    rng = random.Random(12)
    base = [[rng.randrange(50) for _ in range(40)] for _ in range(5)]
    runs = [*base]
    for _ in range(25):
        own = []
        for _ in range(rng.randrange(1, 6)):
            b = rng.choice(base)
            a = rng.randrange(35)
            own += b[a : a + rng.randrange(2, 20)]
        runs.append(own)
    ids = [rng.randrange(1000) * 31 + i for i in range(len(runs))]
    if weak:  # windows that share a hash are found out by comparing words
        rolled, calls = W.rolled, []
        monkeypatch.setattr(W, "rolled", lambda h, n: (calls.append(1), rolled(h, n) & np.uint64(3 if len(calls) < 3 else 2**64 - 1))[1])
    first = np.append(0, np.cumsum([len(r) for r in runs]))
    begin, length, source = relative_lz.parse(np.concatenate(runs).astype(np.int64), first, np.array(ids), 4)
    got = {(int(np.searchsorted(first, b, "right") - 1), int(b - first[np.searchsorted(first, b, "right") - 1]), int(n)) for b, n in zip(begin, length, strict=True)}
    # of several places in the earliest reference any may be the source, so lengths may differ; coverage may not
    cover = lambda factors: {(r, a + i) for r, a, n in factors for i in range(n)}
    expected = naive_factors(runs, ids, 4)
    assert cover(got) == cover(expected) and len(got) > 20
    every = np.concatenate(runs)
    assert all((every[b : b + n] == every[s : s + n]).all() for b, n, s in zip(begin, length, source, strict=True))


def test_few_words_alone_in_a_chunk(spark):
    """Texts of all numbers of words below and above a window's, each alone in its batch."""
    values = W.mix(np.arange(14, dtype=np.uint64))
    for n in range(15):
        for size in range(1, 15):
            assert W.sliding_min(values[:n], size).tolist() == [values[i : i + size].min() for i in range(min(n, 14) - size + 1)]
    words = [f"w{i}" for i in range(14)]
    rows = [(100 * copy + n, " ".join(words[:n])) for copy in range(2) for n in range(15)]
    deal = substring_dedup.Deal(48, 13, [])
    for n in range(15):
        chunk = pa.RecordBatch.from_pydict({"doc_id": [n], "text": pa.array([rows[n][1]], pa.string())})
        (batch,) = substring_dedup._batches([chunk], 13, deal)
        assert sum(batch["loads"].to_pylist()[0]) == max(0, n - 12)
        assert len(list(substring_dedup._offer([batch], deal))) == (n > 12)
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(30)).collect()}
    assert got == {i: 13 if i == 14 else i - 100 if i in (113, 114) else 0 for i, _ in rows}


def test_substring_dedup_tells_structured_words_apart(spark):
    a, b = thue_morse(2048)
    rest = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame([(1, " ".join([*rest, a])), (2, " ".join([*rest, b])), (3, " ".join([*rest, a]))], "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_duplicates(docs).collect()} == {1: 0, 2: 0, 3: 13}


def test_substring_rows_grow_with_the_input(monkeypatch):
    """Rows for blocks at two sizes, with more blocks than any batch has pieces: never over the pieces."""
    monkeypatch.setattr(substring_dedup, "BATCH_WORDS", 500)
    rng = random.Random(1)
    rows = []
    for n in (20, 80):
        chunk = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text": [" ".join(f"w{rng.randrange(10**6)}" for _ in range(100)) for _ in range(n)]})
        deal = substring_dedup.Deal(100 * n, 13, [])
        rows.append(sum(b.num_rows for i in range(n) for x in substring_dedup._batches([chunk.slice(i, 1)], 13, deal) for b in substring_dedup._offer([x], deal)))
    assert rows[1] < 4.4 * rows[0] and rows[1] < 80 * 88 / 3


@pytest.mark.parametrize("hot_windows", [substring_dedup.HOT_WINDOWS, 400, 20])
def test_substring_dedup(docs, hot_windows):
    rows = plain(docs)
    first: dict = {}
    for i, t in rows:
        w = SPACE.findall(t or "")
        if i is not None:
            for j in range(len(w) - 12):
                key = tuple(w[j : j + 13])
                first[key] = min(i, first.get(key, i))
    expected = []
    for i, t in rows:
        w = SPACE.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if i is not None and first.get(tuple(w[j : j + 13]), i) < i:
                gone[j : j + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substring_dedup.remove_duplicates(docs, hot_windows=hot_windows)
    same([tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()], expected)
    assert sum(r[2] for r in expected) > 20_000
    assert substring_dedup.remove_duplicates(empty(docs)).count() == 0


def test_simhash_fingerprints_and_components(docs):
    rows = plain(docs)
    prints = []
    for _, t in rows:
        w = SPACE.findall((t or "").translate(LOW))
        h = [xxhash.xxh64_intdigest(" ".join(w[j : j + 3]).encode(), 42) for j in range(max(1, len(w) - 2))] if w else []
        prints.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)].append(i)
    expected = [(i, prints[k] - (1 << 64) if prints[k] >> 63 else prints[k], min(least[root(k)], default=None)) for k, (i, _) in enumerate(rows)]
    same([tuple(r) for r in simhash_dedup.near_duplicates(docs).collect()], expected)
    kept = simhash_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    same([i for i in ids if i is not None], {c for _, _, c in expected if c is not None} & {i for i, _, c in expected if i == c})
    assert simhash_dedup.near_duplicates(empty(docs)).count() == 0


@pytest.mark.parametrize("small,large", [(1, 2), (2, 6), (16, 2000), (1, 2000)])
def test_covering_links_every_close_pair(spark, small, large):
    """By joins, by searches in tasks, by further coverings and by parts; a cluster's links are fewer than its pairs."""
    rng = random.Random(5)
    values = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        values |= {base} | {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for _ in range(8)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    close = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    found = {(min(r), max(r)) for r in simhash_dedup.close_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 3, small, large).collect()}

    def groups(pairs):
        least = {v: v for v in signed}
        for _ in signed:
            before = dict(least)
            for a, b in pairs:
                least[a] = least[b] = min(least[a], least[b])
            if before == least:
                return least

    assert found <= close and groups(found) == groups(close) and len(close) > 200


def test_a_dense_cluster_gives_few_links():
    fps = np.array([sum(1 << b for b in own) for k in range(3) for own in itertools.combinations(range(40), k)], np.int64)
    links = simhash_dedup.spanning(fps, 3)
    assert len(links) == len(fps) - 1 and all((a ^ b).bit_count() <= 3 for a, b in links)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 200) if i != 120] + [(500, 400), (400, 500), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == (0 if i <= 120 else 121) for i in range(201)) and got[500] == 400


def test_components_join_the_links_of_a_task_before_any_are_shuffled(spark, monkeypatch):
    """A chain within a task takes one round, and chunks of a random graph give the components of the whole."""
    written = []
    kept = components_module.saved
    monkeypatch.setattr(components_module, "saved", lambda df, name: written.append(name) or kept(df, name))
    chain = spark.range(3000).coalesce(1).selectExpr("id as a", "id + 1 as b")
    assert components(chain).where("label <> 0").isEmpty()
    assert written == ["links", "labels", "labels"]
    rng = random.Random(5)
    links = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(260)]
    parent = {x: x for pair in links for x in pair}
    for _ in parent:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    for parts in (1, 7):
        got = components(spark.createDataFrame(links, "a long, b long").repartition(parts)).collect()
        assert sorted(map(tuple, got)) == sorted(parent.items())


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontaminate(spark, docs, block_bytes):
    rows = plain(docs)
    passage = next(t for i, t in rows if i == 7)
    w = ALNUM.findall(passage)
    items = [(1, " ".join(w[:25])), (2, " ".join(w[20:32])), (11, "-".join(w[3:7])), (3, ""), (4, None), (None, w[0]), (5, "never seen words"), (1, " ".join(w[:25])), (6, "1234"), (None, " ".join(w[25:36]))]
    benchmark = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, doc_id int")
    windows = collections.defaultdict(set)
    for k, t in items:
        own = ALNUM.findall((t or "").translate(LOW))
        for j in range(max(1, len(own) - 9)):
            if own:
                windows[tuple(own[j : j + 10])] |= set() if k is None else {str(k)}
    expected = []
    for i, t in rows:
        own = ALNUM.findall((t or "").translate(LOW))
        hit, found = [False] * len(own), set()
        for size in {len(x) for x in windows}:
            for j in range(len(own) - size + 1):
                if (k := windows.get(tuple(own[j : j + size]))) is not None:
                    found |= k
                    hit[j : j + size] = [True] * size
        expected.append((i, len(own), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    spans = decontaminate.benchmark_spans(docs, benchmark, block_bytes=block_bytes)
    got = spans.mapInArrow(decontaminate._digests, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
    same([tuple(r) for r in got.collect()], expected)
    clean = decontaminate.clean_documents(docs, benchmark, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    same([r.doc_id for r in clean.collect()], [e[0] for e in expected if not e[5]])
    assert decontaminate.benchmark_spans(empty(docs), benchmark).count() == 0
    assert decontaminate.clean_documents(docs, benchmark.where("1 = 0")).count() == docs.count()


def test_decontaminate_names_items_and_compares_words(spark):
    """Ids with commas and without characters, and words that a polynomial hash takes for the benchmark's."""
    a, b = thue_morse(2048)
    rest = " ".join(f"w{i}" for i in range(9))
    docs = spark.createDataFrame([(1, f"x {rest} {a} y"), (2, f"x {rest} {b} y"), (3, "one two")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("a,b", f"{rest} {a}"), ("", "one two"), ("", "one"), ("c", f"{rest} {a}")], "item_id string, text string")
    got = decontaminate.benchmark_spans(docs, benchmark).mapInArrow(decontaminate._digests, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean").collect()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    same([tuple(r) for r in got], [(1, 12, 10, 2, digest("a,b,c"), True), (2, 12, 0, 0, digest(""), False), (3, 2, 2, 1, digest(""), True)])


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 3000)
    text[-1] = 0
    index = decontaminate.FMIndex(text, 4)
    for size in (1, 2, 5):
        patterns = rng.integers(1, 4, (20, size)).astype(np.int32)
        low, high = index.search(patterns)
        for p, a, z in zip(patterns, low, high, strict=True):
            expected = [i for i in range(len(text) - size + 1) if (text[i : i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, z)).tolist()) == expected


@pytest.mark.parametrize("sum_rows", [lm_score.SUM_ROWS, 1])
def test_lm_score(docs, sum_rows):
    rows = plain(docs)
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    tokens = [[*SPACE.findall((t or "").translate(LOW)), 0] for _, t in rows]
    c = collections.Counter(x for own, h in zip(tokens, held, strict=True) if not h for x in own)
    n, v = sum(c.values()), len(c)
    expected = collections.Counter((i, h, len(own), sum(c[x] > 0 for x in own), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in own), 4)) for (i, _), h, own in zip(rows, held, tokens, strict=True))
    got = lm_score.score_texts(docs, sum_rows=sum_rows).collect()
    assert collections.Counter((*tuple(r)[:5], round(r.base_score, 4)) for r in got) == expected
    assert all(r.score < 0 for r in got)
    assert lm_score.score_texts(empty(docs)).count() == 0


def test_log_bilinear_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    n = 6
    token = np.zeros(20_000, np.int64)
    for i in range(1, len(token)):
        token[i] = 2 + (token[i - 1] - 1) % 4 if rng.random() < 0.9 else rng.integers(2, 6)
    shares = np.bincount(token, minlength=n) + 1.0
    model = lm_score.LogBilinear(shares / shares.sum())
    for _ in range(6):
        model.fit(token[:-2], token[1:-1], token[2:], rng)
    A, B, Z = model.tables()
    p = np.exp(A[:, None, :].astype(float) + B[None, :, :] - Z[:, :, None])
    assert np.allclose(p.sum(2), 1, atol=1e-4)
    uniform = np.log(shares / shares.sum())[token[2:]].mean()
    assert np.log(p[token[:-2], token[1:-1], token[2:]]).mean() > uniform + 0.5
    again = lm_score.LogBilinear(shares / shares.sum(), seed=1)
    again.set_vector(model.vector())
    assert all((again.p[k] == model.p[k]).all() and (again.squares[k] == model.squares[k]).all() for k in model.p)


def test_lm_score_is_the_normalised_score_of_the_model(spark, docs, monkeypatch):
    """Scores against plain loops over tokens, with few words and shapes, so that most tokens share classes."""
    kept = []
    learned = lm_score.learned
    monkeypatch.setattr(lm_score, "learned", lambda *a: kept.append((a[1], learned(*a))) or kept[-1][1])
    rows = plain(docs)
    chunk = pa.RecordBatch.from_pydict({"doc_id": [None if i is None else i for i, _ in rows], "text": [t for _, t in rows], "held": [int(i is None or zlib.crc32(str(i).encode()) % 10 == 0) for i, _ in rows]}, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("held", pa.int8())]))
    coded = [r for b in lm_score._code(iter([chunk]), 5, 7) for r in b.to_pylist()]
    asked = pa.Table.from_pylist([{k: r[k] for k in ("batch", "block", "hashes", "counts", "kinds")} for r in coded if r["block"] >= 0], schema=pa.schema([("batch", pa.string()), ("block", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary()), ("kinds", pa.binary())]))
    tokens = [[*SPACE.findall((t or "").translate(LOW)), ""] for _, t in rows]
    learn = [i is not None and zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    c = collections.Counter(x for own, h in zip(tokens, learn, strict=True) if h for x in own)
    hash_of = lambda x: int(lm_score.tokens_of(pa.array([x]), 7)[0][0])
    shape_of = lambda x: int(lm_score.tokens_of(pa.array([x]), 7)[1][0])
    hashes, shapes = {x: hash_of(x) for own in tokens for x in own}, {x: shape_of(x) for own in tokens for x in own}
    assert asked.num_rows == 5 and sum(len(r["hashes"]) // 8 for r in asked.to_pylist()) == len(hashes)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    words = sorted(c, key=lambda x: (-c[x], signed(hashes[x])))[:12]
    klass = {x: 8 + words.index(x) if x in words else 1 + shapes[x] for x in hashes}
    total, distinct = collections.Counter(), collections.Counter()
    for x, n in c.items():
        total[klass[x]] += n
        distinct[klass[x]] += 1
    got = {(r.doc_id, r.n_tokens): r.score for r in lm_score.score_texts(docs, 12, 7).collect()}
    classes, model = kept[0]
    assert classes.of(np.array(list(hashes.values()), np.uint64), np.array(list(shapes.values()))).tolist() == list(klass.values())
    R, Q, C, b = (model.p[k].astype(float) for k in "RQCb")
    cache = {}

    def log_p(i, j, k):
        if (i, j) not in cache:
            z = [sum((R[i] * C[0] + R[j] * C[1]) * Q[m]) + b[m, 0] for m in range(len(Q))]
            cache[i, j] = [x - math.log(sum(math.exp(y) for y in z[1:])) for x in z]
        return cache[i, j][k] / math.log(10)

    for (i, _), own in zip(rows, tokens, strict=True):
        score, before = 0.0, [0, 0]
        for x in own:
            k = klass[x]
            score += log_p(*before, k) + (0 if k > 7 else math.log10((c[x] + 0.1) / (total[k] + 0.1 * (distinct[k] + 1))))
            before = [before[1], k]
        assert got[i, len(own)] == pytest.approx(score, rel=1e-4)


def test_lm_score_learns_from_every_training_document_and_beats_the_base(spark):
    """Two languages whose words follow each other in rings: what a text's last words are tells the next."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        ring = [f"{'ab'[i % 2]}{k}" for k in range(30)]
        at, words = rng.randrange(30), []
        for _ in range(120):
            words.append(ring[at])
            at = (at + 1) % 30 if rng.random() < 0.9 else rng.randrange(30)
        rows.append((i, " ".join(words)))
    got = lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).where("held_out").collect()
    gain = sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got)
    assert gain > 0.2


def test_packing(docs):
    from tokenizers import Tokenizer

    paths = packing.public_vocabulary()
    whole = Tokenizer.from_file(paths[0])
    odd = [(2000, "a <|endoftext|> b"), (2001, " " * 1_000_000 + "x"), (2002, "ab" * 500_000), (2003, "\n" * 1_000_000), (2004, "x" + "  y" * 1000), (2005, "\u3000" * 5000 + "z")]
    rows = plain(docs) + odd
    more = docs.sparkSession.createDataFrame(odd, "doc_id long, text string")
    pieces = packing.pack_documents(docs.select("doc_id", "text").unionByName(more), *paths).collect()
    wanted = collections.Counter()
    for i, t in rows:
        wanted[(i, len(whole.encode(t or "", add_special_tokens=False).ids) + 1)] += 1
    total = collections.Counter()
    for p in pieces:
        total[(p.doc_id, p.doc_tokens)] += p.length
    assert total == collections.Counter({k: k[1] * n for k, n in wanted.items()})
    ids = {i: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    assert all(p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) for p in pieces)
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.pack_documents(empty(docs), *paths).count() == 0


@pytest.mark.parametrize("dense_terms", [0, 7, 1000])
def test_bm25_neighbours_match_brute_force(dense_terms):
    """All terms of a seed and all its neighbours, whichever postings are dense."""
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(2, 60 if i % 2 else 20, rng.integers(0, 30)), packing.END_ID).astype(np.uint32) for i in range(40)]
    index = packing.Index(docs, dense_terms)
    found = [collections.Counter(d[:-1].tolist()) for d in docs]
    n, mean = len(docs), np.mean([len(d) - 1 for d in docs])
    df = collections.Counter(t for c in found for t in c)
    weight = lambda t, i: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * found[i][t] * 2.2 / (found[i][t] + 1.2 * (0.25 + 0.75 * (len(docs[i]) - 1) / mean))
    for seed in range(n):
        score = {i: sum(weight(t, i) for t in found[seed] if found[i][t]) for i in range(n) if i != seed and i % 3}
        free = np.array([i != seed and i % 3 > 0 for i in range(n)])
        near = index.neighbours(seed, free).tolist()
        assert set(near) == {i for i, s in score.items() if s > 0}
        assert [score[i] for i in near] == pytest.approx(sorted((s for s in score.values() if s > 0), reverse=True), rel=1e-5)


def test_windows_are_filled_by_the_best_unused_neighbours():
    """The pieces against a packer that scores by the index's formula and takes the best unused document each time."""
    rng = np.random.default_rng(3)
    docs = [np.append(rng.integers(2, 40, rng.integers(1, 25)), packing.END_ID).astype(np.uint32) for _ in range(50)]
    index = packing.Index(docs)
    stream, used = [], set()
    room, ranked = 64, []
    while len(used) < len(docs):
        doc = ranked.pop(0) if ranked else next(i for i in range(len(docs)) if i not in used)
        used.add(doc)
        stream.append(doc)
        left = room - len(docs[doc])
        while left <= 0:
            left, ranked = left + 64, []
        room = left
        if not ranked and room < 64:  # the document that stands in the window is its seed
            score = index.score(doc)
            ranked = sorted((i for i in range(len(docs)) if i not in used and score[i] > 0), key=lambda i: (-score[i], i))
    pieces = list(packing.pack(docs, 64))
    assert list(dict.fromkeys(p[0] for p in pieces)) == stream
    assert list(packing.pack([np.array([packing.END_ID], np.uint32)] * 3)) == [(0, 0, 1, 0, 0), (1, 0, 1, 0, 1), (2, 0, 1, 1, 0)]


def test_language_id(spark, docs):
    rng = random.Random(4)
    letters = {"xx": "abcdefg", "yy": "uvwxyzé", "zz": "mnopqrs"}
    rows = [(i, " ".join("".join(rng.choice(letters[k]) for _ in range(5)) for _ in range(20)), k) for i in range(300) for k in [("xx", "yy", "zz")[i % 3]]]
    rows += [(900, None, "xx"), (901, "12 3!", "yy"), (902, "", None), (None, "uvw xyz uvw", "yy")]
    rows += [(910, "Съешь же ещё этих мягких французских булок да выпей чаю", None), (911, "数据处理系统的性能", None)]  # in none of them
    own = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(own).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902)) and got[None].held_out
    held = [(i, k) for i, _, k in rows[:300] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i, _ in held) and sum(got[i].lang_pred == k for i, k in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = language_id.identified_documents(own)
    assert kept.columns == own.columns and {r.doc_id for r in kept.collect()} == {i for i, _, _ in rows} - {900, 901, 902, 910, 911}
    # what the model has learned decides: another language's texts stay when it is learned, and go when it isn't wanted
    assert {r.doc_id for r in language_id.identified_documents(own, ["yy"]).collect()} == {i for i, _, k in rows[:300] if k == "yy"} | {None}
    without = own.withColumn("lang", F.when(F.col("lang") != "zz", F.col("lang")))
    model = language_id._learned(without)[1]
    name, _, _, far, _ = language_id._answers(pa.array([t for _, t, _ in rows], pa.string()), model)
    expected = {i for (i, _, _), k, x in zip(rows, name, far, strict=True) if k != "und" and x <= language_id.FAR}
    assert {r.doc_id for r in language_id.identified_documents(without).collect()} == expected != {i for i, _, _ in rows} - {900, 901, 902, 910, 911}
    assert {r.lang_pred for r in language_id.identify(own.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(empty(docs)).count() == 0


def test_output_codes_decode_like_plain_loops():
    """Features, bits, weighted losses, winner, score and flag of each text, one n-gram and one bit at a time."""
    rng = random.Random(5)
    letters = ["abcdé", "cdefg", "fghij", "ijkab"]
    prose = lambda k, n: " ".join("".join(rng.choice(letters[k]) for _ in range(4)) for _ in range(n))
    learn = [(prose(i % 4, 15), "klmn"[i % 4]) for i in range(200)]
    model = language_id.OutputCodes(language_id.features(pa.array([t for t, _ in learn])), [k for _, k in learn])
    test = [prose(i % 4, rng.randrange(1, 30)) for i in range(40)] + [prose(0, 10) + " " + prose(1, 10), "1", "", "ñ", "Ab  CD", None]
    names, scores, close, far, second_names = language_id._answers(pa.array(test, pa.string()), model)
    for i, t in enumerate(test):
        raw = bytes(c | 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in (t or "").encode() + b"\n")
        x = np.zeros(language_id.BUCKETS)
        for size in (2, 3):
            for j in range(len(raw) - size + 1):
                gram = raw[j : j + size]
                if gram != b" " * size:
                    x[((int.from_bytes(gram, "big") * 0x9E3779B1 + size) % 2**32) >> 20] += 1
        x = np.sqrt(x)
        x /= max(math.sqrt(sum(x**2)), 1e-9)
        bits = [float(np.dot(x, model.w[:-1, b]) + model.w[-1, b]) for b in range(model.w.shape[1])]
        losses = [sum(math.log(1 + math.exp(-f * c)) * k for f, c, k in zip(bits, code, weights, strict=True)) for code, weights in zip(model.code, model.weights, strict=True)]
        if not any(c.isalpha() for c in t or ""):
            assert (names[i], scores[i], close[i]) == ("und", 0, False)
            continue
        first, second = sorted(losses)[:2]
        assert names[i] == model.names[losses.index(first)] and far[i] == pytest.approx(first, rel=1e-3, abs=1e-5)
        assert second_names[i] == model.names[losses.index(second)]
        assert scores[i] == pytest.approx(1 / sum(math.exp(first - x) for x in losses), rel=1e-3)
        assert abs(second - first - language_id.MARGIN) < 1e-4 or close[i] == (second - first < language_id.MARGIN)


def test_language_id_holds_its_sample_once_in_the_driver(spark):
    """Beside the features themselves, learning allocates less than a third of them."""
    import tracemalloc

    rng = random.Random(8)
    n = 800
    rows = [(i, "".join(rng.choice(("qrstuvwxyz ", "ijklmnop ")[i % 2]) for _ in range(60)), ("xx", "yy")[i % 2], i << 20) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, h long").select("text", "lang", "h").cache()
    docs.count()
    tracemalloc.start()
    try:
        model = language_id.fit(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.names == ["xx", "yy"] and peak < 4 / 3 * n * (language_id.BUCKETS + 1) * 4


def test_codewords_are_apart():
    for n in (2, 3, 5, 9, 40):
        code = language_id.codewords(n)
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= (1 if n == 2 else 2)


def test_quality(spark, docs):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    rows = [(i, " ".join(word().upper() + "!!" if i % 4 == 0 else word() for _ in range(50))) for i in range(400)]
    labels = [(i, 0 if i % 4 == 0 else 1) for i in range(400)] + [(5, None), (None, 1), (99999, 0)]
    own = spark.createDataFrame([*rows, (500, None), (501, ""), (None, "abc")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score_quality(own, marks).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and all(got[i].predicted == (i % 4 != 0) for i in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values()) and len(got) == 403
    assert {r.score for r in quality.score_quality(own, marks.where("1 = 0")).collect()} == {0.5}
    assert quality.score_quality(empty(docs), marks).count() == 0


def test_quality_matches_plain_moments_and_distances(spark):
    """Some statistics by counting characters, class moments by loops, distances by inverse and determinant."""
    rng = random.Random(16)
    word = lambda k: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 6 + 3 * k)))
    rows = [(i, " ".join(word(i % 2).upper() if rng.random() < 0.2 * (i % 2) else word(i % 2) + ",." * (rng.random() < 0.1) for _ in range(rng.randrange(20, 60))) + "\n7!") for i in range(240)]
    labels = [(i, i % 2) for i in range(200)]
    own = spark.createDataFrame([*rows, (900, ""), (901, None)], "doc_id long, text string").repartition(3)
    x = {r.doc_id: list(r.x) for r in quality.text_statistics(own).collect()}
    for i, t in rows:
        raw, words = len(t) + 1, t.split()
        share = lambda chars: math.sqrt(sum(c in chars for c in t) / raw)  # noqa: B023, E731
        expected = {"log_bytes": math.log1p(raw), "upper": share("ABCDEFGHIJ"), "digit": share("0123456789"), "end_marks": share("!?"), "commas": share(".,;:"), "word_length": math.log1p(sum(map(len, words)) / len(words)),
                    "long_words": math.sqrt(sum(len(w) > 12 for w in words) / len(words)), "distinct_words": len(set(words)) / len(words), "repeated_next": math.sqrt(sum(a == b for a, b in zip(words, words[1:])) / len(words))}
        assert [x[i][quality.STATISTICS.index(k)] for k in expected] == pytest.approx(list(expected.values()))
    learn = {k: [x[i] for i, y in labels if y == k and zlib.crc32(str(i).encode()) % 5] for k in (0, 1)}
    size, total = len(quality.STATISTICS), sum(map(len, learn.values()))
    mean = {k: [sum(r[a] for r in v) / len(v) for a in range(size)] for k, v in learn.items()}
    cov = {k: np.array([[sum((r[a] - mean[k][a]) * (r[b] - mean[k][b]) for r in v) / len(v) for b in range(size)] for a in range(size)]) for k, v in learn.items()}
    pooled = sum(len(learn[k]) / total * cov[k] for k in cov)
    log = {}
    for k, c in cov.items():
        c = (1 - quality.POOLED - quality.DIAGONAL) * c + quality.POOLED * pooled + quality.DIAGONAL * np.diag(np.diag(c)) + quality.FLOOR * np.eye(size)
        inverse, half = np.linalg.inv(c), np.linalg.slogdet(c)[1] / 2
        log[k] = {i: -0.5 * (np.array(r) - mean[k]) @ inverse @ (np.array(r) - mean[k]) - half for i, r in x.items()}
    got = {r.doc_id: r.score for r in quality.score_quality(own, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    for i in x:
        odds = (log[1][i] - log[0][i]) / quality.TEMPER + math.log(len(learn[1]) / len(learn[0]))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-max(-500, min(500, odds)))), rel=1e-4, abs=1e-9)


def test_media_round_trip(docs):
    rows = plain(docs)
    got = media.media_features(media.encode_media(docs)).collect()
    expected = []
    for i, t in rows:
        p = (t or "").encode()
        padded = p + bytes(-len(p) % 64 or (0 if p else 64))
        expected.append((i, len(p), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]), len(padded) + 44, hashlib.sha256(media.to_wav(padded)).hexdigest()))
    same([tuple(r)[:7] for r in got], expected)
    by = collections.defaultdict(set)
    for r in got:
        by[r.payload_sha256].add(tuple(r.codes))
    assert all(len(x) == 1 for x in by.values())
    assert media.from_wav(media.to_wav(b"\x00\xff" * 32)) == b"\x00\xff" * 32


def test_landmarks_find_a_tone():
    t = np.arange(4096)
    tone = (128 + 100 * np.sin(2 * np.pi * t * 32 / media.FRAME)).astype(np.uint8)
    assert (media.peaks(tone)[:, 0] == 32).all()
    codes = media.landmarks(tone)
    assert (np.diff(codes) >= 0).all() and {int(c >> 14 & 1023) for c in codes} >= {32}


@pytest.mark.parametrize("size", [64, 192, 704, 1500, 3008])
def test_landmarks_match_a_plain_transform(size, monkeypatch):
    """Frames, transforms, peaks and pairs one by one, by sums of cosines and sines; with runs of two frames."""
    monkeypatch.setattr(media, "FRAMES_AT_ONCE", 2)
    rng = random.Random(size)
    samples = np.array([rng.randrange(97, 123) for _ in range(size)], np.uint8)
    n = max(media.REACH + 1, -(-size // media.HOP) + 1)
    angle = 2 * np.pi * np.outer(np.arange(257), np.arange(512)) / 512
    power = []
    for f in range(n):
        x = np.array([float(samples[(f * media.HOP - media.HOP + i) % size]) for i in range(512)])
        x = (x - x.mean()) * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(512) / 512))
        power.append(np.hypot(np.cos(angle) @ x, np.sin(angle) @ x))
    top = []
    for f in range(n):
        near = lambda k: max(power[g][j] for g in range(max(0, f - 1), min(n, f + 2)) for j in range(max(1, k - 4), min(256, k + 4) + 1))  # noqa: B023, E731
        own = [k for k in range(1, 257) if power[f][k] >= near(k) * (1 - media.EQUAL)]
        top.append(sorted(own, key=lambda k: -power[f][k])[:2])  # noqa: B023
    codes = [f << 24 | k << 14 | top[f + d][0] << 4 | d for f in range(n) for d in range(1, 4) if f + d < n and top[f + d] for k in top[f]]
    if not codes:
        codes = [f << 24 | k << 14 for f in range(n) for k in top[f]]
    got = media.landmarks(samples).tolist()
    assert got == sorted(got) and len(got) > 0
    # single precision may take another of two all but equal bins
    assert len(set(got) ^ set(codes)) <= 0.1 * len(codes)


def test_landmarks_cover_short_payloads_and_tails():
    feature = lambda text: tuple(media.landmarks(np.frombuffer(text.encode() + bytes(-len(text) % media.UNIT), np.uint8)))
    rng = random.Random(2)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    assert all(feature(prose(n)) for n in range(0, 710, 10))
    short = [prose(n) for n in (60, 64, 120, 128, 200, 512, 700)]  # below, the zeros that fill the unit outweigh the text
    assert len(set(map(feature, short))) == len(short)
    for n in (576, 640, 704, 960, 2048 + 192):  # the tail behind the last full frame
        body = prose(n)
        assert len({feature(body[:-60] + prose(60)) for _ in range(5)}) == 5
        assert len({feature(prose(60) + body[60:]) for _ in range(5)}) == 5
    for n in range(0, 1200, 7):
        assert len(media.peaks(np.zeros(n + 1, np.uint8))) >= media.REACH + 1


def best_segmentation(word: bytes, scores: dict[bytes, int]) -> tuple[int, int]:
    """(micro-nats, tokens) by trying every piece before every end, from the word's end on."""
    least = min(scores.values()) - token_counts.UNKNOWN
    best = {len(word): (0, 0)}
    for at in reversed(range(len(word))):
        ways = [(scores.get(word[at : at + 1], least) + best[at + 1][0], best[at + 1][1] - 1)]
        ways += [(scores[word[at:z]] + best[z][0], best[z][1] - 1) for z in range(at + 2, min(len(word), at + 60) + 1) if word[at:z] in scores]
        best[at] = max(ways)
    return best[0][0], -best[0][1]


def test_token_counts(docs):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = token_counts.read_pieces(path)
    a, b = thue_morse(1024)
    # words of every width, a script of three bytes a character, and words that a weak hash takes for one
    odd = [(3000, "x" * 39 + " " + "x" * 40), (3001, "abcdefgh" * 60), (3002, "the" * 1500), (3003, "数据处理" * 9 + " " + "数据" * 80), (3004, f"{a} {b} {a}")]
    more = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame(odd, "doc_id long, text string"))
    cache: dict = {}
    expected = []
    for i, t in plain(more):
        w = SPACE.findall(t or "")
        each = [cache.setdefault(x, best_segmentation(token_counts.MARK + x.encode(), scores)) if x not in cache else cache[x] for x in w]
        expected.append((i, len(w), sum(n for _, n in each), sum(s for s, _ in each)))
    same([tuple(r) for r in token_counts.token_counts(more, path).collect()], expected)
    assert token_counts.token_counts(empty(docs), path).count() == 0


def test_trie_shares_prefixes_without_changing_results():
    scores = {b"a": -3, b"b": -4, b"ab": -5, b"abc": -20, b"ca": -6, token_counts.MARK + b"a": -4}
    pieces = token_counts.Pieces(scores)
    words = sorted({"".join(random.Random(i).choice("abcx") for _ in range(1 + i % 9)).encode() for i in range(200)})
    letters = np.zeros((len(words), token_counts.WIDTHS[0]), np.uint8)
    for i, w in enumerate(words):
        letters[i, : len(w)] = np.frombuffer(w, np.uint8)
    score, count = pieces.many(letters, np.array([len(w) for w in words]))
    assert list(zip(score.tolist(), count.tolist(), strict=True)) == [best_segmentation(w, scores) for w in words] == [pieces.one(w) for w in words]


def secret_rows() -> list[tuple]:
    rng = random.Random(8)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(400):
        filler = " ".join(rng.choice(["the", "river", "house", "green", "walks"]) for _ in range(30))
        kinds = [
            f'token = "{hexes(40)}"', f"password={hexes(18)}", "AKIA" + "".join(rng.choice("ABCDEFGHJK234567") for _ in range(16)), 'password = "' + "".join(rng.choice("abXYZ!@#$") for _ in range(14)) + '"',
            f"call +1 (555) 555-{rng.randrange(1000, 9999)}", f"order number {rng.randrange(10**15, 10**16)}", "", f"see section{rng.randrange(10, 99)} overleaf",
        ]
        rows.append((i, f"{filler} {kinds[i % 8]} {filler}", "src", 1))
    return rows


def test_secret_scan(spark, docs):
    rows = secret_rows()
    own = spark.createDataFrame([*rows, (1000, None, None, None), (1001, "", "s", 0), (None, rows[0][1], "s", 5)], "doc_id long, text string, source string, n_chars long")
    scanner = secret_scan.train(own)
    found = secret_scan.each_finding(secret_scan.scan(own, scanner), "doc_id", "text").collect()
    flagged = {r.doc_id for r in found if r.score >= secret_scan.THRESHOLD}
    assert flagged == {i for i in range(400) if i % 8 < 4} | {None}
    assert all(r.text[r.start : r.start + len(r.value)] == r.value for r in found)
    clean = {r.doc_id: r for r in secret_scan.redact(own, scanner).collect()}
    assert len(clean) == 403 and clean[1000].text is None and clean[1001].text == ""
    for i, t, _, n in rows:
        spans = [(r.start, r.start + len(r.value)) for r in found if r.doc_id == i and r.score >= secret_scan.THRESHOLD]
        for a, z in sorted(spans, reverse=True):
            t = t[:a] + secret_scan.REDACTED + t[z:]
        assert clean[i].text == t and clean[i].n_chars == (len(t) if spans else n)
    nothing = secret_scan.train(empty(docs))
    assert all(r.score == 0 for r in secret_scan.each_finding(secret_scan.scan(own, nothing), "doc_id").collect())
    assert secret_scan.redact(docs, scanner).columns == docs.columns and secret_scan.redact(empty(docs), scanner).count() == 0
    plan = secret_scan.scan(own, scanner)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_secret_candidates_features_and_forest_match_plain_loops(spark):
    """Candidates, their spans, every feature and the forest's score of each, by regular expressions and loops over characters."""
    rows = secret_rows()[:80] + [(500, 'k = "abcd1234" then abcd12345678 and x="p@ss!word" y: \'Zz9-zz9+q\' camelCaseIdentifier =', "a/test/b", 1), (501, "é abcdefg1é 😀 q=1234567890", "a/b", 1)]
    own = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    scanner = secret_scan.train(own)
    run = re.compile(r"""[=:]\s?["'`][^\s"'`]{6,}["'`]|=[^\s="'`]{8,}|[A-Za-z0-9+/_-]{8,}""")
    opening = re.compile(r"""^(=(?:\s?["'`])?|:\s?["'`])""")
    changes = re.compile(r"(?=[a-z][0-9]|[0-9][a-z]|[A-Z][0-9]|[0-9][A-Z]|[a-z][A-Z]|[A-Z][a-z])")
    alphabet = secret_scan._ALPHABET

    def score(t, x):
        while not isinstance(t, float):
            t = t[2] if x[t[0]] <= t[1] else t[3]
        return t

    expected = {}
    for i, text, path, _ in rows:
        runs = list(run.finditer(text))
        for m in runs:
            r = m.group()
            head = opening.match(r).group() if r[0] in "=:" else ""
            if not (r[0] in "=:" or re.search("[0-9]", r) or (len(r) >= 12 and re.search("[a-z][A-Z]", r))):
                continue
            value = r[len(head) :].rstrip("\"'`") if head else r
            n = len(value)
            plain = [alphabet.index("0" if c in "0123456789" else c if c in alphabet[:26] else "_") for c in value.lower()]
            left = dict.fromkeys(scanner.words)
            covered, at = 0, 0
            while at < n:
                word = next((w for w in left if value.lower().startswith(w, at)), "")
                covered += len(word)
                at += max(1, len(word))
            before, after = text[: m.start() + len(head)][-48:], text[m.end() :][:24]
            near = sum(scanner.weights.get(w, 0) for w in re.split("[^a-z]+", f"{before} {after}".lower()) if len(w) >= 3)
            x = [n, sum(c in "0123456789" for c in value) / n, sum("A" <= c <= "Z" for c in value) / n, (len(changes.findall(value)) + len(re.findall("[^A-Za-z0-9]", value))) / n,
                 sum(ord(scanner.transitions[28 * a + b]) - 40 for a, b in zip(plain, plain[1:])) / (n - 1), covered / n, near, path.count("/"), float("test" in path)]
            expected[i, m.start() + len(head)] = (value, x, sum(score(t, x) for t in scanner.forest.trees) / len(scanner.forest.trees))
    found = secret_scan.each_finding(secret_scan.with_features(secret_scan.with_candidates(own), scanner), "doc_id").collect()
    assert {(r.doc_id, r.start): r.value for r in found} == {k: v[0] for k, v in expected.items()} and len(expected) > 60
    for r in found:
        assert r.x == pytest.approx(expected[r.doc_id, r.start][1], abs=1e-6), (r.value, r.before, r.after)
    scores = {(r.doc_id, r.start): r.score for r in secret_scan.each_finding(secret_scan.scan(own, scanner), "doc_id").collect()}
    assert scores == pytest.approx({k: v[2] for k, v in expected.items()})
    assert any(not isinstance(t, float) for t in scanner.forest.trees)


def test_secrets_go_at_their_places_under_any_column_names(spark):
    """A short secret's characters inside another word stay; columns may have the names that scan would like; findings of one's own train it."""
    text = 'token = "abcd1234" and later abcd12345678 xabcd1234y'
    rows = [(i, f'token = "{random.Random(i).getrandbits(64):016x}" river', "s", "w", "x", 0) for i in range(40)] + [(100 + i, f"river number {10**15 + i} house", "s", "w", "x", 0) for i in range(40)] + [(900, text, "s", "w", "x", 0)]
    own = spark.createDataFrame(rows, "doc_id long, text string, source string, _words string, scan string, f int")
    scanner = secret_scan.train(own)
    out = secret_scan.redact(own, scanner)
    assert out.columns == own.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[900].text.startswith('token = "[SECRET]" and later ') and "[SECRET]5678" not in got[900].text and got[900].scan == "x"
    assert all("[SECRET]" in got[i].text for i in range(40)) and all("[SECRET]" not in got[100 + i].text for i in range(40))
    labels = secret_scan.each_finding(secret_scan.with_candidates(own), "doc_id").select("value", "before", "after", "path", (F.col("doc_id") >= 100).cast("double").alias("label"))
    other = secret_scan.fit_scanner(scanner, labels)
    got = {r.doc_id: r.text for r in secret_scan.redact(own, other).collect()}
    assert all("[SECRET]" not in got[i] for i in range(40)) and all("[SECRET]" in got[100 + i] for i in range(40))


def test_places_of_very_many_candidates_are_found_in_little_time(spark):
    """100,000 candidates of one text of 1.2 MB, where places and redaction take a pass each; places agree with the text."""
    import time

    n = 100_000
    long = " ".join(f"k{i:05d}ab{i % 7}=x" for i in range(n))
    short = " ".join(f"w{i} tok{i:06d}z" for i in range(9000))
    docs = spark.createDataFrame([(1, long), (2, short)], "doc_id long, text string")
    learned = secret_scan.Scanner("(" * 28 * 28, ["the"], {}, secret_scan.Forest([(0, 0.0, 0.0, 1.0)]))
    began = time.time()
    found = secret_scan.each_finding(secret_scan.scan(docs, learned), "doc_id", "text").select("doc_id", "start", "value", F.substring("text", F.col("start") + 1, F.length("value")).alias("there"), "score").where("doc_id = 2 or start % 97 = 0").collect()
    assert len([r for r in found if r.doc_id == 2]) == 9000 and all(r.value == r.there and r.score == 1 for r in found)
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs, learned).collect()}
    assert clean[1].count(secret_scan.REDACTED) == n and clean[2] == " ".join(f"w{i} {secret_scan.REDACTED}" for i in range(9000))
    assert time.time() - began < 120


def test_redaction_keeps_quotes_across_line_feeds(spark):
    learned = secret_scan.Scanner("(" * 28 * 28, ["the"], {}, secret_scan.Forest([(0, 0.0, 0.0, 1.0)]))
    texts = ['a =\n"Zq9aB3xK7mP2wL5tY8" b', "k: 'Zq9aB3xK7mP2'", 'x="abc\'d9"', "y=Zq9aB3xK7mP2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in secret_scan.redact(docs, learned).collect()}
    assert got[0] == 'a =\n"[SECRET]" b' and got[1] == "k: '[SECRET]'" and got[3] == "y=[SECRET]"
