"""Operator 12 against plain loops."""

import hashlib
import random
import re
import struct

import pytest

pytest.importorskip("tickerloom.llm")

import xxhash  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tickerloom.llm import order_minhash as om  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOP = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hashed(values, kinds):
    seed = 42
    for v, k in zip(values, kinds, strict=True):
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack(k, v), seed)
    return signed(seed)


def fingerprint(text):
    own = [w[i : i + 16] for w in WORD.findall(text) for i in range(0, len(w), 16)]
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in own]
    seen, sets = {}, {}
    for p in range(max(1, len(h) - 2) if h else 0):
        g = hashed((h[p : p + 3] + [None] * 3)[:3], ["<q"] * 3) >> 26 << 26
        o = seen[g] = seen.get(g, -1) + 1
        v = hashed((g, o), ("<q", "<i")) >> 26 << 26
        sets.setdefault((v & TOP) >> 58, []).append((v, p))
    out = []
    for b in range(64):
        least = sorted(sets.get(b, []))[:2]
        tuple_hash = hashed([v for v, _ in sorted(least, key=lambda x: x[1])], ["<q"] * len(least))
        out.append(f"{1 + tuple_hash % 65535 if least else 0:04x}")
    return out


def alike(a, b):
    own = [(x, y) for x, y in zip(a, b, strict=True) if x != "0000" or y != "0000"]
    return sum(x == y for x, y in own) / len(own) if own else 1.0


def rows():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdéf数😀") for _ in range(rng.randrange(1, 8))) for _ in range(80)]
    out = [(rng.randrange(10**6) - 5 * 10**5, rng.choice([" ", "\n", " \t"]).join(rng.choice(words[: rng.choice([1, 5, 80])]) for _ in range(rng.randrange(0, 200)))) for _ in range(120)]
    out += [(10**7, "x" * 3000), (10**7 + 1, "y" * 16 + " " + "z" * 17), (-(10**12), None), (10**12, ""), (5, "one"), (6, "one two"), (7, "two one"), (8, "one two " * 3000), (9, "a b c " * 3)]
    return out


def expected(docs):
    order = sorted(docs, key=lambda r: -r[0])
    out = {}
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        a, b, c = fingerprint(t), fingerprint(edited), fingerprint(following)
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), alike(a, b), alike(a, c))
    return out


@pytest.mark.parametrize("count", [1, 2, 129])
def test_query_matches_plain_loops(spark, tmp_path, count):
    docs = rows()[:count]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in docs], "doc_id long, text string, h int, block string, fp int")
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = om.op12_order_minhash(spark, str(tmp_path)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected(docs) and len(got) == len(docs)


def test_likeness_follows_order_and_edits(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(600)]
    versions = [base, base, base[300:] + base[:300], base[:590] + [word() for _ in range(10)], base[:300] + [word() for _ in range(300)], [word() for _ in range(600)]]
    own = om.with_fingerprint(spark.createDataFrame([(i, " ".join(v)) for i, v in enumerate(versions)], "i int, t string"), "t", "fp")
    fps = {r.i: r.fp for r in own.collect()}
    near = [alike([f"{x:04x}" for x in fps[0]], [f"{x:04x}" for x in fps[i]]) for i in range(6)]
    assert near[1] == 1 and 0.4 < near[2] < 0.9 and near[3] > 0.8 and 0.05 < near[4] < 0.4 and near[5] < 0.05


def test_successors_of_null_and_equal_ids(spark):
    rows = [(None, 5, "e"), (None, -5, "d"), (3, 1, "b"), (3, 1, "b"), (3, 0, "a"), (None, 5, "e"), (9, 7, "z"), (1, 2, "c")]
    table = spark.createDataFrame(rows, "doc_id long, h long, t string").repartition(3)
    for parts in (1, 2, 5):
        found = om.with_successor(table, ["t"], parts).collect()
        assert sorted((r.t, r.next_t) for r in found) == sorted(zip("zabbcdee", "abbcdeez", strict=True))
    assert om.with_successor(table.where("1 = 0"), ["t"], 4).collect() == []
    assert om.with_successor(table.where("t = 'c'"), ["t"], 4).select("next_t").collect() == [("c",)]


def test_lambdas_read_columns_and_not_expressions(spark, tmp_path):
    """An expression that a lambda reads is computed for each element, so each step stays a projection of its own, without Python."""
    spark.createDataFrame([(1, "a b c d")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = om.fingerprinted(spark.read.parquet(f"{tmp_path}/documents.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") == 3 and plan.count("Project") >= 6 and "Python" not in plan and "Arrow" not in plan
    assert all(f"{c}#" in plan for c in ("_ow", "_os", "_of", "_on", "_oc", "_oh"))
