"""Operator 13 against brute force on odd tables; test_sql compares it with SQL."""

import collections
import itertools
import random
import re

import pytest

pytest.importorskip("tickerloom.llm")

from pyspark.sql import functions as F  # noqa: E402

from tickerloom.llm import filter_audit  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    out = [(i, prose(rng.randrange(0, 300)), rng.choice(["a", "b", None, ""])) for i in range(80)]
    out = [(i, t.upper() if i % 6 == 0 else f"{t} & 5%" if i % 5 == 0 else t, p) for i, t, p in out]
    out += [(100 + i, out[i % 9][1], "a") for i in range(60)]  # groups of copies
    out += [(300 + i, "the same", "b") for i in range(90)]  # a large one
    out += [(400, None, "a"), (401, "", "a"), (402, None, None), (403, " \x0b\t\x0c\r\n ", "b"), (404, "É" * 50 + "A" * 5, "b"), (405, "É" * 44 + "A" * 5, "b"), (406, "x " * 200_000, "c")]
    out += [(None, "the same", "b"), (None, None, "a"), (None, None, "a"), out[3], out[3], (3, "another text of an id", "b")]
    rng.shuffle(out)
    return out


def brute(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    counts = collections.Counter()
    for i, t, p in docs:
        t = t or ""
        w = WORD.findall(t)
        bits = (len(w) < 100) + 2 * (100 * len(set(w)) < 80 * len(w)) + 4 * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + 8 * bool(re.search("[#$%&*|]", t))
        bits += 16 * (i is not None and least[t] < i)
        own = [x for x in labels if x[0] == i and i is not None]
        counts[p or "", bits, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)] += 1
    out = {}
    for part in {k[0] for k in counts}:
        shapley = collections.Counter()
        mine = [(b, g, x, n) for (p, b, g, x), n in counts.items() if p == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                bit = 1 << "ABCDE".index(c)
                gone = [m for m in left if m[0] & bit]
                left = [m for m in left if not m[0] & bit]
                total = lambda ms: sum(m[3] for m in ms)
                shapley[c] += total(gone)
                out[part, "".join(order), step] = [total(left), total(gone), total([m for m in mine if m[0] & bit]) - total(gone), total([m for m in mine if m[0] == bit]), total([m for m in gone if m[1]]), total([m for m in gone if m[2]]), c]
        for (p, _, _), v in out.items():
            if p == part:
                v[6] = shapley[v[6]] if isinstance(v[6], str) else v[6]
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("hot_groups", [1000, 3])
def test_matches_brute_force(spark, hot_groups):
    docs = rows()
    labels = [(i, rng % 2, rng % 3) for i, rng in zip(range(0, 400, 2), itertools.count())] + [(0, 1, None), (0, 0, 1), (None, 1, 1), (7, None, None)]
    table = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in docs], "doc_id long, text string, lang string, bits int, n int, part string, h int").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.combinations(table, marks, hot_groups)).collect()
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == brute(docs, labels)


def test_empty_table_and_unequal_texts_of_one_hash(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.combinations(none, labels)).collect() == []
    keyed = spark.createDataFrame([(1, "p", "x"), (2, "p", "y"), (3, "p", "y"), (4, "p", "x"), (5, "p", "z")], "doc_id long, part string, text string").withColumn("h", F.lit(7).cast("long"))
    assert sorted(r.doc_id for r in filter_audit.later_twins(keyed).collect()) == [3, 4]
