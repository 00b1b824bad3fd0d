"""The pipeline stage by stage against its operators' brute-force rules on planted cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tickerloom.llm")

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from tickerloom.llm import near_copies, simhash_dedup  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(30)
    rows = [(i, prose(80)) for i in range(120)]
    rows += [(200 + i, t) for i, (_, t) in enumerate(rows[:10])]  # exact copies
    rows += [(300 + i, t + " ") for i, (_, t) in enumerate(rows[:5])]
    rows += [(400 + i, f"{prose(20)} {passage} {prose(20)}") for i in range(5)]
    rows += [(500 + i, f'{prose(20)} token = "{rng.getrandbits(160):040x}" {prose(20)}') for i in range(30)]
    rows += [(700, "12 34"), (701, None), (702, "Съешь же ещё этих мягких французских булок да выпей чаю"), (703, "数据处理系统的性能")]  # in none of the languages
    rows += [(800 + i, "".join(rng.choice(("qrstuvwxyz ", "ijklmnéèà ", "wxyzäöü ")[i % 3]) for _ in range(400))) for i in range(90)]
    rows += [(900, " " * 1_000_000 + prose(30)), (901, "\n" * 1_000_000 + prose(30)), (902, prose(20) + " " + "ab" * 500_000)]
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, None if 700 <= i < 704 else ("xx", "yy", "zz")[i % 3] if 800 <= i < 890 else "en", "src0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, dict(rows)


def test_stages(spark, folder):
    at, rows = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns = docs.columns
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, at)
        assert docs.columns == columns
        docs = docs.cache()
        kept.append({r.doc_id: r.text for r in docs.collect()})
    language, near, clean, secrets = kept
    assert set(language) == set(rows) - {700, 701, 702, 703}
    assert set(near) == set(language) - set(range(200, 210)) - set(range(300, 305))
    assert set(clean) == set(near) - set(range(400, 405))
    assert set(secrets) == set(clean)
    changed = {i for i in secrets if secrets[i] != clean[i]}
    assert changed == set(range(500, 530)) and all("[SECRET]" in secrets[i] for i in changed)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, at).collect()
    assert {p.doc_id for p in pieces} == set(secrets)
    assert corpus_pipeline.run(spark, at).count() == len(pieces)


def test_the_language_stage_goes_by_what_it_has_learned(spark, folder):
    """With other langs to learn from, other rows stay."""
    at, rows = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    kept = lambda d: {r.doc_id for r in corpus_pipeline.language_stage(spark, d, at).select("doc_id").collect()}
    rng = random.Random(3)
    more = spark.createDataFrame([(2000 + i, "".join(rng.choice("абвгдежзиклмнопрстуфхчшщыьюя ") for _ in range(300)), "ru", "s", 300) for i in range(40)], docs.schema)
    assert 702 not in kept(docs)
    assert 702 in kept(docs.union(more))
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_stage(spark, nothing, at).count() == 0


def test_stages_on_odd_tables(spark, folder, tmp_path):
    """Empty tables, nulls in every column, repeated rows and columns with names that operators use."""
    at, rows = folder
    schema = "doc_id long, text string, lang string, source string, n_chars long, text_key long, scan string, _found string, h long, block int, key long, f int, held_out boolean"
    some = [(i, t, "en", "s", len(t or "")) for i, t in list(rows.items())[:60]]
    odd = [*some, *some[:3], (None, None, None, None, None), (None, rows[0], "en", None, None), (5000, None, "en", None, 0), (5001, "", None, "s", None), (5002, "Ab cd", None, None, None)]
    full = spark.createDataFrame([(*r, 1, "a", None, 2, 3, 4, 5, True) for r in odd], schema)
    none = full.where("1 = 0")
    spark.createDataFrame([(1, "never seen words"), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    expected = {0: {None, *rows} & {None, *(i for i, *_ in some), 5002}}
    docs = full
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, none, str(tmp_path)).count() == 0
        out = stage(spark, docs, str(tmp_path))
        if k == len(corpus_pipeline.STAGES) - 1:
            assert {p.doc_id for p in out.collect()} == {r.doc_id for r in docs.collect()}
            continue
        assert out.columns == docs.columns
        out = out.cache()
        found = out.collect()
        if k in expected:
            assert {r.doc_id for r in found} - {5002} == expected[k] - {5002}
        if k == 1:  # one of each repeated row, and the null doc_id as it names nothing
            ids = [r.doc_id for r in found]
            assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and None in ids
        assert all(r.scan == "a" and r.f == 5 for r in found)
        docs = out


@pytest.mark.parametrize("large", [2000, 3])
def test_near_copies_match_brute_force(spark, large):
    """Word-edited copies on both sides of the similarity, chains of them, copies of copies, short and empty texts."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(40):
        words = [word() for _ in range(rng.randrange(60, 200))]
        rows.append((10 * i, " ".join(words)))
        for k in range(1, rng.randrange(1, 9)):
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = word()
            rows.append((10 * i + k, " ".join(words)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "One  two\n"), (904, "one three"), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {()}

    sets = {i: shingles(t) for i, t in rows if i is not None}
    least = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(pairs) > 40
    for _ in sets:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    found = near_copies.near_copies(docs, large).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found} == {**least, None: least[0]}
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(i for i in least if least[i] == i)
    assert near_copies.near_copies(docs.where("1 = 0")).collect() == []


def test_the_first_round_finds_pairs_by_simhash_under_covering_masks(spark):
    """Without any band, the components are those of pairs that agree under a mask, as all within 3 bits do, and have the similarity."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(40):
        words = [word() for _ in range(rng.randrange(100, 400))]
        rows.append((10 * i, " ".join(words)))
        for k in range(1, 6):
            words[rng.randrange(len(words))] = word()
            rows.append((10 * i + k, " ".join(words)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "One  two"), (904, "again and again " * 50), (905, "again and again " * 60)]
    _, h, ends = near_copies.shingles(pa.array([t for _, t in rows]))
    sets = [{int(x) for x in h[a:z]} for a, z in zip(ends[:-1], ends[1:], strict=True)]
    fps = [sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in s) > len(s)) if s else None for s in sets]
    got = near_copies.fingerprints(h, ends)
    assert [None if m else int(x) & (1 << 64) - 1 for x, m in zip(got.data, got.mask, strict=True)] == fps
    like = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    meet = lambda a, b: any((fps[a] ^ fps[b]) & m == 0 for m in simhash_dedup.masks(3))
    every = [(a, b) for a in range(len(rows)) for b in range(a) if fps[a] is not None and fps[b] is not None]
    close = [(a, b) for a, b in every if (fps[a] ^ fps[b]).bit_count() <= 3 and sets[a] != sets[b]]
    assert len(close) > 20 and all(meet(a, b) for a, b in close)
    pairs = [(a, b) for a, b in every if meet(a, b) and like(a, b)] + [(1 + rows.index((900, None)), rows.index((900, None)))]
    least = [i for i, _ in rows]
    for _ in range(10):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in near_copies.near_copies(docs, rounds=near_copies.ROUNDS[:1]).collect()}
    assert found == {i: c for (i, _), c in zip(rows, least, strict=True)}
    assert len(set(near_copies.near_copies(docs).toPandas().component_id)) < len(set(found.values()))


def test_a_group_of_near_copies_is_linked_about_once(spark, monkeypatch):
    """Links that a round adds join what earlier rounds have left apart, so their sum stays near the number of texts, not that times the tables and bands."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(300)]
    rows = []
    for i in range(150):
        own = list(words)
        own[rng.randrange(300)] = f"other{i}"
        rows.append((i, " ".join(own)))
    made, whole = [], near_copies.components
    monkeypatch.setattr(near_copies, "components", lambda links: made.append(links.distinct().count()) or whole(links))
    found = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 150
    assert 149 <= sum(made) < 2 * 150, made


def test_links_of_groups_connect_what_pairs_connect():
    rng = random.Random(6)
    for _ in range(40):
        base = [[rng.randrange(1 << 40) for _ in range(30)] for _ in range(4)]
        sets = [np.unique(np.array([x if rng.random() > 0.04 else rng.randrange(1 << 40) for x in base[rng.randrange(4)]], np.uint64)) for _ in range(25)]
        groups = np.array([rng.randrange(25) for _ in sets])
        every = [(a, b) for a in range(25) for b in range(a) if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))]

        def reached(pairs, groups=groups):
            least = groups.tolist()
            for _ in range(25):
                for a, b in pairs:
                    for i in [i for i, x in enumerate(least) if x in (least[a], least[b])]:
                        least[i] = min(least[a], least[b])
            return least

        got = near_copies.links(sets, groups=groups)
        assert set(map(frozenset, got)) <= set(map(frozenset, every)) and reached(got) == reached(every)
        assert len(got) == len(set(groups.tolist())) - len(set(reached(every)))
