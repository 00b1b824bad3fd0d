"""Near copies among documents: five-word shingles with a Jaccard similarity of 0.8 or more.

Candidates come first from SimHash: a text has a 64-bit fingerprint of its distinct shingles, and every pair of texts
within RADIUS bits meets in a table of simhash_dedup's covering masks. Those are the closest copies; at 0.8, the least
similarity that counts, fingerprints differ in 10 bits on average, and a covering of that radius has 2,047 tables. So the
pairs that are further apart are found next, by BANDS hashes of BAND_HASHES MinHash values each: two texts of similarity s
agree in a band with chance s**BAND_HASHES; at 0.8 they agree in none with a chance of 0.00036, and above it with less.
Texts of equal words become one row before any search.

Candidates are then compared exactly, by their sets of shingle hashes, and only pairs within the similarity are linked.
Buckets with the same members are compared once, and those that an earlier round has connected not at all. A bucket's links are found by a search that goes on from each linked
text to those not yet reached, so a bucket of copies takes about one pass. What earlier rounds have connected counts as reached
together, so a bucket's links are fewer than the groups that it holds, and each round joins groups, not texts. A bucket of over LARGE texts is dealt into
parts, and each pair of parts is compared by itself: no pair is left out, and what meets in one task is bounded.

Results by case: texts of fewer than five words are one shingle; null and empty texts are copies of each other;
repeated rows and null doc_ids take part, but a null never names a component, which is null if all its ids are; ties don't
arise, as a component is named by its least doc_id; a very long text is worked whole in one task, in memory for its shingles'
hashes; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import simhash_dedup
from tickerloom.llm import words as W
from tickerloom.llm.components import components
from tickerloom.llm.tables import saved

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Bits in which the fingerprints of a pair of the first round differ at most.
RADIUS = simhash_dedup.RADIUS
BANDS, BAND_HASHES = 20, 5
#: First and last band of each round of comparisons, for each search; the covering's tables count down from -1. A search's first rounds are small, as their links join texts, later ones groups.
ROUNDS = (((-1, -1), (1 - (1 << (RADIUS + 1)), -2)), ((0, 2), (3, BANDS - 1)))
#: Bits of a shingle's hash in the sets that are compared: two given shingles share one with a chance of 2**-40.
HASH_BITS = 40
#: Texts of a bucket that are compared in one task are at most about twice as many.
LARGE = 2000

_RNG = np.random.default_rng(11)
_FLIPS = _RNG.integers(0, 1 << 63, BANDS * BAND_HASHES, np.uint64)
_FACTORS = _RNG.integers(0, 1 << 63, BANDS * BAND_HASHES, np.uint64) << np.uint64(1) | np.uint64(1)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A key of each text's words, the hashes of the shingles of all texts, and where each text's begin, with the end."""
    w = W.Words(texts, W.SPACE_WORD, lower=True)
    h = w.hashes()
    n = np.diff(w.first)
    keys = np.array([xxhash.xxh64_intdigest(h[a:z].tobytes()) for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)], np.uint64).view(np.int64)
    counts = np.where(n >= SHINGLE_WORDS, n - SHINGLE_WORDS + 1, np.minimum(n, 1))
    ends = np.append(0, np.cumsum(counts))
    out = np.zeros(int(ends[-1]), np.uint64)
    long = np.repeat(n >= SHINGLE_WORDS, counts)
    out[long] = W.rolled(h, SHINGLE_WORDS)[W.whole_windows(w.text_of(), SHINGLE_WORDS)]
    for i in np.flatnonzero((n > 0) & (n < SHINGLE_WORDS)):
        out[ends[i]] = W.rolled(h[w.first[i] : w.first[i + 1]], int(n[i]))[0]
    return keys, out, ends


def bands(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bands of each text, a row each; texts without shingles have zeros."""
    out = np.zeros((len(ends) - 1, BANDS), np.uint64)
    some = np.flatnonzero(np.diff(ends))
    for b in range(BANDS if len(some) else 0):
        own = np.full(len(some), b + 1, np.uint64)
        for i in range(b * BAND_HASHES, (b + 1) * BAND_HASHES):
            own = W.mix(own ^ np.minimum.reduceat((h ^ _FLIPS[i]) * _FACTORS[i], ends[some]))
        out[some, b] = own
    return out


def fingerprints(h: np.ndarray, ends: np.ndarray) -> np.ma.MaskedArray:
    """The SimHash of each text's distinct shingles: a bit is one if it is set in over half of them; none for texts without shingles."""
    counts = np.diff(ends)
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))[: len(h)]
    h, n = h[new], np.bincount(text[new], minlength=len(counts))
    some, out = np.flatnonzero(n), np.zeros(len(counts), np.uint64)
    first = (np.cumsum(n) - n)[some]
    for bit in range(64 if len(some) else 0):
        ones = np.add.reduceat(h >> np.uint64(bit) & np.uint64(1), first)
        out[some] |= (2 * ones > n[some].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return np.ma.array(out.view(np.int64), mask=n == 0)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in W.chunks(batches):
        keys, h, ends = shingles(chunk["text"])
        own = bands(h, ends).view(np.int64)
        offsets = pa.array(np.arange(len(own) + 1) * BANDS, pa.int32())
        fps = fingerprints(h, ends)
        yield pa.RecordBatch.from_pydict({"doc_id": chunk["doc_id"], "key": keys, "fp": pa.array(fps.data, pa.int64(), mask=np.ma.getmaskarray(fps)), "bands": pa.ListArray.from_arrays(offsets, pa.array(own.reshape(-1)))})


def packed(h: np.ndarray) -> bytes:
    """The distinct values of HASH_BITS bits in order, as steps from one to the next, which need fewer bytes."""
    x = np.unique(h & np.uint64((1 << HASH_BITS) - 1))
    return len(x).to_bytes(4, "little") + W.pack(np.diff(x, prepend=np.uint64(0)))


def unpacked(b: bytes) -> np.ndarray:
    return np.cumsum(W.unpack(b[4:], np.uint64, int.from_bytes(b[:4], "little")))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct shingle hashes of each text."""
    for chunk in W.chunks(batches):
        keys, h, ends = shingles(chunk["text"])
        yield pa.RecordBatch.from_pydict({"key": keys, "shingles": pa.array([packed(h[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)], pa.binary())})


def links(sets: list[np.ndarray], similarity: float = SIMILARITY, groups: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of sets of at least the similarity that connect all sets which chains of such pairs connect; sets of equal groups are connected without a pair."""
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), sizes)
    first = np.append(0, np.cumsum(sizes))
    every, marks = codes, np.zeros(int(codes.max()) + 1 if len(codes) else 0, bool)
    groups = np.arange(len(sets)) if groups is None else groups
    free = np.ones(len(sets), bool)
    left, found, dropped = len(sets), [], 0
    for seed in range(len(sets)):
        queue = np.flatnonzero(free & (groups == groups[seed])).tolist() if free[seed] else []
        left -= len(queue)
        free[queue] = False
        while queue and left:
            x = queue.pop()
            own = codes[first[x] : first[x + 1]]
            marks[own] = True
            both = np.bincount(owner[marks[every]], minlength=len(sets))
            marks[own] = False
            near = np.flatnonzero(free & (both > 0) & (both >= similarity * (sizes[x] + sizes - both)))
            found += [(x, int(y)) for y in near[np.unique(groups[near], return_index=True)[1]]]
            reached = np.flatnonzero(free & np.isin(groups, groups[near])) if len(near) else near
            free[reached] = False
            left -= len(reached)
            dropped += len(reached) + 1
            queue += reached.tolist()
            if 2 * dropped > left:  # look no more at what is reached
                stays = free[owner]
                every, owner, dropped = every[stays], owner[stays], 0
    return found


def _links(cell: pa.Table) -> pa.Table:
    labels = cell["label"].to_numpy()
    pairs = np.array(links([unpacked(x.as_py()) for x in cell["shingles"]], groups=labels), np.int64).reshape(-1, 2)
    return pa.table({"a": labels[pairs[:, 0]], "b": labels[pairs[:, 1]]})


def relabelled(labels: DataFrame, moved: DataFrame) -> DataFrame:
    """labels (node, label) after moved (node, label), whose nodes are labels or new nodes: the least node of each group that has become one."""
    to = moved.select(F.col("node").alias("label"), F.col("label").alias("to"))
    known = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return known.unionByName(moved.join(labels, "node", "left_anti").select("node", "label"))


def connected(docs: DataFrame, distinct: DataFrame, large: int = LARGE, rounds: tuple = ROUNDS) -> DataFrame:
    """(node, label): the least key that chains of texts within the similarity reach, of keys in such chains; distinct has key, fp and bands.

    The covering's tables and the bands are compared in rounds. A bucket whose texts an earlier round has connected already has nothing to add and is left
    out, so groups of copies, which share most of their bands, are compared in the first round alone.
    """
    close = distinct.where("fp is not null").select("key", simhash_dedup.covering(F.col("fp"), RADIUS).alias("k"))
    close = close.select("key", (-1 - F.col("k.t")).alias("band"), F.xxhash64("k.t", "k.v").alias("bucket"))
    rows = close.unionByName(distinct.select("key", F.posexplode("bands").alias("band", "bucket")).where("bucket <> 0"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = saved(rows.join(shared, "bucket").select("key", "band", "bucket"), "members")
    sets = docs.mapInArrow(_sets, "key long, shingles binary").join(members.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    sets = saved(sets, "shingles")
    labels = None
    for first, last in (r for search in rounds for r in search):
        own = members.where(F.col("band").between(first, last))
        if labels is None:
            own = own.withColumn("label", F.col("key"))
        else:
            own = own.join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", "bucket", F.coalesce("label", "key").alias("label"))
        sizes = own.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("key")).alias("members"), F.min("label").alias("a"), F.max("label").alias("z")).where("a < z")
        once = saved(sizes.groupBy("n", "members").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("n") / large).cast("int").alias("parts")), "buckets")
        part = own.join(once, "bucket").withColumn("part", F.pmod(F.xxhash64("key", F.lit(3)), F.col("parts")).cast("int"))
        other = part.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        cells = other.select("key", "label", "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
        pairs = saved(cells.join(sets, "key").groupBy("bucket", "i", "j").applyInArrow(_links, "a long, b long"), "pairs")
        moved = components(pairs)
        labels = moved if labels is None else saved(relabelled(labels, moved), "labels")
    return labels


def near_copies(docs: DataFrame, large: int = LARGE, rounds: tuple = ROUNDS) -> DataFrame:
    """(doc_id, component_id) of each row: the least doc_id that chains of near copies reach."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = saved(docs.mapInArrow(_sketch, "doc_id long, key long, fp long, bands array<long>"), "sketches")
    distinct = saved(own.groupBy("key").agg(F.min("doc_id").alias("least"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "distinct")
    linked = connected(docs.select("text"), distinct, large, rounds)
    labelled = distinct.join(linked.withColumnRenamed("node", "key"), "key", "left").select("key", "least", F.coalesce("label", "key").alias("label"))
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return own.join(labelled.join(named, "label").select("key", "component_id"), "key").select("doc_id", "component_id")
