"""Operator 2: near-duplicates by SimHash fingerprints, found with covering locality-sensitive hashing.

For radius r every bit gets a random value of r + 1 bits, and each non-zero vector v of r + 1 bits gives the mask of
the bits whose value has an odd product with v. The values of at most r differing bits span less than the
whole space, so some v is orthogonal to them all, and the two fingerprints agree under that v's mask: every pair
within the radius meets in one of the 2**(r+1) - 1 tables, none is missed.

Equal fingerprints become one row before any search, so exact copies cost nothing there. A bucket gives links that
connect what its pairs connect, not all its pairs: those of up to SMALL fingerprints come from a join, those of up to
LARGE from a search in one task that goes on from each linked fingerprint to those not yet reached. Larger buckets are
dealt again by a second and third independent covering within the bucket, which keeps the guarantee and splits them
into ever closer groups. What is still too large then is dealt into parts, and each pair of parts is searched by itself.

Results by case: null and empty texts have fingerprint zero, and link like any other; repeated rows stay, each
with its result; a null doc_id takes part but never names a component, which is null if all its ids are; ties don't
arise, as a component is named by its least doc_id; a very long text is hashed as a whole, in memory for its shingles'
hashes; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import words as W
from tickerloom.llm.components import components
from tickerloom.llm.tables import saved, table

RADIUS = 3
SHINGLE_WORDS = 3
#: Distinct fingerprints of a bucket that a join compares, and that one task searches.
SMALL, LARGE = 16, 2000
COVERINGS = 3


def masks(radius: int = RADIUS, seed: int = 1) -> list[int]:
    """The masks of one covering, as signed 64-bit values."""
    rng = random.Random(seed)
    values = [rng.randrange(1 << (radius + 1)) for _ in range(64)]
    out = [sum(1 << i for i, x in enumerate(values) if (x & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh64_intdigest
    for chunk in W.chunks(batches):
        w = W.Words(chunk["text"], W.SPACE_WORD, lower=True)
        pieces = w.buf.tobytes().split()
        out = []
        for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            own = pieces[a:z]
            n = len(own) - size + 1
            h = [digest(b" ".join(own[i : i + size]), 42) for i in range(max(1, n))] if own else []
            # a bit is one if it is set in over half the hashes; slices keep a long text's bits small
            bits = sum((np.unpackbits(np.array(h[i : i + 65536], ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64) for i in range(0, len(h), 65536)), np.zeros(64, np.int64))
            out.append(int.from_bytes(np.packbits(bits * 2 > len(h)).tobytes(), "big", signed=True))
        yield pa.RecordBatch.from_pydict({"doc_id": chunk["doc_id"], "fp": pa.array(out, pa.int64())})


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda b: _fingerprints(b, size), "doc_id long, fp long")


def covering(fp: Column, radius: int = RADIUS, seed: int = 1) -> Column:
    """A row (t, v) for each table of a covering: two fingerprints within the radius are equal in at least one."""
    return F.explode(F.array(*(F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks(radius, seed)))))


def spanning(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs within the radius that connect all values which such pairs connect; fewer than there are values."""
    bits, found, left = fps.view(np.uint64), [], np.arange(len(fps))  # signed values would count the bits of their amounts
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(bits[left] ^ bits[x]) <= radius
            found += [(int(fps[x]), int(fps[y])) for y in left[near]]
            queue += left[near].tolist()
            left = left[~near]
    return found


def _search(bucket: pa.Table, radius: int) -> pa.Table:
    pairs = spanning(np.unique(bucket["fp"].to_numpy()), radius)
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})


def close_links(distinct: DataFrame, radius: int = RADIUS, small: int = SMALL, large: int = LARGE) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints fp that differ in at most radius bits, enough to connect all that such pairs connect."""
    found, search = [], lambda bucket: _search(bucket, radius)
    rows = distinct.select("fp", F.lit("").alias("path"))
    for level in range(COVERINGS):
        keyed = rows.select("fp", "path", covering(F.col("fp"), radius, level + 1).alias("k")).select("fp", F.concat_ws("/", "path", "k.t", "k.v").alias("path"))
        sizes = keyed.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = saved(keyed.join(sizes, "path"), "buckets")
        few = shared.where(F.col("n") <= small)
        a, b = few.select("path", F.col("fp").alias("a")), few.select("path", F.col("fp").alias("b"))
        found.append(a.join(b, "path").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b"))
        found.append(shared.where((F.col("n") > small) & (F.col("n") <= large)).groupBy("path").applyInArrow(search, "a long, b long"))
        many = shared.where(F.col("n") > large)
        if many.isEmpty():
            break
        if level == COVERINGS - 1:
            part = many.withColumn("parts", F.ceil(F.col("n") / large).cast("int")).withColumn("part", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int"))
            cells = part.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).select("fp", "path", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
            found.append(cells.groupBy("path", "i", "j").applyInArrow(search, "a long, b long"))
        rows = many.select("fp", "path")
    return functools.reduce(DataFrame.union, found).distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of each row: the least doc_id that chains of fingerprints within the radius reach."""
    own = saved(fingerprints(docs), "fingerprints")
    distinct = saved(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    linked = components(close_links(distinct, radius))
    # labels are fingerprints; a component is named by the least document of any of its fingerprints
    labelled = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = labelled.join(named, "label").select("fp", "component_id")
    return own.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def op2_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """keep_least for the components of fingerprints within the radius."""
    return keep_least(docs, near_duplicates(docs, radius))


def keep_least(docs: DataFrame, components: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, less those that share a component (doc_id, component_id) with a row of smaller doc_id; of repeated rows of one doc_id one stays, and rows without doc_id stay."""
    found = saved(components, "components")
    gone = found.where("doc_id > component_id").select("doc_id").distinct()
    repeated = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return kept
    one = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
