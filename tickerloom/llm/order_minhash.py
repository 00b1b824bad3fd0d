"""Operator 12: document fingerprints by Order MinHash, in DataFrame functions alone.

A text's words (long ones in pieces) give k-mers of K neighbouring pieces; the k-mers that are equal are numbered in text order, so
repeats count. Each numbered k-mer has a hash, whose highest bits choose one of BINS sets; of each set the TUPLE k-mers of
least hash are kept, put back into the order in which they stand in the text, and hashed as a tuple. A set agrees in two
documents if the same least k-mers stand in the same order, so moving passages counts as well as replacing them. One hash
serves all sets, where a hash for each would cost BINS times as much. The likeness of two fingerprints is the share of
agreeing sets among those that either document has k-mers for.

All of it is linear or n log n in a text's words: k-mers are sorted with their places, so equal ones lie together, and groups are
numbered by lambda indexes. Columns of the steps are selected one by one, as an expression that a lambda reads is computed for each element.

A document's successor comes next by descending doc_id. Documents are dealt into blocks of neighbouring doc_ids, with bounds
from quantiles; in each a window looks one row ahead, so the texts are shuffled once. The last row of a block takes the first
of the next block, one row a block, which is broadcast with that known number.

Results by case: null and empty texts have no k-mers, a fingerprint of zeros, a likeness of 1 to each other and of 0 to others; a text
of fewer than K pieces has one k-mer of them all; null doc_ids come last, in order of the texts' hashes, as do equal doc_ids;
equal rows are each other's successors; a single row is its own; a very long text is worked whole, in memory for some numbers a word; an empty
table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.tables import block_count, table

K = 3
BINS, BIN_BITS = 64, 6
TUPLE = 2
#: Hashes share a number with places of so many bits, so that plain numbers are sorted; a text of more pieces counts places anew.
PLACE_BITS = 26
#: Longer words are cut into pieces of so many characters.
PIECE_CHARS = 16
#: Text of a block of neighbouring doc_ids, and how many blocks there are at least.
BLOCK_BYTES, LEAST_BLOCKS = 256 << 20, 256

_DIGITS = 4


def pieces(text: Column) -> Column:
    """The words of a text, long ones cut."""
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\f\r", " " * 5), " "), "")
    cut = lambda w: F.when(F.length(w) <= PIECE_CHARS, F.array(w)).otherwise(F.regexp_extract_all(w, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0)))
    return F.transform(F.array(words), lambda own: F.when(F.exists(own, lambda w: F.length(w) > PIECE_CHARS), F.flatten(F.transform(own, cut))).otherwise(own))[0]


def with_fingerprint(docs: DataFrame, text: str, name: str, k: int = K, size: int = TUPLE) -> DataFrame:
    """docs with an array of BINS numbers, 0 for a set without k-mers; columns named with a leading _o serve on the way."""
    low, high = (1 << PLACE_BITS) - 1, -(1 << PLACE_BITS)
    step = docs.withColumn("_ow", F.transform(pieces(F.col(text)), lambda w: F.xxhash64(w)))
    gram = ", ".join(f"get(_ow, i + {j})" for j in range(k))
    step = step.withColumn("_os", F.expr(f"sort_array(if(size(_ow) = 0, slice(array(0L), 1, 0), transform(sequence(0, greatest(size(_ow) - {k}, 0)), i -> xxhash64({gram}) & {high}L | i & {low}L)))")).drop("_ow")
    step = step.withColumn("_of", F.expr(f"filter(transform(_os, (x, i) -> if(i > 0 and (get(_os, i - 1) ^ x) & {high}L = 0, -1, i)), i -> i >= 0)"))
    # the o-th of equal k-mers, hashed with its number; most are the only ones
    numbered = lambda x, o: f"coalesce(xxhash64({x} & {high}L, {o}) & {high}L | {x} & {low}L, 0L)"
    step = step.withColumn("_on", F.expr(f"""sort_array(flatten(transform(_of, (a, j) -> if(coalesce(get(_of, j + 1), size(_os)) = a + 1, array({numbered("get(_os, a)", 0)}),
        transform(sequence(a, coalesce(get(_of, j + 1), size(_os)) - 1), (i, o) -> {numbered("get(_os, i)", "o")})))))""")).drop("_os", "_of")
    bin_of = lambda x: f"cast(shiftrightunsigned({x}, {64 - BIN_BITS}) as int)"
    apart = lambda x, y: f"shiftrightunsigned({x} ^ {y}, {64 - BIN_BITS}) <> 0"
    step = step.withColumn("_oc", F.expr(f"filter(_on, (x, i) -> i < {size} or {apart(f'get(_on, i - {size})', 'x')})")).drop("_on")
    step = step.withColumn("_oh", F.expr(f"filter(transform(_oc, (x, i) -> if(i = 0 or {apart('get(_oc, i - 1)', 'x')}, i, -1)), i -> i >= 0)"))
    # a set's k-mers in text order, as (bin, number)
    turned = f"shiftleft(x & {low}L, {64 - PLACE_BITS}) | shiftrightunsigned(x, {PLACE_BITS})"
    order = f"transform(sort_array(transform(slice(_oc, a + 1, coalesce(get(_oh, j + 1), size(_oc)) - a), x -> {turned})), x -> shiftleft(x, {PLACE_BITS}))"
    entries = f"map_from_entries(transform(_oh, (a, j) -> struct({bin_of('get(_oc, a)')}, cast(1 + pmod(xxhash64({order}), {16**_DIGITS - 1}) as int))))"
    # an outer lambda binds the map, so it is made once
    return step.withColumn(name, F.expr(f"transform(array({entries}), m -> transform(sequence(0, {BINS - 1}), b -> coalesce(m[b], 0)))[0]")).drop("_oc", "_oh")


def written_out(fingerprint: Column) -> Column:
    """A fingerprint as hexadecimal digits."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), _DIGITS, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal numbers among the sets in which either has one; 1 if neither has any."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), None).otherwise((x == y).cast("int")))
    counts = F.aggregate(pairs, F.struct(F.lit(0).alias("n"), F.lit(0).alias("same")), lambda s, x: F.struct((s["n"] + F.when(x.isNull(), 0).otherwise(1)).alias("n"), (s["same"] + F.coalesce(x, F.lit(0))).alias("same")))
    return F.transform(F.array(counts), lambda c: F.when(c["n"] == 0, 1.0).otherwise(c["same"] / c["n"]))[0]


def _block(doc_id: Column, h: Column, bounds: list[int], parts: int) -> Column:
    """Blocks by descending doc_id, then those of null ids by ascending hash. Bounds are searched in two steps."""
    width = max(1, int(len(bounds) ** 0.5))
    rows = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    above = lambda values, x: F.size(F.filter(values, lambda b: b > x))
    if not rows:
        known = F.lit(0)
    else:
        # bounds descend; the row in which the first bound not above doc_id lies
        lasts = F.array(*(F.lit(r[-1]) for r in rows))
        table = F.array(*(F.array(*map(F.lit, r)) for r in rows))
        at = above(lasts, doc_id)
        known = F.transform(F.array(at), lambda a: F.when(a == len(rows), len(bounds)).otherwise(a * width + above(F.coalesce(F.get(table, a), F.array().cast("array<bigint>")), doc_id)))[0]
    unknown = len(bounds) + 1 + F.floor((F.shiftright(h, 33) + (1 << 30)) * parts / F.lit(float(1 << 31))).cast("int")
    return F.when(doc_id.isNull(), unknown).otherwise(known)


def with_successor(rows: DataFrame, columns: list[str], parts: int, extend: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """rows (doc_id, h, ...), extended, with next_<column>: the columns of the next row by descending doc_id and ascending h; of the first row after the last.

    extend adds columns that follow from a row; they are computed once a row, and once more for the first row of each block.
    """
    quantiles = [i / parts for i in range(1, parts)]
    found = rows.agg(F.approx_percentile("doc_id", quantiles, max(10_000, 20 * parts)).alias("q")).first()["q"] or []
    bounds = sorted(set(found), reverse=True)
    block = _block(F.col("doc_id"), F.col("h"), bounds, parts)
    dealt = extend(rows.withColumn("block", block))
    order = [F.desc_nulls_last("doc_id"), F.asc("h")]
    w = Window.partitionBy("block").orderBy(*order)
    ahead = dealt.withColumns({"next_block": F.lead("block").over(w)} | {f"next_{c}": F.lead(c).over(w) for c in columns})
    # the first row of each block, and the block before it that has rows: of known ids first, one row a block
    firsts = rows.withColumn("block", block).groupBy("block").agg(F.min_by(F.struct("doc_id", "h"), F.struct((-F.col("doc_id")).alias("d"), "h")).alias("k")).collect()
    blocks = sorted(r["block"] for r in firsts)
    if not blocks:
        return ahead.drop("block", "next_block", "h").select(*[c for c in dealt.columns if c not in ("h", "block")], *(f"next_{c}" for c in columns))
    heads = {r["block"]: r["k"] for r in firsts}
    before = [(blocks[i - 1], b, heads[b]["doc_id"], heads[b]["h"]) for i, b in enumerate(blocks)]
    wanted = F.broadcast(rows.sparkSession.createDataFrame(before, "to_block int, block int, doc_id long, h long"))
    same = rows.alias("r").join(wanted.alias("w"), F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("r.h") == F.col("w.h")))
    plain = same.groupBy("w.to_block").agg(*(F.first(f"r.{c}").alias(c) for c in rows.columns))  # equal rows have equal columns
    head = extend(plain).select("to_block", *(F.col(c).alias(f"head_{c}") for c in columns))
    out = ahead.join(F.broadcast(head), F.col("next_block").isNull() & (F.col("block") == F.col("to_block")), "left")
    return out.withColumns({f"next_{c}": F.when(F.col("next_block").isNull(), F.col(f"head_{c}")).otherwise(F.col(f"next_{c}")) for c in columns}).select(*[c for c in dealt.columns if c not in ("h", "block")], *(f"next_{c}" for c in columns))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h) of each row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h, fp) of each row."""
    return with_fingerprint(keyed(docs), "text", "fp")


def op12_order_minhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = docs.select(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    pairs = with_successor(keyed(docs), ["text", "fp"], block_count(size, BLOCK_BYTES, LEAST_BLOCKS), lambda df: with_fingerprint(df, "text", "fp"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = pairs.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    both = with_fingerprint(edited, "edited", "edited_fp")
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written_out(F.col("fp")).alias("fingerprint"), written_out(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
