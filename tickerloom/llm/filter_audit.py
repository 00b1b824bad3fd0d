"""Operator 13: what each filter of a cascade removes in every order of the filters.

A document fails some of five conditions, kept as bits. Four are expressions on its own text. The fifth, an equal text under
a smaller doc_id, is an existential self-join: a left-semi join on the text's hash, the text itself and the smaller doc_id. The
ids that it finds are united with the ids and bits of the other failures, and one aggregation gives the bits of every
document. How often each combination of bits occurs is all that the orders need: 32 rows a part, whatever the input.

The right side of the self-join is aggregated to one row a text before it is shuffled. A text that more than one in
HOT_GROUPS rows hold is dealt into parts by doc_id on the left and repeated once a part on the right; fewer than HOT_GROUPS
texts can be so frequent, which bounds what is broadcast.

Results by case: a null text is empty, and equal to other empty ones; a null lang is the part of the empty string; a null
doc_id has no smaller one and is smaller than none; of rows with one doc_id and text none is smaller, so all stay or go
together, each counted as a document; documents without labels count as neither good nor toxic, and of several labels of one
doc_id any that is 1 counts; a very long text is worked whole, in memory for its words; an empty table has no part and
gives no rows; other columns are passed over.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.tables import table

LETTERS = "ABCDE"
TWIN_BIT = 1 << LETTERS.index("E")
#: A text with more than one in so many rows is dealt into parts.
HOT_GROUPS = 1000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failed_bits(text: Column, least_words: int = 100, least_distinct: int = 80, most_upper: int = 10, marks: str = "#$%&*|") -> Column:
    """The bits of the conditions on a text alone: few words, few distinct words (percent), many capitals (percent of code points), any of the marks."""
    # one column for the words: a lambda binds them, so they are split once
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\f\r", " " * 5), " "), "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    capitals = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    few = F.transform(F.array(counts), lambda c: F.when(c["n"] < least_words, 1).otherwise(0) + F.when(100 * c["d"] < least_distinct * c["n"], 2).otherwise(0))[0]
    marked = F.length(F.translate(text, marks, "")) < F.length(text)
    return few + F.when(100 * capitals > most_upper * F.length(text), 4).otherwise(0) + F.when(marked, 8).otherwise(0)


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text, h) of each row: the text without nulls and its hash."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("h"))


def later_twins(rows: DataFrame, hot_groups: int = HOT_GROUPS) -> DataFrame:
    """The rows of keyed texts, without the text, that have an equal text under a smaller doc_id."""
    share = max(1.0, rows.count() / hot_groups)
    sizes = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
    hot = F.broadcast(sizes.select("h", F.ceil(F.col("n") / share).cast("int").alias("parts")))  # fewer than hot_groups rows
    parts = F.coalesce("parts", F.lit(1))
    firsts = rows.where("doc_id is not null").groupBy("h", "text").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    right = firsts.join(hot, "h", "left").select("h", "text", "least", F.explode(F.sequence(F.lit(0), parts - 1)).alias("deal"))
    left = rows.join(hot, "h", "left").withColumn("deal", F.pmod(F.xxhash64("doc_id"), parts).cast("int"))
    same = (left["h"] == right["h"]) & (left["deal"] == right["deal"]) & (left["text"] == right["text"])
    return left.join(right, same & (right["least"] < left["doc_id"]), "left_semi").select("doc_id", "part", "h")


def combinations(docs: DataFrame, labels: DataFrame, hot_groups: int = HOT_GROUPS) -> DataFrame:
    """(part, bits, n, good, toxic): how many documents of each part fail each combination of filters, all, good and toxic ones."""
    rows = keyed_texts(docs)
    own = rows.select("doc_id", "part", "h", failed_bits(F.col("text")).alias("bits"), F.lit(1).alias("n"))
    twins = later_twins(rows, hot_groups).select("doc_id", "part", "h", F.lit(TWIN_BIT).alias("bits"), F.lit(0).alias("n"))
    each = own.unionByName(twins).groupBy("doc_id", "part", "h").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    # rows of one doc_id and text found twins together, as often as there are of them; their n counts them
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    known = each.join(marks, "doc_id", "left")
    return known.groupBy("part", "bits").agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")))


def order_steps(letters: str = LETTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it) of every order of the filters."""
    bit = {c: 1 << i for i, c in enumerate(letters)}
    return [("".join(o), k + 1, bit[o[k]], sum(bit[c] for c in o[:k])) for o in itertools.permutations(letters) for k in range(len(o))]


def audit(found: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from the combinations of failures in each part."""
    steps = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(b).alias("bit"), F.lit(e).alias("earlier")) for o, k, b, e in order_steps(letters)))
    each = found.withColumn("s", F.explode(steps)).select("part", "bits", "n", "good", "toxic", "s.*")
    failing, before = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.col("earlier")) != 0
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0)).cast("long")
    out = each.groupBy("part", "filter_order", "step", "bit").agg(
        total("n", ~failing & ~before).alias("kept"), total("n", failing & ~before).alias("removed"), total("n", failing & before).alias("redundant"),
        total("n", F.col("bits") == F.col("bit")).alias("unique_fails"), total("good", failing & ~before).alias("good_lost"), total("toxic", failing & ~before).alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(combinations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
