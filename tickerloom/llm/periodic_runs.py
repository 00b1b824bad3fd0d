"""Operator 11: periodic runs of words, seeded by minimizers of several scales.

A run is a stretch of words in which words `period` apart are equal, of at least LEAST_WORDS words and LEAST_TURNS periods,
that no neighbouring word extends; its period is the smallest it has. Lags up to DIRECT are scanned directly, as runs of such
periods must be long. Longer periods fall into scales (low, high], high about GROWTH times low. In a run of period q of that
scale, grams of `high` >= q words that are equal lie multiples of q apart, since the words of one period are no repetition
themselves. A window of `2 * low + 3 - high` grams and its neighbour q further both fit into three periods, so their minima
are equal grams exactly q apart, with no equal gram between: neighbours among the equal minimizers of a scale are all the
seeds there are to check. A seed is extended in both directions by comparing words; a stretch is extended once for each lag, so the
work is n log n for any text. Hashes only propose, words decide, and every run is found.

Words are coded by their bytes over a batch of texts, every text is followed by a code of its own, and texts lie longest first,
so each scale works on the front part that is long enough for it.

Results by case: null and empty texts have no words and no runs; repeated rows have the same results each; runs of equal start and
length are one, of the smallest period; a null doc_id is carried along; a very long text is a batch of its own, in memory for a
few numbers a word; an empty table gives an empty result; other columns are carried along but for those of the results' names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm import words as W
from tickerloom.llm.tables import table

LEAST_WORDS, LEAST_TURNS = 24, 3
#: Lags that are scanned directly.
DIRECT = 8
GROWTH = 1.5

_MIX = np.uint64(0x9E3779B97F4A7C15)

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)


def scales(longest: int, low: int = DIRECT, growth: float = GROWTH) -> Iterator[tuple[int, int, int]]:
    """(low, high, grams in a window) up to the longest period that fits in a text of so many words."""
    while LEAST_TURNS * (low + 1) <= longest:
        high = max(low + 1, int(low * growth))
        yield low, high, 2 * low + 3 - high
        low = high


def _gram_hashes(doubled: list[np.ndarray], size: int, n: int) -> np.ndarray:
    """A hash of each run of size codes among the first n, from hashes of runs of powers of two, which are added as needed; n doesn't grow from call to call."""
    level = size.bit_length() - 1
    while len(doubled) <= level:
        h, step = doubled[-1], 1 << (len(doubled) - 1)
        left = n - 2 * step + 1
        doubled.append(W.mix(h[:left] * _MIX + h[step : step + left]))
    reach, h = 1 << level, doubled[level]
    left = n - size + 1
    return h[:left] if reach == size else W.mix((h[:left] ^ _MIX) * _MIX + h[size - reach : size - reach + left])


def _sliding_max(x: np.ndarray, size: int) -> np.ndarray:
    return ~W.sliding_min(~x, size)


def seeds(hashes: np.ndarray, low: int, high: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of neighbouring equal minimizers whose lag belongs to the scale."""
    least = W.sliding_min(hashes, window)
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # a gram is a minimizer if it is the least of any window that holds it
    around = np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding_max(around, window) == hashes)
    own = hashes[chosen]
    order = np.argsort(own, kind="stable")
    place, own = chosen[order], own[order]
    lag = np.diff(place)
    fits = (own[1:] == own[:-1]) & (lag > low) & (lag <= high)
    return place[:-1][fits], lag[fits]


def _first_unlike(seq: np.ndarray, at: int, lag: int) -> int:
    """The first place from `at` on whose value differs from the one `lag` further."""
    size = 64
    while at + lag < len(seq):
        part = seq[at + lag : at + lag + size]
        unlike = np.flatnonzero(seq[at : at + len(part)] != part)
        if len(unlike):
            return at + int(unlike[0])
        at, size = at + len(part), size * 2
    return at


def _last_unlike(seq: np.ndarray, at: int, lag: int) -> int:
    """The last place before `at` whose value differs from the one `lag` further, or -1."""
    size = 64
    while at > 0:
        a = max(0, at - size)
        unlike = np.flatnonzero(seq[a:at] != seq[a + lag : at + lag])
        if len(unlike):
            return a + int(unlike[-1])
        at, size = a, size * 2
    return -1


def _enough(length, lag):
    return (length >= LEAST_WORDS) & (length >= LEAST_TURNS * lag)


def find_runs(codes: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each sequence of codes (0 or more), by start and period."""
    sizes = np.array([len(c) for c in codes], np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    n_long = int((sizes >= LEAST_WORDS).sum())  # the rest can't hold a run
    own = by_size[:n_long]
    found: list[list] = [[] for _ in codes]
    if not n_long:
        return found
    # each sequence is followed by a value of its own
    seq = np.concatenate([x for i, k in enumerate(own.tolist()) for x in (codes[k].astype(np.int64), np.array([-1 - i]))])
    ends = np.cumsum(sizes[own] + 1)
    starts = ends - sizes[own] - 1
    periods: dict[tuple[int, int], int] = {}

    def take(start: int, length: int, lag: int) -> None:
        periods[start, length] = min(lag, periods.get((start, length), lag))

    for lag in range(1, DIRECT + 1):
        alike = np.zeros(max(0, len(seq) - lag) + 2, np.int8)
        alike[1:-1] = seq[:-lag] == seq[lag:] if len(seq) > lag else 0
        turns = np.diff(alike)
        a, z = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        fits = _enough(z - a + lag, lag)
        for start, stop in zip(a[fits].tolist(), z[fits].tolist(), strict=True):
            take(start, stop - start + lag, lag)
    doubled = [W.mix(seq.astype(np.uint64) * _MIX + np.uint64(1))]
    for low, high, window in scales(int(sizes[own[0]])):
        n = int(ends[np.searchsorted(-sizes[own], -LEAST_TURNS * (low + 1), "right") - 1])
        if n < high:
            break
        place, lag = seeds(_gram_hashes(doubled, high, n), low, high, window)
        reach: dict[int, int] = {}  # where the last stretch of each lag ends; places come in order for each lag
        order = np.lexsort((place, lag))
        for at, d in zip(place[order].tolist(), lag[order].tolist(), strict=True):
            if at < reach.get(d, 0):
                continue
            start, stop = _last_unlike(seq, at, d) + 1, _first_unlike(seq, at, d)
            reach[d] = max(stop, at + 1)
            if stop > at and _enough(stop - start + d, d):
                take(start, stop - start + d, d)
    for (start, length), lag in periods.items():
        i = int(np.searchsorted(ends, start, "right"))
        found[own[i]].append((start - int(starts[i]), length, lag))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(pieces: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, less those that a run holds after its first period."""
    if not runs:
        return b" ".join(pieces)
    gone = np.zeros(len(pieces) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([pieces[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()])


def _scan(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    for chunk in W.chunks(batches):
        w = W.Words(chunk["text"], W.SPACE_WORD)
        _, code = w.codes()
        bounds = w.first.tolist()
        spans = list(zip(bounds[:-1], bounds[1:], strict=True))
        runs = find_runs([code[a:z] for a, z in spans])
        pieces = w.buf.tobytes().split()
        kept = [collapsed(pieces[a:z], r) for (a, z), r in zip(spans, runs, strict=True)]
        cells = [[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in runs]
        columns = {n: chunk[n] for n in names} | {"n_words": pa.array(np.diff(w.first), pa.int64()), "runs": pa.array(cells, kind), "collapsed": pa.array(kept, pa.binary()).cast(pa.string())}
        yield pa.RecordBatch.from_pydict(columns)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """docs without text, with n_words, runs (array of start, length, period) and collapsed, the text without repetitions."""
    keep = [f for f in docs.schema.fields if f.name not in ("text", "n_words", "runs", "collapsed")]
    out = T.StructType([*keep, T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    names = [f.name for f in keep]
    return docs.select(*names, "text").mapInArrow(lambda b: _scan(b, names), out)


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", " " * 5), " "), "")


def with_planted_runs(docs: DataFrame, one_in: int = 10) -> DataFrame:
    """(doc_id, text) in which one in so many documents, by crc32 of its decimal doc_id, repeats its words from some word on with some period; others, and rows without doc_id, keep their text."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"), F.when(h % one_in == 0, words_of(F.col("text"))).alias("w"))
    own = own.withColumns({"g": F.floor(F.col("h") / 10), "n": F.size("w").cast("long")})
    own = own.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    own = own.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    repeated = F.expr("array_join(transform(sequence(0L, n - 1), i -> get(w, cast(if(i < a, i, a + (i - a) % p) as int))), ' ')")
    return own.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # runs come by start and period, so the first of the greatest exponent stays
    best = F.expr("aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0), (b, x) -> if(x.length * b.period > b.length * x.period, x, b))")
    lines = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')")
    own = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return own.select("doc_id", "n_runs", "b.start", "b.length", "b.period", F.expr("1000 * b.length div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
