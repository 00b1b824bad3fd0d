"""Operator 3: benchmark passages in documents, found through an FM-index of each shard of documents.

A shard is a run of documents inside a task. Words outside the benchmark's vocabulary end any occurrence, so the
shard's text is the runs of vocabulary words that are long enough for the shortest window, each closed
by a separator. Its suffix array gives the Burrows-Wheeler transform, kept as a wavelet matrix for ranks; all
windows of the benchmark are searched backwards at once; their occurrences are located by walking to the next
sampled suffix position; and the spans of one document are merged. Words are matched by hashes and then compared
themselves. Nothing is shuffled, but for a benchmark beyond BENCHMARK_BYTES: it is searched in blocks of items, one
after another, and the spans of a document are merged over the blocks. The driver holds one block at a time.

Results by case: null and empty texts have no words; an item with a null item_id marks words as hit but can't be named
or counted; repeated rows of documents each get their result; repeated item_ids count once; ties don't arise; a very
long text makes a shard of its own, worked in memory of about 200 bytes for each of its words that the benchmark has; an
empty benchmark hits nothing; an empty documents table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import words as W
from tickerloom.llm.tables import saved, table

#: Texts of benchmark items that are sent to the tasks at once.
BENCHMARK_BYTES = 8 << 20
SHARD_WORDS = 1_000_000
SAMPLE_EVERY = 8

FOUND = "doc_id long, text_key long, n_words long, starts array<int>, untils array<int>, items array<string>"


class FMIndex:
    """An FM-index of a text of symbols from 0 to below sigma; 0 separates and ends runs and is never searched."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        self.size = n
        breaks = text == 0
        rank = np.where(breaks, np.cumsum(breaks) - 1, text + breaks.sum()).astype(np.int64)
        reach = 1
        while True:  # prefix doubling; separators differ, so it ends with the longest repeated run
            after = np.zeros(n, np.int64)
            after[: max(0, n - reach)] = rank[reach:]
            key = (rank << 32) | after
            order = np.argsort(key)
            rank[order] = np.append(0, np.cumsum(np.diff(key[order]) != 0))
            if rank[order[-1]] == n - 1:
                break
            reach *= 2
        before = text[order - 1].astype(np.int64)
        before[order == 0] = 0
        self.before = before
        self.less = np.append(0, np.cumsum(np.bincount(text, minlength=sigma)))
        self.levels = []
        for bit in reversed(range(max(1, int(sigma - 1).bit_length()))):
            ones = (before >> bit) & 1
            self.levels.append((bit, n - int(ones.sum()), np.append(0, np.cumsum(ones)).astype(np.int32)))
            before = np.concatenate([before[ones == 0], before[ones == 1]])
        sampled = np.append(True, breaks[:-1])  # the first of each run, so that no walk crosses a separator
        sampled |= np.arange(n) % SAMPLE_EVERY == 0
        self.sampled = sampled[order]
        self.positions = order[self.sampled]
        self.sample_rank = np.cumsum(self.sampled) - 1

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each place."""
        start = np.zeros(len(symbols), np.int64)
        for bit, zeros, ones in self.levels:
            up = ((symbols >> bit) & 1).astype(bool)
            a, b = ones[start], ones[at]
            start, at = np.where(up, zeros + a, start - a), np.where(up, zeros + b, at - b)
        return at - start

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that each row of patterns begins; rows are right-aligned, 0 fills the left."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for j in reversed(range(patterns.shape[1])):
            live = np.flatnonzero((patterns[:, j] > 0) & (low < high))
            c = patterns[live, j].astype(np.int64)
            low[live], high[live] = self.less[c] + self.rank(c, low[live]), self.less[c] + self.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes."""
        rows, steps, out = rows.copy(), 0, np.zeros(len(rows), np.int64)
        walking = np.arange(len(rows))
        while len(walking):
            there = self.sampled[rows[walking]]
            done = walking[there]
            out[done] = self.positions[self.sample_rank[rows[done]]] + steps
            walking = walking[~there]
            c = self.before[rows[walking]]
            rows[walking] = self.less[c] + self.rank(c, rows[walking])
            steps += 1
        return out


class Windows:
    """The distinct windows of some items: vocabulary, patterns of symbols and the items of each."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        w = W.Words(pa.array([t for _, t in items], pa.string()), W.ALNUM_WORD, lower=True)
        first, code = w.codes()
        self.buf, self.starts, self.ends = w.buf, w.starts[first], w.ends[first]
        for self.seed in itertools.count():  # until all its words have hashes of their own
            h = W.span_hashes(w.buf, self.starts, self.ends, self.seed)
            order = np.argsort(h)
            if (np.diff(h[order]) > 0).all():
                break
        self.vocabulary, self.starts, self.ends = h[order], self.starts[order], self.ends[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        symbols = place[code]
        rows, owners = [], []
        for i, (a, z) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
            own = symbols[a:z] + 1
            if len(own) >= size:
                rows.append(np.lib.stride_tricks.sliding_window_view(own, size))
            elif len(own):
                rows.append(np.concatenate([np.zeros(size - len(own), np.int64), own])[None])
            owners += [i] * (len(rows[-1]) if len(own) else 0)
        stacked = np.concatenate(rows).astype(np.int32) if rows else np.zeros((0, size), np.int32)
        self.patterns, of = np.unique(stacked, axis=0, return_inverse=True)
        self.lengths = (self.patterns > 0).sum(1)
        pairs = np.unique(np.stack([of.reshape(-1), np.array(owners, np.int64)], 1), axis=0) if len(stacked) else np.zeros((0, 2), np.int64)
        self.item_of, self.first_item = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.patterns) + 1))
        self.names = np.array([k for k, _ in items], object)

    def symbols(self, w: W.Words) -> np.ndarray:
        """The symbol of each word; 0 outside the vocabulary."""
        h = W.span_hashes(w.buf, w.starts, w.ends, self.seed)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        out = np.zeros(len(h), np.int64)
        some = np.flatnonzero(self.vocabulary[at] == h)
        own = at[some]
        same = W.same_spans(w.buf, w.starts[some], w.ends[some], self.starts[own], self.ends[own], self.buf)
        out[some[same]] = own[same] + 1
        return out


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(first - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())


class _Shard:
    def __init__(self, windows: Windows):
        self.windows, self.least = windows, int(windows.lengths.min()) if len(windows.lengths) else 0
        self.batches, self.texts, self.places, self.counts = [], [], [], []
        self.words = 0

    def add(self, chunk: pa.RecordBatch) -> None:
        w = W.Words(chunk["text"], W.ALNUM_WORD, lower=True)
        self.batches.append(chunk)
        self.counts.append(np.diff(w.first))
        if len(w) and len(self.windows.vocabulary):
            symbols = self.windows.symbols(w)
            known = symbols > 0
            begins = known & np.append(True, ~known[:-1])
            begins[w.first[:-1][w.first[:-1] < len(w)]] |= known[w.first[:-1][w.first[:-1] < len(w)]]
            starts = np.flatnonzero(begins)
            stops = np.append(np.flatnonzero(~known | begins), len(w))
            stops = stops[np.searchsorted(stops, starts, "right")]
            long = stops - starts >= self.least
            starts, n = starts[long], (stops - starts)[long]
            ends = np.cumsum(n + 1)
            text, place = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64), np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
            take = _ranges(starts, n)
            into = _ranges(ends - n - 1, n)
            text[into], place[into] = symbols[take], take + self.words
            self.texts.append(text)
            self.places.append(place)
        self.words += len(w)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences: window, first word in the shard, number of words."""
        text = np.concatenate(self.texts) if self.texts else np.zeros(0, np.int64)
        if not len(text):
            return (np.zeros(0, np.int64),) * 3
        index = FMIndex(text, len(self.windows.vocabulary) + 1)
        low, high = index.search(self.windows.patterns)
        window = np.repeat(np.arange(len(low)), high - low)
        at = np.concatenate(self.places)[index.locate(_ranges(low, high - low))]
        return window, at, self.windows.lengths[window]

    def clean(self) -> Iterator[pa.RecordBatch]:
        """The batches without the rows that have an occurrence."""
        _, at, _ = self.found()
        first = np.append(0, np.cumsum(np.concatenate(self.counts))) if self.counts else np.zeros(1, np.int64)
        stays = np.ones(len(first) - 1, bool)
        stays[np.searchsorted(first, at, "right") - 1] = False
        d = 0
        for batch in self.batches:
            yield batch.filter(pa.array(stays[d : d + batch.num_rows]))
            d += batch.num_rows

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.batches:
            return
        window, at, length = self.found()
        first = np.append(0, np.cumsum(np.concatenate(self.counts)))
        marks = np.zeros(self.words + 1, np.int64)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + length, -1)
        hit = np.append(0, (np.cumsum(marks) > 0).astype(np.int8))
        steps = np.diff(hit[: self.words + 1])
        # a span may touch the next text's, so each text's first word begins one
        begin = steps == 1
        inside = hit[1 : self.words + 1] > 0
        heads = first[:-1][first[:-1] < self.words]
        begin[heads] |= inside[heads]
        starts = np.flatnonzero(begin)
        stops = np.append(np.flatnonzero(~inside | begin), self.words)
        stops = stops[np.searchsorted(stops, starts, "right")] if len(starts) else starts
        doc = np.searchsorted(first, starts, "right") - 1
        spans = np.searchsorted(doc, np.arange(len(first)))
        of = np.searchsorted(first, at, "right") - 1
        pairs = np.unique(np.stack([of, window], 1), axis=0) if len(of) else np.zeros((0, 2), np.int64)
        counts = self.windows.first_item[pairs[:, 1] + 1] - self.windows.first_item[pairs[:, 1]]
        items = self.windows.item_of[_ranges(self.windows.first_item[pairs[:, 1]], counts)]
        owned = np.unique(np.stack([np.repeat(pairs[:, 0], counts), items], 1), axis=0) if len(items) else np.zeros((0, 2), np.int64)
        item_ends = np.searchsorted(owned[:, 0], np.arange(len(first)))
        names = self.windows.names
        d = 0
        for batch, n_words in zip(self.batches, self.counts, strict=True):
            z = d + batch.num_rows
            a, b = spans[d], spans[z]
            offsets = pa.array(spans[d : z + 1] - a, pa.int32())
            base = np.repeat(first[d:z], np.diff(spans[d : z + 1]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "text_key": batch["text_key"], "n_words": pa.array(n_words, pa.int64()),
                "starts": pa.ListArray.from_arrays(offsets, pa.array(starts[a:b] - base, pa.int32())),
                "untils": pa.ListArray.from_arrays(offsets, pa.array(stops[a:b] - base, pa.int32())),
                "items": pa.ListArray.from_arrays(pa.array(item_ends[d : z + 1] - item_ends[d], pa.int32()), pa.array(names[owned[item_ends[d] : item_ends[z], 1]].tolist(), pa.string())),
            })
            d = z


def _scan(batches: Iterator[pa.RecordBatch], windows: Windows) -> Iterator[pa.RecordBatch]:
    shard = _Shard(windows)
    for chunk in W.chunks(batches):
        shard.add(chunk)
        if shard.words >= SHARD_WORDS:
            yield from shard.rows()
            shard = _Shard(windows)
    yield from shard.rows()


def _blocks(benchmark: DataFrame, size: int, block_bytes: int) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark's windows in blocks of about block_bytes of text, one at a time, and whether that is all."""
    spark = benchmark.sparkSession
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    blocks = max(1, math.ceil((items.select(F.sum(F.octet_length("text"))).first()[0] or 0) / block_bytes))
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        shared = spark.sparkContext.broadcast(Windows([tuple(r) for r in own.collect()], size))
        yield shared, blocks == 1
        if blocks > 1:  # what was found is written by now
            shared.destroy()


def benchmark_spans(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """(doc_id, text_key, n_words, starts, untils, items) of each row of docs: merged spans of hit words, and the ids of the items whose windows occur, as strings (null for items without one)."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    found, blocks = None, 0
    for windows, whole in _blocks(benchmark, size, block_bytes):
        one = keyed.mapInArrow(lambda batches, windows=windows: _scan(batches, windows.value), FOUND)
        if whole:
            return one
        one, blocks = saved(one, "found"), blocks + 1
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("untils")).alias("untils"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), F.count(F.lit(1)).alias("n"),
    )
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("n") / blocks).cast("int")))).drop("copy", "n").mapInArrow(_merge, FOUND)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of several blocks become disjoint."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            spans: list[list[int]] = []
            for a, z in sorted(zip(row["starts"], row["untils"], strict=True)):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(z, spans[-1][1])
                else:
                    spans.append([a, z])
            row["starts"], row["untils"] = [a for a, _ in spans], [z for _, z in spans]
        yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [sorted(set(x) - {None}) for x in batch["items"].to_pylist()]
        hit = [sum(z) - sum(a) for a, z in zip(batch["starts"].to_pylist(), batch["untils"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch["doc_id"], "n_words": batch["n_words"], "n_hit": pa.array(hit, pa.int64()),
            "n_items": pa.array([len(x) for x in items], pa.int64()),
            "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], "contaminated": pa.array([x > 0 for x in hit], pa.bool_()),
        })


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    spans = benchmark_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return spans.mapInArrow(_digests, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def _clean(batches: Iterator[pa.RecordBatch], windows: Windows) -> Iterator[pa.RecordBatch]:
    """The rows without a hit, with all their columns."""
    shard = _Shard(windows)
    for chunk in W.chunks(batches):
        shard.add(chunk)
        if shard.words >= SHARD_WORDS:
            yield from shard.clean()
            shard = _Shard(windows)
    yield from shard.clean()


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """The rows of docs in which no window of the benchmark occurs, with all their columns; each block of the benchmark is one more pass without a shuffle."""
    out = docs
    for windows, whole in _blocks(benchmark, size, block_bytes):
        out = out.mapInArrow(lambda batches, windows=windows: _clean(batches, windows.value), docs.schema)
        if not whole:
            out = saved(out, "clean")
    return out
