"""Operator 4: quality of whole texts by a regularised quadratic discriminant.

A text becomes a dozen statistics (shares of kinds of bytes, of repeated words and lines, word lengths), transformed
to be closer to normal. Each class has a mean and a covariance, shrunk towards its own diagonal and the pooled
covariance; both come from sums that Spark adds up over all labelled rows, so nothing is sampled. A text's
log-density in a class is its Mahalanobis distance through the class's Cholesky factor, computed once, with the
factor's log-determinant; the score is the logistic of the difference of log-densities and log-priors.

Results by case: a null text counts as empty and both are scored; rows of labels without quality or without a
document aren't learned from; several labels of one document each count; a null doc_id counts as held out;
with labels of one class or none the score is that class's share, or a half; repeated rows stay; ties don't arise, as a
row's score takes no other row's rank into account; a very long text is counted whole in one task; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import words as W
from tickerloom.llm.tables import saved, table

FOLDS = 5
THRESHOLD = 0.3
#: Weights of the pooled covariance and of the own diagonal in a class's covariance, and the least variance.
POOLED, DIAGONAL, FLOOR = 0.2, 0.2, 1e-4
#: Log-density differences are divided by this: the statistics aren't normal, and bare posteriors are too sure.
TEMPER = 4.0

STATISTICS = ("log_bytes", "upper", "digit", "end_marks", "commas", "symbols", "bars", "spaces", "lines", "high", "word_length", "long_words", "distinct_words", "repeated_next", "distinct_lines", "symbol_ends")


def _class_table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int8)
    out[list(chars)] = 1
    return out


_KINDS = [_class_table(x) for x in (bytes(range(65, 91)), b"0123456789", b"!?", b".,;:", b"#$%&*@^~_+=<>{}[]\\/", b"|", b" \t", b"\n\r", bytes(range(128, 256)))]


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of transformed statistics for each text."""
    w = W.Words(texts, W.SPACE_WORD, lower=False)
    size = np.diff(w.texts).astype(float)
    n = len(size)
    out = [np.log1p(size)]
    counts = []
    for kind in _KINDS:
        c = np.add.reduceat(kind[w.buf], w.texts[:-1], dtype=np.int64) if n else np.zeros(0)
        counts.append(c)
    upper, digit, ends, commas, symbols, bars, spaces, lines, high = counts
    out += [np.sqrt(x / size) for x in (upper, digit, ends, commas, symbols, bars, spaces, np.maximum(lines - 1, 0), high)]
    words = np.maximum(np.diff(w.first), 1).astype(float)
    of = w.text_of()
    length = (w.ends - w.starts).astype(float)
    per_text = lambda x: np.bincount(of, x, n)
    out += [np.log1p(per_text(length) / words), np.sqrt(per_text((length > 12).astype(float)) / words)]
    h = w.hashes()
    pair = np.sort((h >> np.uint64(32) << np.uint64(32)) ^ of.astype(np.uint64)) if len(h) else h
    fresh = np.append(True, np.diff(pair) != 0)[: len(pair)]
    out.append(np.bincount((pair & np.uint64(0xFFFFFFFF)).astype(np.int64)[fresh], minlength=n)[:n] / words)
    again = np.append(False, (h[1:] == h[:-1]) & (of[1:] == of[:-1]))[: len(h)].astype(float)
    out.append(np.sqrt(per_text(again) / words))
    starts = np.flatnonzero(np.append(True, (w.buf[:-1] == 10)))[: int((w.buf == 10).sum())] if len(w.buf) else np.zeros(0, np.int64)
    stops = np.flatnonzero(w.buf == 10)
    line = W.span_hashes(w.buf, starts, stops)
    line_of = np.searchsorted(w.texts, starts, "right") - 1
    key = np.unique(np.stack([line_of.astype(np.uint64), line], 1), axis=0) if len(line) else np.zeros((0, 2), np.uint64)
    out.append(np.bincount(key[:, 0].astype(np.int64), minlength=n) / np.maximum(np.bincount(line_of, minlength=n), 1))
    last = w.buf[w.ends - 1] if len(w) else np.zeros(0, np.uint8)
    out.append(np.sqrt(per_text((_KINDS[4][last] > 0).astype(float)) / words))
    return np.stack(out, 1)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in W.chunks(batches):
        x = statistics(chunk["text"])
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
        yield pa.RecordBatch.from_pydict({"doc_id": chunk["doc_id"], "x": flat})


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_statistics, "doc_id long, x array<double>")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = len(STATISTICS)
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.hstack([np.ones((batch.num_rows, 1)), batch["x"].flatten().to_numpy().reshape(-1, size)])
        y = batch["label"].to_numpy()
        for k in np.unique(y):
            own = x[y == k]
            total[int(k)] = total.get(int(k), 0) + own.T @ own
    rows = [(k, i, float(v)) for k, m in total.items() for i, v in enumerate(m.reshape(-1))]
    if rows:
        yield pa.RecordBatch.from_pydict(dict(zip(("label", "place", "value"), map(list, zip(*rows, strict=True)), strict=True)), schema=pa.schema([("label", pa.int32()), ("place", pa.int32()), ("value", pa.float64())]))


class Discriminant:
    """Classes 0 and 1 by their moments: {label: sum of (1, x)^T (1, x)}."""

    def __init__(self, moments: dict[int, np.ndarray]):
        self.counts = {k: m[0, 0] for k, m in moments.items()}
        self.parts = {}
        if len(moments) < 2:
            return
        means = {k: m[0, 1:] / m[0, 0] for k, m in moments.items()}
        own = {k: m[1:, 1:] / m[0, 0] - np.outer(means[k], means[k]) for k, m in moments.items()}
        total = sum(self.counts.values())
        pooled = sum(c * self.counts[k] for k, c in own.items()) / total
        for k, c in own.items():
            c = (1 - POOLED - DIAGONAL) * c + POOLED * pooled + DIAGONAL * np.diag(np.diag(c)) + FLOOR * np.eye(len(c))
            factor = np.linalg.cholesky(c)
            self.parts[k] = means[k], np.linalg.inv(factor), np.log(np.diag(factor)).sum(), np.log(self.counts[k] / total)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The chance of class 1."""
        if len(self.parts) < 2:
            n = sum(self.counts.values())
            return np.full(len(x), self.counts.get(1, 0) / n if n else 0.5)
        log = {k: -0.5 * (((x - mean) @ inverse.T) ** 2).sum(1) - half for k, (mean, inverse, half, _) in self.parts.items()}
        odds = (log[1] - log[0]) / TEMPER + self.parts[1][3] - self.parts[0][3]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def learn(found: DataFrame, labels: DataFrame) -> Discriminant:
    """The discriminant of all rows of found (doc_id, x) that have a label."""
    own = labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    sums = found.join(own, "doc_id").select("label", "x").mapInArrow(_sums, "label int, place int, value double")
    rows = sums.groupBy("label", "place").agg(F.sum("value").alias("value")).collect()  # two classes of fixed size
    size = len(STATISTICS) + 1
    moments = {k: np.zeros(size * size) for k in {r.label for r in rows}}
    for r in rows:
        moments[r.label][r.place] = r.value
    return Discriminant({k: m.reshape(size, size) for k, m in moments.items()})


def _scored(batches: Iterator[pa.RecordBatch], model: Discriminant) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            score = model.score(batch["x"].flatten().to_numpy().reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": score, "predicted": pa.array((score >= THRESHOLD).astype(np.int32))})


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; see the module."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == 0, F.lit(True))
    found = saved(text_statistics(docs), "statistics").withColumn("held_out", held)
    model = learn(found.where("not held_out"), labels)
    return found.mapInArrow(lambda b: _scored(b, model), "doc_id long, held_out boolean, score double, predicted int")


def op4_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
