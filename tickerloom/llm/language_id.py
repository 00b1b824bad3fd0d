"""Operator 7: languages of whole texts by error-correcting output codes over byte n-grams.

Each language has a codeword; for each of its bits a binary classifier over hashed n-grams of letters is learned
(regularised logistic regression, all bits in one descent). A text's outputs are compared with every codeword:
each bit's logistic loss is weighted by how well its classifier did on that language in training, and the nearest
codeword wins. The score is the winner's share of exp(-loss); a text whose two nearest codewords are less than
MARGIN apart is flagged ambiguous. The loss itself tells how far a text is from all learned languages: log(2) is what
classifiers give that know nothing of it, so a text beyond FAR is in none of them.

The classifier is fitted on about SAMPLE_DOCS documents a language and SAMPLE_ALL in all, chosen by hashes of
their ids (a documented bound); every text is read whole and predicted.

Results by case: null texts and texts without a letter are `und` with score 0; rows with null lang or null
doc_id and texts without a letter aren't learned from, and a null doc_id counts as held out; without any language to learn all texts are
`und`; with one language all others are that; of equally near codewords the first in the order of names wins; repeated
rows stay; a very long text takes about 100 bytes of memory for each of its own; an empty table gives an empty result;
other columns are passed over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import words as W
from tickerloom.llm.tables import table

FOLDS, HELD_FOLD = 4, 2
SAMPLE_DOCS = 800
SAMPLE_ALL = 6400
#: Counts of up to so many languages are sent to all tasks; beyond that, a join shuffles the texts.
BROADCAST_LANGUAGES = 1000
BUCKETS = 1 << 12
STEPS, RATE, RIDGE = 300, 20.0, 1e-4
#: Bytes of text whose features are held at once.
FEATURE_BYTES = 1 << 19
#: Difference of losses under which a text is ambiguous.
MARGIN = 0.02
#: Loss against the nearest codeword beyond which a text is in no learned language.
FAR = 0.4
UNDETERMINED = "und"

_LETTERS = W.LOWER.copy()
_LETTERS[[i for i in range(128) if not (65 <= i <= 90 or 97 <= i <= 122)]] = 0x20


def features(texts: pa.Array) -> np.ndarray:
    """A row of unit length for each text: square roots of the shares of its hashed byte pairs and triples."""
    buf, starts = W.joined(texts)
    b = _LETTERS[buf].astype(np.uint32)
    n = len(starts) - 1
    sizes = np.diff(starts)
    out = np.zeros((n, BUCKETS), np.float32)
    for size in (2, 3):
        if len(b) < size:
            continue
        code = b[: len(b) - size + 1].copy()
        for j in range(1, size):
            code = code << 8 | b[j : len(b) - size + 1 + j]
        bucket = (code * np.uint32(0x9E3779B1) + np.uint32(size)) >> np.uint32(32 - 12)
        of = np.repeat(np.arange(n), sizes)[: len(code)]
        inside = np.arange(len(code)) + size <= np.repeat(starts[1:], sizes)[: len(code)]
        keep = inside & (code != 0x20202020 & ((1 << 8 * size) - 1))  # runs of spaces say nothing
        out += np.bincount(of[keep] * BUCKETS + bucket[keep], minlength=n * BUCKETS).reshape(n, BUCKETS)
    np.sqrt(out, out=out)
    norm = np.sqrt((out**2).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """A codeword of -1 and 1 for each of n languages: all splits for up to five, else random ones, well apart."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        splits = range(1, 1 << (n - 1))
        return np.array([[1 if (s >> i) & 1 else -1 for s in splits] for i in range(n)], np.int8)
    rng = np.random.default_rng(seed)
    bits = 10 * int(np.ceil(np.log2(n)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        least = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if least > apart:
            best, apart = code, least
    return best


class OutputCodes:
    """Binary classifiers of the bits of codewords and their weighted decoding; rows of x are features, which a column of ones may follow."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        self.names = sorted(set(labels))
        self.code = codewords(len(self.names))
        y = np.array([self.names.index(k) for k in labels])
        target = (self.code[y] > 0).astype(np.float32)
        if x.shape[1] == BUCKETS:
            x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        w = speed = np.zeros((x.shape[1], target.shape[1]), np.float32)
        share = 1 / np.bincount(y)[y] / len(self.names)  # languages count alike
        for step in range(STEPS):
            ahead = w + 0.9 * speed
            error = (1 / (1 + np.exp(-(x @ ahead))) - target) * share[:, None].astype(np.float32)
            speed = 0.9 * speed - RATE * 0.1 * (x.T @ error + RIDGE * ahead)
            w = w + speed
        self.w = w
        right = (np.sign(x @ w) == self.code[y]).astype(float)
        accuracy = np.stack([right[y == i].mean(0) for i in range(len(self.names))]) + 1e-6
        self.weights = (accuracy / accuracy.sum(1, keepdims=True)).astype(np.float32)

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each row against each codeword."""
        f = x @ self.w[:-1] + self.w[-1]
        return np.stack([(np.logaddexp(0, -f * c) * k).sum(1) for c, k in zip(self.code, self.weights, strict=True)], 1)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in W.chunks(batches):
        x = features(chunk["text"]).astype(np.float16)
        yield pa.RecordBatch.from_pydict({"lang": chunk["lang"], "x": pa.array([zlib.compress(r.tobytes(), 1) for r in x], pa.binary())})  # most features are zero


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> OutputCodes | None:
    """Learn from rows with columns text, lang and h, a hash of the id: those whose hashes are in a share that holds about sample_docs of each language."""
    counts = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = counts.count()
    each = max(20, min(sample_docs, SAMPLE_ALL // max(1, languages)))
    if languages <= BROADCAST_LANGUAGES:
        counts = F.broadcast(counts)
    share = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    sample = docs.join(counts, "lang").where(share < each / F.col("n")).select("text", "lang").mapInArrow(_sampled, "lang string, x binary").toArrow()
    if not sample.num_rows:
        return None
    labels = sample["lang"].to_pylist()
    x = np.ones((len(labels), BUCKETS + 1), np.float32)  # the one copy in the driver's memory
    for row, packed in zip(x, sample["x"], strict=True):
        row[:-1] = np.frombuffer(zlib.decompress(packed.as_py()), np.float16)
    return OutputCodes(x, labels)


def _answers(texts: pa.Array, model: OutputCodes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, score, ambiguity, loss against the nearest codeword and name of the second nearest of each text."""
    n = len(texts)
    letter = pc.match_substring_regex(texts, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
    name, score, close, far = np.full(n, UNDETERMINED, object), np.zeros(n), np.zeros(n, bool), np.full(n, np.inf)
    second = name.copy()
    if model is not None:
        loss = model.losses(features(texts))
        order = np.sort(loss, 1)
        share = np.exp(order[:, 0][:, None] - loss)
        name[letter] = np.array(model.names, object)[loss.argmin(1)][letter]
        score[letter] = (1 / share.sum(1))[letter]
        close = letter & (order[:, min(1, loss.shape[1] - 1)] - order[:, 0] < MARGIN) & (loss.shape[1] > 1)
        far[letter] = order[letter, 0]
        second[letter] = np.array(model.names, object)[loss.argsort(1, kind="stable")[:, min(1, loss.shape[1] - 1)]][letter]
    return name, score, close, far, second


def _predicted(batches: Iterator[pa.RecordBatch], model: OutputCodes | None) -> Iterator[pa.RecordBatch]:
    for chunk in W.chunks(batches, limit=FEATURE_BYTES):
        name, score, close, *_ = _answers(chunk["text"], model)
        yield pa.RecordBatch.from_pydict({"doc_id": chunk["doc_id"], "held_out": chunk["held_out"], "lang_pred": pa.array(name.tolist(), pa.string()), "score": score, "ambiguous": close})


def _kept(batches: Iterator[pa.RecordBatch], model: OutputCodes | None, languages: list[str] | None) -> Iterator[pa.RecordBatch]:
    for chunk in W.chunks(batches, limit=FEATURE_BYTES):
        name, _, close, far, second = _answers(chunk["text"], model)
        stays = (name != UNDETERMINED) & (far <= FAR)
        if languages is not None:
            stays &= np.isin(name.astype(str), languages) | (close & np.isin(second.astype(str), languages))
        yield chunk.filter(pa.array(stays))


def _learned(docs: DataFrame) -> tuple[DataFrame, OutputCodes | None]:
    """The columns for learning with held_out, and the model of the rows that aren't."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"), F.coalesce(fold == HELD_FOLD, F.lit(True)).alias("held_out"))
    return own, fit(own.where("not held_out and lang is not null").where(F.col("text").rlike(r"\p{L}")).select("text", "lang", F.xxhash64("doc_id", F.lit(11)).alias("h")))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of each row; see the module."""
    own, model = _learned(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return own.select("doc_id", "held_out", "text").mapInArrow(lambda b: _predicted(b, shared.value), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def identified_documents(docs: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """The rows of docs, with all their columns, that are in a learned language: not `und` and not beyond FAR from all. With `languages`, those predicted as one of them, and those that are ambiguous between one of them and another."""
    shared = docs.sparkSession.sparkContext.broadcast(_learned(docs)[1])
    return docs.mapInArrow(lambda b: _kept(b, shared.value, languages), docs.schema)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
