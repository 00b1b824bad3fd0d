"""Operator 5: language-model scores of whole texts by a log-bilinear model trained with noise-contrastive estimation.

Counting. Each task turns a run of documents into codes of its distinct tokens. Every token belongs to a block by
its hash; a task sends a block one row with its distinct tokens and their counts, so a token met in every
document still reaches its block once a task. Blocks add up the counts over all documents and answer each task's
row in its own order, and the answers meet the codes again under the task's key. No vocabulary is broadcast.
Beyond SUM_ROWS rows of tasks, a block adds up in two steps, by shares of the tasks and then over the shares, so that what
meets in one group grows with the root of the input.

Model. Every token has a class, and every class its own parameters: the WORDS most frequent training tokens have one
each, all others share SHAPES classes by their endings; inside a class a token has its smoothed share of the class. Both
numbers are parameters. The score of class k after words of classes i, j is bilinear: (R_i*C1 + R_j*C2).Q_k + b_k.
Parameters are learned in numpy by noise-contrastive estimation from every window of every training document, in ROUNDS
rounds: shards of documents, dealt by the hash of doc_id, go on from the same parameters, each with its own windows of the
round, and Spark averages what they have learned, weighted by windows. Shards don't follow the input's partitions, so the
same rows give the same scores in any layout, but for rounding. As the score splits into A[i,k] + B[j,k], the normaliser of every context is one
matrix product, exp(A) exp(B)^T, so each token's log-probability is exactly normalised, unknown tokens included.

Results by case: null and empty texts are just their end token; a null doc_id counts as held out, and nothing is
learned from it; repeated rows stay, each counted; empty tables give an empty result; if there are no training
documents all tokens are unknown; of tokens that are equally frequent at the end of the WORDS those of smaller hashes
have classes; a very long text is coded and scored as a whole in one task; other columns are passed over.
"""

from __future__ import annotations

import copy
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import words as W
from tickerloom.llm.tables import block_count, saved, table, text_bytes

BATCH_TOKENS = 1_000_000
BLOCK_BYTES = 8 << 20
#: Rows of a block that are added up at once, and rows of an Arrow batch that a task sends.
SUM_ROWS = 2000
SENT_ROWS = 1000
#: The share of documents that are held out is one in FOLDS, by crc32 of the id.
FOLDS = 10
SMOOTHING = 0.1
WORDS = 1000
SHAPES = 1000
DIMENSIONS = 32
ROUNDS = 8
#: Training tokens of a shard, which goes on by itself within a round.
SHARD_TOKENS = 4_000_000
BATCH = 2048
NOISE = 64
RATE = 0.1
#: Rows in which the parameters of a task are sent.
PARTS = 8

END = np.uint64(0x5DEECE66D)
#: Bytes at the end of a token that choose its shape.
ENDING_BYTES = 3

CODED = "batch string, block int, hashes binary, counts binary, kinds binary, distinct int, own binary, shapes binary, codes binary, ids binary, held binary, lengths binary"
ANSWER = "batch string, block int, counts binary, total long, distinct long, top_hash array<long>, top_count array<long>, top_shape array<int>, shape_total array<long>, shape_distinct array<long>"
SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tokens_of(texts: pa.Array, kinds: int = SHAPES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of the tokens of some texts, each closed by the end token, and the number of tokens of each text."""
    w = W.Words(texts, W.SPACE_WORD, lower=True)
    lengths = np.diff(w.first) + 1
    hashes, shapes = np.full(int(lengths.sum()), END, np.uint64), np.zeros(int(lengths.sum()), np.uint16)
    inside = np.ones(len(hashes), bool)
    inside[np.cumsum(lengths) - 1] = False
    hashes[inside] = w.hashes()
    shapes[inside] = W.span_hashes(w.buf, np.maximum(w.starts, w.ends - ENDING_BYTES), w.ends) % np.uint64(kinds)
    return hashes, shapes, lengths


def _code(batches: Iterator[pa.RecordBatch], blocks: int, kinds: int) -> Iterator[pa.RecordBatch]:
    parts: list[tuple] = []
    tokens = 0

    def rows() -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        h, shape, lengths, ids, held = (np.concatenate(x) for x in zip(*parts, strict=True))
        learn = np.repeat(held == 0, lengths)
        distinct, first, code, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        shape = shape[first]
        often = np.argsort(-times, kind="stable")
        place = np.empty(len(often), np.uint32)
        place[often] = np.arange(len(often), dtype=np.uint32)
        counts = np.bincount(code[learn], minlength=len(distinct)).astype(np.int64)
        key = uuid.uuid4().hex
        null = pa.nulls(1, pa.binary())
        yield pa.RecordBatch.from_pydict({
            "batch": [key], "block": pa.array([-1], pa.int32()), "hashes": null, "counts": null, "kinds": null, "distinct": pa.array([len(distinct)], pa.int32()),
            "own": [distinct[often].tobytes()], "shapes": [W.pack(shape[often])], "codes": [W.pack(place[code])], "ids": [ids.tobytes()], "held": [held.tobytes()], "lengths": [lengths.astype(np.int64).tobytes()],
        })
        block = distinct % np.uint64(blocks)
        order = np.argsort(block, kind="stable")
        bounds = np.append(np.flatnonzero(np.append(True, np.diff(block[order]) != 0)), len(order))
        for i in range(0, len(bounds) - 1, SENT_ROWS):
            each = [order[a:z] for a, z in zip(bounds[i : i + SENT_ROWS], bounds[i + 1 : i + 1 + SENT_ROWS], strict=False)]
            null = pa.nulls(len(each), pa.binary())
            yield pa.RecordBatch.from_pydict({
                "batch": [key] * len(each), "block": pa.array([int(block[own[0]]) for own in each], pa.int32()), "hashes": [distinct[own].tobytes() for own in each], "counts": [W.pack(counts[own]) for own in each],
                "kinds": [W.pack(shape[own]) for own in each], "distinct": pa.nulls(len(each), pa.int32()), "own": null, "shapes": null, "codes": null, "ids": null, "held": null, "lengths": null,
            })

    for chunk in W.chunks(batches):
        h, shape, lengths = tokens_of(chunk["text"], kinds)
        ids = chunk["doc_id"]
        parts.append((h, shape, lengths, ids.fill_null(0).to_numpy(zero_copy_only=False), np.where(ids.is_null().to_numpy(zero_copy_only=False), 2, chunk["held"].to_numpy(zero_copy_only=False)).astype(np.int8)))
        tokens += len(h)
        if tokens >= BATCH_TOKENS:
            yield from rows()
            parts, tokens = [], 0
    yield from rows()


class _Sums:
    """The distinct tokens of some rows of a block, their shapes and their counts over those rows."""

    def __init__(self, asked: pa.Table):
        hashes = [np.frombuffer(x.as_py(), np.uint64) for x in asked["hashes"]]
        each = lambda column, kind: np.concatenate([W.unpack(x.as_py(), kind, len(h)) for x, h in zip(asked[column], hashes, strict=True)])
        self.distinct, first, code = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        self.shapes = each("kinds", np.uint16)[first]
        self.total = np.bincount(code, each("counts", np.int64), len(self.distinct)).astype(np.int64)
        self.codes = np.split(code, np.cumsum([len(h) for h in hashes])[:-1])


def _answer_table(rows: list[dict]) -> pa.Table:
    many = pa.list_(pa.int64())
    kinds = [("batch", pa.string()), ("block", pa.int32()), ("counts", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64()), ("top_hash", many), ("top_count", many), ("top_shape", pa.list_(pa.int32())), ("shape_total", many), ("shape_distinct", many)]
    return pa.Table.from_pylist(rows, schema=pa.schema(kinds))


def _count(asked: pa.Table, words: int, kinds: int) -> pa.Table:
    """Add up a block's counts and answer each row in its order; the first answer also carries the block's totals."""
    own = _Sums(asked)
    top = np.argsort(-own.total, kind="stable")[:words]
    top = top[own.total[top] > 0]
    by_shape = lambda x: np.bincount(own.shapes, x, kinds).astype(np.int64).tolist()
    summary = {
        "total": int(own.total.sum()), "distinct": int((own.total > 0).sum()), "top_hash": own.distinct[top].view(np.int64).tolist(), "top_count": own.total[top].tolist(),
        "top_shape": own.shapes[top].tolist(), "shape_total": by_shape(own.total), "shape_distinct": by_shape(own.total > 0),
    }
    none = {k: [] if isinstance(v, list) else 0 for k, v in summary.items()}
    return _answer_table([{"batch": batch, "block": block, "counts": W.pack(own.total[code])} | (none if i else summary)
                          for i, (batch, block, code) in enumerate(zip(asked["batch"].to_pylist(), asked["block"].to_pylist(), own.codes, strict=True))])


def _share_counts(asked: pa.Table) -> pa.Table:
    """The counts of a share of a block's rows, as one row that stands for them."""
    own = _Sums(asked)
    return pa.table({"batch": [str(asked["share"][0].as_py())], "block": asked["block"][:1]} | {k: pa.array([x], pa.binary()) for k, x in (("hashes", own.distinct.tobytes()), ("counts", W.pack(own.total)), ("kinds", W.pack(own.shapes)))})


def _share_answers(asked: pa.Table, found: pa.Table) -> pa.Table:
    """Answer a share's rows from the answer that their share got."""
    own = _Sums(asked)
    total = W.unpack(found["counts"][0].as_py(), np.int64, len(own.distinct))
    return pa.table({"batch": asked["batch"], "block": asked["block"], "counts": pa.array([W.pack(total[code]) for code in own.codes], pa.binary())})


def _counted(asked: DataFrame, batches: int, words: int, kinds: int, sum_rows: int) -> tuple[DataFrame, DataFrame]:
    """(batch, block, counts) of each row that was asked, and a table with the totals of each block."""
    count = lambda t: _count(t, words, kinds)
    if batches <= sum_rows:
        answers = saved(asked.groupBy("block").applyInArrow(count, ANSWER), "counts")
        return answers, answers
    asked = asked.withColumn("share", F.pmod(F.xxhash64("batch"), F.lit(math.ceil(math.sqrt(batches)))).cast("int"))
    shares = asked.groupBy("block", "share").applyInArrow(_share_counts, "batch string, block int, hashes binary, counts binary, kinds binary")
    totals = saved(shares.groupBy("block").applyInArrow(count, ANSWER), "totals")
    by_share = totals.select("block", F.col("batch").cast("int").alias("share"), "counts").groupBy("block", "share")
    return saved(asked.groupBy("block", "share").cogroup(by_share).applyInArrow(_share_answers, "batch string, block int, counts binary"), "counts"), totals


class Classes:
    """Class 0 only stands before a text's start, then come the shapes, then the words of the vocabulary."""

    def __init__(self, vocabulary: np.ndarray, kinds: int):
        self.kinds = kinds
        self.order = np.argsort(vocabulary)
        self.sorted = vocabulary[self.order]

    def __len__(self) -> int:
        return len(self.sorted) + self.kinds + 1

    def of(self, hashes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        out = shapes.astype(np.int32) + 1
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
            out = np.where(self.sorted[at] == hashes, self.order[at].astype(np.int32) + self.kinds + 1, out)
        return out


def _contexts(k: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes two tokens and one token before each."""
    one, two = np.zeros(len(k), np.int32), np.zeros(len(k), np.int32)
    two[1:], one[2:] = k[:-1], k[:-2]
    first = np.cumsum(lengths) - lengths
    two[first] = one[first] = 0
    one[(first + 1)[lengths > 1]] = 0
    return one, two


class LogBilinear:
    """Two context words, diagonal position weights; trained by noise-contrastive estimation.

    p: the parameters; squares: for each row of them what its steps are divided by.
    """

    def __init__(self, shares: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = len(shares)
        self.shares = shares
        self.cumulated = np.cumsum(shares) / shares.sum()
        values = lambda: rng.normal(0, 0.1, (n, dimensions)).astype(np.float32)
        self.p = {"R": values(), "Q": values(), "C": np.ones((2, dimensions), np.float32), "b": np.log(shares).astype(np.float32)[:, None]}
        self.squares = {k: np.full(len(v), 1e-2, np.float32) for k, v in self.p.items()}

    def vector(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (*self.p.values(), *self.squares.values())])

    def set_vector(self, x: np.ndarray) -> None:
        for own in (self.p, self.squares):
            for k, v in own.items():
                own[k], x = x[: v.size].reshape(v.shape).copy(), x[v.size :]

    def fit(self, one: np.ndarray, two: np.ndarray, token: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over the windows in random order."""
        order = rng.permutation(len(token))
        for a in range(0, len(order), BATCH):
            own = order[a : a + BATCH]
            self._step(one[own], two[own], token[own], rng)

    def _step(self, one, two, token, rng) -> None:
        R, Q, C, b = (self.p[k] for k in "RQCb")
        noise = np.minimum(np.searchsorted(self.cumulated, rng.random(NOISE)), len(self.shares) - 1)
        offset = np.log(NOISE * self.shares).astype(np.float32)
        before = R[one], R[two]
        h = before[0] * C[0] + before[1] * C[1]
        q, z = Q[token], Q[noise]
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        true = 1 - sigmoid((h * q).sum(1) + b[token, 0] - offset[token])
        false = -sigmoid(h @ z.T + b[noise, 0] - offset[noise])
        back = true[:, None] * q + false @ z
        n = len(token) ** 0.5
        self._add("Q", np.append(token, noise), np.concatenate([true[:, None] * h, false.T @ h]) / n)
        self._add("b", np.append(token, noise), np.append(true, false.sum(0))[:, None] / n)
        self._add("R", np.append(one, two), np.concatenate([back * C[0], back * C[1]]) / n)
        self._add("C", np.arange(2), np.stack([(back * x).sum(0) for x in before]) / n)

    def _add(self, name: str, rows: np.ndarray, step: np.ndarray) -> None:
        """Add the steps of each row, scaled by what the row has moved so far."""
        order = np.argsort(rows, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(rows[order]) != 0))
        step, rows = np.add.reduceat(step[order], heads, axis=0), rows[order][heads]
        self.squares[name][rows] += (step**2).mean(1)
        self.p[name][rows] += RATE * step / np.sqrt(self.squares[name][rows])[:, None]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A, B and the normaliser: log p(k | i, j) = A[i, k] + B[j, k] - Z[i, j]. Class 0 is never predicted."""
        R, Q, C, b = (self.p[k] for k in "RQCb")
        A, B = (R * C[0]) @ Q.T + b[:, 0], (R * C[1]) @ Q.T
        A[:, 0] = -np.inf
        top_a, top_b = A.max(1, keepdims=True), B.max(1, keepdims=True)
        Z = np.log(np.exp(A - top_a) @ np.exp(B - top_b).T) + top_a + top_b.T
        return A.astype(np.float32), B.astype(np.float32), Z.astype(np.float32)


class _Coded:
    """The documents of one batch as classes."""

    def __init__(self, row: dict, classes: Classes):
        self.hashes, self.lengths, self.held = np.frombuffer(row["own"], np.uint64), np.frombuffer(row["lengths"], np.int64), np.frombuffer(row["held"], np.int8)
        self.klass = classes.of(self.hashes, W.unpack(row["shapes"], np.uint16, row["distinct"]))
        self.code = W.unpack(row["codes"], np.uint32, int(self.lengths.sum()))
        self.k = self.klass[self.code]


def _dealt(batches: Iterator[pa.RecordBatch], classes: Classes, shards: int) -> Iterator[pa.RecordBatch]:
    """The classes of training documents by the shard that the hash of a document's id chooses; a batch sends a shard one row."""
    for batch in batches:
        for row in batch.to_pylist():
            own = _Coded(row, classes)
            first = np.cumsum(own.lengths) - own.lengths
            train = np.flatnonzero(own.held == 0)
            keys = W.mix(np.frombuffer(row["ids"], np.int64)[train].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
            shard = (keys % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            heads = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)) if len(order) else order
            out = {"shard": [], "keys": [], "lengths": [], "classes": []}
            for docs in np.split(order, heads[1:]) if len(order) else []:
                at = train[docs]
                out["shard"].append(int(shard[docs[0]]))
                out["keys"].append(keys[docs].tobytes())
                out["lengths"].append(own.lengths[at].tobytes())
                k = np.concatenate([own.k[a : a + n] for a, n in zip(first[at].tolist(), own.lengths[at].tolist(), strict=True)])
                out["classes"].append(W.pack(k.astype(np.uint32)))
            yield pa.RecordBatch.from_pydict({"shard": pa.array(out["shard"], pa.int32())} | {c: pa.array(out[c], pa.binary()) for c in ("keys", "lengths", "classes")})


def _gathered(sent: pa.Table) -> pa.Table:
    """One shard's documents in the order of their keys, then of their classes, wherever they came from."""
    docs = []
    for row in sent.to_pylist():
        lengths = np.frombuffer(row["lengths"], np.int64)
        k = W.unpack(row["classes"], np.uint32, int(lengths.sum()))
        docs += zip(np.frombuffer(row["keys"], np.uint64).tolist(), lengths.tolist(), (x.tobytes() for x in np.split(k, np.cumsum(lengths)[:-1])), strict=True)
    docs.sort()
    lengths, k = np.array([n for _, n, _ in docs], np.int64), np.frombuffer(b"".join(x for _, _, x in docs), np.uint32)
    return pa.table({"shard": sent["shard"][:1], "lengths": pa.array([lengths.tobytes()], pa.binary()), "classes": pa.array([W.pack(k)], pa.binary())})


def _learn(batches: Iterator[pa.RecordBatch], model: LogBilinear, turn: int) -> Iterator[pa.RecordBatch]:
    """From the same model, each shard's windows of one round: the parameters times the windows, summed over a task's shards, in parts."""
    windows, total = 0, 0.0
    for batch in batches:
        for row in batch.to_pylist():
            lengths = np.frombuffer(row["lengths"], np.int64)
            k = W.unpack(row["classes"], np.uint32, int(lengths.sum())).astype(np.int32)
            one, two = _contexts(k, lengths)
            take = np.arange(turn, len(k), ROUNDS)
            own = copy.deepcopy(model)
            own.fit(one[take], two[take], k[take], np.random.default_rng((turn, row["shard"])))
            windows, total = windows + len(take), total + own.vector().astype(np.float64) * len(take)
    if windows:
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(PARTS), pa.int32()), "windows": [windows] * PARTS, "sums": [x.tobytes() for x in np.array_split(total, PARTS)]})


def _averaged(sent: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in sent["sums"])
    return pa.table({"part": sent["part"][:1], "values": pa.array([(total / sum(sent["windows"].to_pylist())).astype(np.float32).tobytes()], pa.binary())})


def learned(documents: DataFrame, classes: Classes, shares: np.ndarray, tokens: int) -> LogBilinear:
    """The model after ROUNDS rounds over all training windows of the coded documents; its size doesn't depend on them.

    Documents are dealt into shards of about SHARD_TOKENS by their ids, so how many there are follows from the training tokens,
    and what a shard learns from its documents: not from the layout of the input.
    """
    shards = max(1, math.ceil(tokens / SHARD_TOKENS))
    dealt = documents.mapInArrow(lambda b: _dealt(b, classes, shards), "shard int, keys binary, lengths binary, classes binary")
    gathered = saved(dealt.groupBy("shard").applyInArrow(_gathered, "shard int, lengths binary, classes binary"), "shards")
    model = LogBilinear(shares)
    for turn in range(ROUNDS):
        sent = gathered.mapInArrow(lambda b, turn=turn: _learn(b, model, turn), "part int, windows long, sums binary")
        parts = {r.part: np.frombuffer(r["values"], np.float32) for r in sent.groupBy("part").applyInArrow(_averaged, "part int, values binary").collect()}  # PARTS rows
        if parts:
            model.set_vector(np.concatenate([parts[i] for i in range(PARTS)]))
    return model


def _scores(rows: pa.Table, blocks: int, classes: Classes, tables, total: int, distinct: int, class_total: np.ndarray, class_distinct: np.ndarray) -> pa.Table:
    """Score the documents of one batch."""
    block = rows["block"].to_numpy()
    row = rows.filter(pa.array(block == -1)).to_pylist()[0]
    own = _Coded(row, classes)
    c = np.zeros(len(own.hashes), np.int64)
    # answers lie in the order of blocks and, in a block, of hashes
    of = (own.hashes % np.uint64(blocks)).astype(np.int64)
    place, sizes = np.lexsort((own.hashes, of)), np.unique(of, return_counts=True)[1].tolist()
    answers = rows.filter(pa.array(block >= 0)).select(["block", "counts"]).sort_by("block")["counts"].to_pylist()
    c[place] = np.concatenate([W.unpack(x, np.int64, n) for x, n in zip(answers, sizes, strict=True)])
    log = np.log10((c + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))
    inside = np.where(own.klass > classes.kinds, 0, np.log10((c + SMOOTHING) / (class_total + SMOOTHING * (class_distinct + 1))[np.minimum(own.klass, classes.kinds)]))
    one, two = _contexts(own.k, own.lengths)
    A, B, Z = tables
    model = (A[one, own.k].astype(np.float64) + B[two, own.k] - Z[one, two]) / np.log(10) + inside[own.code]
    ids, first = np.frombuffer(row["ids"], np.int64), np.cumsum(own.lengths) - own.lengths
    return pa.table({
        "doc_id": pa.array(ids, mask=own.held == 2), "held_out": pa.array(own.held > 0), "n_tokens": own.lengths, "n_known": np.add.reduceat((c > 0)[own.code].astype(np.int64), first),
        "train_tokens": np.full(len(ids), total), "base_score": np.add.reduceat(log[own.code], first), "score": np.add.reduceat(model, first),
    })


def score_texts(docs: DataFrame, words: int = WORDS, kinds: int = SHAPES, sum_rows: int = SUM_ROWS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row; see the module."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held", F.coalesce(fold == 0, F.lit(True)).cast("tinyint"))
    blocks = block_count(text_bytes(docs), BLOCK_BYTES)
    coded = saved(docs.mapInArrow(lambda b: _code(b, blocks, kinds), CODED), "coded")
    documents = coded.where("block = -1").select("batch", "block", "distinct", "own", "shapes", "codes", "ids", "held", "lengths")
    answers, totals = _counted(coded.where("block >= 0").select("batch", "block", "hashes", "counts", "kinds"), documents.count(), words, kinds, sum_rows)
    total, distinct = (x or 0 for x in totals.agg(F.sum("total"), F.sum("distinct")).first())
    top = totals.where("size(top_hash) > 0").select(F.explode(F.arrays_zip("top_hash", "top_count", "top_shape")).alias("t")).select("t.*").orderBy(F.desc("top_count"), "top_hash").limit(words).collect()
    shapes = totals.select(F.posexplode(F.arrays_zip("shape_total", "shape_distinct")).alias("shape", "x")).groupBy("shape").agg(F.sum("x.shape_total").alias("n"), F.sum("x.shape_distinct").alias("d")).collect()  # a row a shape
    class_total, class_distinct = np.zeros(kinds + 1, np.int64), np.zeros(kinds + 1, np.int64)
    for r in shapes:
        class_total[r["shape"] + 1], class_distinct[r["shape"] + 1] = r["n"], r["d"]
    for r in top:  # these have a class each
        class_total[r.top_shape + 1] -= r.top_count
        class_distinct[r.top_shape + 1] -= 1
    classes = Classes(np.array([r.top_hash for r in top], np.int64).view(np.uint64), kinds)
    shares = np.append(class_total, [r.top_count for r in top]) + 1.0
    model = learned(documents.select("distinct", "own", "shapes", "codes", "ids", "held", "lengths"), classes, shares / shares.sum(), int(total))
    shared = docs.sparkSession.sparkContext.broadcast((classes, model.tables()))
    both = documents.unionByName(answers.select("batch", "block", "counts"), allowMissingColumns=True)
    return both.groupBy("batch").applyInArrow(lambda t: _scores(t, blocks, *shared.value, total, distinct, class_total, class_distinct), SCORE)


def op5_lm_score(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
