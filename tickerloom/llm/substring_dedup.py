"""Operator 9: duplicate word spans by relative Lempel-Ziv parsing against indexed reference blocks.

A document is factored greedily into the longest runs of words that also stand in the reference, which is all
documents with smaller ids; factors of `size` words and more are its duplicate spans (relative_lz). A parse
against every block of a large corpus would take the square of its size, so the reference is dealt into blocks by
content: each window of `size` words belongs to the block of its minimizer (the least hash of its three-word
runs). Equal windows then always meet in one block, and a piece of a document has to be parsed only against the block
that can hold its windows. A block's reference is the words of all pieces dealt to it, indexed by the earliest
position of each window; factors are found by comparing words. A piece holds whole windows, and the cursor of a
parse stops at every window across a factor's end, so neither boundaries of factors nor of pieces hide a match.

A batch of documents is a block by itself first: what it repeats is known before anything is shuffled, so a passage
that a third of all documents share reaches its block once a batch, not once a document. Pieces travel as
compressed text. Blocks name spans by batch and place in it, so that spans meet their texts batch by batch.

A frequent run of three words may be the minimizer of any number of windows. What each block will get is therefore
counted. The windows of a block of over HOT_WINDOWS are dealt again, by the minimizer of their runs of eight words, and
those of a part that is still too large by the whole window; neither changes which windows are equal.
A batch sends a block one row, and never more rows than it has pieces, so rows grow with the input at most.

Results by case: a null text has no words; a null doc_id has no order, so its row is kept whole and removes
nothing from others; rows with one doc_id don't remove each other's words (none is smaller), and a repeated row
gets the result once for each row; a very long text is a batch of its own, worked in memory of about 100 bytes a
word; ties don't arise, as any earliest occurrence gives the same spans; an empty table gives an empty result; other
columns are passed over.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import relative_lz
from tickerloom.llm import words as W
from tickerloom.llm.tables import block_count, saved, text_bytes

#: Words of the documents that are parsed against each other before they are sent to their blocks.
BATCH_WORDS = 1_000_000
#: Words of the runs whose least hash deals a window, at first and for what is dealt again.
MINIMIZER_WORDS = (3, 8)
BLOCK_BYTES = 4 << 20
#: Windows of a block that one task may hold.
HOT_WINDOWS = 1_500_000
#: Bytes and rows of an Arrow batch of pieces.
SENT_BYTES, SENT_ROWS = 1 << 20, 1000

BATCH = "batch string, docs binary, n int, doc binary, start binary, until binary, blocks array<long>, loads array<long>"
PIECES = "batch string, block long, n int, bytes long, doc binary, id binary, start binary, words binary"
SPANS = "batch string, n int, doc binary, start binary, until binary"

#: Ends a piece in a block's text; no UTF-8 text has this byte.
_END = 0xFF
_PIECE_WORD = W.SPACE_WORD.copy()
_PIECE_WORD[_END] = False


class Deal:
    """The block of each window. hot: for each level of dealing again, the keys of blocks and into how many parts each goes."""

    def __init__(self, blocks: int, size: int, hot: list[dict[int, int]]):
        self.blocks, self.size = blocks, size
        self.hot = [(np.array(sorted(x), np.int64), np.array([x[k] for k in sorted(x)], np.uint64)) for x in hot]

    def of(self, h: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of each whole window, from the hashes of the words, and whether all levels dealt it."""
        least = lambda n: W.sliding_min(W.rolled(h, n), self.size - n + 1)[: len(ok)][ok]
        runs = [min(n, self.size) for n in (*MINIMIZER_WORDS, self.size)]
        key = (least(runs[0]) % np.uint64(self.blocks)).astype(np.int64)
        dealt = np.ones(len(key), bool)
        for (keys, parts), n in zip(self.hot, runs[1:], strict=False):
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            dealt &= keys[at] == key
            own = np.flatnonzero(dealt)
            part = W.mix(least(n)[own]) % parts[at[own]]
            key[own] = (W.mix(key[own].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + part) >> np.uint64(1)).astype(np.int64)
        return key, dealt


class _Docs:
    """The words of a batch's documents; those without an id have none here."""

    def __init__(self, docs: pa.RecordBatch, size: int):
        self.ids = docs["doc_id"].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        texts = pa.compute.if_else(docs["doc_id"].is_valid(), docs["text"], pa.scalar(None, docs["text"].type))
        self.w = W.Words(texts, W.SPACE_WORD)
        self.size = size
        self.text_of = self.w.text_of()

    def known(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, start, until) of the factors that stand in the batch's own documents of smaller id."""
        begin, length, _ = relative_lz.parse(self.w.codes()[1], self.w.first, self.ids, self.size)
        doc = self.text_of[begin]
        start = begin - self.w.first[doc]
        return doc.astype(np.int32), start.astype(np.int32), (start + length).astype(np.int32)

    def open_windows(self, known: tuple[np.ndarray, ...], deal: Deal) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words and blocks of the windows that no known factor covers, and whether all levels dealt them."""
        ok = W.whole_windows(self.text_of, self.size)
        doc, start, until = known
        steps = np.zeros(len(self.w) + 1, np.int64)
        np.add.at(steps, self.w.first[doc] + start, 1)
        np.add.at(steps, self.w.first[doc] + until - self.size + 1, -1)
        ok &= np.cumsum(steps)[: len(ok)] == 0
        block, dealt = deal.of(self.w.hashes(), ok)
        return np.flatnonzero(ok), block, dealt

    def pieces(self, at: np.ndarray, block: np.ndarray) -> Iterator[dict]:
        """A row for each block: runs of neighbouring windows of one document, as text."""
        if not len(at):
            return
        breaks = np.append(True, (np.diff(at) != 1) | (np.diff(block) != 0) | (np.diff(self.text_of[at]) != 0))
        heads = np.flatnonzero(breaks)
        first, last = at[heads], at[np.append(heads[1:], len(at)) - 1] + self.size - 1
        a, z, doc = self.w.starts[first], self.w.ends[last], self.text_of[first]
        start = (first - self.w.first[doc]).astype(np.int32)
        data = self.w.buf.tobytes()
        order = np.argsort(block[heads], kind="stable")
        bounds = np.append(np.flatnonzero(np.append(True, np.diff(block[heads][order]) != 0)), len(order))
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            own = order[i:j]
            words = b"".join(data[x:y] + b"\xff" for x, y in zip(a[own].tolist(), z[own].tolist(), strict=True))
            yield {"block": int(block[heads[own[0]]]), "n": len(own), "bytes": len(words), "doc": W.pack(doc[own].astype(np.int32)), "id": W.pack(self.ids[doc[own]]), "start": W.pack(start[own]), "words": W.CODEC.compress(words, asbytes=True)}


def _written(docs: list[pa.RecordBatch]) -> bytes:
    whole = pa.Table.from_batches(docs).combine_chunks().to_batches()[0]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression=W.CODEC)) as out:
        out.write_batch(whole)
    return sink.getvalue().to_pybytes()


def _read(docs: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(docs).read_next_batch()


def _batches(batches: Iterator[pa.RecordBatch], size: int, deal: Deal) -> Iterator[pa.RecordBatch]:
    """Batches of documents with their known factors and how many windows they have left for each block."""

    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        written = _written(held)
        docs = _Docs(_read(written), size)
        known = docs.known()
        blocks, loads = np.unique(docs.open_windows(known, deal)[1], return_counts=True)
        doc, start, until = map(W.pack, known)
        return pa.RecordBatch.from_pylist([{"batch": uuid.uuid4().hex, "docs": written, "n": len(known[0]), "doc": doc, "start": start, "until": until, "blocks": blocks.tolist(), "loads": loads.tolist()}], schema=_BATCH_SCHEMA)

    held, words = [], 0
    for chunk in W.chunks(batches):
        held.append(chunk.select(["doc_id", "text"]))
        words += len(W.Words(chunk["text"], W.SPACE_WORD))
        if words >= BATCH_WORDS:
            yield row(held)
            held, words = [], 0
    if held:
        yield row(held)


_BATCH_SCHEMA = pa.schema([("batch", pa.string()), ("docs", pa.binary()), ("n", pa.int32()), ("doc", pa.binary()), ("start", pa.binary()), ("until", pa.binary()), ("blocks", pa.list_(pa.int64())), ("loads", pa.list_(pa.int64()))])


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _known(row: dict) -> tuple[np.ndarray, ...]:
    return tuple(W.unpack(row[k], np.int32, row["n"]) for k in ("doc", "start", "until"))


def _recount(batches: Iterator[pa.RecordBatch], deal: Deal) -> Iterator[pa.RecordBatch]:
    """How many windows each block of the last level gets from a batch."""
    for row in _each(batches):
        _, block, dealt = _Docs(_read(row["docs"]), deal.size).open_windows(_known(row), deal)
        own, n = np.unique(block[dealt], return_counts=True)
        yield pa.RecordBatch.from_pydict({"block": own, "n": n})


def _offer(batches: Iterator[pa.RecordBatch], deal: Deal) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("batch", pa.string()), ("block", pa.int64()), ("n", pa.int32()), ("bytes", pa.int64()), *((k, pa.binary()) for k in ("doc", "id", "start", "words"))])
    for row in _each(batches):
        docs = _Docs(_read(row["docs"]), deal.size)
        at, block, _ = docs.open_windows(_known(row), deal)
        own, room = [], SENT_BYTES
        for piece in docs.pieces(at, block):
            own.append({"batch": row["batch"]} | piece)
            room -= len(piece["words"])
            if room <= 0 or len(own) == SENT_ROWS:
                yield pa.RecordBatch.from_pylist(own, schema=kinds)
                own, room = [], SENT_BYTES
        if own:
            yield pa.RecordBatch.from_pylist(own, schema=kinds)


def _parse(offered: pa.Table, size: int) -> pa.Table:
    """Index the words of a block and parse each of its pieces against those of smaller ids."""
    rows = offered.to_pylist()
    counts = np.array([r["n"] for r in rows])
    doc, start = (np.concatenate([W.unpack(r[k], np.int32, r["n"]) for r in rows]) for k in ("doc", "start"))
    ids = np.concatenate([W.unpack(r["id"], np.int64, r["n"]) for r in rows])
    buf = np.concatenate([np.frombuffer(pa.decompress(r["words"], r["bytes"], "zstd", asbytes=True), np.uint8) for r in rows])
    starts, ends = W.spans(buf, _PIECE_WORD)
    first = np.append(0, np.searchsorted(starts, np.flatnonzero(buf == _END)))
    begin, length, _ = relative_lz.parse(W.span_codes(buf, starts, ends)[1], first, ids, size)
    order = np.argsort(begin)
    begin, length = begin[order], length[order]
    piece = np.searchsorted(first, begin, "right") - 1
    at = (start[piece] + begin - first[piece]).astype(np.int32)
    bounds = np.searchsorted(piece, np.append(0, np.cumsum(counts)))
    out = [{"batch": r["batch"], "n": int(z - a), "doc": W.pack(doc[piece[a:z]]), "start": W.pack(at[a:z]), "until": W.pack((at[a:z] + length[a:z]).astype(np.int32))} for r, a, z in zip(rows, bounds[:-1], bounds[1:], strict=True) if z > a]
    return pa.Table.from_pylist(out, schema=pa.schema([("batch", pa.string()), ("n", pa.int32()), *((k, pa.binary()) for k in ("doc", "start", "until"))]))


def _dealt(batches: DataFrame, blocks: int, size: int, hot_windows: int) -> Deal:
    """The deal by which no block gets over hot_windows windows, but for equal ones of different batches.

    Each hot block has over hot_windows windows, so their list is shorter than the input's words over that number.
    """
    hot: list[dict[int, int]] = []
    loads = batches.select(F.explode(F.arrays_zip("blocks", "loads")).alias("x")).select(F.col("x.blocks").alias("block"), F.col("x.loads").alias("n"))
    for _ in range(2):
        over = {r.block: math.ceil(2 * r.n / hot_windows) for r in loads.groupBy("block").agg(F.sum("n").alias("n")).where(F.col("n") > hot_windows).collect()}
        if not over:
            break
        hot.append(over)
        deal = Deal(blocks, size, hot)
        loads = batches.select("docs", "n", "doc", "start", "until").mapInArrow(lambda b, deal=deal: _recount(b, deal), "block long, n long")
    return Deal(blocks, size, hot)


def _cut(docs: pa.RecordBatch, doc: np.ndarray, start: np.ndarray, until: np.ndarray) -> pa.Table:
    """The documents of a batch without the words of the spans."""
    w = W.Words(docs["text"], W.SPACE_WORD)
    steps = np.zeros(len(w) + 1, np.int64)
    np.add.at(steps, w.first[doc] + start, 1)
    np.add.at(steps, w.first[doc] + until, -1)
    gone = np.cumsum(steps)[:-1] > 0
    stay = np.flatnonzero(~gone)
    marks = np.zeros(len(w.buf) + 1, np.int8)
    marks[w.starts[stay]] = 1
    marks[w.ends[stay] + 1] -= 1  # each word takes the byte behind it along, as a space
    mask = np.cumsum(marks[:-1]).astype(bool)
    text = np.where(W.SPACE_WORD[w.buf], w.buf, 0x20)[mask].tobytes()
    to = np.append(0, np.cumsum(mask))[w.texts]
    removed = np.append(0, np.cumsum(gone))[w.first]
    texts = [text[a : max(a, z - 1)] for a, z in zip(to[:-1], to[1:], strict=True)]
    return pa.table({
        "doc_id": docs["doc_id"], "kept": pa.array([x.decode() for x in texts], pa.string()), "n_words": np.diff(w.first), "n_removed": np.diff(removed),
        "kept_sha256": [hashlib.sha256(x).hexdigest() for x in texts],
    })


def _answer(rows: pa.Table) -> pa.Table:
    """Cut a batch by its known factors and by those that blocks found."""
    rows = rows.to_pylist()
    spans = [np.concatenate(x) for x in zip(*map(_known, rows), strict=True)]
    return _cut(_read(next(r["docs"] for r in rows if r["docs"] is not None)), *spans)


def remove_duplicates(docs: DataFrame, size: int = 13, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """(doc_id, kept, n_words, n_removed, kept_sha256) of each row: its words without duplicate spans, joined by one space."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = block_count(text_bytes(docs), BLOCK_BYTES)
    plain = Deal(blocks, size, [])
    batches = saved(docs.mapInArrow(lambda b: _batches(b, size, plain), BATCH), "batches")
    deal = _dealt(batches, blocks, size, hot_windows)
    own = batches.select("batch", "docs", "n", "doc", "start", "until")
    spans = own.mapInArrow(lambda b: _offer(b, deal), PIECES).groupBy("block").applyInArrow(lambda x: _parse(x, size), SPANS)
    both = own.unionByName(spans, allowMissingColumns=True)
    return both.groupBy("batch").applyInArrow(_answer, "doc_id long, kept string, n_words long, n_removed long, kept_sha256 string")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from tickerloom.llm.tables import table

    return remove_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
