"""Operator 6: packing of token sequences by lexical retrieval.

A shard is a run of documents inside a task, with a BM25 inverted index over their token ids. A seed document opens
a window; the index ranks all unused documents of the shard that share a term with it, by all of the seed's terms, and
they fill the rest of the window in order. A document that doesn't fit is cut, and what is left of it opens the next
window. Where no unused neighbour is left, the next unused document goes on. Only a shard's end leaves a window
unfilled; it is dealt into sequences of powers of two, which need no padding. Shards are bounded in tokens and
documents, so memory is too, and nothing is shuffled.

Postings of the most frequent terms are kept as dense columns, whose share of all scores is one matrix product a
shard; those of all other terms are lists, which a search adds up. No term or neighbour is left out.

Results by case: null and empty texts are just the end id; repeated rows and null doc_ids stay, each with its own
pieces; ties of scores go to the earlier document; an empty table gives an empty result; texts with the vocabulary's
special strings, or with runs of over RUN_CHARS characters with or without white space, go through the
tokenizers library itself, so that no length or shape of a text is too much; a very long text is cut into windows like
any other, and a shard holds it as a whole; other columns are passed over.
"""

from __future__ import annotations

import base64
import collections
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import words as W
from tickerloom.llm.tables import table

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1_500_000
SHARD_DOCS = 3000
#: Terms whose postings are dense columns.
DENSE_TERMS = 1024
K1, B = 1.2, 0.75
#: The fast encoder's pattern runs out of stack on very long runs of one kind.
RUN_CHARS = 1000
SPECIAL = "<|endoftext|>"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_encoders: dict[tuple[str, str], tuple] = {}
_GAP = re.compile(rf"\s{{{RUN_CHARS}}}")


class Encoder:
    """Token ids of texts: a fast encoder with the same vocabulary, and the tokenizers library for special strings."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.whole = json_path, None

    def ids(self, text: str) -> np.ndarray:
        if SPECIAL in text or (len(text) > RUN_CHARS and (max(map(len, text.split()), default=0) > RUN_CHARS or _GAP.search(text))):
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.json_path)
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array([*ids, END_ID], np.uint32)


def encoder(json_path: str, ranks_path: str, pattern: str) -> Encoder:
    """One encoder a worker, as building its tables takes a while."""
    key = json_path, ranks_path
    if key not in _encoders:
        _encoders[key] = Encoder(json_path, ranks_path, pattern)
    return _encoders[key]


class Index:
    """A BM25 inverted index over a shard's token ids, without the end ids."""

    def __init__(self, docs: list[np.ndarray], dense_terms: int = DENSE_TERMS):
        n = len(docs)
        lengths = np.array([len(d) - 1 for d in docs])
        key = np.sort(np.concatenate([d[:-1] for d in docs]).astype(np.uint64) << np.uint64(32) | np.repeat(np.arange(n, dtype=np.uint64), lengths))
        heads = np.flatnonzero(np.append(True, np.diff(key) != 0)[: len(key)])
        times = np.diff(np.append(heads, len(key)))
        key = key[heads]
        doc = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        tops = np.flatnonzero(np.append(True, np.diff(key >> np.uint64(32)) != 0)[: len(key)])
        found = np.diff(np.append(tops, len(key)))
        term = np.repeat(np.arange(len(tops)), found)
        idf = np.log(1 + (n - found + 0.5) / (found + 0.5))
        weight = idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * lengths[doc] / max(lengths.mean(), 1)))
        often = np.argsort(-found, kind="stable")[:dense_terms]
        often = often[found[often] > 1]
        column = np.full(len(tops), -1)
        column[often] = np.arange(len(often))
        there = np.flatnonzero(column[term] >= 0)
        dense = np.zeros((n, len(often)), np.float32)
        dense[doc[there], column[term[there]]] = weight[there]
        #: what the dense columns add to the score of each document (row) for each seed (column)
        self.scores = dense @ (dense > 0).astype(np.float32).T
        rest = np.flatnonzero((column[term] < 0) & (found[term] > 1))
        self.doc, self.weight, term = doc[rest], weight[rest], term[rest]
        of = np.unique(term, return_index=True, return_inverse=True)
        self.first = np.append(of[1], len(rest))
        by_doc = np.argsort(self.doc, kind="stable")
        self.terms, self.terms_of = of[2][by_doc], np.searchsorted(self.doc[by_doc], np.arange(n + 1))

    def score(self, seed: int) -> np.ndarray:
        """The BM25 score of each document for all terms of the seed."""
        score = self.scores[:, seed].astype(np.float64)
        terms = self.terms[self.terms_of[seed] : self.terms_of[seed + 1]]
        if len(terms):
            slots = [slice(self.first[t], self.first[t + 1]) for t in terms.tolist()]
            score += np.bincount(np.concatenate([self.doc[s] for s in slots]), np.concatenate([self.weight[s] for s in slots]), len(score))
        return score

    def neighbours(self, seed: int, free: np.ndarray) -> np.ndarray:
        """All free documents that share a term with the seed, best first; ties go to the earlier document."""
        score = np.where(free, self.score(seed), 0)
        near = np.flatnonzero(score > 0)
        return near[np.argsort(-score[near], kind="stable")]


def pack(docs: list[np.ndarray], window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; sequences count from 0."""
    if not docs:
        return
    index, free = Index(docs), np.ones(len(docs), bool)
    sequence = offset = start = next_free = 0
    queue: collections.deque[int] = collections.deque()
    current: int | None = None
    pieces = []
    while True:
        if current is None:
            while queue and not free[queue[0]]:
                queue.popleft()
            if not queue:
                while next_free < len(docs) and not free[next_free]:
                    next_free += 1
                if next_free == len(docs):
                    break
                queue = collections.deque([next_free])
            current, start = queue.popleft(), 0
            free[current] = False
        take = min(window - offset, len(docs[current]) - start)
        pieces.append((current, start, take, sequence, offset))
        start, offset = start + take, offset + take
        if offset == window:
            sequence, offset, queue = sequence + 1, 0, collections.deque()
        if start == len(docs[current]):
            if offset and not queue:
                queue = collections.deque(index.neighbours(current, free).tolist())
            current = None
    # the last window, unfilled, in powers of two
    tail = [p for p in pieces if offset and p[3] == sequence]
    yield from pieces[: len(pieces) - len(tail)]
    sizes = [1 << i for i in reversed(range(offset.bit_length())) if offset >> i & 1]
    room = sizes.pop(0) if sizes else 0
    at = 0
    for doc, begin, length, *_ in tail:
        while length:
            take = min(length, room - at)
            yield doc, begin, take, sequence, at
            begin, length, at = begin + take, length - take, at + take
            if at == room and (length or sizes):
                sequence, at, room = sequence + 1, 0, sizes.pop(0)


def _pack(batches: Iterator[pa.RecordBatch], paths: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    own = encoder(*paths)
    base = TaskContext.get().partitionId() << 40
    ids: list = []
    docs: list[np.ndarray] = []
    tokens = 0

    def rows() -> pa.RecordBatch:
        nonlocal base
        doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pack(docs), strict=True))
        crc = [zlib.crc32(docs[d][a : a + n].astype("<u4")) for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
        out = pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()).take(pa.array(doc)), "start": start, "length": length, "ids_crc32": pa.array(crc, pa.int64()),
            "doc_tokens": np.array([len(d) for d in docs], np.int64)[doc], "sequence_id": sequence + base, "offset": offset,
        })
        base += int(sequence.max()) + 1
        return out

    for chunk in W.chunks(batches):
        for i, text in zip(chunk["doc_id"].to_pylist(), chunk["text"].to_pylist(), strict=True):
            ids.append(i)
            docs.append(own.ids(text or ""))
            tokens += len(docs[-1])
            if tokens >= SHARD_TOKENS or len(docs) == SHARD_DOCS:
                yield rows()
                ids, docs, tokens = [], [], 0
    if docs:
        yield rows()


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, pattern: str) -> DataFrame:
    """The pieces of each row's token ids in sequences of WINDOW or of smaller powers of two; the paths are the executors'."""
    paths = json_path, ranks_path, pattern
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda b: _pack(b, paths), PIECES)


def public_vocabulary() -> tuple[str, str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), *public_vocabulary())
