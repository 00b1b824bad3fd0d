"""Operator 10: unigram token counts by dynamic programming over a trie of pre-tokens.

A pre-token is a word behind a word mark. Its tokens are the pieces of its best segmentation: the forward score of
a prefix is the best, over the pieces that may end it, of the score before the piece plus the piece's. The
distinct pre-tokens of a run of documents are sorted, which lays out their trie: a prefix shared with the word
before is a node that exists already, so its forward score is computed once and carried along; terminal nodes
hold the counts, and the documents only add them up. Depths are worked through in numpy, all nodes of one at once.
Words of similar length share a trie, so that a long one doesn't widen all others. Pieces are matched byte by byte
in a trie of their reversed spellings. The sizes of runs bound memory; nothing is shuffled.

The vocabulary is a public one, read from a path, never trained. It comes without probabilities, so a piece of
rank r is given Zipf's share, 1 / (r + ZIPF), as whole micro-nats: sums are exact and ties are decided alike
everywhere (fewer tokens first). A byte that no piece covers is a token of its own at UNKNOWN below the least score.

Results by case: null and empty texts have no tokens; repeated rows and null doc_ids stay, each with its result; an
empty table gives an empty result; a pre-token of over the last of WIDTHS bytes shares no prefix and takes the same
recurrence by itself, in time and memory linear in its length; of segmentations of equal score the one with the
fewest tokens counts; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import words as W
from tickerloom.llm.tables import table

ZIPF = 2.7
UNKNOWN = 10_000_000
NONE = np.iinfo(np.int64).min
#: Most bytes of the words of one trie.
WIDTHS = (40, 400, 4000)
#: Stands for the word mark; no UTF-8 text has this byte.
MARK = b"\xff"
BATCH_WORDS = 1_000_000
NODE_ROWS = 100_000


def read_pieces(path: str) -> dict[bytes, int]:
    """Pieces of a sentencepiece model and their scores in micro-nats, by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    shares = 1 / (np.arange(len(normal)) + ZIPF)
    scores = np.rint(np.log(shares / shares.sum()) * 1e6).astype(np.int64)
    return {model.id_to_piece(i).encode().replace("▁".encode(), MARK): int(s) for i, s in zip(normal, scores, strict=True)}


class Pieces:
    """Pieces and their scores, and a trie of their bytes from the last to the first.

    Node 0 is the root; steps holds parent << 8 | byte in ascending order, and the node it leads to is its place + 1.
    """

    def __init__(self, scores: dict[bytes, int]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.least = min(scores.values()) - UNKNOWN
        endings = sorted({piece[i:][::-1] for piece in scores for i in range(len(piece))}, key=lambda x: (len(x), x))
        # by length and then by bytes, so that places of parents, and with them the steps, ascend
        place = {b"": 0} | {x: i + 1 for i, x in enumerate(endings)}
        self.steps = np.array([place[x[:-1]] << 8 | x[-1] for x in endings], np.int64)
        self.score = np.array([scores.get(x[::-1], NONE) for x in endings], np.int64)

    def one(self, word: bytes) -> tuple[int, int]:
        """Score and number of tokens of one pre-token."""
        best: list[tuple[int, int]] = [(0, 0)]
        for d in range(1, len(word) + 1):
            at, n = best[d - 1]
            most = (at + self.scores.get(word[d - 1 : d], self.least), n - 1)
            for size in range(2, min(d, self.longest) + 1):
                s = self.scores.get(word[d - size : d])
                if s is not None:
                    most = max(most, (best[d - size][0] + s, best[d - size][1] - 1))
            best.append(most)
        return best[-1][0], -best[-1][1]

    def many(self, letters: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and token counts of the words in the rows of letters, which are sorted, differ, and end in zeros."""
        n, width = letters.shape
        differ = letters[1:] != letters[:-1]
        shared = np.append(0, np.where(differ.any(1), differ.argmax(1), width))
        forward, tokens = np.zeros((width + 1, n), np.int64), np.zeros((width + 1, n), np.int32)
        for d in range(1, int(lengths.max(initial=0)) + 1):
            own = np.flatnonzero((shared < d) & (lengths >= d))
            best = np.full(len(own), NONE, np.int64)
            count = np.zeros(len(own), np.int32)
            live, node = np.arange(len(own)), np.zeros(len(own), np.int64)
            for size in range(1, min(d, self.longest) + 1):
                step = node << 8 | letters[own[live], d - size]
                at = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
                known = self.steps[at] == step
                score = np.where(known, self.score[at], NONE)
                if size == 1:
                    score = np.where(score == NONE, self.least, score)
                piece = np.flatnonzero(score > NONE)
                row = live[piece]
                f = forward[d - size, own[row]] + score[piece]
                c = tokens[d - size, own[row]] + 1
                better = (f > best[row]) | ((f == best[row]) & (c < count[row]))
                best[row[better]], count[row[better]] = f[better], c[better]
                live, node = live[known], at[known] + 1
                if not len(live):
                    break
            forward[d, own], tokens[d, own] = best, count
            carried = np.flatnonzero((shared >= d) & (lengths >= d))  # nodes of words before
            if len(carried):
                owner = np.zeros(n, np.int64)
                owner[own] = own
                owner = np.maximum.accumulate(owner)[carried]
                forward[d, carried], tokens[d, carried] = forward[d, owner], tokens[d, owner]
        rows = np.arange(n)
        return forward[lengths, rows], tokens[lengths, rows]


def _distinct_counts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Scores and token counts of distinct words."""
    score, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    lengths = ends - starts + 1
    for i in np.flatnonzero(lengths > WIDTHS[-1]).tolist():
        score[i], count[i] = pieces.one(MARK + buf[starts[i] : ends[i]].tobytes())
    for least, width in zip((0, *WIDTHS), WIDTHS, strict=False):
        some = np.flatnonzero((lengths > least) & (lengths <= width))
        rows = NODE_ROWS * WIDTHS[0] // width
        # by their first bytes, so that each trie holds neighbours
        head = np.zeros((len(some), 8), np.uint8)
        for j in range(8):
            there = lengths[some] > j + 1
            head[there, j] = buf[starts[some[there]] + j]
        some = some[np.argsort(head.view(">u8").reshape(-1).astype(np.uint64), kind="stable")]
        for a in range(0, len(some), rows):
            own = some[a : a + rows]
            letters = np.zeros((len(own), width), np.uint8)
            letters[:, 0] = MARK[0]
            for j in range(1, int(lengths[own].max())):
                there = lengths[own] > j
                letters[there, j] = buf[starts[own[there]] + j - 1]
            keys = letters.view(">u8").reshape(len(own), width // 8)
            order = np.lexsort(tuple(keys[:, i].astype(np.uint64) for i in reversed(range(-(-int(lengths[own].max()) // 8)))))
            score[own[order]], count[own[order]] = pieces.many(letters[order], lengths[own[order]])
    return score, count


def _count(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    words = 0

    def rows() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        buf = np.concatenate([w.buf for _, w in held])
        base = np.cumsum([0] + [len(w.buf) for _, w in held[:-1]])
        starts = np.concatenate([w.starts + b for (_, w), b in zip(held, base, strict=True)])
        ends = np.concatenate([w.ends + b for (_, w), b in zip(held, base, strict=True)])
        first, code = W.span_codes(buf, starts, ends)
        score, count = _distinct_counts(buf, starts[first], ends[first], pieces)
        totals = np.append(0, np.cumsum(count[code])), np.append(0, np.cumsum(score[code]))
        at = 0
        for batch, w in held:
            bounds = w.first + at
            at += len(w)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "n_words": np.diff(w.first), "n_tokens": np.diff(totals[0][bounds]), "micro_nats": np.diff(totals[1][bounds])})

    for chunk in W.chunks(batches):
        w = W.Words(chunk["text"], W.SPACE_WORD)
        held.append((chunk.select(["doc_id"]), w))
        words += len(w)
        if words >= BATCH_WORDS:
            yield from rows()
            held, words = [], 0
    yield from rows()


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, micro_nats) of each row, by the vocabulary at path on the driver."""
    pieces = docs.sparkSession.sparkContext.broadcast(Pieces(read_pieces(path)))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(lambda b: _count(b, pieces.value), "doc_id long, n_words long, n_tokens long, micro_nats long")


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
