"""Words, windows and hashes of whole Arrow batches of texts, in numpy.

A batch of texts is one byte buffer: every text is followed by a line feed, which no word class holds, so
that words never join across texts. UTF-8 bytes above 0x7F always belong to words, hence classes of bytes and
classes of characters find the same words. A word's hash takes in eight bytes at a time and mixes after each, so
it isn't linear in the bytes: words of equal length up to eight bytes never share one, other given words do with a
chance of about 2**-64. Where a result is exact by contract, Words.codes compares the words themselves.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False

#: ASCII digits, ASCII letters in lower case and everything above ASCII.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Longer spans are hashed and compared one by one.
LONG_SPAN = 256
_LANES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of MurmurHash3 on unsigned 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of at most limit bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, each followed by a line feed (null: empty), and where each begins, with the end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    texts = pc.binary_join_element_wise(texts, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


class Words:
    """The words of some texts.

    buf: the bytes; starts, ends: of each word in buf; first: the number of words before each text, with the
    total; texts: where each text begins in buf.
    """

    def __init__(self, texts: pa.Array, word: np.ndarray, lower: bool = False):
        buf, self.texts = joined(texts)
        self.buf = LOWER[buf] if lower else buf
        self.starts, self.ends = spans(self.buf, word)
        self.first = np.searchsorted(self.starts, self.texts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends)

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        return span_codes(self.buf, self.starts, self.ends)

    def text_of(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def spans(buf: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes of the class in buf, whose last byte isn't of it."""
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[1:] = word[buf]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def _eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of buf on, as one number; zeros follow the end."""
    return np.ndarray(len(buf) + 1, "<u8", np.append(buf, np.zeros(8, np.uint8)).tobytes(), strides=(1,))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of each span of bytes."""
    size = ends - starts
    eights = _eights(buf)
    h = mix(size.astype(np.uint64) * _STEP + np.uint64(seed + 1))
    live = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    for done in range(0, LONG_SPAN, 8):
        if not len(live):
            break
        left = size[live] - done
        h[live] = mix(h[live] ^ (eights[starts[live] + done] & _LANES[np.minimum(left, 8)]))
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        h[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes(), seed)
    return h


def same_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray, other_ends: np.ndarray, other_buf: np.ndarray | None = None) -> np.ndarray:
    """Whether each span has the bytes of the other span beside it, which lies in other_buf or in buf itself."""
    other_buf = buf if other_buf is None else other_buf
    size = ends - starts
    same = size == other_ends - others
    one = _eights(buf)
    two = one if other_buf is buf else _eights(other_buf)
    live = np.flatnonzero(same & (size > 0) & (size <= LONG_SPAN))
    for done in range(0, LONG_SPAN, 8):
        if not len(live):
            break
        left = size[live] - done
        differ = ((one[starts[live] + done] ^ two[others[live] + done]) & _LANES[np.minimum(left, 8)]) > 0
        same[live[differ]] = False
        live = live[~differ & (left > 8)]
    for i in np.flatnonzero(same & (size > LONG_SPAN)).tolist():
        same[i] = (buf[starts[i] : ends[i]] == other_buf[others[i] : other_ends[i]]).all()
    return same


def span_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one span of each number, and the number of each span: equal for spans of equal bytes and for no others."""
    for seed in itertools.count():
        _, first, code = np.unique(span_hashes(buf, starts, ends, seed), return_index=True, return_inverse=True)
        if same_spans(buf, starts, ends, starts[first][code], ends[first][code]).all():
            return first, code


def rolled(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of size consecutive values."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, size):
        out *= _STEP
        out += h[j : j + n]
    return mix(out)


def whole_windows(text_of: np.ndarray, size: int) -> np.ndarray:
    """Which runs of size consecutive words lie in one text, by their first word."""
    n = len(text_of) - size + 1
    return text_of[:n] == text_of[size - 1 :] if n > 0 else np.zeros(0, bool)


def sliding_min(h: np.ndarray, size: int) -> np.ndarray:
    """The least of each run of size consecutive values; none if there are fewer."""
    if len(h) < size:
        return h[:0]
    reach = 1
    while reach * 2 <= size:
        h = np.minimum(h[: len(h) - reach], h[reach:])
        reach *= 2
    return np.minimum(h[: len(h) - size + reach], h[size - reach :]) if size > reach else h


#: Texts on their way are worth some seconds of packing, as what is shuffled is the larger cost.
CODEC = pa.Codec("zstd", compression_level=6)


def pack(x: np.ndarray) -> bytes:
    """Whole numbers compressed, byte plane by byte plane."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), "zstd", asbytes=True) if len(x) else b""


def unpack(b: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(pa.decompress(b, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n).T).view(kind).reshape(n)
