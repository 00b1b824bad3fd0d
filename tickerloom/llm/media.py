"""Operator 8: byte payloads as WAV columns and their spectral fingerprints.

A payload is stored losslessly as the 8-bit mono samples of a WAV file and read back by the wave module. A bin of its
short-time Fourier transform is a spectral peak if no bin within NEAR_BINS and NEAR_FRAMES of it is stronger. Of each
frame the PEAKS strongest peaks count; each is paired with the strongest peak of each of the next REACH frames; a pair
is coded as its frame, both bins and the distance, in one whole number, and the codes are an array in order of time.
A recording in which no two peaks are near enough has its single peaks as codes, so no recording is without.

Frames are transformed in runs, so that a long recording takes memory for its samples and codes only. The samples are
continued periodically beyond both ends, so that frames cover the first and the last of them, and there are frames
enough for pairs however short a payload is. A frame's mean is taken off, as it would outshine all else in texts.

Results by case: null and empty texts are 64 zero bytes; equal texts give equal values, as a transform sees one
text only; equally strong neighbours are peaks both, and of equally strong peaks of a frame the lower bins count; repeated
rows and null doc_ids stay, each with its result; a very long text is one recording; an empty table gives an empty
result; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import words as W
from tickerloom.llm.tables import table

UNIT = 64
SAMPLE_RATE = 8000
FRAME = 512
HOP = 256
PEAKS = 2
REACH = 3
NEAR_BINS, NEAR_FRAMES = 4, 1
#: Bins that are weaker by this share count as equally strong, so that a steady tone is a peak in all its frames.
EQUAL = 1e-3
FRAMES_AT_ONCE = 2048

_HANN = (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(FRAME) / FRAME)).astype(np.float32)


def to_wav(payload: bytes, rate: int = SAMPLE_RATE) -> bytes:
    """A WAV file with the payload's bytes as 8-bit mono samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(rate)
        f.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as f:
        return f.readframes(f.getnframes())


def peaks(samples: np.ndarray) -> np.ndarray:
    """The bins of the PEAKS strongest spectral peaks of each frame, strongest first, of 8-bit samples around 128; -1 where a frame has fewer."""
    x = samples.astype(np.float32) - 128 if len(samples) else np.zeros(1, np.float32)
    # the frames lap over both ends, so that the window's weights add up to one at every sample
    n = max(REACH + 1, -(-len(x) // HOP) + 1)
    x = np.pad(x, (HOP, FRAME + (n - 2) * HOP - len(x)), "wrap")
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    out = []
    for a in range(0, n, FRAMES_AT_ONCE):
        before = min(a, NEAR_FRAMES)
        own = frames[a - before : a + FRAMES_AT_ONCE + NEAR_FRAMES]
        power = np.abs(np.fft.rfft((own - own.mean(1, keepdims=True)) * _HANN, axis=1))[:, 1:]
        power = np.where(power >= (1 - EQUAL) * _highest_near(power), power, -1)[before : before + min(FRAMES_AT_ONCE, n - a)]
        out.append(_strongest(power))
    return np.concatenate(out)


def _highest_near(power: np.ndarray) -> np.ndarray:
    """The largest value within NEAR_FRAMES rows and NEAR_BINS columns of each."""
    for axis, reach in ((0, NEAR_FRAMES), (1, NEAR_BINS)):
        own = np.moveaxis(power, axis, 0)
        most = own.copy()
        for d in range(1, reach + 1):
            np.maximum(most[d:], own[:-d], out=most[d:])
            np.maximum(most[:-d], own[d:], out=most[:-d])
        power = np.moveaxis(most, 0, axis)
    return power


def _strongest(power: np.ndarray) -> np.ndarray:
    """The bins (columns, from 1 on) of each row's PEAKS largest values, the first of equals; -1 for negative ones. The values are used up."""
    rows = np.arange(len(power))
    found = []
    for _ in range(PEAKS):
        best = power.argmax(1)
        found.append(np.where(power[rows, best] < 0, -1, best + 1))
        power[rows, best] = -1
    return np.stack(found, 1)


def landmarks(samples: np.ndarray) -> np.ndarray:
    """Codes of peak pairs in order of time: frame << 24 | bin << 14 | later bin << 4 | frames between; the later bin is 0 where a peak stands alone."""
    top = peaks(samples).astype(np.int64)
    frame = np.arange(len(top), dtype=np.int64)
    out = []
    for step in range(1, REACH + 1):
        for p in range(PEAKS):
            there = (top[:-step, p] > 0) & (top[step:, 0] > 0)
            out.append((frame[:-step] << 24 | top[:-step, p] << 14 | top[step:, 0] << 4 | step)[there])
    if not any(map(len, out)):
        out = [(frame << 24 | top[:, p] << 14)[top[:, p] > 0] for p in range(PEAKS)]
    return np.sort(np.concatenate(out))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in W.chunks(batches):
        media, sizes = [], []
        for text in chunk["text"].to_pylist():
            payload = (text or "").encode()
            sizes.append(len(payload))
            media.append(to_wav(payload + bytes(-len(payload) % UNIT or (0 if payload else UNIT))))
        yield pa.RecordBatch.from_pydict({"doc_id": chunk["doc_id"], "n_bytes": pa.array(sizes, pa.int64()), "media": pa.array(media, pa.binary())})


def encode_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) of each row: its text as a WAV file."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode, "doc_id long, n_bytes long, media binary")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in W.chunks(batches, "media"):
        rows = []
        for media in (x.as_py() for x in chunk["media"]):
            payload = from_wav(media)
            codes = landmarks(np.frombuffer(payload, np.uint8))
            rows.append({"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-UNIT:]), "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(), "codes": codes})
        columns = {"doc_id": chunk["doc_id"], "n_bytes": chunk["n_bytes"]}
        columns |= {k: [r[k] for r in rows] for k in rows[0]}
        yield pa.RecordBatch.from_pydict(columns, schema=pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("codes", pa.list_(pa.int64()))]))


def media_features(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, codes) of each stored file, read back."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, codes array<long>"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_features, schema)


def op8_media(spark, sf_dir: str) -> DataFrame:
    found = media_features(encode_media(table(spark, sf_dir, "documents")))
    return found.withColumn("feature", F.concat_ws(",", F.col("codes").cast("array<string>"))).drop("codes")
