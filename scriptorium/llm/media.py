"""Operator 4: media columns, AVI motion-JPEG.

`stored` keeps each text losslessly as the samples of an AVI; `read_back` parses
the index, decodes the intra frames and takes digests; `clips` gives a timed row
for each shot.  A shot ends where the difference of the grey histograms of two
frames is over FLOOR and over the mean of the differences before it in the shot
by SPREAD of their deviations.

Null text counts as empty: a payload of 64 zero bytes.  Equal texts give equal
media.  Repeated rows are coded each.  An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import avi
from .base import blank_as_empty
from .tokens import slices

UNIT = 64
BATCH = 1 << 20  # bytes that are coded side by side
BINS, FLOOR, SPREAD = 16, 0.08, 1.5


def padded(raw: bytes) -> bytes:
    return raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def stored(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, BATCH):
                texts = [t.encode() for t in part.column(1).to_pylist()]
                media = avi.encode([padded(t) for t in texts])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), blank_as_empty().alias("text")).mapInArrow(encode, "doc_id long, n_bytes long, media binary")


def shots(frames: np.ndarray) -> list[tuple[int, int]]:
    """First and next-after-last frame of each shot."""
    n = len(frames)
    if n < 2:
        return [(0, n)]
    bins = frames.reshape(n, -1) // (256 // BINS)
    counts = np.bincount((np.arange(n)[:, None] * BINS + bins).ravel(), minlength=n * BINS).reshape(n, BINS)
    changes = (np.abs(np.diff(counts, axis=0)).sum(axis=1) / (2 * bins.shape[1])).tolist()
    out, first, seen, total, squares = [], 0, 0, 0.0, 0.0
    for k, change in enumerate(changes, 1):
        mean = total / seen if seen else 0.0
        deviation = max(0.0, squares / seen - mean * mean) ** 0.5 if seen else 0.0
        if change > max(FLOOR, mean + SPREAD * deviation):
            out.append((first, k))
            first, seen, total, squares = k, 0, 0.0, 0.0
        else:
            seen, total, squares = seen + 1, total + change, squares + change * change
    return [*out, (first, n)]


def read_back(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes and what the stored media hold, with the shots as `feature`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, BATCH):
                rows, files = [], part.column(2).to_pylist()
                for file, (payload, frames) in zip(files, avi.decode(files), strict=True):
                    feature = f"{len(frames)}:" + ",".join(f"{a}-{b}" for a, b in shots(frames))
                    rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(file), hashlib.sha256(file).hexdigest(), feature))
                types = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()
                names = "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], ["doc_id", "n_bytes", *names])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(read, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def clips(media: DataFrame) -> DataFrame:
    """doc_id, clip, start_s, end_s, n_frames, mean_grey: a row for each shot."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, BATCH):
                rows = [
                    (doc, k, a / avi.RATE, b / avi.RATE, b - a, float(frames[a:b].mean()))
                    for doc, (_, frames) in zip(part.column(0).to_pylist(), avi.decode(part.column(1).to_pylist()), strict=True)
                    for k, (a, b) in enumerate(shots(frames))
                ]
                types = pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.float64()
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["doc_id", "clip", "start_s", "end_s", "n_frames", "mean_grey"])

    return media.select("doc_id", "media").mapInArrow(cut, "doc_id long, clip int, start_s double, end_s double, n_frames int, mean_grey double")
