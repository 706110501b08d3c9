"""Binary columns as PNG media: lossless storage, checksum tests, unfiltering, and a low-frequency hash.

A payload of bytes becomes 8-bit RGB samples, 64 pixels (192 bytes) a row. The writer puts the zlib stream into IDAT
chunks of bounded size, each with its CRC; the reader tests every CRC, inflates, and undoes the five row filters with
numpy. The feature is the sign pattern of the lowest 8 by 8 cosine coefficients of a 32 by 32 reduction of the picture.

Defined results: null and empty texts store one row of spaces; equal texts give equal values; repeated rows repeat.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronoloom.llm.common import materialize, slices, small_batches

WIDTH, CHANNELS = 64, 3
STRIDE = WIDTH * CHANNELS
#: Bytes of one IDAT chunk.
CHUNK = 1 << 20
#: Fixed value: the eight bytes that open every PNG file.
SIGNATURE = b"\x89PNG\r\n\x1a\n"

NONE, SUB, UP, AVERAGE, PAETH = range(5)


def chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def filtered(rows: np.ndarray, kind: int) -> np.ndarray:
    """Rows with the filter byte in front; the writer takes the shorter stream of NONE and UP."""
    out = np.empty((len(rows), rows.shape[1] + 1), np.uint8)
    out[:, 0] = kind
    out[:, 1:] = rows
    if kind == UP:
        out[1:, 1:] -= rows[:-1]
    return out


def encode_png(payload: bytes, level: int = 1) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, STRIDE)
    stream = min((zlib.compress(filtered(rows, kind).tobytes(), level) for kind in (NONE, UP)), key=len)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 2, 0, 0, 0)
    body = b"".join(chunk(b"IDAT", stream[i : i + CHUNK]) for i in range(0, len(stream), CHUNK))
    return SIGNATURE + chunk(b"IHDR", head) + body + chunk(b"IEND", b"")


def unfiltered(raw: np.ndarray, step: int) -> np.ndarray:
    """Samples from rows that begin with a filter byte; step is the bytes of a pixel."""
    kinds, rows = raw[:, 0], raw[:, 1:]
    if (kinds == NONE).all():
        return rows
    if (kinds == UP).all():
        return np.cumsum(rows, axis=0, dtype=np.uint8)
    if (kinds == SUB).all():
        return np.cumsum(rows.reshape(len(rows), -1, step), axis=1, dtype=np.uint8).reshape(rows.shape)
    out, above = np.empty_like(rows), np.zeros(rows.shape[1], np.uint8)
    for i, kind in enumerate(kinds):
        if kind == NONE:
            row = rows[i]
        elif kind == SUB:
            row = np.cumsum(rows[i].reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        elif kind == UP:
            row = rows[i] + above
        elif kind in (AVERAGE, PAETH):
            row, left, corner = rows[i].astype(np.int32), np.zeros(step, np.int32), np.zeros(step, np.int32)
            for at in range(0, len(row), step):
                up = above[at : at + step].astype(np.int32)
                if kind == AVERAGE:
                    guess = (left + up) >> 1
                else:
                    a, b, c = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left = row[at : at + step] = (row[at : at + step] + guess) & 255
                corner = up
            row = row.astype(np.uint8)
        else:
            raise ValueError(f"unknown filter {kind}")
        out[i] = above = row
    return out


def decode_png(media: bytes) -> np.ndarray:
    """Samples (height, width, 3) of an 8-bit RGB picture; raises on a wrong signature, order or checksum."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, size, stream, ended = 8, None, [], False
    while at < len(media) and not ended:
        (length,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + length]
        if struct.unpack_from(">I", media, at + 8 + length)[0] != zlib.crc32(kind + body):
            raise ValueError(f"checksum of {kind!r} at {at}")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            stream.append(body)
        ended = kind == b"IEND"
        at += length + 12
    if size is None or not ended or size[2:] != (8, 2, 0, 0, 0):
        raise ValueError("not an 8-bit RGB picture without interlacing")
    width, height = size[:2]
    raw = np.frombuffer(zlib.decompress(b"".join(stream)), np.uint8).reshape(height, width * CHANNELS + 1)
    return unfiltered(raw, CHANNELS).reshape(height, width, CHANNELS)


_COS = np.cos(np.pi * (2 * np.arange(32)[None, :] + 1) * np.arange(8)[:, None] / 64)


def picture_hash(samples: np.ndarray) -> str:
    """64 bits: which of the lowest cosine coefficients exceed their median."""
    grey = samples.sum(axis=2, dtype=np.int64)
    for axis in (0, 1):
        n = grey.shape[axis]
        if n >= 32:
            edges = np.arange(32) * n // 32
            counts = np.diff(np.append(edges, n))
            grey = np.add.reduceat(grey, edges, axis=axis) / (counts[:, None] if axis == 0 else counts)
        else:
            grey = grey.take(np.arange(32) * n // 32, axis=axis)
    low = np.round(_COS @ grey @ _COS.T, 6).ravel()
    bits = low > np.median(low[1:])
    return np.packbits(bits).tobytes().hex()


def padded(text: bytes) -> bytes:
    return text.ljust(max(STRIDE, -(-len(text) // STRIDE) * STRIDE), b" ")


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, media binary), written to the shared folder and read again."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
                media = pa.array([encode_png(padded(x)) for x in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), media], names=[id_col, "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    made = docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, n_bytes bigint, media binary")
    return materialize(made, "media")


def features(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) from the stored bytes."""
    small_batches(stored.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                out = []
                for media in batch.column(2).to_pylist():
                    samples = decode_png(media)
                    payload = samples.tobytes()
                    out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), picture_hash(samples)))
                columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=[id_col, "n_bytes", *made])

    made = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kind = stored.schema[id_col].dataType.simpleString()
    return stored.select(id_col, "n_bytes", "media").mapInArrow(
        run, f"{id_col} {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    )
