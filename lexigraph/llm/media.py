"""Operator 1: media columns. PNG images with per-chunk checksum tests, numpy unfiltering and cosine-transform hashes."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lexigraph.llm.common import map_columns

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH, CHANNELS = 64, 3
ROW = WIDTH * CHANNELS
#: Bytes of compressed data in an IDAT chunk.
CHUNK = 1 << 15
#: Side of the grey image that is transformed, and of the low-frequency corner that makes the hash.
SIDE, LOW = 32, 8
#: The cosine basis in 12-bit fixed point: integer arithmetic gives the same bits on every machine.
BASIS = np.round(4096 * np.cos(np.pi * np.outer(np.arange(LOW), 2 * np.arange(SIDE) + 1) / (2 * SIDE))).astype(np.int64)


class BadImage(ValueError):
    """The bytes are not a PNG image that this reader takes, or a checksum does not hold."""


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(samples: np.ndarray, level: int = 1) -> bytes:
    """8-bit samples (height, width, 1 or 3) as PNG; each row takes the filter None, Sub or Up whose residuals are smallest."""
    height, width, channels = samples.shape
    rows = samples.reshape(height, width * channels)
    sub, up = rows.copy(), rows.copy()
    sub[:, channels:] -= rows[:, :-channels]
    up[1:] -= rows[:-1]
    cost = [np.minimum(x, -x).sum(axis=1, dtype=np.int64) for x in (rows, sub, up)]
    best = np.argmin(np.stack(cost), axis=0)
    out = np.empty((height, 1 + width * channels), np.uint8)
    out[:, 0] = best
    for k, x in enumerate((rows, sub, up)):
        out[best == k, 1:] = x[best == k]
    packed = zlib.compress(out.tobytes(), level)
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if channels == 3 else 0, 0, 0, 0)
    data = b"".join(_chunk(b"IDAT", packed[i : i + CHUNK]) for i in range(0, len(packed), CHUNK))
    return SIGNATURE + _chunk(b"IHDR", head) + data + _chunk(b"IEND", b"")


def _unfilter(filters: np.ndarray, rows: np.ndarray, channels: int) -> np.ndarray:
    """Undo the five PNG filters. Runs of None, Sub or Up rows are undone at once by running sums modulo 256."""
    height, width = rows.shape
    out = np.empty_like(rows)
    above = np.zeros(width, np.uint8)
    starts = np.flatnonzero(np.diff(filters.astype(np.int16), prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), height]):
        kind, block = int(filters[a]), rows[a:b]
        if kind == 0:
            out[a:b] = block
        elif kind == 1:
            out[a:b] = np.cumsum(block.reshape(b - a, -1, channels), axis=1, dtype=np.uint8).reshape(b - a, width)
        elif kind == 2:
            out[a:b] = np.cumsum(block, axis=0, dtype=np.uint8) + above
        elif kind in (3, 4):
            for y in range(a, b):
                up = above.astype(np.int64)
                line = np.zeros(width, np.int64)
                for x in range(0, width, channels):
                    left = line[x - channels : x] if x else np.zeros(channels, np.int64)
                    high = up[x : x + channels]
                    if kind == 3:
                        guess = (left + high) >> 1
                    else:
                        corner = up[x - channels : x] if x else np.zeros(channels, np.int64)
                        p = left + high - corner
                        da, db, dc = abs(p - left), abs(p - high), abs(p - corner)
                        guess = np.where((da <= db) & (da <= dc), left, np.where(db <= dc, high, corner))
                    line[x : x + channels] = (rows[y, x : x + channels] + guess) & 255
                out[y] = line.astype(np.uint8)
                above = out[y]
        else:
            raise BadImage(f"filter {kind}")
        above = out[b - 1]
    return out


def _header(body: bytes) -> tuple[int, int, int]:
    """Height, width and channels of an IHDR body."""
    if len(body) != 13:
        raise BadImage("header")
    width, height, depth, colour, *rest = struct.unpack(">IIBBBBB", body)
    if not (0 < width < 2**31 and 0 < height < 2**31) or depth != 8 or colour not in (0, 2) or any(rest):
        raise BadImage("format")
    return height, width, 3 if colour == 2 else 1


def decode_png(data: bytes) -> np.ndarray:
    """The samples of an 8-bit grey or RGB image. BadImage if it is not one.

    Tested are every chunk's length and CRC, that one header comes first and one end last, the Adler sum of the
    stream, and that the stream holds what the header says; no more than that is ever unpacked.
    """
    if data[:8] != SIGNATURE:
        raise BadImage("signature")
    at, head, ended, parts, need = 8, None, False, [], 0
    stream = zlib.decompressobj()
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise BadImage("cut off")
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if len(body) < size or data[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(kind + body)):
            raise BadImage(f"checksum of {kind!r}")
        if (kind == b"IHDR") != (head is None):
            raise BadImage("header")
        if kind == b"IHDR":
            head = _header(body)
            need = head[0] * (1 + head[1] * head[2])
        elif kind == b"IDAT":
            try:
                parts.append(stream.decompress(body, need + 1))
            except zlib.error as e:
                raise BadImage(str(e)) from e
            need -= len(parts[-1])
            if need < 0 or stream.unconsumed_tail:
                raise BadImage("size")
        ended = kind == b"IEND"
        at += 12 + size
    if not ended or at != len(data) or not stream.eof or stream.unused_data or need:
        raise BadImage("cut off")
    height, width, channels = head
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(height, -1)
    return _unfilter(raw[:, 0], raw[:, 1:], channels).reshape(height, width, channels)


def cosine_hash(samples: np.ndarray) -> bytes:
    """64 bits: grey image, area means on 32 x 32, cosine transform, signs of its low 8 x 8 corner against their median."""
    height, width, _ = samples.shape
    grey = samples.sum(axis=2, dtype=np.int64)
    for axis, n in ((0, height), (1, width)):
        cuts = np.arange(SIDE) * n // SIDE
        if n >= SIDE:
            sums = np.add.reduceat(grey, cuts, axis=axis)
            sizes = np.diff(np.append(cuts, n))
            grey = sums * 1024 // (sizes[:, None] if axis == 0 else sizes)
        else:
            grey = np.take(grey, cuts, axis=axis) * 1024
    corner = (BASIS @ (grey >> 10) @ BASIS.T).ravel()
    low = np.sort(corner[1:])
    return np.packbits(corner > low[len(low) // 2]).tobytes()


def image_columns(df: DataFrame, image_col: str = "image", keep: tuple[str, ...] = ()) -> DataFrame:
    """For a binary column of PNG images: ok (all checksums hold), width, height, samples (binary), phash (binary of 8 bytes).

    A null or damaged image gives ok = false and nulls, never an error. `keep` columns come first.
    """

    def run(*cols):
        *kept, images = cols
        out = [[] for _ in range(5)]
        for data in images:
            try:
                x = decode_png(data) if data is not None else None
            except BadImage:
                x = None
            row = (False, None, None, None, None) if x is None else (True, x.shape[1], x.shape[0], x.tobytes(), cosine_hash(x))
            for c, v in zip(out, row):
                c.append(v)
        return [*kept, *out]

    picked = df.select(*keep, image_col)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return map_columns(picked, run, (types + ", " if types else "") + "ok boolean, width int, height int, samples binary, phash binary")


def text_payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes with spaces up to a positive multiple of the image row, and their number before that."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data.ljust(max(1, -(-len(data) // ROW)) * ROW), len(data)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, image): every text as a 64-pixel-wide RGB image. Null texts are empty; repeated rows give equal images."""

    def run(ids, texts):
        payloads = [text_payload(t) for t in texts]
        return [ids, [n for _, n in payloads], [encode_png(np.frombuffer(p, np.uint8).reshape(-1, WIDTH, CHANNELS)) for p, _ in payloads]]

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_columns(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, n_bytes long, image binary")


def op1_media_columns(spark, sf_dir: str) -> DataFrame:
    """The digests of each text's image, from the bytes that were stored and read back."""
    stored = text_media(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    read = image_columns(stored, "image", keep=("doc_id", "n_bytes", "image"))
    return read.select(
        "doc_id", "n_bytes", F.octet_length("samples").cast("long").alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -16, 16)).alias("tail_crc32"), F.octet_length("image").cast("long").alias("media_bytes"),
        F.sha2("image", 256).alias("media_sha256"), F.lower(F.hex("phash")).alias("feature"), "ok",
    )
