"""Media columns: Netpbm and BMP to numpy arrays, area resizing by integral images, NPY tiles and difference hashes.

Each row is handled on its own, without a shuffle, so repeated rows each get their own, equal result. A null or empty payload
is one unit of padding; null media give nulls. Images of any size are decoded from their own bytes; a malformed image raises
ValueError. An empty table gives an empty one; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenfold.llm.common import by_piece

UNIT, WIDTH = 576, 24
_HEAD = re.compile(rb"(P[1-6])((?:\s+|#[^\n]*\n)+)")


def encode_pgm(samples: bytes, width: int = WIDTH) -> bytes:
    """Binary greymap of 8-bit samples."""
    return b"P5\n%d %d\n255\n" % (width, len(samples) // width) + samples


def encode_bmp(rgb: np.ndarray) -> bytes:
    """Uncompressed 24-bit bitmap, bottom row first."""
    h, w, _ = rgb.shape
    stride = (3 * w + 3) // 4 * 4
    rows = np.zeros((h, stride), np.uint8)
    rows[:, : 3 * w] = rgb[::-1, :, ::-1].reshape(h, 3 * w)
    return b"BM" + struct.pack("<IHHI", 54 + rows.size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, rows.size, 2835, 2835, 0, 0) + rows.tobytes()


def decode(blob: bytes) -> np.ndarray:
    """(rows, columns) or (rows, columns, 3) array of a Netpbm P1 to P6 or an uncompressed 8-, 24- or 32-bit BMP."""
    return _bmp(blob) if blob[:2] == b"BM" else _netpbm(blob)


def _netpbm(blob: bytes) -> np.ndarray:
    kind, at, fields = blob[:2], 2, []
    if not re.fullmatch(rb"P[1-6]", kind):
        raise ValueError("neither Netpbm nor BMP")
    need = 2 if kind in (b"P1", b"P4") else 3
    while len(fields) < need:
        m = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)").match(blob, at)
        if not m:
            raise ValueError("the header is cut off")
        fields.append(int(m[1]))
        at = m.end()
    w, h, most = fields[0], fields[1], fields[2] if need == 3 else 1
    colours = 3 if kind in (b"P3", b"P6") else 1
    if kind in (b"P1", b"P2", b"P3"):
        body = re.sub(rb"#[^\n]*", b"", blob[at:])
        v = np.frombuffer(re.sub(rb"\s", b"", body), np.uint8)[: w * h] - 48 if kind == b"P1" else np.array(body.split()[: w * h * colours], dtype=np.int64)
    elif kind == b"P4":
        v = np.unpackbits(np.frombuffer(blob, np.uint8, -1, at + 1).reshape(h, -1), axis=1)[:, :w].ravel()
    else:
        v = np.frombuffer(blob, ">u2" if most > 255 else np.uint8, w * h * colours, at + 1)
    if v.size != w * h * colours:
        raise ValueError("samples are missing")
    if need == 2:
        v = 1 - v  # 1 is black
    v = v.astype(np.uint16 if most > 255 else np.uint8)
    return v.reshape(h, w, 3) if colours == 3 else v.reshape(h, w)


def _bmp(blob: bytes) -> np.ndarray:
    start, size = struct.unpack_from("<II", blob, 10)
    w, h, _, bits, packed, _, _, _, used = struct.unpack_from("<iiHHIIiiI", blob, 18)
    if packed not in (0, 3) or bits not in (8, 24, 32):
        raise ValueError("only uncompressed bitmaps of 8, 24 or 32 bits")
    stride = (w * bits + 31) // 32 * 4
    rows = np.frombuffer(blob, np.uint8, stride * abs(h), start).reshape(abs(h), stride)
    rows = rows[::-1] if h > 0 else rows
    if bits == 8:
        palette = np.frombuffer(blob, np.uint8, 4 * (used or 256), 14 + size).reshape(-1, 4)
        return palette[rows[:, :w]][:, :, 2::-1]
    return rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1]


def area_resize(img: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """Mean of the exact (fractional) source area of every output pixel, by interpolating the integral image."""
    img = img.mean(axis=2) if img.ndim == 3 else img
    h, w = img.shape
    total = np.zeros((h + 1, w + 1))
    np.cumsum(np.cumsum(img, axis=0, dtype=np.float64), axis=1, out=total[1:, 1:])
    y, x = np.arange(rows + 1) * (h / rows), np.arange(cols + 1) * (w / cols)
    yi, xi = np.minimum(y.astype(int), h - 1), np.minimum(x.astype(int), w - 1)
    fy, fx = (y - yi)[:, None], (x - xi)[None, :]
    edge = total[yi] * (1 - fy) + total[yi + 1] * fy
    edge = edge[:, xi] * (1 - fx) + edge[:, xi + 1] * fx
    return np.diff(np.diff(edge, axis=0), axis=1) / (h / rows * w / cols)


def difference_hash(img: np.ndarray) -> str:
    """64 bits: whether each of 8 x 9 resized pixels is darker than its right neighbour."""
    small = np.round(area_resize(img, 8, 9), 6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def npy_tile(img: np.ndarray, side: int = 16) -> bytes:
    out = io.BytesIO()
    np.save(out, np.round(area_resize(img, side, side), 3).astype(np.float32))
    return out.getvalue()


def media_tiles(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", side: int = 16) -> DataFrame:
    """id, height, width, dhash, tile (an .npy file's bytes) of every image of a binary column; null media give nulls."""

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for blob in b.column(1).to_pylist():
            img = None if blob is None else decode(blob)
            out.append((None,) * 4 if img is None else (img.shape[0], img.shape[1], difference_hash(img), npy_tile(img, side)))
        h, w, d, t = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(h, pa.int32()), pa.array(w, pa.int32()), pa.array(d, pa.string()), pa.array(t, pa.binary())], ["id", "height", "width", "dhash", "tile"])

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, media_col).mapInArrow(by_piece(one, media_col, 16 << 20), f"id {kind}, height int, width int, dhash string, tile binary")


def write_tiles(tiles: DataFrame, path: str) -> None:
    """One row per tile in Parquet; the tile column holds complete .npy files."""
    tiles.write.mode("errorifexists").parquet(path)


def store_payload(docs: DataFrame) -> DataFrame:
    """Text bytes, padded with 255 to whole units, as a PGM; read back, hashed, resized and tiled."""

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in b.column(1).to_pylist():
            data = (text or "").encode()
            media = encode_pgm(data + b"\xff" * (UNIT - len(data) % UNIT if len(data) % UNIT or not data else 0))
            img = decode(media)
            back = img.tobytes()
            out.append((len(data), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), f"{difference_hash(img)}:{zlib.crc32(npy_tile(img)):08x}"))
        cols = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(by_piece(one), f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
