"""Planes and arrays kept as whole files: TIFF (baseline, one or many pages), NPY, and numeric matrices of MAT level 5.

Files are read as binary rows, one kernel call a file, so a plane can be chosen before any pixel is decoded; a page of a
larger stack is decoded alone. Writing goes through the whole-file sink.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.sources.files import write_files

PLANES = "path string, page int, height int, width int, data array<double>"
# Fixed values of the public file formats: sizes of TIFF field types, and element types of MAT level 5.
TIFF_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 16: 8}
TIFF_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
MAT_TYPES = {1: "i1", 2: "u1", 3: "i2", 4: "u2", 5: "i4", 6: "u4", 7: "f4", 9: "f8", 12: "i8", 13: "u8"}
MAT_CELL, MAT_STRUCT, MAT_CHAR, MAT_MATRIX, MAT_PACKED = 1, 2, 4, 14, 15


def tiff_pages(blob: bytes) -> list[dict[int, tuple]]:
    """The fields of every page, by tag."""
    order = {b"II": "<", b"MM": ">"}.get(blob[:2])
    if order is None or struct.unpack_from(order + "H", blob, 2)[0] != 42:
        raise ValueError("not a baseline TIFF")
    at, pages = struct.unpack_from(order + "I", blob, 4)[0], []
    while at:
        n = struct.unpack_from(order + "H", blob, at)[0]
        fields: dict[int, tuple] = {0: (order,)}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", blob, at + 2 + 12 * i)
            size = TIFF_SIZES.get(kind, 1) * count
            place = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", blob, at + 10 + 12 * i)[0]
            if kind in TIFF_CODES:
                fields[tag] = struct.unpack_from(f"{order}{count}{TIFF_CODES[kind]}", blob, place)
        pages.append(fields)
        at = struct.unpack_from(order + "I", blob, at + 2 + 12 * n)[0]
    return pages


def tiff_page(blob: bytes, fields: dict[int, tuple]) -> np.ndarray:
    """One page's samples (height, width); strips that are raw or deflated."""
    one = lambda tag, other: fields.get(tag, (other,))[0]
    w, h, bits, packed, form = one(256, 0), one(257, 0), one(258, 1), one(259, 1), one(339, 1)
    if packed not in (1, 8, 32946) or one(277, 1) != 1 or bits not in (8, 16, 32, 64) or one(317, 1) != 1:
        raise ValueError("only grey TIFFs, raw or deflated, of 8 to 64 bits")
    raw = b"".join(blob[a : a + n] if packed == 1 else zlib.decompress(blob[a : a + n]) for a, n in zip(fields[273], fields[279], strict=True))
    kind = np.dtype(fields[0][0] + {1: "u", 2: "i", 3: "f"}[form] + str(bits // 8))
    return np.frombuffer(raw, kind, w * h).reshape(h, w)


def encode_tiff(pages: np.ndarray, deflate: bool = False) -> bytes:
    """A little-endian TIFF of grey pages (n, height, width); one strip a page."""
    pages = pages[None] if pages.ndim == 2 else pages
    n, h, w = pages.shape
    form = {"u": 1, "i": 2, "f": 3}[pages.dtype.kind]
    out = bytearray(struct.pack("<2sHI", b"II", 42, 8))
    for i, page in enumerate(pages.astype(pages.dtype.newbyteorder("<"))):
        strip = zlib.compress(page.tobytes(), 1) if deflate else page.tobytes()
        fields = [(256, 4, w), (257, 4, h), (258, 3, pages.dtype.itemsize * 8), (259, 3, 8 if deflate else 1), (262, 3, 1), (273, 4, 0), (277, 3, 1), (278, 4, h), (279, 4, len(strip)), (339, 3, form)]
        start = len(out)
        body = start + 2 + 12 * len(fields) + 4
        after = body + len(strip) + len(strip) % 2
        out += struct.pack("<H", len(fields))
        for tag, kind, v in fields:
            out += struct.pack("<HHI", tag, kind, 1) + (struct.pack("<HH", v, 0) if kind == 3 else struct.pack("<I", body if tag == 273 else v))
        out += struct.pack("<I", after if i + 1 < n else 0) + strip + b"\0" * (len(strip) % 2)
    return bytes(out)


def encode_npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a, allow_pickle=False)
    return out.getvalue()


def decode_npy(blob: bytes) -> np.ndarray:
    """Arrays only: files with pickled objects raise ValueError, as loading them could run any code."""
    return np.load(io.BytesIO(blob), allow_pickle=False)


def decode_mat(blob: bytes) -> dict[str, object]:
    """Variables of a MAT file of level 5: arrays, lists for cells, dicts (or lists of them) for structures."""
    if blob[126:128] not in (b"IM", b"MI"):
        raise ValueError("not a MAT file of level 5")
    o = "<" if blob[126:128] == b"IM" else ">"

    def element(b: bytes, at: int) -> tuple[int, bytes, int]:
        kind, size = struct.unpack_from(o + "II", b, at)
        if kind >> 16:  # a small element: size and type share a word
            return kind & 0xFFFF, b[at + 4 : at + 4 + (kind >> 16)], at + 8
        end = at + 8 + size
        return kind, b[at + 8 : end], end if kind == MAT_PACKED else end + -size % 8

    def numbers(kind: int, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, o + MAT_TYPES[kind])

    def matrix(b: bytes) -> tuple[str, object]:
        _, flags, at = element(b, 0)
        form = struct.unpack_from(o + "I", flags)[0] & 0xFF
        kind, raw, at = element(b, at)
        shape = numbers(kind, raw).tolist()
        _, name, at = element(b, at)
        count = int(np.prod(shape))
        if form == MAT_CELL or form == MAT_STRUCT:
            fields = [None]
            if form == MAT_STRUCT:
                kind, raw, at = element(b, at)
                width = int(numbers(kind, raw)[0])
                _, raw, at = element(b, at)
                fields = [raw[i : i + width].split(b"\0")[0].decode() for i in range(0, len(raw), width)]
            items = []
            for _ in range(count):
                row = {}
                for f in fields:
                    _, raw, at = element(b, at)
                    row[f] = matrix(raw)[1] if raw else np.zeros((0, 0))
                items.append(row[None] if form == MAT_CELL else row)
            return name.decode(), items[0] if form == MAT_STRUCT and count == 1 else items
        kind, raw, at = element(b, at)
        v = numbers(kind, raw) if kind in MAT_TYPES else np.frombuffer(raw, np.uint8)
        if form == MAT_CHAR:
            return name.decode(), "".join(map(chr, v.tolist()))
        return name.decode(), v.reshape(shape, order="F")

    out, at = {}, 128
    while at + 8 <= len(blob):
        kind, raw, at = element(blob, at)
        if kind == MAT_PACKED:
            kind, raw, _ = element(zlib.decompress(raw), 0)
        if kind == MAT_MATRIX:
            name, v = matrix(raw)
            out[name] = v
    return out


def encode_mat(variables: dict[str, np.ndarray | list[np.ndarray]]) -> bytes:
    """A MAT file of level 5 with arrays of doubles, and cells of such arrays for lists."""

    def element(kind: int, raw: bytes) -> bytes:
        return struct.pack("<II", kind, len(raw)) + raw + bytes(-len(raw) % 8)

    def matrix(name: str, v: np.ndarray | list[np.ndarray]) -> bytes:
        cells = isinstance(v, list)
        shape = (1, len(v)) if cells else v.shape if v.ndim > 1 else (1, v.size)
        head = element(6, struct.pack("<II", MAT_CELL if cells else 6, 0)) + element(5, np.array(shape, "<i4").tobytes()) + element(1, name.encode())
        body = b"".join(matrix("", x) for x in v) if cells else element(9, np.asarray(v, "<f8").tobytes(order="F"))
        return element(MAT_MATRIX, head + body)

    text = b"MATLAB 5.0 MAT-file".ljust(124) + struct.pack("<H", 0x0100) + b"IM"
    return text + b"".join(matrix(n, v) for n, v in variables.items())


def affine_list(value: object) -> list[np.ndarray]:
    """3 x 3 matrices out of whatever holds them: cells, structures, one array of 3 x 3 or 3 x 3 x n; others are left out."""
    if isinstance(value, dict):
        return [m for v in value.values() for m in affine_list(v)]
    if isinstance(value, list):
        return [m for v in value for m in affine_list(v)]
    if isinstance(value, np.ndarray) and value.dtype != object and value.shape[:2] == (3, 3):
        return [value.astype(float)] if value.ndim == 2 else [value[:, :, i].astype(float) for i in range(value.shape[2])] if value.ndim == 3 else []
    return []


def files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """path, name, length of all files below a folder whose names fit a glob pattern; contents aren't read."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return r.load(path).select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length")


def read_tiffs(spark: SparkSession, path: str, pattern: str = "*.tif*", pages: list[int] | None = None, where: Column | None = None) -> DataFrame:
    """Pages of TIFF files. where: a condition on path, which is tested before a file's content is read."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    d = d.where(where) if where is not None else d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, blob in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                for i, fields in enumerate(tiff_pages(blob)):
                    if pages is not None and i not in pages:
                        continue
                    a = tiff_page(blob, fields)
                    data = pa.ListArray.from_arrays(pa.array([0, a.size], pa.int32()), pa.array(a.ravel().astype(float)))
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([i], pa.int32()), pa.array([a.shape[0]], pa.int32()), pa.array([a.shape[1]], pa.int32()), data], ["path", "page", "height", "width", "data"])

    return d.select("path", "content").mapInArrow(run, PLANES)


def planes_to_pixels(planes: DataFrame, top: int = 0, bottom: int = 0, left: int = 0, right: int = 0) -> DataFrame:
    """path, page, z (row), y (column), v, after so many rows and columns are cut off (0: none)."""
    e = planes.select("path", "page", "height", "width", F.posexplode("data").alias("p", "v"))
    e = e.select("path", "page", "height", "width", F.expr("cast(p div width as int)").alias("z"), F.expr("cast(p % width as int)").alias("y"), "v")
    e = e.where((F.col("z") >= top) & (F.col("z") < F.col("height") - bottom) & (F.col("y") >= left) & (F.col("y") < F.col("width") - right))
    return e.select("path", "page", (F.col("z") - top).alias("z"), (F.col("y") - left).alias("y"), "v")


def write_images(vox: DataFrame, path: str, name: Column, height: int, width: int, form: str = "tif", dtype: str = "<u2") -> None:
    """Pixels (z, y, v) as one file per name: tif (clipped and rounded half to even for integers) or npy."""
    kind = np.dtype(dtype)

    def one(g: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros((height, width))
        a[g.z, g.y] = g.v
        if kind.kind in "ui":
            a = np.clip(np.rint(a), np.iinfo(kind).min, np.iinfo(kind).max)
        a = a.astype(kind)
        return pd.DataFrame({"name": [f"{g.name.iloc[0]}.{form}"], "payload": [encode_tiff(a) if form == "tif" else encode_npy(a)]})

    d = vox.select(name.alias("name"), "z", "y", F.col("v").cast("double").alias("v"))
    write_files(d.groupBy("name").applyInPandas(one, "name string, payload binary"), path)


def read_npys(spark: SparkSession, path: str, pattern: str = "*.npy") -> DataFrame:
    """path, shape, data (C order) of NPY files."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, blob in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                a = decode_npy(blob)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([list(a.shape)], pa.list_(pa.int32())), pa.array([np.ravel(a).astype(float)], pa.list_(pa.float64()))], ["path", "shape", "data"])

    return d.select("path", "content").mapInArrow(run, "path string, shape array<int>, data array<double>")


def read_matrices(spark: SparkSession, path: str, pattern: str = "*.mat") -> DataFrame:
    """path, name, m, i, j, v of the numeric matrices in MAT files (m: number of a 3 x 3 one in a list, else 0)."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, blob in zip(b.path, b.content, strict=True):
                for key, value in decode_mat(blob).items():
                    plain = isinstance(value, np.ndarray) and value.ndim == 2 and value.shape != (3, 3)
                    for m, a in enumerate([value.astype(float)] if plain else affine_list(value)):
                        i, j = (x.ravel() for x in np.indices(a.shape))
                        yield pd.DataFrame({"path": name, "name": key, "m": m, "i": i, "j": j, "v": a.ravel()})

    return d.select("path", "content").mapInPandas(run, "path string, name string, m int, i int, j int, v double")
