"""TIFF volumes by parts: pages, and the strips or tiles within them, as rows that are read only when they are asked for.

read_tiff_volume() walks the directories of every file by range reads (classic and 64-bit files, both byte orders) and gives
one row per strip or tile; its pixels are an Arrow function of the row, so conditions on path, page or place choose segments
before any is read, and files of any length are read by many tasks. write_tiff_volumes() writes 64-bit files, page after page
as they arrive in order, so a task never holds more than two pages.

Segments are raw, deflated, zstd, LZW or PackBits, with or without horizontal differences; samples are single grey values of
8 to 64 bits. Anything else raises ValueError.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from lumenfold.plans.shared import materialize
from lumenfold.sources.files import open_folder
from lumenfold.sources.store import PACK

# Fixed values of the public format: sizes and codes of field types, tags, and names of the ways to pack a segment.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
CODES = {1: "B", 3: "H", 4: "I", 13: "I", 16: "Q", 18: "Q"}
WIDTH, HEIGHT, BITS, PACKING, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORM = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317, 322, 323, 324, 325, 339
WANTED = {WIDTH, HEIGHT, BITS, PACKING, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORM}
PACKINGS = {1: "none", 5: "lzw", 8: "deflate", 32946: "deflate", 32773: "packbits", 50000: "zstd"}
CLEAR, END, FIRST = 256, 257, 258
#: Unpacked bytes of the segments that one task reads.
GROUP = 32 << 20
#: Bytes read at once where a directory is expected.
PEEK = 4096

SEGMENTS = "path string, page int, height int, width int, z0 int, y0 int, nz int, ny int, data array<double>"


@dataclass
class Page:
    height: int
    width: int
    kind: str
    packing: str
    predictor: int
    rows: int
    columns: int
    places: tuple[int, ...]
    bytes: tuple[int, ...]

    def segments(self) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(z0, y0, nz, ny, place, bytes) of every strip or tile, cut at the page's far edges."""
        across = -(-self.width // self.columns)
        for i, (place, n) in enumerate(zip(self.places, self.bytes, strict=True)):
            z, y = i // across * self.rows, i % across * self.columns
            yield z, y, min(self.rows, self.height - z), min(self.columns, self.width - y), place, n


def pages(f) -> Iterator[Page]:
    """The directories of a file that can be entered anywhere (seek, read), one after the other."""

    def get(at: int, n: int) -> bytes:
        f.seek(at)
        raw = f.read(n)
        if len(raw) < n:
            raise ValueError("the TIFF is cut off")
        return raw

    start = get(0, 8)
    o = {b"II": "<", b"MM": ">"}.get(start[:2])
    version = struct.unpack_from(o + "H", start, 2)[0] if o else 0
    if version == 42:
        big, at = False, struct.unpack_from(o + "I", start, 4)[0]
    elif version == 43 and struct.unpack_from(o + "HH", start, 4) == (8, 0):
        big, at = True, struct.unpack(o + "Q", get(8, 8))[0]
    else:
        raise ValueError("not a TIFF")
    head, entry, inner, count_of, place_of = (8, 20, 8, "Q", "Q") if big else (2, 12, 4, "H", "I")
    seen = set()
    while at:
        if at in seen:
            raise ValueError("the directories of the TIFF run in a circle")
        seen.add(at)
        f.seek(at)
        peek = f.read(PEEK)
        n = struct.unpack_from(o + count_of, peek)[0]
        size = head + n * entry + inner
        if len(peek) < size:
            peek += get(at + len(peek), size - len(peek))
        t: dict[int, tuple] = {}
        for i in range(n):
            a = head + i * entry
            tag, kind = struct.unpack_from(o + "HH", peek, a)
            if tag not in WANTED or kind not in CODES:
                continue
            values = struct.unpack_from(o + ("Q" if big else "I"), peek, a + 4)[0]
            length, a = SIZES[kind] * values, a + (12 if big else 8)
            if length <= inner:
                raw = peek[a : a + length]
            else:
                place = struct.unpack_from(o + place_of, peek, a)[0]
                raw = peek[place - at : place - at + length] if at <= place and place + length <= at + len(peek) else get(place, length)
            t[tag] = struct.unpack(f"{o}{values}{CODES[kind]}", raw)
        yield page_of(t, o)
        at = struct.unpack_from(o + place_of, peek, head + n * entry)[0]


def page_of(t: dict[int, tuple], order: str) -> Page:
    one = lambda tag, other: t.get(tag, (other,))[0]
    width, height, bits, form = one(WIDTH, 0), one(HEIGHT, 0), one(BITS, 1), one(FORM, 1)
    packing, predictor = PACKINGS.get(one(PACKING, 1)), one(PREDICTOR, 1)
    if packing is None or one(SAMPLES, 1) != 1 or bits not in (8, 16, 32, 64) or form not in (1, 2, 3) or predictor not in (1, 2) or (predictor == 2 and form == 3):
        raise ValueError("only grey TIFFs of 8 to 64 bits, raw or packed by deflate, zstd, LZW or PackBits")
    kind = order + {1: "u", 2: "i", 3: "f"}[form] + str(bits // 8)
    if TILES in t:
        return Page(height, width, kind, packing, predictor, one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0), t[TILES], t[TILE_BYTES])
    return Page(height, width, kind, packing, predictor, min(one(ROWS, height), height) or 1, width or 1, t.get(STRIPS, ()), t.get(STRIP_BYTES, ()))


def unpack_lzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, first bit first; the code length grows one code early, as the format has it."""
    out, table = [], [bytes([i]) for i in range(256)] + [b"", b""]
    value = bits = at = 0
    width, last = 9, None
    while True:
        while bits < width:
            if at == len(raw):
                return b"".join(out)  # some writers leave the last code out
            value, bits, at = value << 8 | raw[at], bits + 8, at + 1
        bits -= width
        code, value = value >> bits, value & ((1 << bits) - 1)
        if code == END:
            return b"".join(out)
        if code == CLEAR:
            del table[FIRST:]
            width, last = 9, None
            continue
        if last is None:
            text = table[code]
        else:
            if code > len(table):
                raise ValueError("a damaged LZW segment")
            text = table[code] if code < len(table) else last + last[:1]
            table.append(last + text[:1])
        out.append(text)
        last = text
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12


def unpack_bits(raw: bytes) -> bytes:
    """Runs: a length below 128 is followed by one byte more than that, one above by a byte that is repeated."""
    out, at = [], 0
    while at < len(raw):
        n = raw[at]
        if n < 128:
            out.append(raw[at + 1 : at + 2 + n])
            at += 2 + n
        else:
            out.append(raw[at + 1 : at + 2] * (257 - n) if n > 128 else b"")
            at += 2 if n > 128 else 1
    return b"".join(out)


def unpack_segment(raw: bytes, packing: str, kind: str, predictor: int, rows: int, columns: int) -> np.ndarray:
    """Samples of a segment: whole rows of `columns`, as many of them (rows at most) as there are bytes."""
    if packing == "zstd":
        with pa.input_stream(pa.BufferReader(raw), compression="zstd") as f:
            raw = f.read()
    elif packing != "none":
        raw = zlib.decompress(raw) if packing == "deflate" else unpack_lzw(raw) if packing == "lzw" else unpack_bits(raw)
    k = np.dtype(kind)
    n = min(rows, len(raw) // (columns * k.itemsize))
    a = np.frombuffer(raw, k, n * columns).reshape(n, columns)
    return np.cumsum(a, axis=1, dtype=k.newbyteorder("=")) if predictor == 2 else a


def read_tiff_volume(spark: SparkSession, path: str, pattern: str = "*.tif*", group: int = GROUP) -> DataFrame:
    """One row per strip or tile of every page: path, page, height and width of the page, z0, y0, nz, ny and data (row by row) of
    the segment. Segments of about `group` unpacked bytes stay together; a task reads one such group, or several small ones."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path")
    names = ["page", "height", "width", "z0", "y0", "nz", "ny", "place", "size", "rows", "columns", "predictor"]
    segment = pa.struct([*((n, pa.int64()) for n in names), ("kind", pa.string()), ("packing", pa.string())])
    fields = ", ".join(f"{n}: bigint" for n in names) + ", kind: string, packing: string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column("path").to_pylist():
                fs, p = open_folder(name)
                rows, full = [], 0
                with fs.open_input_file(p) as f:
                    for i, g in enumerate(pages(f)):
                        for z, y, nz, ny, place, size in g.segments():
                            rows.append(dict(zip(names, (i, g.height, g.width, z, y, nz, ny, place, size, g.rows, g.columns, g.predictor), strict=True), kind=g.kind, packing=g.packing))
                            full += g.rows * g.columns * np.dtype(g.kind).itemsize
                            if full >= group:
                                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows], pa.list_(segment))], ["path", "s"])
                                rows, full = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows], pa.list_(segment))], ["path", "s"])

    groups = materialize(files.mapInArrow(walk, f"path string, s array<struct<{fields}>>"), "segments")
    n = groups.count()
    tasks = min(n, max(4 * spark.sparkContext.defaultParallelism, -(-n * group // GROUP)))

    @F.arrow_udf("array<double>")
    def values(path: pa.Array, s: pa.Array) -> pa.Array:
        out, opened, f = [], None, None
        for name, r in zip(path.to_pylist(), s.to_pylist(), strict=True):
            if name != opened:
                fs, p = open_folder(name)
                opened, f = name, fs.open_input_file(p)
            raw = f.read_at(r["size"], r["place"])
            a = unpack_segment(raw, r["packing"], r["kind"], r["predictor"], r["rows"], r["columns"])[: r["nz"], : r["ny"]]
            if a.shape != (r["nz"], r["ny"]):
                raise ValueError(f"a segment of {name} is too short")
            out.append(a.astype(float).ravel())
        ends = np.cumsum([0, *map(len, out)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*out, np.zeros(0)])))

    d = groups.repartition(max(1, tasks)).select("path", F.explode("s").alias("s"))
    own = [F.col(f"s.{c}").cast("int").alias(c) for c in ("page", "height", "width", "z0", "y0", "nz", "ny")]
    return d.select("path", *own, values("path", "s").alias("data"))


def segments_to_pixels(segments: DataFrame) -> DataFrame:
    """path, page, z (row), y (column), v."""
    e = segments.select("path", "page", "z0", "y0", "ny", F.posexplode("data").alias("p", "v"))
    return e.select("path", "page", F.expr("cast(z0 + p div ny as int)").alias("z"), F.expr("cast(y0 + p % ny as int)").alias("y"), "v")


def page_segments(a: np.ndarray, rows: int, columns: int | None, packing: str, predictor: bool) -> Iterator[bytes]:
    """Packed strips of so many rows, or tiles if there are columns, of a little-endian page; tiles are filled up with zeros."""
    h, w = a.shape
    for z in range(0, h, rows):
        for y in range(0, w, columns or w):
            part = a[z : z + rows, y : y + (columns or w)]
            if columns:
                part = np.pad(part, ((0, rows - part.shape[0]), (0, columns - part.shape[1])))
            if predictor:
                part = np.concatenate([part[:, :1], np.diff(part, axis=1)], axis=1)  # differences wrap as the samples do
            raw = part.astype(a.dtype.newbyteorder("<")).tobytes()
            yield zlib.compress(raw, 1) if packing == "deflate" else pa.compress(raw, codec="zstd", asbytes=True) if packing == "zstd" else raw


def encode_page(a: np.ndarray, at: int, last: bool, rows: int, columns: int | None, packing: str, predictor: bool) -> bytes:
    """A page's directory, its lists of places and its segments, to stand at byte `at` of a 64-bit file; the next page
    follows them."""
    h, w = a.shape
    body = list(page_segments(a, rows, columns, packing, predictor))
    n = len(body)
    number = {"none": 1, "deflate": 8, "zstd": 50000}[packing]
    fields = [(WIDTH, 4, w), (HEIGHT, 4, h), (BITS, 3, a.dtype.itemsize * 8), (PACKING, 3, number), (PHOTOMETRIC, 3, 1), (SAMPLES, 3, 1), (PREDICTOR, 3, 1 + predictor), (FORM, 3, {"u": 1, "i": 2, "f": 3}[a.dtype.kind])]
    fields += [(TILE_WIDTH, 4, columns), (TILE_HEIGHT, 4, rows), (TILES, 16, None), (TILE_BYTES, 16, None)] if columns else [(ROWS, 4, rows), (STRIPS, 16, None), (STRIP_BYTES, 16, None)]
    lists = at + 8 + 20 * len(fields) + 8
    data = lists + (16 * n if n > 1 else 0)
    places = np.cumsum([data, *map(len, body)])
    end = int(places[-1]) + -int(places[-1]) % 8
    out = io.BytesIO()
    out.write(struct.pack("<Q", len(fields)))
    for tag, kind, v in sorted(fields):
        many = tag in (TILES, TILE_BYTES, STRIPS, STRIP_BYTES)
        if many:
            first = tag in (TILES, STRIPS)
            v = (int(places[0]) if first else len(body[0]) if n else 0) if n <= 1 else lists + (0 if first else 8 * n)
        out.write(struct.pack("<HHQQ", tag, kind, n if many else 1, v))
    out.write(struct.pack("<Q", 0 if last else end))
    if n > 1:
        out.write(places[:-1].astype("<u8").tobytes() + np.array([len(b) for b in body], "<u8").tobytes())
    out.writelines(body)
    out.write(bytes(end - int(places[-1])))
    return out.getvalue()


@dataclass
class Volumes(WriterCommitMessage):
    moves: list[tuple[str, str]]


class VolumeWriter(DataSourceArrowWriter):
    """Rows (name, page, height, width, data): each file's pages one after the other, in order and without gaps."""

    def __init__(self, options: dict):
        self.path, self.kind = options["path"], np.dtype(options.get("dtype", "<u2"))
        self.packing, self.predictor = options.get("packing", "deflate"), options.get("predictor", "true") == "true" and self.kind.kind in "ui"
        self.rows, self.columns = int(options.get("rows", 64)), int(options["columns"]) if options.get("columns") else None
        if self.columns and (self.rows % 16 or self.columns % 16):
            raise ValueError("tiles have sides that are multiples of 16")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = open_folder(self.path)
        moves, f, held, at, expected = [], None, None, 0, 0

        def put(last: bool) -> None:
            nonlocal held, at
            raw = encode_page(held, at, last, min(self.rows, max(1, held.shape[0])) if not self.columns else self.rows, self.columns, self.packing, self.predictor)
            f.write(raw)
            at += len(raw)
            held = None

        name = None
        for b in iterator:
            for i in range(b.num_rows):
                own, page, h, w = (b.column(c)[i].as_py() for c in ("name", "page", "height", "width"))
                if own != name:
                    if f:
                        put(True)
                        f.close()
                    folder, _, short = f"{root}/{own}".rpartition("/")
                    fs.create_dir(folder)
                    moves.append((f"{folder}/.{short}-{uuid.uuid4().hex}", f"{folder}/{short}"))
                    f, name, at, expected = fs.open_output_stream(moves[-1][0], compression=None), own, 16, 0
                    f.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16))
                if page != expected:
                    raise ValueError(f"page {page} of {own} comes where {expected} is due")
                if held is not None:
                    put(False)
                v = b.column("data")[i].values.to_numpy(zero_copy_only=False).reshape(h, w)
                held = (np.clip(np.rint(v), np.iinfo(self.kind).min, np.iinfo(self.kind).max) if self.kind.kind in "ui" else v).astype(self.kind)
                expected += 1
        if f:
            put(True)
            f.close()
        for a, z in moves:
            fs.move(a, z)
        return Volumes(moves)

    def commit(self, messages: list) -> None:
        pass

    def abort(self, messages: list) -> None:
        pass


class TiffVolumes(DataSource):
    """planes.write.format("tiff_volumes") with the options dtype, packing (none, deflate, zstd), predictor, rows and columns."""

    @classmethod
    def name(cls) -> str:
        return "tiff_volumes"

    def schema(self) -> str:
        return "name string, page int, height int, width int, data array<double>"

    def writer(self, schema, overwrite: bool) -> VolumeWriter:
        return VolumeWriter(self.options)


def write_tiff_volumes(planes: DataFrame, path: str, dtype: str = "<u2", packing: str = "deflate", predictor: bool = True, rows: int = 64, columns: int | None = None) -> None:
    """(name, page, height, width, data) as one 64-bit TIFF per name, pages from 0 on without gaps: strips of so many rows, or
    tiles if columns are given. Integers are clipped and rounded half to even. A file is written by one task, and several are
    written at once: a volume of many pages should be several files. Files are moved to their names when they are whole."""
    planes.sparkSession.dataSource.register(TiffVolumes)
    d = planes.select("name", F.col("page").cast("int").alias("page"), F.col("height").cast("int").alias("height"), F.col("width").cast("int").alias("width"), F.col("data").cast("array<double>").alias("data"))
    # as many tasks as there are shuffle partitions: small pages are too few bytes for Spark to tell the work by
    w = d.repartition(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name").sortWithinPartitions("name", "page").write.format("tiff_volumes").mode("append")
    w = w.option("columns", columns) if columns else w
    w.option("dtype", dtype).option("packing", packing).option("predictor", str(predictor).lower()).option("rows", rows).save(path)


def blocks_to_planes(blocks: DataFrame, height: int, width: int) -> DataFrame:
    """x, height, width, data of every plane of blocks (x0, z0, y0, nx, nz, ny, data): blocks are cut into slices that travel as
    arrays, and the slices of a plane meet in one group, together with those of its neighbours where planes are small. Missing parts are 0."""
    many = max(1, PACK // (height * width))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x0, z0, y0, nx, nz, ny = (b.column(c)[i].as_py() for c in ("x0", "z0", "y0", "nx", "nz", "ny"))
                data = b.column("data")[i].values
                full = lambda v: pa.array(np.full(nx, v, np.int64))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(x0, x0 + nx)), full(z0), full(y0), full(ny), pa.ListArray.from_arrays(pa.array(np.arange(nx + 1) * nz * ny, pa.int32()), data)], ["x", "z0", "y0", "ny", "data"])

    def one(g: pa.Table) -> pa.Table:
        xs, at = np.unique(g.column("x").to_numpy(), return_inverse=True)
        lists = pa.concat_arrays(g.column("data").chunks)
        kinds = np.stack([*(g.column(c).to_numpy() for c in ("z0", "y0", "ny")), lists.value_lengths().to_numpy()], axis=1)
        a = np.zeros((len(xs), height, width))
        found, which = np.unique(kinds, axis=0, return_inverse=True)
        for k, (z0, y0, ny, n) in enumerate(found.tolist()):
            rows = np.flatnonzero(which.ravel() == k)
            part = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), n // max(1, ny), ny)
            a[at[rows], z0 : z0 + part.shape[1], y0 : y0 + ny] = part
        full = lambda v: pa.array(np.full(len(xs), v, np.int32))
        planes = pa.ListArray.from_arrays(pa.array(np.arange(len(xs) + 1) * height * width, pa.int32()), pa.array(a.ravel()))
        return pa.table([pa.array(xs), full(height), full(width), planes], ["x", "height", "width", "data"])

    slices = blocks.mapInArrow(cut, "x long, z0 long, y0 long, ny long, data array<double>")
    return slices.groupBy(F.expr(f"x div {many}").alias("g")).applyInArrow(one, "x long, height int, width int, data array<double>")


def volume_files(planes: DataFrame, name: Column, pages_per_file: int) -> DataFrame:
    """Planes (x, height, width, data) numbered for write_tiff_volumes: so many consecutive ones a file; name sees `file`."""
    d = planes.withColumn("file", F.expr(f"x div {pages_per_file}")).withColumn("page", F.expr(f"cast(x % {pages_per_file} as int)"))
    return d.select(name.alias("name"), "page", "height", "width", "data")
