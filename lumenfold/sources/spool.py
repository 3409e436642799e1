"""Camera spools: text header up to {END}, then packed 12-bit frames, optionally zstd-compressed.

The "fli" data source yields one partition per group of frames, reads only its own byte range and decodes whole frames at
once into Arrow. A compressed spool that ends with a seek table (the public seekable zstd layout: frames of their own and a
skippable one with their sizes) is split in the same way; without one it can't be entered midway and is one partition. A
path may be a spool or a folder of spools. read_spools() gives the same rows and reads only the byte ranges of frames that
conditions on path and frame let through. Writing gives one spool per partition, compressed ones with a seek table; the field
`first` keeps the number of its first frame. A task writes under a name of its own, and only the files of tasks that were
committed get their final names.
"""

from __future__ import annotations

import ast
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

HEADER_LIMIT = 40_000
# Fixed values of the public seekable zstd layout: the skippable frame that holds the table, and what ends it.
SKIPPABLE, SEEKABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1, 9
SCHEMA = "path string, frame long, height int, width int, data array<int>"


def unpack12(f: Column, m: Column, last: Column, scale: bool = True) -> tuple[Column, Column]:
    """The two pixels of three bytes."""
    a = F.shiftleft(m.bitwiseAND(0x0F), 8).bitwiseOR(f)
    b = F.shiftleft(last, 4).bitwiseOR(F.shiftright(m.bitwiseAND(0xF0), 4))
    return (a * 16, b * 16) if scale else (a, b)


def unpack12_bytes(raw: bytes | np.ndarray, scale: bool = True) -> np.ndarray:
    t = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.uint16)
    out = np.empty((len(t), 2), np.uint16)
    out[:, 0] = (t[:, 1] & 0x0F) << 8 | t[:, 0]
    out[:, 1] = t[:, 2] << 4 | t[:, 1] >> 4
    return out.ravel() * np.uint16(16 if scale else 1)


def pack12(pixels: np.ndarray) -> bytes:
    p = pixels.astype(np.uint16).reshape(-1, 2)
    return np.stack([p[:, 0] & 0xFF, (p[:, 0] >> 8) | (p[:, 1] & 0x0F) << 4, p[:, 1] >> 4], axis=1).astype(np.uint8).tobytes()


def header_fields(text: Column) -> Column:
    """Map of lower-case keys to trimmed values of a header text; lines without = are left out."""
    lines = F.filter(F.split(F.substring_index(text, "{END}", 1), "\n"), lambda s: s.contains("="))
    pair = lambda s: F.struct(F.lower(F.trim(F.substring_index(s, "=", 1))).alias("k"), F.trim(F.regexp_replace(s, r"^[^=]*=", "")).alias("v"))
    return F.map_from_entries(F.transform(lines, pair))


def header_table(files: DataFrame) -> DataFrame:
    """One row per file of (path, text): x, y, timestamps, header_length and all fields."""
    h = files.select("path", header_fields(F.col("text")).alias("fields"), (F.instr("text", "{END}") + 4).alias("header_length"))
    return h.select("path", *(F.col("fields")[k].cast("long").alias(k) for k in ("x", "y", "timestamps")), F.col("header_length").cast("long"), "fields")


def frame_count(size: Column, header: Column, x: Column, y: Column) -> Column:
    """Whole frames of 12-bit pixels; a remainder is an error."""
    frame = (x * y / 2 * 3).cast("long")
    body = size - header
    return F.when(F.pmod(body, frame) == 0, (body / frame).cast("long")).otherwise(F.raise_error(F.lit("the spool doesn't hold whole frames")).cast("long"))


def frame_groups(headers: DataFrame, at_once: int = 1024) -> DataFrame:
    """Byte range of every group of frames: path, grp, start, stop, frames, last. headers: path, x, y, frames, header_length."""
    g = headers.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(0, (frames - 1) div {at_once})")))).where("frames > 0")
    n = F.least(F.lit(at_once).cast("long"), F.col("frames") - F.col("grp") * at_once)
    frame = F.expr("x * y div 2 * 3")
    start = F.col("header_length") + F.col("grp") * at_once * frame
    return g.select("path", "grp", start.alias("start"), (start + n * frame).alias("stop"), n.alias("frames"), (F.col("grp") == F.expr(f"(frames - 1) div {at_once}")).alias("last"))


def parse_header(raw: bytes) -> dict:
    end = raw.find(b"{END}")
    if end < 0:
        raise ValueError("no {END} in the header")
    out: dict = {"header_length": end + 5}
    for line in raw[:end].decode("latin-1").split("\n"):
        k, eq, v = line.partition("=")
        if eq:
            try:
                out[k.strip().lower()] = ast.literal_eval(v.strip())
            except (ValueError, SyntaxError):
                out[k.strip().lower()] = v.strip()
    return out


def _open(path: str):
    fs, p = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs, p


def _spools(path: str) -> list[str]:
    """The spools of a folder, or the path itself."""
    fs, p = _open(path)
    if fs.get_file_info(p).type != pafs.FileType.Directory:
        return [path]
    names = sorted(i.base_name for i in fs.get_file_info(pafs.FileSelector(p)))
    return [f"{path.rstrip('/')}/{n}" for n in names if n.endswith((".fli", ".fli.zst"))]


def seek_table(fs: pafs.FileSystem, p: str) -> list[tuple[int, int, int]] | None:
    """(offset, packed bytes, unpacked bytes) of every frame of a seekable zstd file, None where there is no table. Two reads
    at the end of the file."""
    size = fs.get_file_info(p).size
    with fs.open_input_file(p) as f:
        if size < FOOTER + 8:
            return None
        n, about, magic = struct.unpack("<IBI", f.read_at(FOOTER, size - FOOTER))
        width = 12 if about & 0x80 else 8
        start = size - FOOTER - n * width - 8
        if magic != SEEKABLE or start < 0:
            return None
        raw = f.read_at(8 + n * width, start)
    if struct.unpack_from("<II", raw) != (SKIPPABLE, n * width + FOOTER):
        return None
    out, at = [], 0
    for i in range(n):
        packed, whole = struct.unpack_from("<II", raw, 8 + i * width)
        out.append((at, packed, whole))
        at += packed
    return out if at == start else None


def encode_seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The frame that ends a seekable file of frames of these (packed, unpacked) bytes."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


class Frames(InputPartition):
    """count frames from byte start on (-1: all up to the end); with pieces, start counts from the content of the first of these
    (offset, packed bytes, unpacked bytes) frames."""

    def __init__(self, path: str, start: int, count: int, first: int, x: int, y: int, packed: bool, pieces: list[tuple[int, int, int]] | None = None):
        self.path, self.start, self.count, self.first, self.x, self.y, self.packed, self.pieces = path, start, count, first, x, y, packed, pieces


def groups_of(path: str, at_once: int) -> list[Frames]:
    """The parts that a spool can be read in: at_once frames each, or all of it where it can't be entered midway."""
    packed = path.endswith(".zst")
    if not packed and not path.endswith(".fli"):
        raise ValueError(f"not a spool: {path}")
    fs, p = _open(path)
    table = seek_table(fs, p) if packed else None
    head = parse_header(read_head(path, table))
    x, y, first, skip = int(head["x"]), int(head["y"]), int(head.get("first") or 0), head["header_length"]
    frame = x * y // 2 * 3
    if packed and not table:
        return [Frames(path, skip, -1, first, x, y, True)]
    body = (sum(t[2] for t in table) if table else fs.get_file_info(p).size) - skip
    if body % frame:
        raise ValueError(f"{path} doesn't hold whole frames")
    n = min(body // frame, int(head.get("timestamps") or body // frame))
    ends, out = np.cumsum([t[2] for t in table or []]), []
    for a in range(0, n, at_once):
        count = min(at_once, n - a)
        start, pieces = skip + a * frame, None
        if table:
            i, j = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + count * frame, "left") + 1
            pieces, start = table[i:j], start - int(ends[i] - table[i][2])
        out.append(Frames(path, start, count, first + a, x, y, packed, pieces))
    return out


def read_head(path: str, table: list[tuple[int, int, int]] | None) -> bytes:
    """The start of a spool, with its header; with a table no more pieces are unpacked than the header takes."""
    fs, p = _open(path)
    if not table:
        with fs.open_input_stream(p, compression="zstd" if path.endswith(".zst") else None) as f:
            return f.read(HEADER_LIMIT)
    out = b""
    with fs.open_input_file(p) as f:
        for place, packed, whole in table:
            out += pa.decompress(f.read_at(packed, place), whole, codec="zstd", asbytes=True) if whole else b""
            if b"{END}" in out or len(out) >= HEADER_LIMIT:
                break
    return out[:HEADER_LIMIT]


def read_bytes(path: str, start: int, size: int, pieces: list[tuple[int, int, int]] | None) -> bytes:
    """A range of a spool, or of the content of some pieces of a packed one."""
    fs, p = _open(path)
    with fs.open_input_file(p) as f:
        if not pieces:
            return f.read_at(size, start)
        out, at = [], 0
        for place, packed, whole in pieces:
            if at + whole > start and at < start + size:  # others aren't unpacked
                b = pa.decompress(f.read_at(packed, place), whole, codec="zstd", asbytes=True)
                out.append(b[max(0, start - at) : start + size - at])
            at += whole
        return b"".join(out)


class SpoolReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [s for p in options["path"].split(",") for s in _spools(p)]
        self.at_once = int(options.get("framesatonce", options.get("framesAtOnce", 64)))
        self.scale = str(options.get("scale", "true")).lower() == "true"

    def partitions(self) -> list[Frames]:
        return [g for path in self.paths for g in groups_of(path, self.at_once)]

    def read(self, part: Frames) -> Iterator[pa.RecordBatch]:
        fs, p = _open(part.path)
        frame = part.x * part.y // 2 * 3
        if part.count < 0:
            with fs.open_input_stream(p, compression="zstd") as f:
                f.read(part.start)
                at = part.first
                while raw := f.read(frame * self.at_once):
                    if len(raw) % frame:
                        raise ValueError(f"{part.path} doesn't hold whole frames")
                    yield self._batch(part, at, raw, frame)
                    at += len(raw) // frame
        else:
            yield self._batch(part, part.first, read_bytes(part.path, part.start, part.count * frame, part.pieces), frame)

    def _batch(self, part: Frames, first: int, raw: bytes, frame: int) -> pa.RecordBatch:
        n = len(raw) // frame
        pixels = unpack12_bytes(raw, self.scale).astype(np.int32)
        data = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * part.x * part.y, pa.int32()), pa.array(pixels))
        return pa.RecordBatch.from_arrays([pa.array([part.path] * n), pa.array(np.arange(first, first + n)), pa.array([part.y] * n, pa.int32()), pa.array([part.x] * n, pa.int32()), data], ["path", "frame", "height", "width", "data"])


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


class SpoolWriter(DataSourceArrowWriter):
    """One spool a partition: rows of (frame, data) with consecutive frame numbers, in order."""

    def __init__(self, options: dict):
        self.path, self.x, self.y = options["path"], int(options["width"]), int(options["height"])
        self.packed = str(options.get("packed", "false")).lower() == "true"
        self.at_once = int(options.get("framesperpiece", options.get("framesPerPiece", 64)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        fs, p = _open(self.path)
        fs.create_dir(p)
        task = TaskContext.get().partitionId()
        temporary = f"{p}/.{task}-{uuid.uuid4().hex}"
        first = last = None
        # the body goes to a file of its own first: the header holds the number of frames
        with fs.open_output_stream(f"{temporary}.body") as f:
            for b in iterator:
                at = b.column("frame").to_numpy()
                if not len(at):
                    continue
                if (np.diff(at) != 1).any() or (last is not None and at[0] != last + 1):
                    raise ValueError("the frames of a spool must be consecutive")
                first, last = at[0] if first is None else first, at[-1]
                pixels = b.column("data").flatten().to_numpy()
                if len(pixels) != len(at) * self.x * self.y:
                    raise ValueError("a frame doesn't have width x height pixels")
                f.write(pack12(pixels))
        if first is None:
            fs.delete_file(f"{temporary}.body")
            return Written("", "")
        fields = {"x": self.x, "y": self.y, "timestamps": int(last - first + 1), "first": int(first)}
        with fs.open_output_stream(temporary, compression=None) as f, fs.open_input_stream(f"{temporary}.body", compression=None) as body:
            sizes, raw = [], header_text(fields)
            while raw:  # the header, then so many frames a piece
                piece = pa.compress(raw, codec="zstd", asbytes=True) if self.packed else raw
                f.write(piece)
                sizes.append((len(piece), len(raw)))
                raw = body.read(self.x * self.y // 2 * 3 * self.at_once)
            if self.packed:
                f.write(encode_seek_table(sizes))
        fs.delete_file(f"{temporary}.body")
        return Written(temporary, f"{p}/part-{first:012d}.fli" + (".zst" if self.packed else ""))

    def commit(self, messages: list) -> None:
        fs, _ = _open(self.path)
        for m in messages:
            if m and m.temporary:
                fs.move(m.temporary, m.final)

    def abort(self, messages: list) -> None:
        fs, _ = _open(self.path)
        for m in messages:
            if m and m.temporary:
                fs.delete_file(m.temporary)


class GrowingReader(DataSourceStreamReader):
    """Frames that are appended to plain spools while a stream runs. An offset says how many whole frames of each spool have been
    handed on; half a frame at a spool's end waits for its rest. New spools of the folder are found at each trigger."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.at_once = int(options.get("framesatonce", options.get("framesAtOnce", 64)))
        self.scale = str(options.get("scale", "true")).lower() == "true"

    def initialOffset(self) -> dict:  # noqa: N802
        return {"frames": {}}

    def latestOffset(self) -> dict:  # noqa: N802
        out = {}
        for path in _spools(self.path):
            if path.endswith(".fli"):
                about = self._about(path)
                if about:
                    _, _, _, skip, frame, size = about
                    out[path.rpartition("/")[2]] = max(0, size - skip) // frame
        return {"frames": out}

    def _about(self, path: str) -> tuple[int, int, int, int, int, int] | None:
        """x, y, first frame, header length, bytes of a frame, bytes of the file; None before the header is there."""
        fs, p = _open(path)
        with fs.open_input_stream(p, compression=None) as f:
            raw = f.read(HEADER_LIMIT)
        if b"{END}" not in raw:
            return None
        head = parse_header(raw)
        x, y = int(head["x"]), int(head["y"])
        return x, y, int(head.get("first") or 0), head["header_length"], x * y // 2 * 3, fs.get_file_info(p).size

    def partitions(self, start: dict, end: dict) -> list[Frames]:
        out = []
        folder = next((s.rpartition("/")[0] for s in _spools(self.path)), "")
        for name, n in sorted(end["frames"].items()):
            path, before = f"{folder}/{name}", start["frames"].get(name, 0)
            x, y, first, skip, frame, _ = self._about(path)
            out += [Frames(path, skip + a * frame, min(self.at_once, n - a), first + a, x, y, False) for a in range(before, n, self.at_once)]
        return out

    def read(self, part: Frames) -> Iterator[pa.RecordBatch]:
        return SpoolReader.read(self, part)

    def _batch(self, part: Frames, first: int, raw: bytes, frame: int) -> pa.RecordBatch:
        return SpoolReader._batch(self, part, first, raw, frame)


class SpoolSource(DataSource):
    """spark.read.format("fli").option("framesAtOnce", 64).load(path), and frames.write.format("fli") with the options
    width, height and packed."""

    @classmethod
    def name(cls) -> str:
        return "fli"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SpoolReader:
        return SpoolReader(self.options)

    def streamReader(self, schema) -> GrowingReader:  # noqa: N802
        return GrowingReader(self.options)

    def writer(self, schema, overwrite: bool) -> SpoolWriter:
        return SpoolWriter(self.options)


def content_size(head: bytes) -> int | None:
    """Size of a zstd stream's content as its frame header states it, None where it doesn't or the bytes aren't zstd."""
    if len(head) < 6 or head[:4] != b"\x28\xb5\x2f\xfd":
        return None
    flag, single, key = head[4] >> 6, head[4] >> 5 & 1, (0, 1, 2, 4)[head[4] & 3]
    size = (single, 2, 4, 8)[flag]
    at = 5 + (0 if single else 1) + key
    if not size or len(head) < at + size:
        return None
    return int.from_bytes(head[at : at + size], "little") + (256 if size == 2 else 0)


def lengths(spools: DataFrame) -> DataFrame:
    """path, stored (bytes of the file), content (unpacked bytes; null where a packed spool doesn't state it). spools: path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path in b.column("path").to_pylist():
                fs, p = _open(path)
                size = fs.get_file_info(p).size
                if path.endswith(".zst"):
                    table = seek_table(fs, p)
                    with fs.open_input_stream(p, compression=None) as f:
                        out.append((path, size, sum(t[2] for t in table) if table else content_size(f.read(18))))
                else:
                    out.append((path, size, size))
            path, size, content = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(size, pa.int64()), pa.array(content, pa.int64())], ["path", "stored", "content"])

    return spools.select("path").mapInArrow(run, "path string, stored long, content long")


def headers(spools: DataFrame) -> DataFrame:
    """header_table() of plain and packed spools; only the start of each file is read. spools: path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for path in b.column("path").to_pylist():
                fs, p = _open(path)
                with fs.open_input_stream(p, compression="zstd" if path.endswith(".zst") else None) as f:
                    raw = f.read(HEADER_LIMIT)
                texts.append(raw[: raw.find(b"{END}") + 5].decode("latin-1"))
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(texts, pa.string())], ["path", "text"])

    return header_table(spools.select("path").mapInArrow(run, "path string, text string"))


def spools_to_store(spark: SparkSession, path: str, out: str, chunks: tuple[int, int, int] = (128, 128, 128), frames_at_once: int = 64, scale: bool = True) -> bool:
    """A spool, or a folder of the spools of one scan, as a chunked volume with its header beside it: header.json,
    header_raw.txt and README.txt. One job: groups of frames are read, cut by chunk and written by the executors. False
    where the store is there already."""
    import json

    from lumenfold.sources.files import write_files
    from lumenfold.sources.store import exists, frames_to_chunks, write_store

    if exists(out):
        return False
    spools = _spools(path)
    sizes = headers(spark.createDataFrame([(s,) for s in spools], "path string")).select("x", "y").distinct().limit(2).collect()
    if len(sizes) > 1:
        raise ValueError(f"the spools of {path} have frames of different sizes")
    fs, p = _open(spools[0])
    with fs.open_input_stream(p, compression="zstd" if spools[0].endswith(".zst") else None) as f:
        raw = f.read(HEADER_LIMIT)
    head = parse_header(raw)
    frames = read_spools(spark, path, frames_at_once=frames_at_once, scale=scale)
    n = (frames.agg(F.max("frame")).first()[0] or 0) + 1
    shape = (int(n), int(head["y"]), int(head["x"]))
    write_store(frames_to_chunks(frames, shape, chunks), out, shape, chunks)
    about = f"frames x rows x columns: {shape}; chunks: {tuple(chunks)}; from {path}\n"
    side = [("header.json", json.dumps(head, default=str, indent=1).encode()), ("header_raw.txt", raw[: head["header_length"]]), ("README.txt", about.encode())]
    write_files(spark.createDataFrame([(a, bytearray(b)) for a, b in side], "name string, payload binary"), out)
    return True


def ingest(spark: SparkSession, folder: str, out: str, chunks: tuple[int, int, int] = (128, 128, 128)) -> list[str]:
    """Every spool of a folder as a volume named after it; finished ones are skipped. Returns the names. All volumes are made by the
    same few jobs, however many there are: chunks, the header's files beside them, and last the descriptions."""
    import json

    from lumenfold.sources.files import write_files
    from lumenfold.sources.store import AXES, Store, description, exists, frames_to_chunks

    spools = _spools(folder)
    label = lambda path: path.rpartition("/")[2].removesuffix(".zst").removesuffix(".fli")
    new = [s for s in spools if not exists(f"{out}/{label(s)}")]
    if not new:
        return [label(s) for s in spools]
    frames = read_spools(spark, *new)
    named = F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"\.fli(\.zst)?$", "").alias("volume")
    sizes = frames.groupBy("path").agg((F.max("frame") + 1).alias("n"), F.max("height").alias("height"), F.max("width").alias("width"))
    sizes = spark.createDataFrame(sizes.collect(), "path string, n long, height int, width int")  # a row a spool

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, payloads = [], []
            for r, data in zip(b.select(["volume", "n", "height", "width", *AXES]).to_pylist(), b.column("data"), strict=True):
                store = Store(f"{out}/{r['volume']}", description([r["n"], r["height"], r["width"]], list(chunks)))
                place = tuple(r[a] // c for a, c in zip(AXES[:3], chunks, strict=True))
                name, payload = store.put_chunk(place, data.values.to_numpy(zero_copy_only=False).reshape([r[a] for a in AXES[3:]]))
                names.append(f"{r['volume']}/{name}")
                payloads.append(payload)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(payloads, pa.binary())], ["name", "payload"])

    def beside(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                side = []
                for r in b.to_pylist():
                    shape, path = [r["n"], r["height"], r["width"]], r["path"]
                    if last:
                        side.append((f"{r['volume']}/.zarray", json.dumps(description(shape, list(chunks)), indent=1).encode()))
                        continue
                    fs, p = _open(path)
                    with fs.open_input_stream(p, compression="zstd" if path.endswith(".zst") else None) as f:
                        raw = f.read(HEADER_LIMIT)
                    head = parse_header(raw)
                    about = f"frames x rows x columns: {tuple(shape)}; chunks: {tuple(chunks)}; from {path}\n"
                    side += [(f"{r['volume']}/{k}", v) for k, v in (("header.json", json.dumps(head, default=str, indent=1).encode()), ("header_raw.txt", raw[: head["header_length"]]), ("README.txt", about.encode()))]
                names, payloads = zip(*side, strict=True) if side else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(payloads, pa.binary())], ["name", "payload"])

        return run

    # spools of one frame size are cut alike
    for height, width in sorted({(r["height"], r["width"]) for r in sizes.collect()}):
        own = F.broadcast(sizes.where((F.col("height") == height) & (F.col("width") == width)).select("path", "n"))
        blocks = frames.join(own, "path").select(named, "n", "frame", "data")
        cut = frames_to_chunks(blocks, (0, height, width), chunks).select("volume", "n", F.lit(height).alias("height"), F.lit(width).alias("width"), *AXES, "data")
        write_files(cut.mapInArrow(files, "name string, payload binary"), out)
    about = sizes.select("path", named, "n", "height", "width")
    for last in (False, True):
        write_files(about.mapInArrow(beside(last), "name string, payload binary"), out)
    return [label(s) for s in spools]


def read_spools(spark: SparkSession, *paths: str, frames_at_once: int = 64, scale: bool = True) -> DataFrame:
    """Frames of spools and folders of spools, up to frames_at_once consecutive ones in a partition. Paths and frame numbers come
    from the headers, and data is an Arrow function of them: Spark applies conditions on these before any frame is read."""
    spark.dataSource.register(SpoolSource)
    spools = [s for p in paths for s in _spools(p)]
    piece = "struct<place:long,packed:long,whole:long>"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                g = groups_of(path, frames_at_once)
                pieces = [[{"place": a, "packed": n, "whole": w} for a, n, w in f.pieces or []] for f in g]
                numbers = [pa.array([getattr(f, k) for f in g], pa.int64()) for k in ("first", "count", "start", "x", "y")]
                kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("place", "packed", "whole")]))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(g), pa.string()), *numbers, pa.array(pieces, kind)], ["path", "first", "count", "start", "x", "y", "pieces"])

    listed = spark.createDataFrame([(s,) for s in spools], "path string")
    groups = listed.repartition(max(1, min(len(spools), 1000))).mapInArrow(parts, f"path string, first long, count long, start long, x long, y long, pieces array<{piece}>")
    # spools that can't be entered midway are streams; the headers say how many parts the others have
    n, streams = groups.agg(F.count(F.expr("if(count > 0, 1, null)")), F.collect_set(F.expr("if(count < 0, path, null)"))).first()

    @F.arrow_udf("array<int>")
    def values(path: pa.Array, k: pa.Array, start: pa.Array, x: pa.Array, y: pa.Array, pieces: pa.Array) -> pa.Array:
        at, begin = k.to_numpy(), start.to_numpy()
        names = path.to_pylist()
        out, i = [], 0
        while i < len(at):
            j = i + 1  # frames that follow each other are one read
            while j < len(at) and names[j] == names[i] and begin[j] == begin[i] and at[j] == at[j - 1] + 1:
                j += 1
            frame = x[i].as_py() * y[i].as_py() // 2 * 3
            own = [(q["place"], q["packed"], q["whole"]) for q in pieces[i].as_py()]
            raw = read_bytes(names[i], int(begin[i] + at[i] * frame), (j - i) * frame, own)
            if len(raw) != (j - i) * frame:
                raise ValueError(f"{names[i]} doesn't hold whole frames")
            out += np.split(unpack12_bytes(raw, scale).astype(np.int32), j - i)
            i = j
        ends = np.cumsum([0, *map(len, out)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*out, np.zeros(0, np.int32)])))

    d = groups.where("count > 0").repartition(max(1, n)).select("*", F.posexplode(F.expr("sequence(first, first + count - 1)")).alias("k", "frame"))
    out = d.select("path", "frame", F.col("y").cast("int").alias("height"), F.col("x").cast("int").alias("width"), values("path", "k", "start", "x", "y", "pieces").alias("data"))
    if streams:
        r = spark.read.format("fli").option("framesAtOnce", frames_at_once).option("scale", str(scale).lower())
        out = out.union(r.load(",".join(streams)))
    return out


def stream_spools(spark: SparkSession, path: str, frames_at_once: int = 64, scale: bool = True) -> DataFrame:
    """Frames of the plain spools of a folder as a stream: each whole frame once, also of spools that still grow."""
    spark.dataSource.register(SpoolSource)
    return spark.readStream.format("fli").option("framesAtOnce", frames_at_once).option("scale", str(scale).lower()).load(path)


def frames_to_voxels(frames: DataFrame) -> DataFrame:
    e = frames.select("path", F.col("frame").alias("x"), "width", F.posexplode("data").alias("p", "v"))
    return e.select("path", "x", F.expr("cast(p div width as int)").alias("z"), F.expr("cast(p % width as int)").alias("y"), "v")


def write_spools(frames: DataFrame, path: str, height: int, width: int, packed: bool = False, at_once: int = 1024, per_piece: int = 64) -> None:
    """(frame, data) rows as spools of up to at_once consecutive frames, each written by an executor; packed ones in pieces of
    per_piece frames."""
    frames.sparkSession.dataSource.register(SpoolSource)
    n, low = frames.agg(F.max("frame") - F.min("frame") + 1, F.min("frame")).first()
    if not n:
        return
    parts = -(-n // at_once)
    d = frames.select(F.col("frame").cast("long").alias("frame"), F.col("data").cast("array<int>").alias("data"))
    # equal ranges of frame numbers, one a partition
    group = F.expr(f"(frame - {low}) div {at_once}")
    d = d.repartitionByRange(parts, group).sortWithinPartitions("frame") if parts > 1 else d.coalesce(1).sortWithinPartitions("frame")
    d.write.format("fli").option("width", width).option("height", height).option("packed", str(packed).lower()).option("framesPerPiece", per_piece).mode("append").save(path)


def header_text(fields: dict) -> bytes:
    return "".join(f"{k} = {v!r}\n" for k, v in fields.items()).encode() + b"{END}"


def write_spool(path: str, frames: np.ndarray, fields: dict | None = None) -> None:
    """A spool of 12-bit frames (n, y, x), for tests and simulations; .zst is compressed."""
    n, y, x = frames.shape
    raw = header_text({"x": x, "y": y, "timestamps": n, **(fields or {})}) + pack12(frames.ravel())
    with pa.OSFile(path, "wb") as f:
        f.write(pa.compress(raw, codec="zstd", asbytes=True) if path.endswith(".zst") else raw)
