"""Chunked array stores: a folder with `.zarray` and one file per chunk (version 2 of the public layout), nested by level.

"volume_store" reads an array of three axes as blocks (x0, z0, y0, nx, nz, ny, data), or of four axes (channels first) as such
blocks with their channel c in front, one partition per group of chunks, without the chunks outside an optional region.
read_store() gives the same rows and opens only the chunks that conditions on them let through. Writing takes the rows: every
task writes its own chunk files, each of them whole or not at all, and the description is written last, so a store without
it is unfinished. Chunks are raw, zstd, zlib, gzip or Blosc; their names are joined by dots or nested by slashes; a missing
chunk file means the fill value.
"""

from __future__ import annotations

import gzip
import itertools
import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, WriterCommitMessage

from lumenfold.sources import blosc
from lumenfold.sources.files import FilesWriter, open_folder

AXES = ["x0", "z0", "y0", "nx", "nz", "ny"]
SCHEMA = "x0 long, z0 long, y0 long, nx int, nz int, ny int, data array<double>"
CHANNELS = "c int, " + SCHEMA
EDGE = 128
#: Voxels of the chunks that one task goes through, and of those that one kernel call fills, where chunks are smaller.
TASK, PACK = 1 << 18, 1 << 16
#: Bytes of unpacked chunks that a store keeps for the next boxes.
KEEP = 32 << 20
#: What the writer's codec names stand for in a description.
COMPRESSORS = {
    "none": None,
    "zstd": {"id": "zstd", "level": 3},
    "zlib": {"id": "zlib", "level": 1},
    "gzip": {"id": "gzip", "level": 1},
    "blosc": {"id": "blosc", "cname": "zstd", "clevel": 5, "shuffle": 1, "blocksize": 0},
}


def read_text(fs: pafs.FileSystem, path: str) -> str | None:
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(path) as f:
        return f.read().decode()


def describe(path: str) -> dict:
    """The store's description; LookupError where there is none."""
    fs, p = open_folder(path)
    text = read_text(fs, f"{p}/.zarray")
    if text is None:
        raise LookupError(f"no array store at {path}")
    d = json.loads(text)
    if d.get("zarr_format") != 2 or d.get("order", "C") != "C" or d.get("filters") or len(d["shape"]) not in (3, 4):
        raise ValueError(f"{path} has a layout that isn't supported")
    kind = (d.get("compressor") or {}).get("id")
    if kind not in (None, "zstd", "zlib", "gzip", "blosc"):
        raise ValueError(f"chunks packed with {kind} can't be read")
    return d


def level_path(path: str, level: int | None) -> str:
    """A level of a multi-resolution group is a folder `scaleN` of it."""
    return path if level is None else f"{path.rstrip('/')}/scale{level}"


def unpack(raw: bytes, compressor: dict | None) -> bytes:
    kind = (compressor or {}).get("id")
    if kind == "blosc":
        return blosc.decompress(raw)
    if kind == "zstd":
        with pa.input_stream(pa.BufferReader(raw), compression="zstd") as f:
            return f.read()
    return zlib.decompress(raw) if kind == "zlib" else gzip.decompress(raw) if kind == "gzip" else raw


def pack(raw: bytes, compressor: dict | None, size: int) -> bytes:
    """size: bytes of an element."""
    kind = (compressor or {}).get("id")
    if kind == "blosc":
        mode = {0: 0, 1: blosc.SHUFFLE, 2: blosc.BITSHUFFLE}[compressor["shuffle"]]
        return blosc.compress(raw, size, compressor["cname"], compressor["clevel"], mode, compressor["blocksize"])
    if kind == "zstd":
        return pa.compress(raw, codec="zstd", asbytes=True)
    return zlib.compress(raw, 1) if kind == "zlib" else gzip.compress(raw, 1, mtime=0) if kind == "gzip" else raw


def store_values(v: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Values as they are stored: clipped and rounded half to even for integers."""
    return np.clip(np.rint(v), np.iinfo(kind).min, np.iinfo(kind).max).astype(kind) if kind.kind in "ui" else v.astype(kind)


def chunks_a_task(spark: SparkSession, total: int, voxels: int, least: int = 4) -> int:
    """So many of `total` chunks of this size are one task's work: small chunks don't make a task each, but every core has some."""
    return max(least, min(TASK // max(1, voxels), total // (4 * spark.sparkContext.defaultParallelism)))


class Store:
    """One array store, opened wherever it is used: chunks by place, and boxes cut from as many chunks as they touch. The chunks
    of the last boxes are kept, so that boxes that overlap don't open a chunk's file each."""

    def __init__(self, path: str, about: dict | None = None):
        self.path = path.rstrip("/")
        self.about = about or describe(path)
        self.shape, self.chunks, self.dtype = self.about["shape"], self.about["chunks"], np.dtype(self.about["dtype"])
        self.kept: dict[tuple[int, ...], np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "kept": {}}

    def counts(self) -> list[int]:
        """Chunks along every axis."""
        return [-(-n // c) for n, c in zip(self.shape, self.chunks, strict=True)]

    def name(self, place: tuple[int, ...]) -> str:
        return self.about.get("dimension_separator", ".").join(map(str, place))

    def chunk(self, place: tuple[int, ...]) -> np.ndarray:
        """A whole chunk, beyond the array's far faces too; the fill value where there is no file."""
        fs, p = open_folder(self.path)
        try:
            with fs.open_input_stream(f"{p}/{self.name(place)}", compression=None) as f:
                raw = unpack(f.read(), self.about.get("compressor"))
        except FileNotFoundError:
            return np.full(self.chunks, self.about.get("fill_value") or 0, self.dtype)
        return np.frombuffer(raw, self.dtype).reshape(self.chunks)

    def kept_chunk(self, place: tuple[int, ...]) -> np.ndarray:
        a = self.kept.pop(place) if place in self.kept else self.chunk(place)
        self.kept[place] = a
        while len(self.kept) > max(1, KEEP // max(1, a.nbytes)):
            del self.kept[next(iter(self.kept))]
        return a

    def put_chunk(self, place: tuple[int, ...], values: np.ndarray) -> tuple[str, bytes]:
        """(name, payload) of a chunk's file; values may be short at the far faces."""
        whole = np.zeros(self.chunks, self.dtype)
        whole[tuple(slice(0, n) for n in values.shape)] = store_values(values, self.dtype)
        return self.name(place), pack(whole.tobytes(), self.about.get("compressor"), self.dtype.itemsize)

    def box(self, low: list[int], high: list[int]) -> np.ndarray:
        """Values from low up to before high, which must lie within the array; chunks are opened one after the other."""
        out = np.empty([b - a for a, b in zip(low, high, strict=True)], self.dtype)
        for place in itertools.product(*(range(a // c, -(-b // c)) for a, b, c in zip(low, high, self.chunks, strict=True))):
            lo = [max(a, i * c) for a, i, c in zip(low, place, self.chunks, strict=True)]
            hi = [min(b, (i + 1) * c) for b, i, c in zip(high, place, self.chunks, strict=True)]
            if all(a < b for a, b in zip(lo, hi, strict=True)):
                cut = tuple(slice(a - i * c, b - i * c) for a, b, i, c in zip(lo, hi, place, self.chunks, strict=True))
                out[tuple(slice(a - o, b - o) for a, b, o in zip(lo, hi, low, strict=True))] = self.kept_chunk(place)[cut]
        return out

    def present(self) -> set[str]:
        """Names of the chunk files that are there."""
        fs, p = open_folder(self.path)
        if fs.get_file_info(p).type != pafs.FileType.Directory:
            return set()
        found = fs.get_file_info(pafs.FileSelector(p, recursive=True))
        return {i.path[len(p) :].strip("/") for i in found if i.type == pafs.FileType.File and not i.base_name.startswith(".")}


def finish(path: str, about: dict) -> None:
    """Write the description, which makes a store whole."""
    fs, p = open_folder(path)
    fs.create_dir(p)
    with fs.open_output_stream(f"{p}/.zarray") as f:
        f.write(json.dumps(about, indent=1).encode())


def description(shape: list[int], chunks: list[int], codec: str = "zstd", dtype: str = "<u2", separator: str = ".") -> dict:
    return {"zarr_format": 2, "shape": list(shape), "chunks": list(chunks), "dtype": dtype, "compressor": COMPRESSORS[codec], "fill_value": 0, "filters": None, "order": "C", "dimension_separator": separator}


class Chunks(InputPartition):
    def __init__(self, places: list[tuple[int, ...]]):
        self.places = places


class StoreReader(DataSourceReader):
    def __init__(self, options: dict):
        self.store = Store(level_path(options["path"], int(options["level"]) if "level" in options else None))
        self.at_once = int(options.get("chunksatonce", options.get("chunksAtOnce", 8)))
        shape = self.store.shape
        self.region = [tuple(map(int, r.split(":"))) for r in options["region"].split(",")] if "region" in options else []
        self.region = [(0, n) for n in shape[: len(shape) - len(self.region)]] + self.region

    def bounds(self, place: tuple[int, ...]) -> tuple[list[int], list[int]]:
        """What a chunk gives: chunks at the far faces are stored whole, the region cuts on both sides."""
        s = self.store
        low = [max(i * c, a) for i, c, (a, _) in zip(place, s.chunks, self.region, strict=True)]
        return low, [min((i + 1) * c, n, b) for i, c, n, (_, b) in zip(place, s.chunks, s.shape, self.region, strict=True)]

    def partitions(self) -> list[Chunks]:
        s = self.store
        spans = [range(max(a, 0) // c, -(-min(b, n) // c)) for (a, b), c, n in zip(self.region, s.chunks, s.shape, strict=True)]
        places = list(itertools.product(*spans))
        return [Chunks(places[a : a + self.at_once]) for a in range(0, len(places), self.at_once)] or [Chunks([])]

    def read(self, part: Chunks) -> Iterator[pa.RecordBatch]:
        for place in part.places:
            low, high = self.bounds(place)
            block = self.store.chunk(place)[tuple(slice(a - i * c, b - i * c) for a, b, i, c in zip(low, high, place, self.store.chunks, strict=True))]
            if block.ndim == 3:
                yield block_row(low, block)
                continue
            for c, one in enumerate(block, low[0]):
                row = block_row(low[1:], one)
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), *row.columns], ["c", *AXES, "data"])


def block_row(low: list[int], block: np.ndarray) -> pa.RecordBatch:
    data = pa.ListArray.from_arrays(pa.array([0, block.size], pa.int32()), pa.array(np.ascontiguousarray(block).ravel().astype(float)))
    return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in low), *(pa.array([v], pa.int32()) for v in block.shape), data], [*AXES, "data"])


class StoreWriter(FilesWriter):
    def __init__(self, options: dict):
        super().__init__(options)
        numbers = lambda k: [int(v) for v in options[k].split(",")]
        self.about = description(numbers("shape"), numbers("chunks"), options.get("codec", "zstd"), options.get("dtype", "<u2"), options.get("separator", "."))
        if len(self.about["shape"]) == 4 and self.about["chunks"][0] != 1:
            raise ValueError("channels are written in chunks of their own")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return super().write(map(self.files, iterator))

    def files(self, b: pa.RecordBatch) -> pa.RecordBatch:
        names, payloads = [], []
        store = Store(self.path, self.about)
        four = len(store.shape) == 4
        for r, data in zip(b.select([*(["c"] if four else []), *AXES]).to_pylist(), b.column("data"), strict=True):
            at, size = [r[a] for a in AXES[:3]], [r[a] for a in AXES[3:]]
            at, size = ([r["c"], *at], [1, *size]) if four else (at, size)
            if any(a % c or n != min(c, s - a) for a, n, c, s in zip(at, size, store.chunks, store.shape, strict=True)):
                raise ValueError(f"a block at {at} of {size} isn't a chunk")
            name, payload = store.put_chunk(tuple(a // c for a, c in zip(at, store.chunks, strict=True)), data.values.to_numpy(zero_copy_only=False).reshape(size))
            names.append(name)
            payloads.append(payload)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(payloads, pa.binary())], ["name", "payload"])

    def commit(self, messages: list) -> None:
        finish(self.path, self.about)


class VolumeStore(DataSource):
    """spark.read.format("volume_store").option("region", "0:64,0:8,0:8").load(path), blocks.write.format("volume_store")"""

    @classmethod
    def name(cls) -> str:
        return "volume_store"

    def schema(self) -> str:
        about = describe(level_path(self.options["path"], int(self.options["level"]) if "level" in self.options else None))
        return CHANNELS if len(about["shape"]) == 4 else SCHEMA

    def reader(self, schema) -> StoreReader:
        return StoreReader(self.options)

    def writer(self, schema, overwrite: bool) -> StoreWriter:
        return StoreWriter(self.options)


def read_store(spark: SparkSession, path: str, level: int | None = None, region: list[tuple[int, int]] | None = None, chunks_at_once: int | None = None, beside: dict[str, str] | None = None) -> DataFrame:
    """Blocks of a store; a region (start and stop of x, z and y, or of channels as well) leaves out the chunks beyond it. beside:
    column names and paths of stores of the same extent, whose values in the same boxes are read along.

    The block columns are arithmetic on a range of chunk numbers, and data is an Arrow function of them. So Spark itself
    applies any condition on c, x0, z0, y0, nx, nz or ny before a chunk is opened, and opens none where data isn't selected.
    (The source interface's own way of pushing conditions keeps those of one query for the next over the same frame in Spark
    4.1, and for both sides of a union, so it can't be used.)"""
    store = Store(level_path(path, level))
    shape, chunks = store.shape, store.chunks
    region = [(0, n) for n in shape[: len(shape) - len(region or [])]] + list(region or [])
    if len(shape) == 4:
        chunks = [1, *chunks[1:]]  # a row has one channel
    spans = [(max(a, 0) // c, max(0, -(-min(b, n) // c) - max(a, 0) // c)) for (a, b), c, n in zip(region, chunks, shape, strict=True)]
    total = math.prod(n for _, n in spans)
    others = {name: Store(p) for name, p in (beside or {}).items()}
    for other in others.values():
        if list(other.shape) != list(shape):
            raise ValueError(f"{other.path} and {store.path} are of different sizes")
    chunks_at_once = chunks_at_once or chunks_a_task(spark, total, math.prod(chunks), 8)
    d, rest = spark.range(0, total, 1, max(1, -(-total // chunks_at_once))), total
    names = ["c", "x", "z", "y"][-len(shape) :]
    low, size = [], []
    for name, (first, n), (a, b), c, whole in zip(names, spans, region, chunks, shape, strict=True):
        rest //= max(n, 1)
        start = F.expr(f"(id div {max(rest, 1)} % {max(n, 1)} + {first}) * {c}")
        low.append(F.greatest(start, F.lit(max(a, 0)).cast("long")).alias(name))
        size.append((F.least(start + c, F.lit(min(b, whole)).cast("long")) - low[-1]).cast("int").alias("n" + name))
    d = d.select(*low, *size)

    def values(store: Store):
        @F.arrow_udf("array<double>")
        def of(*columns: pa.Array) -> pa.Array:
            numbers = np.stack([c.to_numpy() for c in columns], axis=1)
            parts = [store.box(r[: len(names)].tolist(), (r[: len(names)] + r[len(names) :]).tolist()).astype(float).ravel() for r in numbers]
            ends = np.cumsum([0, *(len(v) for v in parts)])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0)])))

        # the function sees plain columns only, so conditions on them stay below it
        return of(*(F.col(n) for n in names), *(F.col("n" + n) for n in names))

    rows = [F.col(n).alias(n + "0") for n in "xzy"], [F.col("n" + n) for n in "xzy"]
    return d.select(*(F.col(n).cast("int").alias(n) for n in names[:-3]), *rows[0], *rows[1], values(store).alias("data"), *(values(o).alias(n) for n, o in others.items()))


def read_stores(spark: SparkSession, stores: list[tuple[str, int]], chunks_at_once: int = 8) -> DataFrame:
    """path and blocks of many stores of three axes in one frame, each from its frame `first` on: (path, first) of every store. The
    executors read the descriptions, and only chunks with such frames are opened."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column("path").to_pylist(), b.column("first").to_pylist(), strict=True):
                s = Store(path)
                if len(s.shape) != 3:
                    raise ValueError(f"{path} has channels")
                starts = itertools.product(range(max(first, 0) // s.chunks[0] * s.chunks[0], s.shape[0], s.chunks[0]), *(range(0, n, c) for n, c in zip(s.shape[1:], s.chunks[1:], strict=True)))
                low = np.array(list(starts), np.int64).reshape(-1, 3)
                high = np.minimum(low + s.chunks, s.shape)
                low[:, 0] = np.maximum(low[:, 0], first)
                cut = low[:, 0] < high[:, 0]
                low, size = low[cut], (high - low)[cut].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(low), pa.string()), *map(pa.array, low.T), *map(pa.array, size.T)], ["path", *AXES])

    listed = spark.createDataFrame(stores, "path string, first long")
    d = listed.repartition(max(1, min(len(stores), 1000))).mapInArrow(places, "path string, " + SCHEMA.rpartition(",")[0])

    @F.arrow_udf("array<double>")
    def values(path: pa.Array, *columns: pa.Array) -> pa.Array:
        opened: dict[str, Store] = {}
        numbers = np.stack([c.to_numpy() for c in columns], axis=1)
        parts = []
        for name, r in zip(path.to_pylist(), numbers, strict=True):
            s = opened.get(name) or opened.setdefault(name, Store(name))
            parts.append(s.box(r[:3].tolist(), (r[:3] + r[3:]).tolist()).astype(float).ravel())
        ends = np.cumsum([0, *map(len, parts)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0)])))

    d = d.repartition(max(1, -(-d.count() // chunks_at_once)))
    return d.select("path", *AXES, values("path", *AXES).alias("data"))


def exists(path: str) -> bool:
    try:
        return bool(describe(path))
    except LookupError:
        return False


def write_store(blocks: DataFrame, path: str, shape: tuple[int, ...], chunks: tuple[int, ...] = (EDGE,) * 3, codec: str = "zstd", dtype: str = "<u2", resume: bool = True, separator: str = ".") -> None:
    """Blocks that are whole chunks (see to_chunks) as a store; with four axes they have a channel c, each in chunks of its
    own. A finished store stays as it is if resume, else it is an error; chunk files of an unfinished one are replaced."""
    if exists(path):
        if resume:
            return
        raise FileExistsError(path)
    blocks.sparkSession.dataSource.register(VolumeStore)
    w = blocks.select(*(["c"] if len(shape) == 4 else []), *AXES, "data").write.format("volume_store").mode("append")
    join = lambda v: ",".join(map(str, v))
    w.option("shape", join(shape)).option("chunks", join(chunks)).option("codec", codec).option("dtype", dtype).option("separator", separator).save(path)


def to_chunks(vox: DataFrame, shape: tuple[int, ...], chunks: tuple[int, ...] = (EDGE,) * 3) -> DataFrame:
    """Voxels as blocks that are whole chunks of a volume (cut at its far faces), missing voxels 0. With four axes voxels have a
    channel c. Neighbouring chunks of up to PACK voxels are one brick; the voxels of a brick are packed into arrays before the one
    shuffle, and one Arrow kernel call fills its chunks."""
    own, channels, (shape, chunks) = (["c"], shape[0], (shape[1:], chunks[1:])) if len(shape) == 4 else ([], 1, (shape, chunks))
    counts, many, room = [-(-n // c) for n, c in zip(shape, chunks, strict=True)], [1, 1, 1], max(1, PACK // math.prod(chunks))
    for axis in (2, 1, 0):
        many[axis] = max(1, min(counts[axis], room))
        room //= many[axis]
    wide = [c * k for c, k in zip(chunks, many, strict=True)]
    bricks = [max(1, -(-n // w)) for n, w in zip(shape, wide, strict=True)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [b.column(c).to_numpy() for c in "xzy"]
            if any(((v < 0) | (v >= n)).any() for v, n in zip(at, shape, strict=True)):
                raise ValueError(f"voxels beyond a volume of {tuple(shape)}")
            brick = b.column("c").to_numpy().astype(np.int64) if own else np.zeros(b.num_rows, np.int64)
            place = np.zeros(b.num_rows, np.int32)
            for v, n, w in zip(at, bricks, wide, strict=True):
                brick, place = brick * n + v // w, place * w + (v % w).astype(np.int32)
            order = np.argsort(brick, kind="stable")
            found, start = np.unique(brick[order], return_index=True)
            ends = pa.array([*start, b.num_rows] if len(found) else [0], pa.int32())
            v = b.column("v").to_numpy(zero_copy_only=False)[order]
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.ListArray.from_arrays(ends, pa.array(place[order])), pa.ListArray.from_arrays(ends, pa.array(v))], ["brick", "p", "v"])

    def one(g: pa.Table) -> pa.Table:
        rest, *index = (int(i) for i in np.unravel_index(g.column("brick")[0].as_py(), (1 << 31, *bricks)))
        place, v = (np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in g.column(n).chunks]) for n in ("p", "v"))
        at = np.unravel_index(place, wide)
        chunk = np.ravel_multi_index([a // c for a, c in zip(at, chunks, strict=True)], many)
        found, which = np.unique(chunk, return_inverse=True)
        block = np.zeros((len(found), *chunks))
        block[which, *(a % c for a, c in zip(at, chunks, strict=True))] = v
        low = np.stack([i * w + k * c for i, w, k, c in zip(index, wide, np.unravel_index(found, many), chunks, strict=True)], axis=1)
        size = np.minimum(np.array(chunks), np.array(shape) - low)
        parts = [a[tuple(slice(0, n) for n in s)].ravel() for a, s in zip(block, size, strict=True)]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts)))
        first = [pa.array(np.full(len(found), rest, np.int32))] if own else []
        return pa.table([*first, *map(pa.array, low.T), *map(pa.array, size.astype(np.int32).T), lists], [*own, *AXES, "data"])

    d = vox.select(*(F.col(c).cast("int").alias(c) for c in own), *(F.col(c).cast("long").alias(c) for c in "xzy"), F.col("v").cast("double").alias("v"))
    # the number of tasks follows the volume: packed voxels are too few bytes to tell it by
    total = channels * math.prod(bricks)
    packed = d.mapInArrow(pack, "brick long, p array<int>, v array<double>").repartition(-(-total // chunks_a_task(vox.sparkSession, total, math.prod(wide), 1)), "brick")
    return packed.groupBy("brick").applyInArrow(one, CHANNELS if own else SCHEMA)


def frames_to_chunks(frames: DataFrame, shape: tuple[int, int, int], chunks: tuple[int, int, int] = (EDGE,) * 3) -> DataFrame:
    """Spool frames (frame, height, width, data) as chunk blocks without a row per pixel: every frame is cut into the parts
    that belong to different chunks, and the parts of a chunk meet in one shuffle of arrays. Frames of several volumes have two more
    columns, which the blocks keep: volume, and n, the number of frames that is this volume's extent."""
    import pandas as pd

    own = ["volume", "n"] if "volume" in frames.columns else []

    _, nz, ny = shape
    cx, cz, cy = chunks

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, flat = b.column("frame").to_numpy(), b.column("data").flatten().to_numpy().reshape(-1, nz, ny)
            for z in range(0, nz, cz):
                for y in range(0, ny, cy):
                    part = np.ascontiguousarray(flat[:, z : z + cz, y : y + cy]).astype(np.int32)
                    size = part[0].size if len(part) else 0
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c) for c in own), pa.array(at // cx * cx), pa.array(np.full(n, z)), pa.array(np.full(n, y)), pa.array(at), pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(part.ravel()))],
                        [*own, "x0", "z0", "y0", "frame", "data"],
                    )

    def one(g: pd.DataFrame) -> pd.DataFrame:
        low = [int(g[c].iloc[0]) for c in ("x0", "z0", "y0")]
        extent = (int(g.n.iloc[0]), nz, ny) if own else shape
        size = [min(n, s - a) for n, s, a in zip(chunks, extent, low, strict=True)]
        block = np.zeros(size)
        block[g.frame.to_numpy() - low[0]] = np.stack(g.data.to_list()).reshape(-1, size[1], size[2])
        return pd.DataFrame({**{c: [g[c].iloc[0]] for c in own}, "x0": [low[0]], "z0": [low[1]], "y0": [low[2]], "nx": [size[0]], "nz": [size[1]], "ny": [size[2]], "data": [block.ravel()]})

    more = "volume string, n long, " if own else ""
    parts = frames.select(*own, F.col("frame").cast("long").alias("frame"), F.col("data").cast("array<int>").alias("data")).mapInArrow(cut, f"{more}x0 long, z0 long, y0 long, frame long, data array<int>")
    return parts.groupBy(*own, "x0", "z0", "y0").applyInPandas(one, more + SCHEMA)


def store_to_voxels(blocks: DataFrame) -> DataFrame:
    """x, z, y, v of all voxels, with their channel c and the path of their store where there is one."""
    own = [c for c in blocks.columns if c in ("path", "c")]
    e = blocks.select(*own, "x0", "z0", "y0", "nz", "ny", F.posexplode("data").alias("p", "v"))
    return e.select(*own, F.expr("x0 + p div (nz * ny)").alias("x"), F.expr("cast(z0 + p div ny % nz as int)").alias("z"), F.expr("cast(y0 + p % ny as int)").alias("y"), "v")
