"""Work on stored volumes chunk by chunk: every task makes whole output chunks and reads what it needs of the source itself.

No voxel is a row and nothing but chunk faces and label pairs is shuffled. A chunk is written whole or not at all and keeps
its name, and run_job() makes only those that aren't there: a job that broke off goes on where it stopped, a lost task
repeats its own chunks. The description of the result is written last; until then `.job` says what the chunks belong to.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators.geometry import axis_taps, output_bounds, warp_cubic
from lumenfold.plans.graph import connected_components
from lumenfold.plans.shared import materialize
from lumenfold.sources.files import open_folder, put_file
from lumenfold.sources.store import EDGE, Store, chunks_a_task, description, exists, finish, read_store, read_text

#: Voxels of halo around a cubic spline's source box: its filter fades by 0.27 a voxel, to 1e-14 here.
HALO = 24
#: No label, in numbers without a sign.
NONE = np.uint64(2**64 - 1)
Kernel = Callable[[list[int], list[int], dict], np.ndarray | tuple[np.ndarray, ...]]


def run_job(
    spark: SparkSession, out: str, about: dict, kernel: Kernel, job: str, extra: DataFrame | None = None, at_once: int | None = None, only: str | None = None, beside: list[tuple[str, dict, str]] | None = None
) -> dict[str, int]:
    """Make a store of this description: kernel(low, high, row) gives the values of the chunk from low up to before high. extra has
    rows by chunk number `place`, one at most each, that the kernel gets. job names the work and its parameters: chunks of another
    job in the same folder raise ValueError. only: a condition on place, to do a job in portions; the last one finishes the store.
    beside: (out, about, job) of further stores of the same grid that the same work fills; the kernel then gives a tuple of values,
    one for each store. A task has at_once neighbouring chunks. Returns how many chunks were made and how many were there before."""
    works = [(out, about, job), *(beside or [])]
    if all(exists(o) for o, _, _ in works):
        return {"made": 0, "kept": 0}
    for o, about_, job_ in works:
        fs, p = open_folder(o)
        said = json.dumps({"job": job_, "about": about_}, sort_keys=True)
        before = read_text(fs, f"{p}/.job")
        if before is None:
            put_file(fs, f"{p}/.job", said.encode())
        elif before != said:
            raise ValueError(f"{o} holds chunks of another job")
    stores = [Store(o, about_) for o, about_, _ in works]
    store = stores[0]
    counts = store.counts()
    total = math.prod(counts)
    parts = max(1, -(-total // (at_once or chunks_a_task(spark, total, math.prod(store.chunks)))))
    d = spark.range(0, total, 1, parts).withColumnRenamed("id", "place")
    d = d.where(only) if only else d
    if extra is not None:
        d = d.join(extra, "place", "left").repartition(parts, "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folders = [open_folder(s.path) for s in stores]
        made = kept = 0
        for b in batches:
            for row in b.to_pylist():
                place = tuple(int(v) for v in np.unravel_index(row["place"], counts))
                if all(fs.get_file_info(f"{p}/{s.name(place)}").type == pafs.FileType.File for s, (fs, p) in zip(stores, folders, strict=True)):
                    kept += 1
                    continue
                low = [i * c for i, c in zip(place, store.chunks, strict=True)]
                high = [min(a + c, n) for a, c, n in zip(low, store.chunks, store.shape, strict=True)]
                values = kernel(low, high, row)
                for s, (fs, p), v in zip(stores, folders, values if beside else (values,), strict=True):
                    name, payload = s.put_chunk(place, v)
                    put_file(fs, f"{p}/{name}", payload)
                made += 1
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64()), pa.array([kept], pa.int64())], ["made", "kept"])

    made, kept = d.mapInArrow(run, "made long, kept long").agg(F.sum("made"), F.sum("kept")).first()
    if not only or all(pending(spark, o, about_).isEmpty() for o, about_, _ in works):
        for o, about_, _ in works:
            finish(o, about_)
            fs, p = open_folder(o)
            fs.delete_file(f"{p}/.job")
    return {"made": made or 0, "kept": kept or 0}


def pending(spark: SparkSession, out: str, about: dict, at_once: int = 1000) -> DataFrame:
    """place, name of the chunks that a job still has to make; every task looks for its own."""
    store = Store(out, about)
    counts = store.counts()
    total = math.prod(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, p = open_folder(out)
        for b in batches:
            place = b.column(0).to_pylist()
            names = [store.name(tuple(int(v) for v in np.unravel_index(i, counts))) for i in place]
            found = fs.get_file_info([f"{p}/{n}" for n in names])
            keep = [f.type != pafs.FileType.File for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string())], ["place", "name"]).filter(pa.array(keep))

    return spark.range(0, total, 1, max(1, -(-total // at_once))).mapInArrow(run, "place long, name string")


def map_store(spark: SparkSession, path: str, out: str, f: Callable[[np.ndarray], np.ndarray], job: str, dtype: str | None = None, codec: str = "blosc") -> dict[str, int]:
    """Every chunk by itself through a function of its values."""
    src = Store(path)
    about = description(src.shape, src.chunks, codec, dtype or src.about["dtype"])
    return run_job(spark, out, about, lambda low, high, row: f(src.box(low, high)), job)


def warp_store(spark: SparkSession, path: str, out: str, m: np.ndarray, chunks: tuple[int, int, int] = (EDGE,) * 3, dtype: str = "<u2", codec: str = "blosc") -> np.ndarray:
    """A stored volume under a 3-D affine of (x, z, y), by cubic splines, 0 outside the source; the output spans the transformed
    corners. A task reads an output chunk's source box and a halo. Returns the coordinates of the output's first voxel."""
    src = Store(path)
    first, last = output_bounds(m, tuple(src.shape))
    inverse = np.linalg.inv(m)

    def kernel(low: list[int], high: list[int], row: dict) -> np.ndarray:
        origin = first + low
        size = [b - a for a, b in zip(low, high, strict=True)]
        corners = np.array([[a + d * (n - 1) for a, d, n in zip(origin, c, size, strict=True)] + [1.0] for c in itertools.product((0, 1), repeat=3)]) @ inverse.T
        a = np.maximum(np.floor(corners[:, :3].min(axis=0)).astype(int) - HALO, 0)
        b = np.minimum(np.ceil(corners[:, :3].max(axis=0)).astype(int) + HALO + 1, src.shape)
        if (a >= b).any():
            return np.zeros(size)
        local = inverse.copy()
        local[:3, 3] -= a
        return warp_cubic(src.box(a.tolist(), b.tolist()).astype(float), local, origin, tuple(size))

    about = description((last - first + 1).tolist(), list(chunks), codec, dtype)
    run_job(spark, out, about, kernel, f"warp {np.asarray(m).tolist()} of {path}")
    return first


def resize_store(spark: SparkSession, path: str, out: str, to: tuple[int, int, int], anti_alias: bool = True, chunks: tuple[int, int, int] = (EDGE,) * 3, dtype: str = "<u2", codec: str = "blosc") -> dict[str, int]:
    """A stored volume at another size, order 1, behind a Gaussian on axes that shrink. The filter is separable: an output chunk is
    three products of its source box with matrices of a few taps a row."""
    src = Store(path)

    def kernel(low: list[int], high: list[int], row: dict) -> np.ndarray:
        taps = [axis_taps(n, o, anti_alias, a, b) for n, o, a, b in zip(src.shape, to, low, high, strict=True)]
        v = src.box([int(i.min()) for i, _ in taps], [int(i.max()) + 1 for i, _ in taps]).astype(float)
        for axis, (i, w) in enumerate(taps):
            t = np.zeros((len(i), v.shape[axis]))
            np.add.at(t, (np.arange(len(i))[:, None], i - i.min()), w)
            v = np.moveaxis(np.tensordot(t, v, axes=(1, axis)), 0, axis)
        return v

    return run_job(spark, out, description(list(to), list(chunks), codec, dtype), kernel, f"resize {to} {anti_alias} of {path}")


def select_rank(counts: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, entries in the buckets before it) of the entry with this rank, for each row of counts."""
    total = np.cumsum(counts, axis=1)
    bucket = (total > rank[:, None]).argmax(axis=1)
    return bucket, np.where(bucket > 0, total[np.arange(len(total)), np.maximum(bucket - 1, 0)], 0)


def column_median(slabs: Callable[[], Iterator[np.ndarray]], pixels: int, n: int) -> np.ndarray:
    """Exact median of n values of 16 bits for each pixel. The slabs (values x pixels) are gone through twice: counts by high byte
    find the bucket of the two middle ranks, counts by low byte in these buckets the values; memory doesn't depend on n."""
    high = np.zeros(pixels * 256, np.int64)
    at = np.arange(pixels, dtype=np.int64) * 256
    for s in slabs():
        high += np.bincount((at + (s >> 8)).ravel(), minlength=len(high))
    high = high.reshape(pixels, 256)
    ranks = [np.full(pixels, (n - 1) // 2), np.full(pixels, n // 2)]
    found = [select_rank(high, r) for r in ranks]
    low = [np.zeros(pixels * 256, np.int64) for _ in found]
    for s in slabs():
        for (bucket, _), counts in zip(found, low, strict=True):
            i, p = np.nonzero(s >> 8 == bucket)
            counts += np.bincount(at[p] + (s[i, p] & 0xFF), minlength=len(counts))
    out = []
    for (bucket, before), counts, r in zip(found, low, ranks, strict=True):
        out.append(bucket * 256 + select_rank(counts.reshape(pixels, 256), r - before)[0])
    return (out[0] + out[1]) / 2


def project_store(spark: SparkSession, path: str, axis: str = "x", first: int = 0, last: int | None = None, tile: int = EDGE, at_once: int = 1) -> DataFrame:
    """Maximum, sum, mean and exact median along one axis (from first up to before last) of a stored volume of 8 or 16-bit integers.

    Rows are tiles of the plane that is left: the start and size on its two axes, and v_max, v_sum, v_mean and v_median as arrays. A
    task goes along the axis chunk by chunk, three times, and holds one chunk and the counts of a tile (100 MB for one of 128 x 128),
    however long the axis is; it takes at_once tiles, one after the other."""
    src = Store(path)
    k = np.dtype(src.about["dtype"])
    if k.kind not in "ui" or k.itemsize > 2:
        raise ValueError("projections are of integers of 8 or 16 bits")
    along = "xzy".index(axis)
    a, b = (i for i in range(3) if i != along)
    last = src.shape[along] if last is None else min(last, src.shape[along])
    n = last - first
    if n <= 0:
        raise ValueError("nothing to project")
    sides = [min(tile, src.chunks[i]) for i in (a, b)]
    # tiles divide chunks, so none of them lies in two
    starts = [[c + o for c in range(0, src.shape[i], src.chunks[i]) for o in range(0, min(src.chunks[i], src.shape[i] - c), side)] for i, side in zip((a, b), sides, strict=True)]
    names = [*(f"{'xzy'[i]}0" for i in (a, b)), *(f"n{'xzy'[i]}" for i in (a, b)), "v_max", "v_sum", "v_mean", "v_median"]
    offset = -np.iinfo(k).min if k.kind == "i" else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                at = [starts[0][t // len(starts[1])], starts[1][t % len(starts[1])]]
                size = [min(side, src.chunks[i] - s % src.chunks[i], src.shape[i] - s) for i, s, side in zip((a, b), at, sides, strict=True)]

                def slabs(at=at, size=size) -> Iterator[np.ndarray]:
                    for s in range(first // src.chunks[along] * src.chunks[along], last, src.chunks[along]):
                        low, high = [0] * 3, [0] * 3
                        low[along], high[along] = max(s, first), min(s + src.chunks[along], last)
                        for i, o, m in zip((a, b), at, size, strict=True):
                            low[i], high[i] = o, o + m
                        v = np.moveaxis(src.box(low, high), along, 0)
                        yield v.reshape(len(v), -1).astype(np.int64) + offset

                top, total = np.zeros(math.prod(size), np.int64), np.zeros(math.prod(size), np.int64)
                for s in slabs():
                    top, total = np.maximum(top, s.max(axis=0)), total + s.sum(axis=0)
                total = total - n * offset
                values = [top - offset, total, total / n, column_median(slabs, len(total), n) - offset]
                yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in at), *(pa.array([v], pa.int32()) for v in size), *(pa.array([v.astype(float)], pa.list_(pa.float64())) for v in values)], names)

    tiles = len(starts[0]) * len(starts[1])
    schema = f"{names[0]} long, {names[1]} long, {names[2]} int, {names[3]} int, " + ", ".join(f"{c} array<double>" for c in names[4:])
    return spark.range(0, tiles, 1, -(-tiles // at_once)).mapInArrow(run, schema)


def plane_pixels(tiles: DataFrame) -> DataFrame:
    """One row per pixel of project_store()'s tiles: the two axes and v_max, v_sum, v_mean, v_median."""
    a, b = (c[0] for c in tiles.columns[:2])
    values = ["v_max", "v_sum", "v_mean", "v_median"]
    e = tiles.select(f"{a}0", f"{b}0", f"n{b}", F.posexplode(F.arrays_zip(*values)).alias("p", "v"))
    return e.select(F.expr(f"{a}0 + p div n{b}").alias(a), F.expr(f"{b}0 + p % n{b}").alias(b), *(f"v.{c}" for c in values))


# labels


def label_block(mask: np.ndarray, kind: int = 26) -> np.ndarray:
    """1 + flat index of the first voxel of its component for every voxel that is set, else 0."""
    from lumenfold.operators.components import half_offsets

    flat = np.flatnonzero(mask)
    place = np.full([n + 2 for n in mask.shape], -1, np.int64)  # an empty rim, so that no shift wraps
    place[1:-1, 1:-1, 1:-1][mask] = np.arange(len(flat))
    steps = np.array([(o[0] * place.shape[1] + o[1]) * place.shape[2] + o[2] for o in half_offsets(kind)])
    inner, wide = np.flatnonzero(place >= 0), place.ravel()
    a, b = [], []
    for s in steps:
        other = wide[inner + s]
        ok = other >= 0
        a.append(np.flatnonzero(ok))
        b.append(other[ok])
    a, b = np.concatenate(a), np.concatenate(b)
    up = np.arange(len(flat))
    while True:
        low = np.minimum(up[a], up[b])
        new = up.copy()
        np.minimum.at(new, up[a], low)
        np.minimum.at(new, up[b], low)
        new = new[new]
        if (new == up).all():
            break
        up = new
    out = np.zeros(mask.size, np.int64)
    out[flat] = flat[up] + 1
    return out.reshape(mask.shape)


def facing(o: tuple[int, int, int], block: np.ndarray, side: int) -> np.ndarray:
    """The part of a block that touches its neighbour in direction o (side 0), or of that neighbour that touches it (side 1)."""
    return block[tuple(slice(None) if d == 0 else slice(-1, None) if (d > 0) == (side == 0) else slice(0, 1) for d in o)]


def label_store(spark: SparkSession, path: str, out: str, threshold: float, kind: int = 26, codec: str = "blosc") -> None:
    """Connected components of the voxels above a threshold as a store of 64-bit labels: 1 + the linear index of a component's
    first voxel, 0 outside, whatever the chunks.

    Chunks are labelled by themselves into `<out>.parts`; the layers in which chunks touch are exchanged, pairs of labels that
    meet there are joined by distributed components, and every chunk gets the new names of its own labels."""
    from lumenfold.operators.components import half_offsets

    if exists(out):
        return
    src = Store(path)
    shape, chunks = src.shape, src.chunks
    counts = src.counts()
    about = description(shape, chunks, codec, "<i8")

    def parts(low: list[int], high: list[int], row: dict) -> np.ndarray:
        local = label_block(src.box(low, high) > threshold, kind)
        on = np.nonzero(local)
        first = np.unravel_index(local[on] - 1, local.shape)
        local[on] = np.ravel_multi_index([f + a for f, a in zip(first, low, strict=True)], shape) + 1
        return local

    run_job(spark, f"{out}.parts", about, parts, f"parts {threshold} {kind} of {path}")
    offsets = half_offsets(kind)
    reach = {6: 1, 18: 2, 26: 3}[kind]

    def faces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for i in range(b.num_rows):
                at, size = ([b.column(c)[i].as_py() for c in names] for names in (("x0", "z0", "y0"), ("nx", "nz", "ny")))
                block = b.column("data")[i].values.to_numpy(zero_copy_only=False).reshape(size).astype(np.int64)
                place = [v // c for v, c in zip(at, chunks, strict=True)]
                for n, o in enumerate(offsets):
                    for side, sign in ((0, 1), (1, -1)):
                        other = [v + sign * d for v, d in zip(place, o, strict=True)]
                        if all(0 <= v < c for v, c in zip(other, counts, strict=True)):
                            part = facing(o, block, side)
                            if part.any():
                                owner = place if side == 0 else other
                                rows.append((int(np.ravel_multi_index(owner, counts)), n, side, list(part.shape), part.ravel()))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.list_(pa.int32())), pa.array(cols[4], pa.list_(pa.int64()))], ["place", "o", "side", "size", "labels"])

    def meet(g: pd.DataFrame) -> pd.DataFrame:
        if len(g) < 2:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        o = offsets[int(g.o.iloc[0])]
        one, two = (np.asarray(r.labels).reshape(r.size_) for r in g.rename(columns={"size": "size_"}).sort_values("side").itertuples())
        # within the layers an axis that the direction leaves alone may still be crossed by a step
        free = [i for i in range(3) if o[i] == 0]
        pairs = []
        for step in itertools.product((-1, 0, 1), repeat=len(free)):
            if sum(map(abs, o)) + sum(map(abs, step)) > reach:
                continue
            a, b = [slice(None)] * 3, [slice(None)] * 3
            for i, s in zip(free, step, strict=True):
                n = one.shape[i]
                a[i], b[i] = slice(max(0, -s), n - max(0, s)), slice(max(0, s), n - max(0, -s))
            u, v = one[tuple(a)].ravel(), two[tuple(b)].ravel()
            ok = (u > 0) & (v > 0)
            pairs.append(np.stack([u[ok], v[ok]], axis=1))
        p = np.unique(np.concatenate(pairs), axis=0)
        return pd.DataFrame({"a": p[:, 0], "b": p[:, 1]})

    layers = read_store(spark, f"{out}.parts").mapInArrow(faces, "place long, o int, side int, size array<int>, labels array<long>")
    whole = connected_components(layers.groupBy("place", "o").applyInPandas(meet, "a long, b long")).where("node <> component")
    # a label belongs to the chunk of its first voxel
    x, z, y = (f"({e})" for e in (f"(node - 1) div {shape[1] * shape[2]}", f"(node - 1) div {shape[2]} % {shape[1]}", f"(node - 1) % {shape[2]}"))
    owner = F.expr(f"({x} div {chunks[0]} * {counts[1]} + {z} div {chunks[1]}) * {counts[2]} + {y} div {chunks[2]}")
    new = materialize(whole.groupBy(owner.alias("place")).agg(F.collect_list(F.struct("node", "component")).alias("new")), "labels")
    pieces = Store(f"{out}.parts")

    def rename(low: list[int], high: list[int], row: dict) -> np.ndarray:
        v = pieces.box(low, high).copy()
        if row["new"]:
            old, to = (np.array([r[c] for r in row["new"]], np.int64) for c in ("node", "component"))
            order = np.argsort(old)
            old, to = old[order], to[order]
            at = np.minimum(np.searchsorted(old, v), len(old) - 1)
            v = np.where(old[at] == v, to[at], v)
        return v

    run_job(spark, out, about, rename, f"labels {threshold} {kind} of {path}", new)


def shell_store(spark: SparkSession, path: str, out: str, most: int = 3, codec: str = "blosc") -> None:
    """Shells around the objects of a store of labels, as two stores: `<out>/label` says whose shell a voxel is in (equal distances:
    the smallest label), `<out>/layer` which one: 1 is the object, k + 1 over k - 1 and up to k voxels away, 0 none. A task reads a
    chunk and a halo of `most` voxels, once for both."""
    src = Store(path)
    r = range(-most, most + 1)
    near = sorted((sum(i * i for i in o), o) for o in itertools.product(r, repeat=3) if sum(i * i for i in o) <= most * most)

    def nearest(low: list[int], high: list[int], row: dict) -> tuple[np.ndarray, np.ndarray]:
        a = [max(0, v - most) for v in low]
        b = [min(n, v + most) for v, n in zip(high, src.shape, strict=True)]
        box = np.pad(src.box(a, b), [(v - lo + most, hi - v2 + most) for v, lo, v2, hi in zip(a, low, b, high, strict=True)])
        # less 1 and without a sign, no label is the largest number: one minimum for every place around, as small chunks cost by the call
        box = (np.maximum(box.astype(np.int64), 0) - 1).view(np.uint64)
        size = [h - v for h, v in zip(high, low, strict=True)]
        if (box == NONE).all():
            return np.zeros(size, np.int64), np.zeros(size, np.int64)
        around = np.lib.stride_tricks.sliding_window_view(box, (2 * most + 1,) * 3)
        label, far = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for d, same in itertools.groupby(near, key=lambda x: x[0]):
            best = np.full(size, NONE)
            for _, (x, z, y) in same:
                np.minimum(best, around[..., x + most, z + most, y + most], out=best)
            new = (label == 0) & (best != NONE)
            label[new], far[new] = best[new] + np.uint64(1), d
        return label, np.where(label > 0, np.ceil(np.sqrt(far)).astype(np.int64) + 1, 0)

    label, layer = ((f"{out}/{name}", description(src.shape, src.chunks, codec, dtype), f"shells {most} {name} of {path}") for name, dtype in (("label", "<i8"), ("layer", "|u1")))
    run_job(spark, *label[:2], nearest, label[2], beside=[layer])
