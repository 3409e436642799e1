"""Registration of the channels of a stored volume: planes are scored, the best ones equalised, matched and correlated, and every
channel is rolled by its median shift into another store.

A task goes through the planes of rows of chunks, one row after the other and tile by tile, so it holds histograms or the few
chosen planes of a row and never a whole channel. What comes to the driver is a shift a channel.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators.geometry import equalised, matched_values, phase_peak
from lumenfold.operators.reduce import top_frames
from lumenfold.plans.shared import materialize
from lumenfold.plans.store_jobs import run_job
from lumenfold.sources.store import Store, chunks_a_task, description

BINS = 100


def tiles(src: Store, low: int, high: int, channel: int) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """(z0, y0) and values of the parts of planes low up to before high of a channel, a chunk's face at a time."""
    _, nx, nz, ny = src.shape
    _, _, cz, cy = src.chunks
    for z, y in itertools.product(range(0, nz, cz), range(0, ny, cy)):
        yield (z, y), src.box([channel, low, z, y], [channel + 1, high, min(z + cz, nz), min(y + cy, ny)])[0]


def entropy(counts: np.ndarray) -> np.ndarray:
    """Of the histograms in the rows, most of whose counts may be 0."""
    row, at = np.nonzero(counts)
    p = counts[row, at] / counts.sum(axis=1)[row]
    return -np.bincount(row, p * np.log(p), len(counts))


def row_tasks(spark: SparkSession, src: Store, channels: int) -> int:
    """How many tasks the rows of chunks are dealt to."""
    rows = -(-src.shape[1] // src.chunks[1])
    return max(1, -(-rows // chunks_a_task(spark, rows, channels * src.chunks[1] * src.shape[2] * src.shape[3], 1)))


def plane_scores(spark: SparkSession, path: str, a: int, b: int, bins: int = BINS) -> DataFrame:
    """x, score of every plane: normalised mutual information of two channels, (H(a) + H(b)) / H(a, b), over equal bins between each
    plane's own least and greatest value; 1 where both are constant. Two passes over the chunks of a row: ranges, then counts."""
    src = Store(path)
    nx, cx = src.shape[1], src.chunks[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in batch.column(0).to_pylist():
                high = min(low + cx, nx)
                n = high - low
                ends = []
                for ch in (a, b):
                    lo, hi = np.full(n, np.inf), np.full(n, -np.inf)
                    for _, v in tiles(src, low, high, ch):
                        v = v.reshape(n, -1)
                        lo, hi = np.minimum(lo, v.min(axis=1)), np.maximum(hi, v.max(axis=1))
                    ends.append((lo, np.where(hi > lo, hi - lo, 1)))
                joint = np.zeros(n * bins * bins, np.int64)
                for (_, u), (_, v) in zip(tiles(src, low, high, a), tiles(src, low, high, b), strict=True):
                    i, j = (np.minimum((w.reshape(n, -1) - lo[:, None]) / size[:, None] * bins, bins - 1).astype(np.int64) for w, (lo, size) in zip((u, v), ends, strict=True))
                    joint += np.bincount((np.arange(n)[:, None] * bins * bins + i * bins + j).ravel(), minlength=len(joint))
                joint = joint.reshape(n, bins, bins)
                both = entropy(joint.reshape(n, -1))
                score = np.where(both > 1e-12, (entropy(joint.sum(axis=2)) + entropy(joint.sum(axis=1))) / np.where(both > 1e-12, both, 1), 1.0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(low, high)), pa.array(score)], ["x", "score"])

    return spark.range(0, nx, cx, row_tasks(spark, src, 2)).mapInArrow(run, "x long, score double")


def plane_shifts(spark: SparkSession, path: str, planes: DataFrame, reference: int, channels: list[int], tile: int | None = None) -> DataFrame:
    """ch, x, dz, dy of the chosen planes (x): what rolls a channel's plane onto the reference's, by phase correlation of equalised
    planes, the moving one's values matched to the reference's. The reference's planes of a row of chunks are equalised once for
    all channels; a task holds these planes of two channels."""
    src = Store(path)
    _, _, nz, ny = src.shape
    cx = src.chunks[1]
    tile = tile or max(8, nz // 8)

    def chosen(xs: list[int], channel: int) -> np.ndarray:
        out = np.zeros((len(xs), nz, ny))
        low = xs[0]
        for (z, y), v in tiles(src, low, xs[-1] + 1, channel):
            part = v[np.array(xs) - low]
            out[:, z : z + part.shape[1], y : y + part.shape[2]] = part
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for xs in b.column("xs").to_pylist():
                fixed = [equalised(p, tile) for p in chosen(xs, reference)]
                for ch in channels:
                    rows = [(ch, x, *phase_peak(f, matched_values(equalised(p, tile), f))) for x, f, p in zip(xs, fixed, chosen(xs, ch), strict=True)]
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["ch", "x", "dz", "dy"])

    # the number of tasks follows the volume: a list of planes is too few bytes to tell it by
    dealt = planes.select("x", F.expr(f"x div {cx}").alias("row")).repartition(row_tasks(spark, src, 1 + len(channels)), "row")
    rows = dealt.groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return rows.select("xs").mapInArrow(run, "ch int, x long, dz int, dy int")


def register_store(spark: SparkSession, path: str, out: str, reference: int = 0, scored: int = 2, share: float = 0.9, tile: int | None = None, codec: str = "blosc") -> dict[int, tuple[int, int]]:
    """Channels of a store (c, x, z, y) rolled onto the reference channel, as another store. The planes whose mutual information between
    the reference and the scored channel reaches the percentile give the shifts; the median of a channel's shifts, rounded half to
    even, is applied to all of its planes as a circular shift. Returns the shift of each channel."""
    src = Store(path)
    channels = [c for c in range(src.shape[0]) if c != reference]
    scores = materialize(plane_scores(spark, path, reference, scored), "scores")  # the percentile and its planes need them twice
    best = materialize(top_frames(scores, share).select("x"), "planes")
    shifts = plane_shifts(spark, path, best, reference, channels, tile)
    found = {r["ch"]: (round(r["dz"]), round(r["dy"])) for r in shifts.groupBy("ch").agg(F.median("dz").alias("dz"), F.median("dy").alias("dy")).collect()}
    found[reference] = (0, 0)
    _, _, nz, ny = src.shape

    def wrapped(low: int, high: int, shift: int, n: int) -> list[tuple[int, int, int]]:
        """(start, stop, place in the output) of the source's parts that make up low up to before high after a roll."""
        parts, at = [], low
        while at < high:
            start = (at - shift) % n
            size = min(high - at, n - start)
            parts.append((start, start + size, at - low))
            at += size
        return parts

    def kernel(low: list[int], high: list[int], row: dict) -> np.ndarray:
        res = np.empty([b - a for a, b in zip(low, high, strict=True)], src.dtype)
        for c in range(low[0], high[0]):
            dz, dy = found[c]
            for (z0, z1, zo), (y0, y1, yo) in itertools.product(wrapped(low[2], high[2], dz, nz), wrapped(low[3], high[3], dy, ny)):
                res[c - low[0], :, zo : zo + z1 - z0, yo : yo + y1 - y0] = src.box([c, low[1], z0, y0], [c + 1, high[1], z1, y1])[0]
        return res

    about = description(src.shape, src.chunks, codec, src.about["dtype"], src.about.get("dimension_separator", "."))
    run_job(spark, out, about, kernel, f"roll {sorted(found.items())} of {path}")
    return found
