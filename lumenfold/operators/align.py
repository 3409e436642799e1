"""Alignment of planes by mutual information.

The metric is the one of Mattes and others (2003): the joint histogram of the fixed plane's grey values and the moved plane's
has Parzen windows, a box for the fixed and a cubic B-spline for the moving one, so it can be derived with respect to the
shift. Regular-step gradient ascent climbs it: steps keep their length along the gradient's direction and are halved where it
turns back. It runs on smoothed and shrunk planes first, then on finer ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 50
#: (shrink factor, standard deviation of the smoothing before it) of each resolution, coarse to fine.
LEVELS = ((6, 6.0), (2, 2.0), (1, 1.0))
STEP, LEAST_STEP, ROUNDS = 1.0, 0.01, 200
#: Planes with sides of fewer pixels than this after shrinking skip the level.
LEAST_SIDE = 16


def smooth(a: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian filter along both axes, edges repeated."""
    reach = int(np.ceil(3 * sigma))
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    w /= w.sum()
    for axis in (0, 1):
        p = np.pad(a, [(reach, reach) if i == axis else (0, 0) for i in (0, 1)], mode="edge")
        n = a.shape[axis]
        a = sum(x * np.take(p, np.arange(k, k + n), axis=axis) for k, x in enumerate(w))
    return a


def bspline(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and derivatives of the four cubic B-splines that cover a place t (0 to 1) behind the second of them."""
    w = np.stack([(1 - t) ** 3, 3 * t**3 - 6 * t**2 + 4, -3 * t**3 + 3 * t**2 + 3 * t + 1, t**3]) / 6
    d = np.stack([-((1 - t) ** 2), 3 * t**2 - 4 * t, -3 * t**2 + 2 * t + 1, t**2]) / 2
    return w, d


class Metric:
    """Mutual information of a fixed plane and a moving one under shifts, and its gradient."""

    def __init__(self, fixed: np.ndarray, moving: np.ndarray):
        self.fixed, self.moving = fixed, moving
        span = lambda a: max(float(a.max() - a.min()), 1e-12)
        # two bins of padding on both sides, so that every window lies inside
        self.f = 2 + np.minimum(((fixed - fixed.min()) / span(fixed) * (BINS - 4)).astype(int), BINS - 5)
        self.low, self.width = float(moving.min()), span(moving) / (BINS - 5)
        self.grad = np.gradient(moving)

    def at(self, shift: np.ndarray) -> tuple[float, np.ndarray]:
        """(information, gradient) where pixel p of the fixed plane meets p + shift of the moving one."""
        h, w = self.moving.shape
        base = np.floor(shift).astype(int)
        z, y = shift - base
        # pixels whose four neighbours are inside
        lo = [max(0, -b) for b in base]
        hi = [min(n, m - 1 - b) for n, m, b in zip(self.fixed.shape, (h, w), base, strict=True)]
        if hi[0] <= lo[0] or hi[1] <= lo[1]:
            return 0.0, np.zeros(2)
        cut = lambda a, i, j: a[lo[0] + base[0] + i : hi[0] + base[0] + i, lo[1] + base[1] + j : hi[1] + base[1] + j]
        mix = lambda a: (cut(a, 0, 0) * (1 - z) * (1 - y) + cut(a, 0, 1) * (1 - z) * y + cut(a, 1, 0) * z * (1 - y) + cut(a, 1, 1) * z * y).ravel()
        m = 2 + (mix(self.moving) - self.low) / self.width
        k = np.floor(m).astype(int)
        weight, slope = bspline(m - k)
        f = self.f[lo[0] : hi[0], lo[1] : hi[1]].ravel()
        cell = f * BINS + k - 1
        n = len(m)
        joint = sum(np.bincount(cell + i, weight[i], BINS * BINS) for i in range(4)).reshape(BINS, BINS) / n
        pf, pm = joint.sum(axis=1), joint.sum(axis=0)
        on = joint > 1e-15
        ratio = np.zeros_like(joint)
        ratio[on] = np.log(joint[on] / np.broadcast_to(pm, joint.shape)[on])
        value = float((joint[on] * (ratio[on] - np.log(np.broadcast_to(pf[:, None], joint.shape)[on]))).sum())
        # the rest of the derivative cancels, as all weights of a pixel sum to one
        pull = sum(slope[i] * ratio.ravel()[cell + i] for i in range(4)) / (n * self.width)
        return value, np.array([float((pull * mix(g)).sum()) for g in self.grad])


def align_planes(fixed: np.ndarray, moving: np.ndarray) -> tuple[float, float, float]:
    """(dz, dy, information): pixel p of the fixed plane lies at p + (dz, dy) of the moving one."""
    shift, value = np.zeros(2), 0.0
    for shrink, sigma in LEVELS:
        if shrink > 1 and min(fixed.shape) // shrink < LEAST_SIDE:
            continue
        part = [smooth(a.astype(float), sigma)[::shrink, ::shrink] for a in (fixed, moving)]
        metric, step, before = Metric(*part), STEP * shrink, np.zeros(2)
        best = (-np.inf, shift)
        for _ in range(ROUNDS):
            value, g = metric.at(shift / shrink)
            best = max(best, (value, shift), key=lambda x: x[0])
            size = float(np.hypot(*g))
            if size < 1e-9:
                break
            if float(g @ before) < 0:
                step /= 2
                if step < LEAST_STEP * shrink:
                    break
            before = g
            shift = shift + step * g / size
        value, shift = best
    return float(shift[0]), float(shift[1]), float(value)


def align_translation(pairs: DataFrame, *keys: str) -> DataFrame:
    """keys, dz, dy (the moving plane's pixels that lie so far on) and information of every pair of planes: height, width, fixed
    and moving as arrays, row by row. A pair is one kernel call, and pairs are spread over the cluster as they are. Planes
    without contrast get no shift; null planes get nulls."""
    kinds = dict(pairs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in range(b.num_rows):
                h, w = b.column("height")[i].as_py(), b.column("width")[i].as_py()
                a, m = (b.column(c)[i].values for c in ("fixed", "moving"))
                planes = [None if x is None else x.to_numpy(zero_copy_only=False).astype(float).reshape(h, w) for x in (a, m)]
                out.append((None,) * 3 if any(p is None for p in planes) else align_planes(*planes))
            cols = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), *(pa.array(c, pa.float64()) for c in cols)], [*keys, "dz", "dy", "information"])

    return pairs.select(*keys, "height", "width", "fixed", "moving").mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "dz double, dy double, information double"]))


def channel_translations(planes: DataFrame, reference: int, every: int = 10, most: int = 1000) -> DataFrame:
    """ch, dz, dy, planes: the median shift of every channel against the reference one over every 10th plane of the middle 1000.
    planes: ch, x, height, width, data (arrays). The planes of a number meet in one join of arrays; no pixel is a row."""
    ends = planes.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.lit(1).alias("one"))
    start = ends.select("one", F.expr(f"greatest(low, low + (high - low + 1 - {most}) div 2)").alias("start"))
    d = planes.withColumn("one", F.lit(1)).join(F.broadcast(start), "one").where((F.col("x") >= F.col("start")) & (F.col("x") < F.col("start") + most) & ((F.col("x") - F.col("start")) % every == 0))
    fixed = d.where(F.col("ch") == reference).select("x", F.col("data").alias("fixed"))
    pairs = d.where(F.col("ch") != reference).select("ch", "x", "height", "width", F.col("data").alias("moving")).join(fixed, "x")
    got = align_translation(pairs, "ch", "x")
    return got.groupBy("ch").agg(F.median("dz").alias("dz"), F.median("dy").alias("dy"), F.count("*").alias("planes"))
