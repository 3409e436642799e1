"""Geometry: resampling, dilation, shells, registration kernels."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUBIC_POLE = np.sqrt(3.0) - 2.0


def output_bounds(m: np.ndarray, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Floor and ceiling of the eight transformed corners."""
    corners = np.array([[*c, 1.0] for c in itertools.product(*((0, n - 1) for n in shape))])
    out = corners @ m.T
    return np.floor(out[:, :3].min(axis=0)).astype(int), np.ceil(out[:, :3].max(axis=0)).astype(int)


def bounds_of(volumes: DataFrame, m: list[list[float]], *by: str) -> DataFrame:
    """by, r, lo, hi: floor and ceiling of each coordinate r of a volume (nx, nz, ny) under an affine of (x, z, y). A coordinate is a
    sum of one term an axis, so its extremes over the eight corners are the sums of the terms' extremes."""
    rows = []
    for r, (*c, offset) in enumerate(m[:3]):
        ends = [F.lit(float(k)) * (F.col(f"n{a}") - 1) for k, a in zip(c, "xzy", strict=True)]
        low, high = (sum((pick(e, F.lit(0.0)) for e in ends), F.lit(float(offset))) for pick in (F.least, F.greatest))
        rows.append(F.struct(F.lit(r).alias("r"), F.floor(low).cast("long").alias("lo"), F.ceil(high).cast("long").alias("hi")))
    return volumes.select(*by, F.explode(F.array(*rows)).alias("b")).select(*by, "b.*")


def warp_bilinear(vox: DataFrame, m: list[list[float]], nz: int, ny: int, pixels: int = 1 << 22) -> DataFrame:
    """2-D affine of every frame, forward matrix on (y, z, 1), 0 outside: the taps are the same for all frames, so one kernel call
    takes as many frames as have about `pixels` pixels, after the one shuffle that brings them together."""
    inv = np.linalg.inv(np.vstack([np.array(m, float), [0, 0, 1]]))
    z, y = (a.ravel() for a in np.indices((nz, ny)))
    sy, sz, _ = np.round(inv @ np.stack([y, z, np.ones(len(y))]), 9)
    fy, fz = np.floor(sy).astype(int), np.floor(sz).astype(int)
    frames = max(1, min(256, pixels // (nz * ny)))

    def one(g: pd.DataFrame) -> pd.DataFrame:
        xs, at = np.unique(g.x.to_numpy(), return_inverse=True)
        img = np.zeros((len(xs), nz + 2, ny + 2))  # a rim of zeros
        img[at, g.z + 1, g.y + 1] = g.v
        out = np.zeros((len(xs), len(z)))
        for dz, dy in itertools.product((0, 1), (0, 1)):
            w = (1 - np.abs(sz - fz - dz)) * (1 - np.abs(sy - fy - dy))
            out += w * img[:, np.clip(fz + dz + 1, 0, nz + 1), np.clip(fy + dy + 1, 0, ny + 1)]
        return pd.DataFrame({"x": np.repeat(xs, len(z)), "z": np.tile(z.astype("int32"), len(xs)), "y": np.tile(y.astype("int32"), len(xs)), "v": out.ravel()})

    group = F.expr(f"x div {frames}").alias("g")
    return vox.select("x", "z", "y", "v", group).groupBy("g").applyInPandas(one, f"x {dict(vox.dtypes)['x']}, z int, y int, v double")


def grid(spark: SparkSession, nz: int, ny: int) -> DataFrame:
    return spark.range(nz * ny).select(F.expr(f"cast(id div {ny} as int)").alias("z"), F.expr(f"cast(id % {ny} as int)").alias("y"))


def spline_prefilter(a: np.ndarray) -> np.ndarray:
    """Cubic B-spline coefficients along every axis (two recursive passes, mirrored edges)."""
    for axis in range(a.ndim):
        c = np.moveaxis(a, axis, 0).astype(float) * 6.0
        n = len(c)
        if n == 1:
            a = np.moveaxis(c / 6.0, 0, axis)
            continue
        powers = CUBIC_POLE ** np.arange(n)
        mirror = np.concatenate([powers[:1] * 1.0, powers[1:-1] + CUBIC_POLE ** (2 * n - 2 - np.arange(1, n - 1)), powers[-1:]])
        c[0] = np.tensordot(mirror, c, axes=(0, 0)) / (1 - CUBIC_POLE ** (2 * n - 2))
        for i in range(1, n):
            c[i] += CUBIC_POLE * c[i - 1]
        c[-1] = (CUBIC_POLE / (CUBIC_POLE**2 - 1)) * (c[-1] + CUBIC_POLE * c[-2])
        for i in range(n - 2, -1, -1):
            c[i] = CUBIC_POLE * (c[i + 1] - c[i])
        a = np.moveaxis(c, 0, axis)
    return a


def warp_cubic(vol: np.ndarray, inverse: np.ndarray, origin: np.ndarray, shape: tuple[int, int, int]) -> np.ndarray:
    """Values at inverse @ (origin + index) by cubic splines; 0 outside the volume."""
    c = spline_prefilter(vol)
    idx = np.stack(np.meshgrid(*(np.arange(n) for n in shape), indexing="ij"), axis=-1).reshape(-1, 3) + origin
    p = np.round(idx @ inverse[:3, :3].T + inverse[:3, 3], 9)
    ok = np.all((p >= 0) & (p <= np.array(vol.shape) - 1), axis=1)
    out = np.zeros(len(p))
    p = p[ok]
    base = np.floor(p).astype(int)
    weights = []
    for d in range(3):
        t = p[:, d] - base[:, d]
        weights.append(np.stack([(1 - t) ** 3, 3 * t**3 - 6 * t**2 + 4, -3 * t**3 + 3 * t**2 + 3 * t + 1, t**3]) / 6)
    # the places of the four taps of each axis, folded at the edges, in the flat volume
    at = []
    for d, n in enumerate(vol.shape):
        q = np.abs(base[:, d] + np.arange(-1, 3)[:, None])
        q = np.where(q > n - 1, 2 * (n - 1) - q, q)
        at.append(np.clip(q, 0, n - 1) * int(np.prod(vol.shape[d + 1 :])))
    total, flat = np.zeros(len(p)), c.ravel()
    for i, j in itertools.product(range(4), repeat=2):
        w, line = weights[0][i] * weights[1][j], at[0][i] + at[1][j]
        for k in range(4):
            total += w * weights[2][k] * flat[line + at[2][k]]
    out[ok] = total
    return out.reshape(shape)


def warp_blocks(vox: DataFrame, m: np.ndarray, shape: tuple[int, int, int], block: int = 64, halo: int = 12) -> DataFrame:
    """3-D affine of an (x, z, y) volume by output blocks. Voxels are packed into cells of the size of a block, and a cell goes to the
    output blocks whose source box, widened by a halo (the spline filter fades by 0.27 a voxel), may touch it: these follow from the
    cell's place, so no list of all blocks is made. A task sees one block and its cells."""
    inv = np.linalg.inv(m)
    low, high = output_bounds(m, shape)
    counts = tuple(int(n) for n in (high - low) // block + 1)
    middle = low + (block - 1) / 2
    # how far a block's middle can be, in the source, from a voxel that the block needs
    reach = np.abs(inv[:3, :3]).sum(axis=1) * (block - 1) / 2 + halo + 2

    @F.arrow_udf("array<long>")
    def touched(cx: pa.Array, cz: pa.Array, cy: pa.Array) -> pa.Array:
        found = []
        for cell in np.stack([c.to_numpy() for c in (cx, cz, cy)], axis=1):
            a, b = cell * block - reach, np.minimum((cell + 1) * block, shape) - 1 + reach
            centre, half = m[:3, :3] @ (a + b) / 2 + m[:3, 3], np.abs(m[:3, :3]) @ (b - a) / 2
            first = np.maximum(np.ceil((centre - half - middle) / block).astype(int), 0)
            last = np.minimum(np.floor((centre + half - middle) / block).astype(int), np.array(counts) - 1)
            at = np.stack(np.meshgrid(*(np.arange(i, j + 1) for i, j in zip(first, last, strict=True)), indexing="ij"), axis=-1).reshape(-1, 3)
            source = (middle + at * block) @ inv[:3, :3].T + inv[:3, 3]
            found.append(np.ravel_multi_index(tuple(at[((source >= a) & (source <= b)).all(axis=1)].T), counts))
        ends = np.cumsum([0, *map(len, found)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*found, np.zeros(0, np.int64)]), pa.int64()))

    cells = [F.expr(f"cast({c} div {block} as long)").alias(f"c{c}") for c in "xzy"]
    place = F.expr(f"cast((x % {block} * {block} + z % {block}) * {block} + y % {block} as int)").alias("p")
    inside = " AND ".join(f"{c} BETWEEN 0 AND {n - 1}" for c, n in zip("xzy", shape, strict=True))
    packed = vox.where(inside).select(*cells, F.struct(place, "v").alias("e")).groupBy("cx", "cz", "cy").agg(F.collect_list("e").alias("e"))
    packed = packed.select("cx", "cz", "cy", F.col("e.p").alias("p"), F.col("e.v").alias("v"))
    dealt = packed.select(F.explode(touched("cx", "cz", "cy")).alias("o"), "*")
    names = ["x", "z", "y", "v"]

    def one(g: pa.Table) -> pa.Table:
        index = np.array(np.unravel_index(g.column("o")[0].as_py(), counts))
        start = low + index * block
        size = tuple(int(n) for n in np.minimum(block, high - start + 1))
        corners = np.array([[k + d * (n - 1) for k, d, n in zip(start, c, size, strict=True)] + [1.0] for c in itertools.product((0, 1), repeat=3)]) @ inv.T
        a = np.maximum(np.floor(corners[:, :3].min(axis=0)).astype(int) - halo, 0)
        b = np.minimum(np.ceil(corners[:, :3].max(axis=0)).astype(int) + halo, np.array(shape) - 1)
        vol, n = np.zeros(np.maximum(b - a + 1, 0)), 0
        for batch in g.to_batches():
            for i, cell in enumerate(np.stack([batch.column(c).to_numpy() for c in ("cx", "cz", "cy")], axis=1)):
                p, v = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("p", "v"))
                at = np.stack(np.unravel_index(p, (block,) * 3)) + (cell * block - a)[:, None]
                ok = ((at >= 0) & (at < np.array(vol.shape)[:, None])).all(axis=0)
                vol[tuple(at[:, ok])] = v[ok]
                n += int(ok.sum())
        if not n:
            return pa.table([pa.array([], k) for k in (pa.int64(), pa.int32(), pa.int32(), pa.float64())], names)
        local = inv.copy()
        local[:3, 3] -= a
        # inside the block's own volume but outside the whole one is 0 as well
        out = warp_cubic(vol, local, start, size)
        x, z, y = (k.ravel() + s for k, s in zip(np.indices(size), start, strict=True))
        return pa.table([pa.array(x, pa.int64()), pa.array(z.astype(np.int32)), pa.array(y.astype(np.int32)), pa.array(out.ravel())], names)

    return dealt.groupBy("o").applyInArrow(one, "x long, z int, y int, v double")


def resize_nearest(vox: DataFrame, nz: int, ny: int, oz: int, oy: int) -> DataFrame:
    """Order 0: every output pixel takes the source under its centre; a join with a plane-sized map."""
    spark = vox.sparkSession
    src = lambda c, n, o: F.least(F.lit(n - 1), F.floor((F.col(c) + 0.5) * n / o)).cast("int")
    t = grid(spark, oz, oy).select(F.col("z").alias("oz"), F.col("y").alias("oy"), src("z", nz, oz).alias("z"), src("y", ny, oy).alias("y"))
    return vox.join(t, ["z", "y"]).select("x", F.col("oz").alias("z"), F.col("oy").alias("y"), "v")


def resize_linear(vox: DataFrame, nz: int, ny: int, oz: int, oy: int) -> DataFrame:
    """Order 1 with half-pixel centres and edge values beyond the border: two taps an axis."""
    spark = vox.sparkSession

    def taps(name: str, n: int, o: int) -> DataFrame:
        p = (F.col("id") + 0.5) * n / o - 0.5
        d = spark.range(o).select(F.col("id").cast("int").alias("o" + name), F.greatest(F.lit(0.0), F.least(F.lit(float(n - 1)), p)).alias("p"))
        d = d.select("o" + name, "p", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).withColumn(name, F.least(F.lit(n - 1), (F.floor("p") + F.col("k")).cast("int")))
        return d.select("o" + name, name, (1 - F.abs(F.col("p") - F.floor("p") - F.col("k"))).alias("w" + name)).where(f"w{name} > 0")

    d = vox.join(taps("z", nz, oz), "z").join(taps("y", ny, oy), "y")
    return d.groupBy("x", F.col("oz").alias("z"), F.col("oy").alias("y")).agg(F.sum(F.col("v") * F.col("wz") * F.col("wy")).alias("v"))


def axis_taps(n: int, o: int, anti_alias: bool, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(sources, weights) of the outputs from low up to before high of one axis, a row each: order 1 with half-pixel centres and
    mirrored edges; where the axis shrinks and anti_alias, behind a Gaussian of (n / o - 1) / 2 samples. A source may come up
    more than once in a row."""
    sigma = max(0.0, (n / o - 1) / 2) if anti_alias else 0.0
    reach = int(4 * sigma + 0.5)
    k = np.arange(-reach, reach + 1)
    w = np.exp(-0.5 * (k / sigma) ** 2) if sigma else np.ones(1)
    w /= w.sum()
    at = (np.arange(low, high) + 0.5) * n / o - 0.5
    base = np.floor(at).astype(int)
    part = (at - base)[:, None]
    # the filter around the lower neighbour, and around the upper one
    weights = np.pad(w, (0, 1)) * (1 - part) + np.pad(w, (1, 0)) * part
    i = base[:, None] + np.arange(-reach, reach + 2)
    return (np.abs((i + n - 1) % (2 * n - 2) - (n - 1)) if n > 1 else np.zeros_like(i)), weights


def resize_taps(n: int, o: int, anti_alias: bool) -> np.ndarray:
    """(output, source, weight) rows of a whole axis, each pair once."""
    i, w = axis_taps(n, o, anti_alias, 0, o)
    pair, back = np.unique((np.arange(o)[:, None] * n + i).ravel(), return_inverse=True)
    total = np.bincount(back, w.ravel())
    return np.stack([pair // n, pair % n, total], axis=1)[total != 0]


def resize_volume(vox: DataFrame, shape: tuple[int, int, int], to: tuple[int, int, int], anti_alias: bool = True) -> DataFrame:
    """An (x, z, y) volume at another size: axis by axis, as the filter and the interpolation are separable. An axis' taps
    are a relation of a few rows per output plane, and its sums combine on the map side."""
    spark, out = vox.sparkSession, vox.select("x", "z", "y", F.col("v").cast("double").alias("v"))
    kinds = dict(vox.dtypes)
    for axis, n, o in zip("xzy", shape, to, strict=True):
        if n == o:
            continue
        t = spark.createDataFrame(pd.DataFrame(resize_taps(n, o, anti_alias), columns=["o", "i", "w"])).select(F.col("o").cast(kinds[axis]).alias("o"), F.col("i").cast(kinds[axis]).alias(axis), "w")
        rest = [c for c in "xzy" if c != axis]
        out = out.join(t, axis).groupBy(*rest, F.col("o").alias(axis)).agg(F.sum(F.col("w") * F.col("v")).alias("v"))
    return out.select("x", "z", "y", "v")


def register_channels(nuclei: DataFrame, colours: DataFrame, shape: tuple[int, int, int], to: tuple[int, int, int], transforms: dict[int, list[list[float]]]) -> DataFrame:
    """One volume of all channels at the colours' size: channel 0 is the nuclei, resized and turned by 180 degrees; channel k
    is colour k under its own 2-D transform. Stored integers. colours: ch (from 1), x, z, y, v."""
    from lumenfold.operators.arith import clip16, rot180

    first = rot180(resize_volume(nuclei, shape, to), to[1], to[2]).withColumn("ch", F.lit(0))
    rest = [warp_bilinear(colours.where(F.col("ch") == ch), m, to[1], to[2]).withColumn("ch", F.lit(ch)) for ch, m in sorted(transforms.items())]
    for d in rest:
        first = first.unionByName(d)
    return first.select("ch", "x", "z", "y", clip16(F.col("v")).alias("v"))


def block_average(vox: DataFrame, k: int) -> DataFrame:
    """One level of a resolution pyramid."""
    return vox.groupBy(F.expr(f"x div {k}").alias("x"), F.expr(f"cast(z div {k} as int)").alias("z"), F.expr(f"cast(y div {k} as int)").alias("y")).agg(F.avg("v").alias("v"))


def neighbours(kind: int) -> list[tuple[int, int, int]]:
    """Offsets of 6-, 18- or 26-neighbourhoods."""
    most = {6: 1, 18: 2, 26: 3}[kind]
    return [o for o in itertools.product((-1, 0, 1), repeat=3) if 0 < sum(map(abs, o)) <= most]


def dilate(mask: DataFrame, kind: int = 26, steps: int = 1, ring: bool = False, bounds: tuple[int, int, int] | None = None) -> DataFrame:
    """Binary dilation of a set of voxels: each is exploded to its neighbours, then made distinct (no join)."""
    out = mask.select("x", "z", "y")
    offsets = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip("xzy", o, strict=True))) for o in [(0, 0, 0), *neighbours(kind)]))
    for _ in range(steps):
        out = out.withColumn("o", F.explode(offsets)).select(*((F.col(c) + F.col(f"o.{c}")).alias(c) for c in "xzy"))
        if bounds:
            for c, n in zip("xzy", bounds, strict=True):
                out = out.where(F.col(c).between(0, n - 1))
        out = out.distinct()
    return out.join(mask.select("x", "z", "y"), ["x", "z", "y"], "left_anti") if ring else out


def shells(labelled: DataFrame, most: int = 3, bounds: tuple[int, int, int] | None = None) -> DataFrame:
    """label, x, z, y, layer: layer 1 is the object; layer k + 1 are voxels over k - 1 and up to k away from the nearest
    object. Equal distances go to the smallest label. Disjoint by construction."""
    r = range(-most, most + 1)
    near = [(o, o[0] ** 2 + o[1] ** 2 + o[2] ** 2) for o in itertools.product(r, repeat=3) if sum(i * i for i in o) <= most * most]
    offsets = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip("xzy", o, strict=True)), F.lit(d).alias("d")) for o, d in near))
    e = labelled.select("label", "x", "z", "y", F.explode(offsets).alias("o")).select("label", *((F.col(c) + F.col(f"o.{c}")).alias(c) for c in "xzy"), F.col("o.d").alias("d"))
    if bounds:
        for c, n in zip("xzy", bounds, strict=True):
            e = e.where(F.col(c).between(0, n - 1))
    g = e.groupBy("x", "z", "y").agg(F.min(F.struct("d", "label")).alias("m"))
    return g.select("m.label", "x", "z", "y", (F.ceil(F.sqrt(F.col("m.d").cast("double"))) + 1).cast("int").alias("layer"))


def phase_peak(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(dz, dy) that moves b onto a: the peak of their phase correlation."""
    nz, ny = a.shape
    f = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
    c = np.fft.ifft2(f / np.maximum(np.abs(f), 1e-12)).real
    dz, dy = (int(i) for i in np.unravel_index(int(np.argmax(np.round(c, 9))), c.shape))
    return dz - nz if dz > nz // 2 else dz, dy - ny if dy > ny // 2 else dy


def matched_values(source: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Source values replaced by the reference's at the same quantile, linearly interpolated."""
    sv, back, sn = np.unique(source.ravel(), return_inverse=True, return_counts=True)
    rv, rn = np.unique(reference.ravel(), return_counts=True)
    new = np.interp(np.cumsum(sn) / max(sn.sum(), 1), np.cumsum(rn) / max(rn.sum(), 1), rv) if len(rv) else sv
    return new[back].reshape(source.shape)


def equalised(img: np.ndarray, tile: int, clip: float = 0.01, bins: int = 256) -> np.ndarray:
    """Contrast-limited adaptive equalisation: clipped tile histograms, interpolated between tile centres."""
    nz, ny = img.shape
    lo, hi = img.min(), img.max()
    if hi <= lo:
        return np.zeros_like(img, float)
    q = np.minimum(((img - lo) / (hi - lo) * bins).astype(int), bins - 1)
    tz, ty = -(-nz // tile), -(-ny // tile)
    maps = np.zeros((tz, ty, bins))
    for i, j in itertools.product(range(tz), range(ty)):
        h = np.bincount(q[i * tile : (i + 1) * tile, j * tile : (j + 1) * tile].ravel(), minlength=bins).astype(float)
        most = max(1.0, clip * h.sum())
        over = np.maximum(h - most, 0).sum()
        h = np.minimum(h, most) + over / bins
        maps[i, j] = np.cumsum(h) / h.sum()
    gz, gy = np.clip((np.arange(nz) + 0.5) / tile - 0.5, 0, tz - 1), np.clip((np.arange(ny) + 0.5) / tile - 0.5, 0, ty - 1)
    z0, y0 = np.floor(gz).astype(int), np.floor(gy).astype(int)
    z1, y1 = np.minimum(z0 + 1, tz - 1), np.minimum(y0 + 1, ty - 1)
    fz, fy = (gz - z0)[:, None], (gy - y0)[None]
    m = lambda a, b: maps[a[:, None], b[None], q]
    return m(z0, y0) * (1 - fz) * (1 - fy) + m(z0, y1) * (1 - fz) * fy + m(z1, y0) * fz * (1 - fy) + m(z1, y1) * fz * fy


def phase_shift(pairs: DataFrame, nz: int, ny: int) -> DataFrame:
    """(x, dz, dy) that moves plane b onto plane a: the peak of the phase correlation of each frame. pairs: x, z, y, a, b."""

    def one(g: pd.DataFrame) -> pd.DataFrame:
        a, b = np.zeros((nz, ny)), np.zeros((nz, ny))
        a[g.z, g.y], b[g.z, g.y] = g.a, g.b
        dz, dy = phase_peak(a, b)
        return pd.DataFrame({"x": g.x.iloc[:1].reset_index(drop=True), "dz": [dz], "dy": [dy]})

    return pairs.groupBy("x").applyInPandas(one, f"x {dict(pairs.dtypes)['x']}, dz int, dy int")


def match_histogram(source: DataFrame, reference: DataFrame, *keys: str) -> DataFrame:
    """Source values replaced by the reference's at the same quantile (linear interpolation), per key (one plane)."""
    cells = source.select(*keys, "z", "y", "v", F.lit(0).alias("r")).union(reference.select(*keys, "z", "y", "v", F.lit(1).alias("r")))

    def one(g: pd.DataFrame) -> pd.DataFrame:
        s, r = g[g.r == 0], g[g.r == 1]
        return s[[*keys, "z", "y"]].assign(v=matched_values(s.v.to_numpy(float), r.v.to_numpy(float)))

    kinds = dict(source.dtypes)
    return cells.groupBy(*keys).applyInPandas(one, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "z int, y int, v double"]))


def equalise(vox: DataFrame, nz: int, ny: int, tile: int, clip: float = 0.01, bins: int = 256) -> DataFrame:
    """Contrast-limited adaptive equalisation of every frame: clipped tile histograms, interpolated between tile centres."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        img = np.zeros((nz, ny))
        img[g.z, g.y] = g.v
        return g[["x", "z", "y"]].assign(v=equalised(img, tile, clip, bins)[g.z, g.y])

    return vox.groupBy("x").applyInPandas(run, "x long, z int, y int, v double")


def register(moving: DataFrame, fixed: DataFrame, nz: int, ny: int, share: float = 0.9, bins: int = 32) -> DataFrame:
    """One (dz, dy) for a channel: phase shifts of the frames whose mutual information with the fixed channel reaches
    the percentile, then the median. moving, fixed: x, z, y, v."""
    from lumenfold.operators.reduce import median_shift, mutual_information, top_frames

    pairs = fixed.withColumnRenamed("v", "a").join(moving.withColumnRenamed("v", "b"), ["x", "z", "y"])
    best = top_frames(mutual_information(pairs, bins, "x").select("x", F.col("nmi").alias("score")), share)
    return median_shift(phase_shift(pairs.join(best.select("x"), "x", "left_semi"), nz, ny).withColumn("ch", F.lit(0)))



def channel_shifts(volume: DataFrame, reference: int, nz: int, ny: int, every: int = 10, most: int = 1000) -> DataFrame:
    """ch, dz, dy: the median phase shift of every channel against the reference one, from every 10th plane of the middle
    1000. volume: ch, x, z, y, v."""
    from lumenfold.operators.reduce import median_shift

    ends = volume.agg(F.min("x").alias("low"), F.max("x").alias("high")).select(F.expr(f"greatest(low, low + (high - low + 1 - {most}) div 2)").alias("start"), F.lit(1).alias("k"))
    d = volume.withColumn("k", F.lit(1)).join(F.broadcast(ends), "k").where((F.col("x") >= F.col("start")) & (F.col("x") < F.col("start") + most) & ((F.col("x") - F.col("start")) % every == 0)).drop("k", "start")
    fixed = d.where(F.col("ch") == reference).select("x", "z", "y", F.col("v").alias("a"))
    pairs = d.where(F.col("ch") != reference).withColumnRenamed("v", "b").join(fixed, ["x", "z", "y"])
    # a frame of a channel is a frame of its own
    pairs = pairs.withColumn("x", F.struct("ch", "x"))
    return median_shift(phase_shift(pairs, nz, ny).select(F.col("x.ch").alias("ch"), "dz", "dy"))
