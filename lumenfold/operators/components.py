"""Connected components of labelled or binary voxels across blocks, and clusters of points."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.operators.geometry import neighbours
from lumenfold.plans.graph import connected_components, stars
from lumenfold.plans.shared import materialize

#: Voxels of the blocks that one kernel call labels, where a block is smaller.
PACK = 1 << 16


def half_offsets(kind: int) -> list[tuple[int, int, int]]:
    """One of each pair of opposite neighbours."""
    return [o for o in neighbours(kind) if o > (0, 0, 0)]


def linear(nz: int, ny: int):
    return F.expr(f"(cast(x as long) * {nz} + z) * {ny} + y")


def label_components(vox: DataFrame, nz: int, ny: int, kind: int = 26, block: int = 64, by_value: bool = False) -> DataFrame:
    """label for every voxel with v <> 0: the smallest linear index of its component, whatever the block size.
    by_value: only equal values connect."""
    parts, whole = label_parts(vox, nz, ny, kind, block, by_value)
    return parts.join(whole, "part", "left").select("x", "z", "y", "v", F.coalesce("component", "part").alias("label"))


def label_parts(vox: DataFrame, nz: int, ny: int, kind: int = 26, block: int = 64, by_value: bool = False) -> tuple[DataFrame, DataFrame]:
    """The voxels with v <> 0 with their linear index i and the part of a component that they belong to, and (part, component) of the
    parts whose component has another name. A part lies within a block, so that no part is larger than one, however large its component.

    Blocks (several in a row along x, up to PACK voxels) are labelled on their own, with the voxels that touch them from outside, which
    are sent to them as well. So a task finds the links between a part and a voxel of another block itself; a join by that voxel makes
    them edges between parts, and distributed components of those join the pieces."""
    wide = [block * max(1, PACK // (block * min(block, nz) * min(block, ny))), block, block]
    counts = [-(-nz // block), -(-ny // block)]
    half = half_offsets(kind)
    # a neighbour block is before or at the same place along x, as half of the offsets are enough
    around = [d for d in itertools.product((-1, 0), (-1, 0, 1), (-1, 0, 1)) if any(d)]
    kinds = dict(vox.dtypes)

    def axes(i: np.ndarray) -> list[np.ndarray]:
        return [i // (nz * ny), i // ny % nz, i % ny]

    def keys(at: list[np.ndarray]) -> np.ndarray:
        x, z, y = (v // w for v, w in zip(at, wide, strict=True))
        return (x * counts[0] + z) * counts[1] + y

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [b.column(c).to_numpy() for c in "xzy"]
            if any(((v < 0) | (v >= n)).any() for v, n in zip(at[1:], (nz, ny), strict=True)):
                raise ValueError(f"voxels beyond planes of {nz} x {ny}")
            i = (at[0] * nz + at[1]) * ny + at[2]
            key, row = [keys(at)], [np.arange(len(i))]
            first = [v % w == 0 for v, w in zip(at, wide, strict=True)]
            last = [v % w == w - 1 for v, w in zip(at, wide, strict=True)]
            for d in around:
                ok = np.ones(len(i), bool)
                for k, lo, hi in zip(d, first, last, strict=True):
                    ok &= lo if k < 0 else hi if k > 0 else True
                seen = np.flatnonzero(ok)
                to = [v[seen] + k for v, k in zip(at, d, strict=True)]
                inside = (to[1] >= 0) & (to[1] < nz) & (to[2] >= 0) & (to[2] < ny)
                key.append(keys([v[inside] for v in to]))
                row.append(seen[inside])
            key, row = np.concatenate(key), np.concatenate(row)
            order = np.argsort(key, kind="stable")
            found, start = np.unique(key[order], return_index=True)
            ends = pa.array([*start, len(row)] if len(found) else [0], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.ListArray.from_arrays(ends, pa.array(i[row[order]])), pa.ListArray.from_arrays(ends, b.column("v").take(pa.array(row[order])))], ["key", "i", "v"])

    def one(g: pa.Table) -> pa.Table:
        i = np.concatenate([c.flatten().to_numpy() for c in g.column("i").chunks])
        value = pa.concat_arrays([c.flatten() for c in g.column("v").chunks])
        order = np.argsort(i)  # so that the first voxel of a part is its smallest linear index
        i, value = i[order], value.take(pa.array(order))
        at = axes(i)
        own = keys(at) == g.column("key")[0].as_py()
        low = [v.min() - 1 for v in at]  # an empty rim, so that no shift wraps
        size = [int(v.max() - a + 2) for v, a in zip(at, low, strict=True)]
        flat = np.ravel_multi_index([v - a for v, a in zip(at, low, strict=True)], size)
        place = np.full(math.prod(size), -1, np.int64)
        place[flat] = np.arange(len(i))
        v = value.to_numpy(zero_copy_only=False) if by_value else None
        a, b = [], []
        for o in half:
            other = place[flat + (o[0] * size[1] + o[1]) * size[2] + o[2]]
            ok = own & (other >= 0)
            if by_value:
                ok &= v == v[other]
            a.append(np.flatnonzero(ok)), b.append(other[ok])
        a, b = np.concatenate(a), np.concatenate(b)
        inner = own[b]
        up = np.arange(len(i))
        node, root = stars(a[inner], b[inner])
        up[node] = root
        links = np.unique(np.stack([i[up[a[~inner]]], i[b[~inner]]], axis=1), axis=0)
        # the block's voxels with their parts, then the links of parts to voxels outside
        mine, n = np.flatnonzero(own), len(links)
        none = lambda k: pa.nulls(n, k)
        cols = [pa.concat_arrays([pa.array(i[mine]), none(pa.int64())]), pa.concat_arrays([value.take(pa.array(mine)), none(value.type)])]
        cols += [pa.array(np.concatenate([i[up[mine]], links[:, 0]])), pa.concat_arrays([pa.nulls(len(mine), pa.int64()), pa.array(links[:, 1])])]
        return pa.table(cols, ["i", "v", "part", "outside"])

    on = vox.where("v <> 0").select(*(F.col(c).cast("long").alias(c) for c in "xzy"), "v")
    # as many tasks as there are shuffle partitions: packed voxels are too few bytes for Spark to tell the work by
    packed = on.mapInArrow(pack, f"key long, i array<long>, v array<{kinds['v']}>").repartition(int(vox.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    got = materialize(packed.groupBy("key").applyInArrow(one, f"i long, v {kinds['v']}, part long, outside long"), "parts")
    parts = got.where("outside IS NULL").select(F.expr(f"i div {nz * ny}").cast(kinds["x"]).alias("x"), F.expr(f"cast(i div {ny} % {nz} as int)").alias("z"), F.expr(f"cast(i % {ny} as int)").alias("y"), "v", "i", "part")
    # only voxels on a face between blocks are seen from outside
    rim = " OR ".join(f"{c} % {w} IN (0, {w - 1})" for c, w, n in zip("xzy", wide, (None, nz, ny), strict=True) if n is None or n > w)
    seen = parts.where(rim).select(F.col("i").alias("outside"), F.col("part").alias("b"))
    pairs = got.where("outside IS NOT NULL").select(F.col("part").alias("a"), "outside").join(seen, "outside").select("a", "b")
    return parts, connected_components(pairs).where("node <> component").withColumnRenamed("node", "part")


def drop_small(labelled: DataFrame, least: int = 4) -> DataFrame:
    keep = labelled.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("label")
    return labelled.join(keep, "label", "left_semi")


def number_labels(labelled: DataFrame) -> DataFrame:
    """Labels 1, 2, ... by smallest voxel: positions within ranges of the label plus the counts of the ranges before."""
    from pyspark.sql import Window as W

    ids = labelled.select("label").distinct().withColumn("r", F.expr("label div 1048576"))
    size = ids.groupBy("r").agg(F.count("*").alias("c"))
    start = size.withColumn("s", F.coalesce(F.sum("c").over(W.orderBy("r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("r", "s")
    named = ids.join(start, "r").select("label", (F.col("s") + F.row_number().over(W.partitionBy("r").orderBy("label"))).alias("object"))
    return labelled.join(named, "label")


def containing(loose: DataFrame, strict: DataFrame, least: int = 3) -> DataFrame:
    """Loose components that wholly contain `least` strict ones or more: overlap counts against sizes by hash joins."""
    size = strict.groupBy(F.col("label").alias("s")).agg(F.count("*").alias("size"))
    both = loose.select("x", "z", "y", F.col("label").alias("l")).join(strict.select("x", "z", "y", F.col("label").alias("s")), ["x", "z", "y"])
    inside = both.groupBy("l", "s").agg(F.count("*").alias("n")).join(size, "s").where("n = size")
    return inside.groupBy("l").agg(F.count("*").alias("parts")).where(F.col("parts") >= least).select(F.col("l").alias("label"), "parts")


def near_cells(sites: DataFrame, eps: float, axes: tuple[str, ...]) -> DataFrame:
    """(a, b) of cells of which some points are at most eps apart. sites: the axes, the cell of each point (g_ and an axis) and the id
    of the cell, rep. A point is sent to the half of the cells around its own that are within reach, and pairs of points become pairs
    of cells before they are shuffled."""
    side = cell_side(eps, axes)
    half = [o for o in itertools.product((-2, -1, 0, 1, 2), repeat=len(axes)) if o > (0,) * len(axes)]
    around = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(axes, o, strict=True))) for o in half))
    left = sites.select(F.col("rep").alias("a"), *(F.col(c).alias(f"a_{c}") for c in axes), *(F.col(f"g_{c}").alias(f"h_{c}") for c in axes), F.explode(around).alias("o"))
    # from the point to the nearest place of the cell, along each axis
    gap = lambda c: F.when(F.col(f"o.{c}") > 0, (F.col(f"h_{c}") + F.col(f"o.{c}")) * side - F.col(f"a_{c}")).when(F.col(f"o.{c}") < 0, F.col(f"a_{c}") - (F.col(f"h_{c}") + F.col(f"o.{c}") + 1) * side).otherwise(0.0)
    left = left.where(sum((gap(c) * gap(c) for c in axes), F.lit(0.0)) <= eps * eps * (1 + 1e-6))
    left = left.select("a", *(f"a_{c}" for c in axes), *((F.col(f"h_{c}") + F.col(f"o.{c}")).alias(f"g_{c}") for c in axes))
    d = sum(((F.col(c) - F.col(f"a_{c}")) * (F.col(c) - F.col(f"a_{c}")) for c in axes), F.lit(0.0))
    # a merge join: no side of it goes through the driver
    return left.join(sites.hint("merge"), [f"g_{c}" for c in axes]).where(d <= eps * eps).select("a", F.col("rep").alias("b")).distinct()


def cell_side(eps: float, axes: tuple[str, ...]) -> float:
    """Side of cells whose points are all within eps of each other, with some room for rounding."""
    return eps / len(axes) ** 0.5 * (1 - 1e-6)


def clusters(points: DataFrame, eps: float, axes: tuple[str, ...] = ("x", "z", "y")) -> DataFrame:
    """id, cluster (smallest id within reach): density clustering with single-point cores is components of the eps-graph.

    Points at one place are one site, and sites of a cell of diagonal eps are one node, so that crowded places don't make a link for
    every pair of points. Points without a finite place stay alone."""
    finite = " AND ".join(f"abs(cast({c} as double)) < cast('Infinity' as double)" for c in axes)
    side = cell_side(eps, axes)
    cells = [F.floor(F.col(c) / side).cast("long").alias(f"g_{c}") for c in axes]
    sites = points.where(finite).groupBy(*axes).agg(F.min("id").alias("id")).select("id", *axes, *cells)
    reps = sites.groupBy(*(f"g_{c}" for c in axes)).agg(F.min("id").alias("rep"))
    sites = materialize(sites.join(reps.hint("merge"), [f"g_{c}" for c in axes]), "sites")
    cc = connected_components(near_cells(sites, eps, axes))
    named = sites.select("rep", *axes).join(cc.hint("merge").withColumnRenamed("node", "rep"), "rep", "left").select(*axes, F.coalesce("component", "rep").alias("cluster"))
    return points.join(named.hint("merge"), list(axes), "left").select("id", *axes, F.coalesce("cluster", "id").alias("cluster"))


def cluster_centres(clustered: DataFrame, axes: tuple[str, ...] = ("x", "z", "y")) -> DataFrame:
    return clustered.groupBy("cluster").agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in axes))


def box_mean(points: DataFrame, vox: DataFrame, size: tuple[int, int, int], shape: tuple[int, int, int], cell: int = 64) -> DataFrame:
    """Mean value in the clipped box around each point, per channel where there is one. A range join: points are dealt
    to the coarse cells that their box touches, voxels lie in one, and the bounds are checked there."""
    lo = [F.greatest(F.lit(0), F.rint(c).cast("long") - s // 2) for c, s in zip(("px", "pz", "py"), size, strict=True)]
    p = points
    for c, a, s, n in zip("xzy", lo, size, shape, strict=True):
        p = p.withColumn(f"lo_{c}", a).withColumn(f"hi_{c}", F.least(F.lit(n), F.col(f"lo_{c}") + s)).withColumn(f"c_{c}", F.explode(F.sequence(F.expr(f"lo_{c} div {cell}"), F.expr(f"greatest(lo_{c} div {cell}, (hi_{c} - 1) div {cell})"))))
    v = vox.select("*", *(F.expr(f"cast({c} div {cell} as long)").alias(f"c_{c}") for c in "xzy"))
    inside = " AND ".join(f"{c} >= lo_{c} AND {c} < hi_{c}" for c in "xzy")
    by = ["id", *(["ch"] if "ch" in vox.columns else [])]
    got = v.join(p, ["c_x", "c_z", "c_y"]).where(inside).groupBy(*by).agg(F.avg("v").alias("mean"), F.count("*").alias("n"))
    return points.select("id").join(got, "id", "left").na.fill(0.0, ["mean"]).na.fill(0, ["n"])
