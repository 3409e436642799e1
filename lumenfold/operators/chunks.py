"""Chunk grids and pruning. Ids are row-major over (z, y, x); origins are 64-bit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def chunk_grids(volumes: DataFrame, size: float, scale: int = 0) -> DataFrame:
    """The volume's own columns but its shape (nz, ny, nx), and chunk, z0, z1, y0, y1, x0, x1 of all its chunks. Each axis has
    floor(n / size) + 1 chunks, so a divisible one ends with an empty chunk. scale: bounds of a level reduced by 2^scale, rounded
    half to even."""
    own = [c for c in volumes.columns if c not in ("nz", "ny", "nx")]
    d = volumes
    for c in "zyx":
        d = d.withColumn(f"k{c}", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col(f"n{c}") / size).cast("long"))))
    ny, nx = (F.floor(F.col(f"n{c}") / size).cast("long") + 1 for c in "yx")
    d = d.withColumn("chunk", (F.col("kz") * ny + F.col("ky")) * nx + F.col("kx"))
    bounds = []
    for c in "zyx":
        top = F.rint(F.col(f"n{c}") / 2**scale)
        bounds += [F.least(F.rint((F.col(f"k{c}") + o) * (size / 2**scale)), top).cast("long").alias(f"{c}{o}") for o in (0, 1)]
    return d.select(*own, "chunk", *bounds)


def chunk_grid(spark: SparkSession, shape: tuple[int, int, int], size: float, scale: int = 0) -> DataFrame:
    """chunk, z0, z1, y0, y1, x0, x1 of one volume of shape (z, y, x)."""
    return chunk_grids(spark.createDataFrame([tuple(map(int, shape))], "nz long, ny long, nx long"), size, scale)


def chunk_of(shape: tuple[int, int, int], size: int) -> Column:
    _, ny, nx = (n // size + 1 for n in shape)
    return F.expr(f"(cast(z div {size} as long) * {ny} + y div {size}) * {nx} + x div {size}")


def grid_extent(grid: DataFrame, *by: str) -> DataFrame:
    return grid.groupBy(*by).agg(F.max("z1").alias("nz"), F.max("y1").alias("ny"), F.max("x1").alias("nx"))


def foreground(grid: DataFrame, flags: DataFrame) -> DataFrame:
    """Chunks that are neither background nor bright. A chunk without a mask counts as background."""
    drop = grid.select("chunk").join(flags, "chunk", "left").where("coalesce(background, true) OR coalesce(bright, false)").select("chunk")
    return grid.join(drop, "chunk", "left_anti")


def pending(expected: DataFrame, done: DataFrame, key: str = "chunk") -> DataFrame:
    """What is still to do: resume after a lost job."""
    return expected.join(done.select(key).distinct(), key, "left_anti")


def with_halo(vox: DataFrame, size: int, halo: int) -> DataFrame:
    """Voxels with the chunk coordinates (bx, bz, by) of every block that needs them: border voxels go to neighbours too."""
    for c in "xzy":
        vox = vox.withColumn(f"b{c}", F.explode(F.array_distinct(F.array(*(F.expr(f"cast(floor(({c} + {d}) / {size}) as long)") for d in (-halo, 0, halo))))))
    return vox.where("bx >= 0 AND bz >= 0 AND by >= 0")
