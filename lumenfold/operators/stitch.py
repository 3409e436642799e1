"""Tiles to slabs to volumes, by coordinate arithmetic and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenfold.operators.arith import minmax16


def tile_starts(tiles: DataFrame) -> DataFrame:
    """start of every tile of a slab: the widths of the tiles before it. tiles: scan_z, scan_y, width."""
    before = W.partitionBy("scan_z").orderBy("scan_y").rowsBetween(W.unboundedPreceding, -1)
    return tiles.withColumn("start", F.coalesce(F.sum("width").over(before), F.lit(0)))


def slab_pads(slabs: DataFrame, shift: int = -24) -> DataFrame:
    """left and total of sheared slabs: slab i moves by i |shift|; a negative shift moves earlier slabs to the right."""
    rank = F.dense_rank().over(W.orderBy("scan_z")) - 1
    n = F.count("*").over(W.partitionBy())
    i = (n - 1 - rank) if shift < 0 else rank
    return slabs.select("scan_z", "width", (i * abs(shift)).cast("long").alias("left_pad"), (F.col("width") + abs(shift) * (n - 1)).cast("long").alias("total"))


def stitch(vox: DataFrame, tiles: DataFrame, shift: int = -24, slab_height: int = 0, rotate: tuple[int, int] | None = None) -> DataFrame:
    """Voxels of all tiles in one volume: y by the tile's start and the slab's shear, z by the slab's place. The tile
    and slab tables (a row per strip) are small and joined to the voxels; nothing else is shuffled."""
    if rotate:
        vox = vox.withColumn("z", F.lit(rotate[0] - 1) - F.col("z")).withColumn("y", F.lit(rotate[1] - 1) - F.col("y"))
    t = tile_starts(tiles)
    pads = slab_pads(t.groupBy("scan_z").agg(F.sum("width").alias("width")), shift).select("scan_z", "left_pad", (F.dense_rank().over(W.orderBy("scan_z")) - 1).alias("slab"))
    d = vox.join(t.join(pads, "scan_z").select("scan_z", "scan_y", "start", "left_pad", "slab"), ["scan_z", "scan_y"])
    return d.select(*[c for c in vox.columns if c not in ("scan_z", "scan_y", "y", "z")], (F.col("slab") * slab_height + F.col("z")).cast("long").alias("z"), (F.col("start") + F.col("left_pad") + F.col("y")).cast("long").alias("y"))


def renumber_planes(planes: DataFrame) -> DataFrame:
    """Planes of all slabs on end: (largest plane) * (slab - 1) + plane."""
    most = planes.agg(F.max("plane").alias("m")).withColumn("k", F.lit(1))
    rank = F.dense_rank().over(W.orderBy("slab"))
    r = planes.select("slab").distinct().select("slab", rank.alias("r"))
    return planes.join(r, "slab").withColumn("k", F.lit(1)).join(F.broadcast(most), "k").select("slab", "plane", (F.col("m") * (F.col("r") - 1) + F.col("plane")).alias("whole"))


def plane_composite(vox: DataFrame, tiles: DataFrame, z: int, normalise: bool = True) -> DataFrame:
    """One z plane over all strips of a slab, as 16-bit values: the filter on z comes before the join and the scaling."""
    d = vox.where(F.col("z") == z).join(tile_starts(tiles).select("scan_z", "scan_y", "start"), ["scan_z", "scan_y"])
    d = d.select("scan_z", "x", (F.col("start") + F.col("y")).cast("long").alias("y"), "v")
    return minmax16(d) if normalise else d


def find_planes(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """The file of every wanted plane (folder, plane), by the name that it must have; path is null where there is none."""
    name = F.concat(F.col("folder"), F.format_string("/plane_%04d.tif", F.col("plane").cast("long")))
    return wanted.withColumn("path", name).join(files.select("path", F.lit(True).alias("there")), "path", "left").select("folder", "plane", F.when(F.col("there"), F.col("path")).alias("path"))
