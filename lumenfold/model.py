"""Volumes as relations.

Logical form: one row per voxel with named axes (x frame, z row, y column, optionally ch and label) and a value v, so no
operator depends on an axis order. Physical form at scale: blocks(x0, z0, y0, data array<float>), written in Parquet
partitioned by scan and channel; to_voxels() and to_blocks() convert between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOXEL = T.StructType([T.StructField("x", T.LongType()), T.StructField("z", T.IntegerType()), T.StructField("y", T.IntegerType()), T.StructField("v", T.IntegerType())])
#: Largest stored intensity.
U16 = 65535
HEIGHT = WIDTH = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x, z, y, label, v: the vectors as 8 x 8 frames of 12-bit intensities scaled by 16."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("x"), "label", F.posexplode("embedding").alias("p", "e"))
    v = F.greatest(F.lit(0), F.least(F.lit(4095), F.rint((F.col("e").cast("double") + 1) * 2047.5).cast("int"))) * 16
    return e.select("x", F.expr("cast(p div 8 as int)").alias("z"), F.expr("cast(p % 8 as int)").alias("y"), "label", v.alias("v"))


def to_blocks(vox: DataFrame, nx: int, nz: int, ny: int, *keys: str) -> DataFrame:
    """x0, z0, y0 and the block's values in (x, z, y) order; voxels that are missing are null. One shuffle on the key."""
    at = [F.expr(f"{c} - {c} % {n}").alias(f"{c}0") for c, n in (("x", nx), ("z", nz), ("y", ny))]
    place = F.expr(f"cast(((x % {nx}) * {nz} + z % {nz}) * {ny} + y % {ny} as int)")
    g = vox.select(*keys, *at, place.alias("p"), F.col("v").cast("float").alias("v")).groupBy(*keys, "x0", "z0", "y0")
    got = g.agg(F.map_from_entries(F.collect_list(F.struct("p", "v"))).alias("m"))
    return got.select(*keys, "x0", "z0", "y0", F.transform(F.sequence(F.lit(0), F.lit(nx * nz * ny - 1)), lambda i: F.col("m")[i]).alias("data"))


def to_voxels(blocks: DataFrame, nx: int, nz: int, ny: int, *keys: str) -> DataFrame:
    e = blocks.select(*keys, "x0", "z0", "y0", F.posexplode("data").alias("p", "v")).where("v IS NOT NULL")
    return e.select(*keys, F.expr(f"x0 + p div {nz * ny}").alias("x"), F.expr(f"cast(z0 + p div {ny} % {nz} as int)").alias("z"), F.expr(f"cast(y0 + p % {ny} as int)").alias("y"), "v")

