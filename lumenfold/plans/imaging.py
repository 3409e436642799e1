"""End-to-end plans of the imaging side; each stage is a lazy relation, written only where a later job resumes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.operators import arith, components, detect, geometry, linalg, reduce, tables


@dataclass(frozen=True)
class Config:
    """All parameters of a run, passed explicitly."""

    frames: int = 1000
    nz: int = 8
    ny: int = 8
    cz: int = 4
    cy: int = 4
    clamp: bool = False
    order: str = "volume"
    threshold: float = 0.999
    least_voxels: int = 4
    stages: tuple[str, ...] = ("background", "laser")
    shift: dict[int, tuple[int, int]] = field(default_factory=dict)


def correct(vox: DataFrame, cfg: Config, pattern: DataFrame | None = None) -> DataFrame:
    """Background from the first frames, subtraction, illumination correction, stored integers."""
    out = vox
    if "background" in cfg.stages:
        out = arith.subtract_background(out, reduce.median_mask(vox, cfg.frames), cfg.clamp)
    if "laser" in cfg.stages and pattern is not None:
        out = arith.divide_pattern(out, pattern)
    return out.withColumn("v", arith.clip16(F.col("v")))


def correct_and_project(vox: DataFrame, cfg: Config) -> DataFrame:
    """Corrected maximum projection along the frames."""
    return correct(vox, cfg).groupBy("z", "y").agg(F.max("v").alias("v_max"), F.sum("v").alias("v_sum"))


def colours(vox: DataFrame, cfg: Config, pattern: DataFrame) -> DataFrame:
    """Quadrants as channels, corrected by channel and pixel, shifted by each channel's registration."""
    ch = arith.split_quadrants(vox, cfg.cz, cfg.cy, cfg.nz, cfg.ny, cfg.order)
    d = arith.divide_pattern(ch, pattern, keys=("ch", "z", "y"))
    nz, ny = min(cfg.cz, cfg.nz - cfg.cz), min(cfg.cy, cfg.ny - cfg.cy)
    dz = dy = F.lit(0)
    for c, (a, b) in cfg.shift.items():
        dz, dy = F.when(F.col("ch") == c, a).otherwise(dz), F.when(F.col("ch") == c, b).otherwise(dy)
    return d.withColumn("z", F.pmod(F.col("z") + dz, F.lit(nz))).withColumn("y", F.pmod(F.col("y") + dy, F.lit(ny)))


def unmixed(vox: DataFrame, m: list[list[float]]) -> DataFrame:
    n = len(m)
    wide = vox.groupBy("x", "z", "y").pivot("ch", list(range(1, n + 1))).agg(F.first("v"))
    names = [f"c{i}" for i in range(1, n + 1)]
    return linalg.unmix(wide.toDF("x", "z", "y", *names), m, names)


def detect_and_measure(vox: DataFrame, channels: DataFrame, cfg: Config, scorer: detect.Scorer, patch: int = 64) -> DataFrame:
    """Scores, mask, components, shells and the spectral table."""
    mask = detect.mask_of(detect.score_patches(vox, scorer, patch), cfg.threshold)
    objects = components.drop_small(components.label_components(mask, cfg.nz, cfg.ny, block=patch), cfg.least_voxels)
    return tables.spectral_table(geometry.shells(objects.select("label", "x", "z", "y"), 3), channels)
