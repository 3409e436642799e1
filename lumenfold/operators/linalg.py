"""Small matrices as (i, j, v) relations, and their application to voxels."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Laser powers, current and earlier.
LASER_POWER = [0.3276, 1.1894, 1.1290, 3.0164]
LASER_POWER_EARLIER = [0.10, 0.44, 0.40, 1.08]


def matrix(spark: SparkSession, rows: list[list[float]]) -> DataFrame:
    """(i, j, v) of a small dense matrix, as literal rows."""
    cells = ", ".join(f"({i}, {j}, {float(v)!r}D)" for i, r in enumerate(rows) for j, v in enumerate(r))
    return spark.sql(f"SELECT * FROM VALUES {cells} AS t(i, j, v)")


def row_normalise(m: DataFrame) -> DataFrame:
    s = m.groupBy("i").agg(F.sum("v").alias("s"))
    return m.join(s, "i").select("i", "j", F.try_divide("v", "s").alias("v"))


def laser_weights(flch: DataFrame, excitation: DataFrame, power: list[float]) -> DataFrame:
    """(laser, ch, w) = power / max(power) * excitation transposed times the row-normalised channel shares."""
    spark = flch.sparkSession
    p = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({i}, {x / max(power)!r}D)" for i, x in enumerate(power)) + " AS p(laser, power)")
    a = excitation.select(F.col("i").alias("fluor"), F.col("j").alias("laser"), F.col("v").alias("e"))
    b = row_normalise(flch).select(F.col("i").alias("fluor"), F.col("j").alias("ch"), F.col("v").alias("f"))
    return a.join(b, "fluor").groupBy("laser", "ch").agg(F.sum(F.col("e") * F.col("f")).alias("w")).join(F.broadcast(p), "laser").select("laser", "ch", (F.col("w") * F.col("power")).alias("w"))


def mix(patterns: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted sum over lasers of (laser, z, y, v) per channel; the weights are one row per laser and channel."""
    return patterns.join(weights, "laser").groupBy("ch", "z", "y").agg(F.sum(F.col("v") * F.col("w")).alias("v"))


def inverse(rows: list[list[float]]) -> list[list[float]]:
    return np.linalg.inv(np.array(rows)).tolist()


def unmix(wide: DataFrame, m: list[list[float]], columns: list[str]) -> DataFrame:
    """Transposed inverse of m applied to the channel columns: linear expressions with literal coefficients, no shuffle."""
    inv = inverse(m)
    out = [sum((F.col(c) * F.lit(inv[j][i]) for j, c in enumerate(columns)), F.lit(0.0)).alias(f"u_{columns[i]}") for i in range(len(columns))]
    return wide.select(*[c for c in wide.columns if c not in columns], *out)


def nonnegative_least_squares(v: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact minima of |a u - v| over u >= 0 for many right-hand sides: of all sets of free unknowns (2^n for n columns) the
    one whose least-squares solution is feasible and has no descent direction left, tested for all rows at once."""
    n = a.shape[1]
    best, out = np.full(len(v), np.inf), np.zeros((len(v), n))
    for chosen in range(1 << n):
        free = [i for i in range(n) if chosen >> i & 1]
        u = np.zeros((len(v), n))
        if free:
            u[:, free] = v @ np.linalg.pinv(a[:, free]).T
        error = ((u @ a.T - v) ** 2).sum(axis=1)
        better = (u >= 0).all(axis=1) & (error < best)
        best[better], out[better] = error[better], u[better]
    return out


def unmix_nonnegative(wide: DataFrame, m: list[list[float]], columns: list[str]) -> DataFrame:
    """Least squares with non-negative results, exact, over whole Arrow batches."""
    a = np.array(m, float).T
    keep = [c for c in wide.columns if c not in columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            u = nonnegative_least_squares(b[columns].to_numpy(float), a)
            yield b[keep].assign(**{f"u_{c}": u[:, i] for i, c in enumerate(columns)})

    kinds = dict(wide.dtypes)
    return wide.mapInPandas(run, ", ".join([*(f"{c} {kinds[c]}" for c in keep), *(f"u_{c} double" for c in columns)]))


def illumination_inverse(wide: DataFrame, lasers: list[list[list[float]]], columns: list[str], light: list[str]) -> DataFrame:
    """Per voxel: G = sum over lasers of diag(light) Q, then pinv(G) times the channels; zeros where G is singular.

    lasers: a matrix Q per laser; light: a column per laser with the local intensity of it."""
    q = np.array(lasers, float)
    keep = [c for c in wide.columns if c not in columns + light]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            g = np.einsum("nl,lij->nij", b[light].to_numpy(float), q)
            ok = np.abs(np.linalg.det(g)) > 1e-12
            out = np.zeros((len(b), len(columns)))
            if ok.any():
                out[ok] = np.einsum("nij,nj->ni", np.linalg.pinv(g[ok]), b[columns].to_numpy(float)[ok])
            yield b[keep].assign(**{f"u_{c}": out[:, i] for i, c in enumerate(columns)})

    kinds = dict(wide.dtypes)
    return wide.mapInPandas(run, ", ".join([*(f"{c} {kinds[c]}" for c in keep), *(f"u_{c} double" for c in columns)]))


def compose_affine(scale=(1.0, 1.0, 1.0), translate=(0.0, 0.0, 0.0), rotation=0.0, shear=0.0, deskew=0.0, tx: float = 0.0) -> np.ndarray:
    """4 x 4 over (z, y, x): scale and translation, in-plane rotation, shear and the stage's deskew; angles in degrees."""
    r, s, d = (math.radians(a) for a in (rotation, shear, deskew))
    scaled = np.diag([*scale, 1.0])
    scaled[:3, 3] = translate
    turned, sheared, skewed = np.eye(4), np.eye(4), np.eye(4)
    turned[:2, :2] = [[math.cos(r), -math.sin(r)], [math.sin(r), math.cos(r)]]
    sheared[0, 1] = math.tan(s)
    skewed[2, 0], skewed[2, 3] = math.tan(d), tx
    return scaled @ turned @ sheared @ skewed
