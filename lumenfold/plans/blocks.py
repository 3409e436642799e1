"""Corrections on blocks of stored volumes: arrays stay arrays, so a strip of billions of voxels is a few thousand rows.

Blocks are rows of (x0, z0, y0, nx, nz, ny, data), as a chunked store gives and takes them. Masks and patterns have one
value per pixel of a plane, whatever the number of frames; they travel inside the tasks after a check of their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.sources.store import SCHEMA

#: Most pixels of a plane that travel inside a task (8 bytes each).
PLANE = 1 << 24


def plane_array(pixels: DataFrame, value: str) -> np.ndarray:
    """(z, y, value) of one plane as an array, 0 where a pixel is missing; ValueError for more than PLANE pixels."""
    top = pixels.agg(F.max("z"), F.max("y")).first()
    nz, ny = ((v if v is not None else -1) + 1 for v in top)
    if nz * ny > PLANE:
        raise ValueError(f"a plane of {nz} x {ny} pixels is too large to travel with the tasks")
    p = pixels.select("z", "y", F.col(value).cast("double").alias("v")).toPandas()
    out = np.zeros((nz, ny))
    out[p.z, p.y] = p.v
    return out


def median_plane(blocks: DataFrame, frames: int = 1000) -> DataFrame:
    """z, y, bg: the median of the first frames, pixel by pixel. The blocks of a column of the volume meet in one shuffle of
    arrays, cut to the frames asked for."""

    def one(g: pd.DataFrame) -> pd.DataFrame:
        parts = [np.asarray(r.data).reshape(r.nx, r.nz, r.ny)[: max(0, frames - r.x0)] for r in g.itertuples()]
        m = np.median(np.concatenate(parts), axis=0)
        z, y = np.indices(m.shape).reshape(2, -1)
        return pd.DataFrame({"z": (z + g.z0.iloc[0]).astype("int32"), "y": (y + g.y0.iloc[0]).astype("int32"), "bg": m.ravel()})

    return blocks.where(F.col("x0") < frames).groupBy("z0", "y0").applyInPandas(one, "z int, y int, bg double")


def correct_blocks(blocks: DataFrame, background: np.ndarray | None = None, pattern: np.ndarray | None = None, clamp: bool = False, eps: float = 1e-6, store: bool = True) -> DataFrame:
    """Subtraction of a background (negative values go where clamp), division by a pattern, and, for storing, values cut to
    16 bits and truncated. One kernel call a block, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                z0, y0, nx, nz, ny = (row.column(c)[0].as_py() for c in ("z0", "y0", "nx", "nz", "ny"))
                v = row.column("data").flatten().to_numpy().reshape(nx, nz, ny)
                cut = np.s_[z0 : z0 + nz, y0 : y0 + ny]
                v = v - background[cut] if background is not None else v
                v = np.maximum(v, 0) if clamp else v
                v = v / (pattern[cut] + eps) if pattern is not None else v
                v = np.trunc(np.clip(v, 0, 65535)) if store else v
                data = pa.ListArray.from_arrays(pa.array([0, v.size], pa.int32()), pa.array(np.ravel(v).astype(float)))
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in ("x0", "z0", "y0", "nx", "nz", "ny")), data], ["x0", "z0", "y0", "nx", "nz", "ny", "data"])

    return blocks.select("x0", "z0", "y0", "nx", "nz", "ny", "data").mapInArrow(run, SCHEMA)


def project_blocks(blocks: DataFrame) -> DataFrame:
    """z, y, v_max, v_sum along the frames: each block reduces itself first, so the shuffle has a row per pixel and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                v = np.asarray(r["data"]).reshape(r["nx"], r["nz"], r["ny"])
                z, y = np.indices(v.shape[1:]).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array((z + r["z0"]).astype(np.int32)), pa.array((y + r["y0"]).astype(np.int32)), pa.array(v.max(axis=0).ravel()), pa.array(v.sum(axis=0).ravel())], ["z", "y", "m", "s"])

    return blocks.mapInArrow(run, "z int, y int, m double, s double").groupBy("z", "y").agg(F.max("m").alias("v_max"), F.sum("s").alias("v_sum"))
