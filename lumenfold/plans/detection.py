"""Objects of stored volumes: found, measured and filtered chunk by chunk, without a row per voxel.

A chunk gives one row for each label (and shell) in it, with counts and sums; the rows of an object that lies in several chunks
meet in one aggregation. All steps that write are resumable jobs (plans/store_jobs.py).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.plans.store_jobs import label_store, shell_store
from lumenfold.sources.store import Store, chunks_a_task


def measure_store(spark: SparkSession, labels: str, values: str | None = None, layers: str | None = None, at_once: int | None = None) -> DataFrame:
    """label, layer (1 without layers), n, x, z, y (means) and values (the mean of each channel, in order; empty without values) of
    everything that has a label. labels and layers: stores of one grid; values: a store of the same extent with three or four
    axes, whatever its chunks. A task reads the same box of all of them."""
    src = Store(labels)
    vol, lay = Store(values) if values else None, Store(layers) if layers else None
    for other in (vol, lay):
        if other and list(other.shape[-3:]) != list(src.shape):
            raise ValueError(f"{other.path} and {labels} are of different sizes")
    counts = src.counts()
    total = int(np.prod(counts))
    channels = 0 if vol is None else vol.shape[0] if len(vol.shape) == 4 else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for place in b.column(0).to_pylist():
                low = [int(i) * c for i, c in zip(np.unravel_index(place, counts), src.chunks, strict=True)]
                high = [min(a + c, n) for a, c, n in zip(low, src.chunks, src.shape, strict=True)]
                block = src.box(low, high).astype(np.int64)
                at = np.nonzero(block)
                if not len(at[0]):
                    continue
                layer = lay.box(low, high)[at].astype(np.int64) if lay else np.ones(len(at[0]), np.int64)
                pair, which = np.unique(np.stack([block[at], layer]), axis=1, return_inverse=True)
                which, n = which.ravel(), pair.shape[1]
                sums = [np.bincount(which, a + o, n) for a, o in zip(at, low, strict=True)]
                means = []
                for c in range(channels):
                    v = vol.box([c, *low], [c + 1, *high])[0] if len(vol.shape) == 4 else vol.box(low, high)
                    means.append(np.bincount(which, v[at].astype(float), n))
                arrays = [pa.array(pair[0]), pa.array(pair[1].astype(np.int32)), pa.array(np.bincount(which, minlength=n)), *map(pa.array, sums)]
                flat = np.stack(means, axis=1).ravel() if means else np.zeros(0)
                arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * channels, pa.int32()), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(arrays, ["label", "layer", "n", "sx", "sz", "sy", "sums"])

    at_once = at_once or chunks_a_task(spark, total, int(np.prod(src.chunks)))
    parts = spark.range(0, total, 1, max(1, -(-total // at_once))).mapInArrow(run, "label long, layer int, n long, sx double, sz double, sy double, sums array<double>")
    whole = parts.groupBy("label", "layer").agg(F.sum("n").alias("n"), *(F.sum(f"s{a}").alias(f"s{a}") for a in "xzy"), *(F.sum(F.col("sums")[c]).alias(f"c{c}") for c in range(channels)))
    mean = lambda c: F.col(c) / F.col("n")
    values_ = F.array(*(mean(f"c{c}") for c in range(channels))) if channels else F.array().cast("array<double>")
    return whole.select("label", "layer", "n", *(mean(f"s{a}").alias(a) for a in "xzy"), values_.alias("values"))


def extract_points_store(spark: SparkSession, path: str, out: str, threshold: float, kind: int = 26, least: int = 4) -> DataFrame:
    """label (linear index of the first voxel), area and centroid (two digits) of the components above a threshold that have `least`
    voxels or more. The labels stay as the store `out`."""
    label_store(spark, path, out, threshold, kind)
    m = measure_store(spark, out).where(F.col("n") >= least)
    return m.select((F.col("label") - 1).alias("label"), F.col("n").alias("area"), *((F.rint(F.col(a) * 100) / 100).alias(a) for a in "xzy"))


def spectra_store(spark: SparkSession, labels: str, values: str, out: str, most: int = 3) -> DataFrame:
    """One row per object: label, x, z, y (centre of its own voxels, rounded half to even), vol_l1 and on (voxels of each layer), and
    ch{c}_l{k}: channel c's mean in layer k, from 1 each (empty layers: 0). The shells stay as stores below `out`."""
    shell_store(spark, labels, out, most)
    m = measure_store(spark, f"{out}/label", values, f"{out}/layer")
    channels = Store(values).shape[0] if len(Store(values).shape) == 4 else 1
    in_layer = lambda k, c: F.coalesce(F.max(F.when(F.col("layer") == k, F.col(c))), F.lit(0))
    cols = [in_layer(k, "n").cast("long").alias(f"vol_l{k}") for k in range(1, most + 2)]
    spectra = [F.coalesce(F.max(F.when(F.col("layer") == k, F.col("values")[c])), F.lit(0.0)).alias(f"ch{c + 1}_l{k}") for c in range(channels) for k in range(1, most + 2)]
    return m.groupBy("label").agg(*(F.rint(in_layer(1, a)).cast("long").alias(a) for a in "xzy"), *cols, *spectra)
