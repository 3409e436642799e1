"""The relational tail: coordinates and measurements of objects from many chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

AXES = ("axis_0", "axis_1", "axis_2")


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in a total order, by partial aggregation rather than a sort of the group."""
    rest = [c for c in df.columns if c not in keys]
    o = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*o)).alias("r")).select(*keys, "r.*").select(*df.columns)


def keep_largest(df: DataFrame, keys: list[str], size: str, order: list[str]) -> DataFrame:
    """The row with the largest size; ties and a missing column go by order."""
    return keep_first(df, keys, [-F.col(size), *order] if size in df.columns else order)


def keep_mean(df: DataFrame, keys: list[str], drop: tuple[str, ...] = ("chunk",)) -> DataFrame:
    """Means of all other numeric columns; NaN counts as missing."""
    num = [c for c, t in df.dtypes if c not in keys and c not in drop and t in ("int", "bigint", "double", "float")]
    return df.groupBy(*keys).agg(*(F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))).alias(c) for c in num))


def offset_labels(df: DataFrame) -> DataFrame:
    """label + the labels used by earlier chunks: a running sum over one row per chunk; empty chunks add 0."""
    most = df.groupBy("chunk").agg(F.max("label").alias("m"))
    run = most.select("chunk", F.coalesce(F.sum("m").over(W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
    return df.join(run, "chunk").withColumn("label", F.col("label") + F.col("shift")).drop("shift")


def reindex(df: DataFrame, order: list[str], part: str) -> DataFrame:
    """Row numbers 0, 1, ... in the order (part first): numbers within a part plus the sizes of the parts before."""
    size = df.groupBy(part).agg(F.count("*").alias("n"))
    start = size.select(part, F.coalesce(F.sum("n").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("s"))
    return df.join(start, part).withColumn("index", F.col("s") + F.row_number().over(W.partitionBy(part).orderBy(*order)) - 1).drop("s")


def combine_points(points: DataFrame, grid: DataFrame, extent: tuple[int, int, int], dedupe: bool = True) -> DataFrame:
    """Chunk-local points (z, y, x) in whole-volume voxels: offset by the chunk's origin, rounded half to even, clipped,
    deduplicated by (chunk, row), renamed to axis_0 (x), axis_1 (z), axis_2 (y). Points of unknown chunks are an error
    of the caller (see unknown_chunks)."""
    d = points.join(grid.select("chunk", "z0", "y0", "x0"), "chunk")
    whole = {c: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.rint(F.col(c) + F.col(f"{c}0")).cast("long"))) for c, n in zip("zyx", extent, strict=True)}
    d = d.select("chunk", "row", whole["x"].alias("axis_0"), whole["z"].alias("axis_1"), whole["y"].alias("axis_2"))
    return keep_first(d, list(AXES), ["chunk", "row"]).select(*AXES) if dedupe else d.select(*AXES)


def unknown_chunks(points: DataFrame, grid: DataFrame) -> DataFrame:
    return points.select("chunk").distinct().join(grid.select("chunk"), "chunk", "left_anti")


def scale_points(points: DataFrame, grid: DataFrame, target: tuple[int, int, int], source: tuple[int, int, int]) -> DataFrame:
    """Points found at another resolution: origin plus coordinate, times target over source shape."""
    d = points.join(grid.select("chunk", "z0", "y0", "x0"), "chunk")
    return d.select("chunk", "row", *(F.rint((F.col(c) + F.col(f"{c}0")) * (t / s)).cast("long").alias(c) for c, t, s in zip("zyx", target, source, strict=True)))


def merge_measurements(df: DataFrame, background: DataFrame, grid: DataFrame, xy_factor: float) -> DataFrame:
    """Measured chunks that aren't background, coordinates divided by the factor plus the origin, labels made unique."""
    d = df.join(background, "chunk", "left_anti").join(grid.select("chunk", "z0", "y0", "x0"), "chunk")
    d = d.withColumn("z", F.col("z") + F.col("z0")).withColumn("y", F.col("y") / xy_factor + F.col("y0")).withColumn("x", F.col("x") / xy_factor + F.col("x0"))
    return offset_labels(d.drop("z0", "y0", "x0"))


def combine_spectra(df: DataFrame, strategy: str = "first") -> DataFrame:
    """Measurements of overlapping chunks: rounded coordinates, one row each by `first`, `max_vol_l1` or `mean`."""
    for c in AXES:
        df = df.withColumn(c, F.rint(c).cast("long"))
    if strategy == "mean":
        return keep_mean(df, list(AXES), ("chunk", "row"))
    return keep_largest(df, list(AXES), "vol_l1" if strategy == "max_vol_l1" else "", ["chunk", "row"]).drop("chunk", "row")


def union_masks(*masks: DataFrame) -> DataFrame:
    """Voxels set in any mask."""
    return reduce(DataFrame.unionByName, masks).where("v > 0").select("x", "z", "y").distinct()


def missing_tiles(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(found.select(*keys).distinct(), keys, "left_anti")


def key_mismatch(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has."""
    x, y = a.select(key).distinct().withColumn("in_a", F.lit(True)), b.select(key).distinct().withColumn("in_b", F.lit(True))
    return x.join(y, key, "full_outer").where("in_a IS NULL OR in_b IS NULL").select(key, F.coalesce("in_a", F.lit(False)).alias("in_a"))


def spectral_table(layers: DataFrame, vox: DataFrame) -> DataFrame:
    """One row per object: coordinates (2 decimals), voxels of every layer, mean of every channel in every layer.

    layers: label, x, z, y, layer 1 to 4; vox: ch 1 to 5. One join on the voxel and one aggregation with a fixed pivot."""
    d = layers.join(vox.select("x", "z", "y", "ch", "v"), ["x", "z", "y"])
    first = F.col("ch") == F.lit(1)
    where = lambda k, *more: reduce(lambda p, q: p & q, more, F.col("layer") == k)
    r = lambda c: F.rint(F.avg(F.when((F.col("layer") == 1) & first, F.col(c))) * 100) / 100
    vols = [F.count(F.when(where(k, first), 1)).alias(f"vol_l{k}") for k in range(1, 5)]
    means = [F.coalesce(F.avg(F.when(where(k, F.col("ch") == c), F.col("v"))), F.lit(0.0)).alias(f"ch{c}_l{k}") for c in range(1, 6) for k in range(1, 5)]
    return d.groupBy("label").agg(r("x").alias("axis_0"), r("z").alias("axis_1"), r("y").alias("axis_2"), *vols, *means)


def route_files(files: DataFrame) -> DataFrame:
    """Where each file of (path, name) belongs: a folder per channel, files without a channel stay where they are."""
    from lumenfold.functions.names import channel_number

    ch = channel_number(F.col("name"))
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.select("path", "name", F.when(ch.isNotNull(), F.concat(folder, F.lit("/ch"), ch, F.lit("/"), F.col("name"))).otherwise(F.col("path")).alias("target"))


def log_spans(lines: DataFrame) -> DataFrame:
    """file, first and last time, seconds between, lines with a time. lines: file, line."""
    from lumenfold.functions.names import log_time

    t = lines.select("file", log_time(F.col("line")).alias("t")).where("t IS NOT NULL")
    g = t.groupBy("file").agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count("*").alias("n"))
    return g.select("file", "first", "last", (F.unix_timestamp("last") - F.unix_timestamp("first")).alias("seconds"), "n")
