"""Reductions of voxel relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.operators.arith import scalar


def median_mask(vox: DataFrame, frames: int = 1000, name: str = "bg") -> DataFrame:
    """Exact median over the first frames of every pixel. The bound on frames bounds the values held for a pixel."""
    return vox.where(F.col("x") < frames).groupBy("z", "y").agg(F.median("v").alias(name))


def mean_mask(vox: DataFrame, start: int, stop: int) -> DataFrame:
    """Rounded mean of a range of frames."""
    return vox.where(F.col("x").between(start, stop - 1)).groupBy("z", "y").agg(F.rint(F.avg("v")).alias("bg"))


def flat_chain(vox: DataFrame, dark: DataFrame, frames: int = 1000, pedestal: float = 1024.0) -> DataFrame:
    """Median, minus (dark - pedestal), over its own median."""
    m = median_mask(vox, frames, "m").join(dark, ["z", "y"]).select("z", "y", (F.col("m") - (F.col("bg") - pedestal)).alias("m"))
    return scalar(m, F.median("m").alias("g")).select("z", "y", F.try_divide("m", "g").alias("flat"))


def interior_normalise(image: DataFrame, value: str, margin: int, nz: int, ny: int, *keys: str) -> DataFrame:
    """(v - min) / (max - min), bounds taken inside a margin, per key (at least one)."""
    inner = image.where(F.col("z").between(margin, nz - margin - 1) & F.col("y").between(margin, ny - margin - 1))
    b = inner.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    d = image.join(b, list(keys))
    return d.withColumn(value, F.try_divide(F.col(value) - F.col("lo"), F.col("hi") - F.col("lo"))).drop("lo", "hi")


def smooth_profile(profile: DataFrame, n: int, sigma: float) -> DataFrame:
    """Gaussian over y with reflected edges, cut at 4 sigma: a fixed number of taps a position, joined by source."""
    r = int(4 * sigma + 0.5)
    w = F.exp(-0.5 * F.pow(F.col("k") / sigma, 2))
    t = profile.select(F.col("y").alias("t"))
    src = F.pmod(F.col("t") + F.col("k"), F.lit(2 * n))
    src = F.when(src >= n, F.lit(2 * n - 1) - src).otherwise(src)
    taps = t.select("t", F.explode(F.sequence(F.lit(-r), F.lit(r))).alias("k")).select("t", src.cast("int").alias("y"), w.alias("w"))
    return taps.join(profile, "y").groupBy("t").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("s")).withColumnRenamed("t", "y")


def contrast_profile(vox: DataFrame, ny: int, frames: int = 1000) -> DataFrame:
    """Column medians p over their smoothed profile s: ((p / s - 1) / 3) + 1."""
    p = vox.where(F.col("x") < frames).groupBy("y").agg(F.median("v").alias("v"))
    return p.join(smooth_profile(p, ny, ny / 10), "y").select("y", (((F.col("v") / F.col("s")) - 1) / 3 + 1).alias("contrast"))


def channel_max(patterns: DataFrame, floor: float = 1e-6) -> DataFrame:
    """Patterns over the maximum of their laser and channel."""
    m = patterns.groupBy("laser", "ch").agg(F.greatest(F.max("v"), F.lit(floor)).alias("m"))
    return patterns.join(m, ["laser", "ch"]).withColumn("v", F.col("v") / F.col("m")).drop("m")


def final_normalise(mixed: DataFrame) -> DataFrame:
    """Per channel: over (mean - min), plus 1, over the new mean."""
    s = mixed.groupBy("ch").agg(F.avg("v").alias("mu"), F.min("v").alias("lo"))
    d = mixed.join(s, "ch").withColumn("v", F.try_divide("v", F.col("mu") - F.col("lo")) + 1).drop("mu", "lo")
    s = d.groupBy("ch").agg(F.avg("v").alias("mu"))
    return d.join(s, "ch").withColumn("v", F.col("v") / F.col("mu")).drop("mu")


def project(vox: DataFrame, *axes: str) -> DataFrame:
    """Maximum, mean, sum and median along the axes not named."""
    return vox.groupBy(*axes).agg(F.max("v").alias("v_max"), F.avg("v").alias("v_mean"), F.sum("v").alias("v_sum"), F.median("v").alias("v_median"))


def project_all(vox: DataFrame) -> DataFrame:
    """Maximum and sum along each of the three axes in one pass by grouping sets."""
    g = vox.groupingSets([["z", "y"], ["x", "y"], ["x", "z"]], "x", "z", "y")
    return g.agg(F.max("v").alias("v_max"), F.sum("v").alias("v_sum"))


def label_stats(vox: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Voxel count, mean value and centroid (2 decimals, half to even) of every label; labels of the list that don't
    occur have count and mean 0."""
    r = lambda c: (F.rint(F.avg(c) * 100) / 100).alias(f"c_{c}")
    s = vox.groupBy("label").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), r("x"), r("z"), r("y"))
    if labels is None:
        return s
    return labels.join(s, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("mean", F.lit(0.0)).alias("mean"), "c_x", "c_z", "c_y")


def label_voxels(vox: DataFrame) -> DataFrame:
    """The voxels of every label, in order, with their number in it: a list without collecting one."""
    from pyspark.sql import Window as W

    return vox.select("label", "x", "z", "y", (F.row_number().over(W.partitionBy("label").orderBy("x", "z", "y")) - 1).alias("i"))


def chunk_flags(vox: DataFrame) -> DataFrame:
    """Per chunk: background (no voxel set) and bright (no voxel unset)."""
    return vox.groupBy("chunk").agg((~F.bool_or(F.col("v") > 0)).alias("background"), F.bool_and(F.col("v") > 0).alias("bright"))


def median_shift(shifts: DataFrame) -> DataFrame:
    return shifts.groupBy("ch").agg(F.rint(F.median("dz")).cast("int").alias("dz"), F.rint(F.median("dy")).cast("int").alias("dy"))


def geometric_shift(shifts: DataFrame, offset: float) -> DataFrame:
    """exp(mean(ln(d + offset))) - offset."""
    g = lambda c: (F.exp(F.avg(F.ln(F.col(c) + offset))) - offset).alias(c)
    return shifts.groupBy("ch").agg(g("dz"), g("dy"))


def percentiles(vox: DataFrame, at: list[float]) -> DataFrame:
    a = F.percentile("v", F.array(*(F.lit(p / 100) for p in at))).alias("q")
    return vox.agg(a).select(F.explode(F.arrays_zip(F.array(*(F.lit(float(p)) for p in at)).alias("p"), F.col("q"))).alias("s")).select("s.p", "s.q")


def top_frames(scores: DataFrame, share: float = 0.9) -> DataFrame:
    """Frames whose score reaches the percentile (linear interpolation)."""
    return scalar(scores, F.percentile("score", F.lit(share)).alias("cut")).where("score >= cut").drop("cut")


def mutual_information(pairs: DataFrame, bins: int = 100, *keys: str) -> DataFrame:
    """Normalised mutual information (H(a) + H(b)) / H(a, b) of two aligned images per key, by binned counts."""
    b = pairs.groupBy(*keys).agg(*(f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("lo", F.min), ("hi", F.max))))

    def bin_of(c: str):
        w = F.col(f"hi_{c}") - F.col(f"lo_{c}")
        return F.when(w > 0, F.least(F.lit(bins - 1), F.floor((F.col(c) - F.col(f"lo_{c}")) * bins / w))).otherwise(0).cast("int")

    h = pairs.join(b, list(keys)).select(*keys, bin_of("a").alias("ba"), bin_of("b").alias("bb")).groupBy(*keys, "ba", "bb").agg(F.count("*").alias("n"))

    def entropy(*by: str) -> DataFrame:
        g = h.groupBy(*keys, *by).agg(F.sum("n").alias("n"))
        t = g.groupBy(*keys).agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.ln("n")).alias("s"))
        return t.select(*keys, (F.ln("t") - F.col("s") / F.col("t")).alias("h_" + "_".join(by)))

    out = entropy("ba").join(entropy("bb"), list(keys)).join(entropy("ba", "bb"), list(keys))
    return out.select(*keys, F.when(F.col("h_ba_bb") > 1e-12, (F.col("h_ba") + F.col("h_bb")) / F.col("h_ba_bb")).otherwise(1.0).alias("nmi"))


def error_logs(lines: DataFrame, word: str = "Traceback") -> DataFrame:
    """Files and lines that hold the word."""
    return lines.where(F.col("line").contains(word)).agg(F.countDistinct("file").alias("files"), F.count("*").alias("lines"))
