"""Element-wise corrections of voxel relations. Masks are (z, y) relations; joins go by named axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.model import U16

EPS = 1e-6


def with_plane(vox: DataFrame, plane: DataFrame, keys: tuple[str, ...] = ("z", "y")) -> DataFrame:
    """Voxels with their pixel of a 2-D image: the relational form of broadcasting along x. Inner: the image must cover
    the volume (see missing_pixels). Spark broadcasts the image while its measured size is below the session's
    threshold and shuffles on the pixel otherwise."""
    return vox.join(plane, list(keys))


def missing_pixels(vox: DataFrame, plane: DataFrame, keys: tuple[str, ...] = ("z", "y")) -> DataFrame:
    """Pixels of the volume that the image lacks; non-empty means the shapes differ."""
    return vox.select(*keys).distinct().join(plane, list(keys), "left_anti")


def clip16(c: Column) -> Column:
    """To 0..65535, then truncated."""
    return F.greatest(F.lit(0), F.least(F.lit(U16), c)).cast("int")


def round16(c: Column) -> Column:
    """To 0..65535, then rounded half to even."""
    return F.rint(F.greatest(F.lit(0), F.least(F.lit(U16), c))).cast("int")


def subtract_background(vox: DataFrame, bg: DataFrame, clamp: bool = False, offset: float = 0.0) -> DataFrame:
    """v - (bg - offset); negative values stay unless clamp."""
    d = F.col("v") - (F.col("bg") - offset)
    return with_plane(vox, bg).withColumn("v", F.greatest(d, F.lit(0.0)) if clamp else d).drop("bg")


def divide_pattern(vox: DataFrame, pattern: DataFrame, eps: float = EPS, keys: tuple[str, ...] = ("z", "y")) -> DataFrame:
    """v / (pattern + eps); null where that is 0."""
    return with_plane(vox, pattern, keys).withColumn("v", F.try_divide(F.col("v").cast("double"), F.col("pattern") + eps)).drop("pattern")


def process_step(vox: DataFrame, bg: DataFrame, pattern: DataFrame) -> DataFrame:
    """Clamped subtraction, then division."""
    return divide_pattern(subtract_background(vox, bg, clamp=True), pattern)


#: Channel of each half (top/bottom by left/right) in the orders in use: rows of (low z, low y), (high z, low y), ...
ORDERS = {"volume": (1, 2, 3, 4), "pattern": (1, 3, 2, 4), "reversed": (4, 3, 2, 1)}


def split_quadrants(vox: DataFrame, cz: int, cy: int, nz: int, ny: int, order: str = "volume") -> DataFrame:
    """ch, and z and y counted from the quadrant's corner, cropped to the common size."""
    a, b, c, d = ORDERS[order]
    low_z, low_y = F.col("z") < cz, F.col("y") < cy
    ch = F.when(low_z & low_y, a).when(low_y, b).when(low_z, c).otherwise(d)
    out = vox.select(*[c for c in vox.columns if c not in ("z", "y")], ch.alias("ch"), F.when(low_z, F.col("z")).otherwise(F.col("z") - cz).alias("z"), F.when(low_y, F.col("y")).otherwise(F.col("y") - cy).alias("y"))
    return out.where((F.col("z") < min(cz, nz - cz)) & (F.col("y") < min(cy, ny - cy)))


def flat_field(vox: DataFrame, by_row: DataFrame, factor: float) -> DataFrame:
    """v / correction of the row * factor, as stored integers."""
    return vox.join(by_row, "z").withColumn("v", clip16(F.try_divide(F.col("v") * F.lit(float(factor)), F.col("corr")))).drop("corr")


def scalar(vox: DataFrame, *aggs: Column) -> DataFrame:
    """vox with global aggregates as columns: a one-row side, joined by a constant key and therefore broadcast."""
    one = vox.agg(*aggs).withColumn("__k", F.lit(1))
    return vox.withColumn("__k", F.lit(1)).join(F.broadcast(one), "__k").drop("__k")


def even_lighting(vox: DataFrame, light: DataFrame) -> DataFrame:
    """v / light, rescaled so that the maximum stays."""
    d = with_plane(vox, light).withColumn("w", F.try_divide(F.col("v").cast("double"), F.col("light")))
    d = scalar(d, F.max("v").alias("m0"), F.max("w").alias("m1"))
    return d.withColumn("v", F.try_divide(F.col("w") * F.col("m0"), F.col("m1"))).drop("w", "m0", "m1", "light")


def minmax16(vox: DataFrame) -> DataFrame:
    """Global minimum to 0 and maximum to 65535, truncated; a constant volume becomes 0."""
    d = scalar(vox, F.min("v").alias("lo"), F.max("v").alias("hi"))
    s = F.floor((F.col("v") - F.col("lo")) * F.lit(float(U16)) / (F.col("hi") - F.col("lo"))).cast("int")
    return d.withColumn("v", F.when(F.col("hi") > F.col("lo"), s).otherwise(0)).drop("lo", "hi")


def zscore(vox: DataFrame, *patch: str) -> DataFrame:
    """(v - mean) / population deviation of each patch; null for constant patches."""
    s = vox.groupBy(*patch).agg(F.avg("v").alias("mu"), F.stddev_pop("v").alias("sd"))
    return vox.join(s, list(patch)).withColumn("v", F.try_divide(F.col("v") - F.col("mu"), F.col("sd"))).drop("mu", "sd")


def roll(vox: DataFrame, dz: int, dy: int, nz: int, ny: int) -> DataFrame:
    return vox.withColumn("z", F.pmod(F.col("z") + dz, F.lit(nz))).withColumn("y", F.pmod(F.col("y") + dy, F.lit(ny)))


def shift_zero(vox: DataFrame, dz: int, dy: int, nz: int, ny: int) -> DataFrame:
    """Shift with zeros moved in: rolled voxels that wrapped around are 0 (no shuffle to fill the gap)."""
    z, y = F.col("z") + dz, F.col("y") + dy
    inside = z.between(0, nz - 1) & y.between(0, ny - 1)
    return roll(vox.withColumn("v", F.when(inside, F.col("v")).otherwise(F.lit(0))), dz, dy, nz, ny)


def rot180(vox: DataFrame, nz: int, ny: int) -> DataFrame:
    return vox.withColumn("z", F.lit(nz - 1) - F.col("z")).withColumn("y", F.lit(ny - 1) - F.col("y"))


def crop(vox: DataFrame, nz: int, ny: int, top: int = 0, bottom: int = 0, left: int = 0, right: int = 0) -> DataFrame:
    """Filter (reaches the scan) and rebase."""
    return vox.where(F.col("z").between(top, nz - bottom - 1) & F.col("y").between(left, ny - right - 1)).withColumn("z", F.col("z") - top).withColumn("y", F.col("y") - left)


def threshold_mask(vox: DataFrame, t: float, strict: bool = True, replicate_constant: bool = False, patch: tuple[str, ...] = ("x",)) -> DataFrame:
    """mask 0/255 of sigmoid(v) over t. replicate_constant: a patch of one value becomes 255 throughout, as rescaling
    between equal bounds would give."""
    p = 1 / (1 + F.exp(-F.col("v")))
    hit = p > t if strict else p >= t
    if not replicate_constant:
        return vox.withColumn("mask", F.when(hit, 255).otherwise(0))
    d = vox.withColumn("hit", hit)
    same = d.groupBy(*patch).agg((F.bool_and("hit") == F.bool_or("hit")).alias("same"))
    return d.join(same, list(patch)).withColumn("mask", F.when(F.col("hit") | F.col("same"), 255).otherwise(0)).drop("hit", "same")


def inpaint(vox: DataFrame, mask: DataFrame, *patch: str) -> DataFrame:
    """Values where the mask is 0 become the patch's median where it is 1."""
    d = vox.join(mask, ["z", "y"])
    med = d.where("m = 1").groupBy(*patch).agg(F.median("v").alias("med"))
    return d.join(med, list(patch), "left").withColumn("v", F.when(F.col("m") == 0, F.col("med")).otherwise(F.col("v").cast("double"))).drop("m", "med")


def pad_ramp(vox: DataFrame, n: int, to: int, axis: str = "y") -> DataFrame:
    """Along an axis from n to a multiple of `to`: the last values fall linearly to 0."""
    pad = -n % to
    if not pad:
        return vox.withColumn("v", F.col("v").cast("double"))
    edge = vox.where(F.col(axis) == n - 1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(pad))))
    more = edge.withColumn(axis, (F.col(axis) + F.col("k")).cast(dict(vox.dtypes)[axis])).withColumn("v", F.col("v") * (1 - F.col("k") / pad)).drop("k")
    return vox.withColumn("v", F.col("v").cast("double")).unionByName(more)


def pad_volume(vox: DataFrame, shape: tuple[int, int, int], to: int = 128) -> DataFrame:
    """All three axes to multiples of `to`, one after the other, so corners fall along every axis that is padded."""
    for axis, n in zip("xzy", shape, strict=True):
        vox = pad_ramp(vox, n, to, axis)
    return vox


def to_units(points: DataFrame, scale: dict[str, float], back: bool = False) -> DataFrame:
    """Pixel coordinates in micrometres (or back)."""
    for c, s in scale.items():
        points = points.withColumn(c, F.col(c) / s if back else F.col(c) * s)
    return points
