"""Dense volumes as voxel tables (z, y, x, v): slices, orientation and pointwise operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxatlas.functions.scalar import saturate

AXES = ("z", "y", "x")
Slice = tuple[int | None, int | None, int | None]


def shape(voxels: DataFrame) -> tuple[int, int, int]:
    """Sizes of a dense volume, from its largest coordinates."""
    top = voxels.agg(*(F.max(a) for a in AXES)).head()
    return tuple((t if t is not None else -1) + 1 for t in top)


def trim(voxels: DataFrame, slices: tuple[Slice, Slice, Slice], sizes: tuple[int, int, int] | None = None) -> DataFrame:
    """The box of three slices (start, stop, step), coordinates from 0 again.

    ``sizes`` is needed only for negative bounds or steps, as in any slice.
    """
    if sizes is None and any((b or 0) < 0 for s in slices for b in s):
        sizes = shape(voxels)
    for axis, (start, stop, step), n in zip(AXES, slices, sizes or (None,) * 3, strict=True):
        c = F.col(axis)
        step = step or 1
        if n is not None:
            start, stop, step = slice(start, stop, step).indices(n)
        start = start or 0
        if step > 0:
            voxels = voxels.where((c >= start) & (F.lit(True) if stop is None else c < stop))
        else:
            voxels = voxels.where((c <= start) & (c > stop))
        if step != 1:
            voxels = voxels.where((c - start) % abs(step) == 0)
        voxels = voxels.withColumn(axis, F.expr(f"cast(({axis} - {start}) div {step} as int)"))
    return voxels


def downsample_rough(voxels: DataFrame, strides: tuple[int, int, int]) -> DataFrame:
    """Every n-th voxel of each axis."""
    return trim(voxels, tuple((None, None, n) for n in strides))


def reorient(voxels: DataFrame, order: tuple[int, int, int], sizes: tuple[int, int, int]) -> DataFrame:
    """Axes permuted as |order| says (from 1), each flipped first where its sign is negative."""
    if sorted(map(abs, order)) != [1, 2, 3]:
        raise ValueError("the orientation is a permutation of 1, 2, 3 with signs")
    new = {}
    for axis, entry in zip(AXES, order, strict=True):
        source = abs(entry) - 1
        c = F.col(AXES[source])
        new[axis] = (F.lit(sizes[source] - 1) - c if entry < 0 else c).cast("int")
    return voxels.withColumns(new)


def bound(v: Column, lower: tuple[float, float], upper: tuple[float, float]) -> Column:
    """Values below lower[0] become lower[1]; then values above upper[0] become upper[1]."""
    if not (lower[0] < upper[0] and lower[1] <= lower[0] and upper[1] >= upper[0]):
        raise ValueError("bounds must be in order")
    raised = F.when(v < lower[0], F.lit(lower[1])).otherwise(v)
    return F.when(raised > upper[0], F.lit(upper[1])).otherwise(raised)


def clip(v: Column, least: float | None = None, most: float | None = None) -> Column:
    """Clamped to whichever bounds are given."""
    if least is not None:
        v = F.greatest(v, F.lit(least))
    return v if most is None else F.least(v, F.lit(most))


def relu(v: Column) -> Column:
    return F.greatest(v, F.lit(0))


def volume_filter(voxels: DataFrame, least: int | None, most: int | None) -> DataFrame:
    """Values out of [least, most] become 0; a bound of None or 0 is none."""
    inside = F.lit(True)
    if least:
        inside = inside & (F.col("v") >= least)
    if most:
        inside = inside & (F.col("v") <= most)
    return voxels.withColumn("v", F.when(inside, F.col("v")).otherwise(F.lit(0).cast(dict(voxels.dtypes)["v"])))


def apply_mask(voxels: DataFrame, mask: DataFrame, bits: int | None = 8) -> DataFrame:
    """Values where the mask is positive, 0 elsewhere; the mask is taken modulo 2**bits first."""
    m = F.col("_m") if bits is None else F.pmod(F.col("_m"), F.lit(1 << bits))
    return voxels.join(mask.select(*AXES, F.col("v").alias("_m")), list(AXES), "left").select(*AXES, F.when(m > 0, F.col("v")).otherwise(0).alias("v"))


def stack_channels(volumes: list[DataFrame]) -> DataFrame:
    """Volumes of one shape as channels c0, c1, ... of 16-bit values."""
    named = [df.select(*AXES, saturate("v").alias(f"c{k}")) for k, df in enumerate(volumes)]
    return reduce(lambda a, b: a.join(b, list(AXES)), named)


def nonzero(voxels: DataFrame) -> DataFrame:
    """Coordinates of voxels that are not 0, labelled by their value; measures still unknown."""
    return voxels.where("v <> 0").select(F.col("v").alias("label"), *AXES, F.lit(-1).alias("volume"), F.lit(-1).alias("sum_intensity"))


def manual_threshold(voxels: DataFrame, value: float) -> DataFrame:
    """1 where v >= value, else 0."""
    return voxels.withColumn("v", (F.col("v") >= value).cast("int"))


def mean_threshold(voxels: DataFrame, deviations: float = 0) -> DataFrame:
    """1 where v exceeds the mean of the positive values by so many population deviations.

    Mean and deviation come from exact sums of 38 digits, one row that every task gets;
    the squares of 2e9 voxels of 16 bits would not fit 64 bits.
    """
    v = F.col("v").cast("double")
    whole = F.col("v").cast("decimal(18,0)")
    stats = voxels.where("v > 0").agg(F.count("*").cast("decimal(19,0)").alias("_n"), F.sum(whole).cast("decimal(19,0)").alias("_s"), F.sum((whole * whole).cast("decimal(28,0)")).alias("_q"))
    # n * n * variance, exact where it fits
    scatter = F.expr("cast(_q as decimal(38,0)) * _n - cast(_s * _s as decimal(38,0))").cast("double")
    stats = stats.select(F.col("_n").cast("double").alias("_n"), F.col("_s").cast("double").alias("_s"), scatter.alias("_c"))
    spread = F.try_divide(F.sqrt(F.greatest("_c", F.lit(0.0))), "_n")
    limit = stats.select((F.try_divide("_s", "_n") + F.lit(float(deviations)) * spread).alias("_limit"))
    return voxels.join(F.broadcast(limit)).select(*AXES, F.coalesce((v > F.col("_limit")).cast("int"), F.lit(0)).alias("v"))


def histogram(voxels: DataFrame, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, n) of the values within [low, high], the last bin closed; by default from the least to the greatest."""
    if low is None or high is None:
        ends = voxels.agg(F.min("v"), F.max("v")).head()
        low, high = (float(e) if e is not None else 0.0 for e in ends)
    width = (high - low) / bins or 1.0
    inside = voxels.where((F.col("v") >= low) & (F.col("v") <= high))
    at = F.least(F.floor((F.col("v").cast("double") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def density_histogram(voxels: DataFrame, bins: int = 256, low: float = 0, high: float = 5000) -> DataFrame:
    """(left, density) of every bin, the counts divided by their total and the bin width."""
    spark = voxels.sparkSession
    width = (high - low) / bins
    counts = histogram(voxels, bins, low, high)
    total = counts.agg(F.sum("n").alias("_total"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").join(F.broadcast(total)).select((F.lit(float(low)) + F.col("bin") * F.lit(width)).alias("left"), F.coalesce(F.try_divide(F.coalesce("n", F.lit(0)).cast("double"), F.col("_total") * F.lit(width)), F.lit(0.0)).alias("density"))


def specimen_histograms(volumes: dict[str, DataFrame], bins: int = 256, low: float = 0, high: float = 5000) -> DataFrame:
    """(specimen, left, density): the histogram of each specimen's image, in one pass over all."""
    named = [df.select(F.lit(name).alias("specimen"), F.col("v").cast("double").alias("v")) for name, df in volumes.items()]
    width = (high - low) / bins
    at = F.least(F.floor((F.col("v") - F.lit(float(low))) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = reduce(DataFrame.unionByName, named).where((F.col("v") >= low) & (F.col("v") <= high)).groupBy("specimen", at.alias("bin")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("specimen").agg(F.sum("n").alias("_total"))
    spark = named[0].sparkSession
    names = spark.createDataFrame([(name,) for name in volumes], "specimen string").select("specimen", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    density = F.coalesce(F.try_divide(F.coalesce("n", F.lit(0)).cast("double"), F.col("_total") * F.lit(width)), F.lit(0.0))
    return names.join(counts, ["specimen", "bin"], "left").join(totals, "specimen", "left").select("specimen", (F.lit(float(low)) + F.col("bin") * F.lit(width)).alias("left"), density.alias("density"))


def otsu_bin(counts: DataFrame) -> DataFrame:
    """The bin (one row) after which the variance between the classes below and above is greatest.

    ``counts`` is a histogram of few bins.  Means are those of bin numbers; the first
    of equal bins wins.
    """
    from pyspark.sql import Window

    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    weighed = F.col("bin").cast("bigint") * F.col("n")
    sums = counts.select("bin", F.sum("n").over(below).alias("w"), F.sum(weighed).over(below).alias("s"), F.sum("n").over(everything).alias("wt"), F.sum(weighed).over(everything).alias("st"))
    # w0 * w1 * (mean0 - mean1)^2 = (wt * s - st * w)^2 / (w * (wt - w)), in exact numerators of
    # 38 digits: products of the counts of 1e9 voxels do not fit 64 bits
    sums = sums.select("bin", *(F.col(c).cast("decimal(18,0)").alias(c) for c in ("w", "s", "wt", "st")))
    diff = (F.col("wt") * F.col("s") - F.col("st") * F.col("w")).cast("double")
    variance = F.coalesce(F.try_divide(diff * diff, (F.col("w") * (F.col("wt") - F.col("w"))).cast("double")), F.lit(0.0))
    return sums.select("bin", variance.alias("variance")).agg(F.max_by("bin", F.struct("variance", -F.col("bin"))).alias("otsu_bin"))


def otsu_threshold(voxels: DataFrame, bins: int = 256, mode: str = "index") -> DataFrame:
    """1 where v exceeds Otsu's threshold: the bin's number, or with mode "edge" its right edge."""
    ends = voxels.agg(F.min("v"), F.max("v")).head()
    low, high = (float(e or 0) for e in ends)
    best = otsu_bin(histogram(voxels, bins, low, high))
    limit = F.col("otsu_bin").cast("double")
    if mode == "edge":
        limit = F.lit(low) + (limit + 1) * F.lit((high - low) / bins)
    return voxels.join(F.broadcast(best)).select(*AXES, (F.col("v") > limit).cast("int").alias("v"))
