"""Exact histograms, two-class thresholds and what they say about a volume."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_BIN = 65535
#: Limits of the threshold gates.
FOREGROUND_RANGE, LEAST_SEPARABILITY, LEAST_SEPARATION, LEAST_PEAKS = (0.01, 0.35), 0.45, 0.75, 2


def finite(value: Column) -> Column:
    v = value.cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def exact_histogram(samples: DataFrame, value: str = "value") -> DataFrame:
    """``bin, c``: how often each integer level occurs (partial sums before the shuffle)."""
    return samples.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("int").alias("bin")).agg(F.count("*").alias("c"))


def volume_stats(samples: DataFrame, value: str = "value") -> DataFrame:
    """One row: range, mean, and counts of finite and other samples."""
    v, ok = F.col(value).cast("double"), finite(F.col(value))
    return samples.agg(
        F.min(F.when(ok, v)).alias("minimum"), F.max(F.when(ok, v)).alias("maximum"), F.avg(F.when(ok, v)).alias("mean"),
        F.count_if(ok).alias("finite_count"), F.count_if(~ok).alias("nonfinite_count"),
    )


def affine_histogram(samples: DataFrame, value: str = "value") -> DataFrame:
    """Finite samples scaled to 0..65535 over their own range, rounded half to even, counted.

    Two passes: the range is one row. Equal ends or no finite sample raise an error.
    """
    low, high = samples.where(finite(F.col(value))).agg(F.min(F.col(value).cast("double")), F.max(F.col(value).cast("double"))).first()
    if low is None or low == high:
        raise ValueError("the samples have no range")
    scaled = F.rint((F.col(value).cast("double") - F.lit(low)) * F.lit(TOP_BIN / (high - low)))
    levels = samples.where(finite(F.col(value))).select(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(float(TOP_BIN))).cast("int").alias("value"))
    return exact_histogram(levels)


def _running(hist: DataFrame) -> DataFrame:
    # a histogram has 65,536 rows at most, so one task orders it
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    mass = F.col("c") * F.col("bin").cast("long")
    return hist.select(
        "bin", "c", F.sum("c").over(upto).alias("w0"), F.sum(mass).over(upto).alias("s0"),
        F.sum("c").over(whole).alias("n"), F.sum(mass).over(whole).alias("s"),
    )


def otsu(hist: DataFrame) -> DataFrame:
    """One row ``threshold, separability``: the first bin at which the variance between classes is largest.

    Bins up to the threshold count as background in the search; afterwards a
    sample at the threshold is foreground. One occupied bin is its own
    threshold with separability 0; an empty histogram gives no row.
    """
    d = lambda c: F.col(c).cast("double")
    w1, mean0 = d("n") - d("w0"), d("s0") / d("w0")
    gap = F.when(w1 > 0, mean0 - (d("s") - d("s0")) / F.nullif(w1, F.lit(0.0)))
    scored = _running(hist).withColumn("between", F.coalesce(d("w0") * w1 * gap * gap, F.lit(0.0)))
    mean = F.col("s").cast("double") / F.col("n").cast("double")
    return (
        scored.agg(
            F.max_by("bin", F.struct("between", -F.col("bin"))).alias("threshold"),
            F.max("between").alias("between"), F.max("n").alias("n"),
            F.sum(d("c") * (d("bin") - mean) * (d("bin") - mean)).alias("spread"),
        )
        .where("threshold is not null")
        .select("threshold", F.when(F.col("spread") > 0, F.col("between") / (F.col("n") * F.col("spread"))).otherwise(0.0).alias("separability"))
    )


def diagnostics(hist: DataFrame, threshold: DataFrame) -> DataFrame:
    """Class shares, means, variances, separation and gates of one threshold row.

    A class without samples has null statistics and fails the separation gate.
    """
    joined = hist.join(F.broadcast(threshold.select("threshold", "separability").limit(1)))  # one row by definition
    fg = F.col("bin") >= F.col("threshold")
    b, c = F.col("bin").cast("double"), F.col("c").cast("double")
    sums = joined.groupBy("threshold", "separability").agg(
        F.sum(c).alias("n"),
        *[f(side).alias(f"{name}{k}") for k, side in ((0, ~fg), (1, fg)) for name, f in (
            ("w", lambda s: F.coalesce(F.sum(F.when(s, c)), F.lit(0.0))), ("s", lambda s: F.sum(F.when(s, c * b))), ("q", lambda s: F.sum(F.when(s, c * b * b))))],
    )
    mean = lambda k: F.col(f"s{k}") / F.nullif(F.col(f"w{k}"), F.lit(0.0))
    var = lambda k: F.col(f"q{k}") / F.nullif(F.col(f"w{k}"), F.lit(0.0)) - mean(k) * mean(k)
    out = sums.select(
        "threshold", "separability", (F.col("w1") / F.col("n")).alias("foreground_fraction"),
        mean(0).alias("background_mean"), mean(1).alias("foreground_mean"), var(0).alias("background_variance"), var(1).alias("foreground_variance"),
    )
    separation = F.abs(F.col("foreground_mean") - F.col("background_mean")) / F.sqrt(F.greatest((F.col("background_variance") + F.col("foreground_variance")) / 2, F.lit(1e-12)))
    return (
        out.withColumn("class_separation", separation)
        .withColumn("fraction_ok", F.col("foreground_fraction").between(*FOREGROUND_RANGE))
        .withColumn("separability_ok", F.col("separability") >= LEAST_SEPARABILITY)
        .withColumn("separation_ok", F.coalesce(F.col("class_separation") >= LEAST_SEPARATION, F.lit(False)))
    )


def triangle(hist: DataFrame) -> DataFrame:
    """Triangle threshold: the occupied bin farthest below the line from the peak to the far end.

    The longer side of the peak is used; the first bin wins ties; the left side
    is walked from its far end. One occupied bin is its own threshold.
    """
    whole = Window.partitionBy()
    ends = hist.where("c > 0").select(
        "bin", "c", F.min("bin").over(whole).alias("low"), F.max("bin").over(whole).alias("high"),
        F.first("bin").over(Window.orderBy(F.desc("c"), "bin")).alias("peak"), F.max("c").over(whole).alias("top"),
    )
    left = (F.col("peak") - F.col("low")) > (F.col("high") - F.col("peak"))
    far = F.when(left, F.col("low")).otherwise(F.col("high"))
    side = F.when(left, F.col("bin") <= F.col("peak")).otherwise(F.col("bin") >= F.col("peak"))
    run = F.abs(F.col("peak") - far).cast("double")
    below = F.col("top").cast("double") * F.abs(F.col("bin") - far).cast("double") - F.col("c").cast("double") * run
    return ends.where(side).agg(F.max_by("bin", F.struct(below.alias("d"), (-F.abs(F.col("bin") - F.col("peak"))).alias("e"))).alias("threshold")).where("threshold is not null")


def threshold_sweep(hist: DataFrame, threshold: DataFrame, offsets: Sequence[int]) -> DataFrame:
    """``candidate, foreground, growth`` for thresholds at percent offsets from the first: distinct, within 0..65535."""
    at = F.least(F.lit(float(TOP_BIN)), F.greatest(F.lit(0.0), F.rint(F.col("threshold") * (F.lit(1.0) + F.col("offset") / F.lit(100.0)))))
    candidates = threshold.select("threshold", F.explode(F.array(*[F.lit(int(o)) for o in offsets])).alias("offset")).select("threshold", at.cast("int").alias("candidate")).distinct()
    # a handful of candidates against 65,536 bins at most
    counted = hist.join(F.broadcast(candidates)).groupBy("candidate").agg(
        F.coalesce(F.sum(F.when(F.col("bin") >= F.col("candidate"), F.col("c"))), F.lit(0)).cast("long").alias("foreground"),
        F.sum(F.when(F.col("bin") >= F.col("threshold"), F.col("c"))).cast("double").alias("base"),
    )
    return counted.select("candidate", "foreground", (F.col("foreground") / F.nullif(F.col("base"), F.lit(0.0)) - 1).alias("growth"))


def mask_comparison(cells: DataFrame, expected: Column, observed: Column) -> DataFrame:
    """One row: foreground, expected foreground, mismatches, false positives and negatives, exact match."""
    e, o = F.coalesce(expected, F.lit(False)), F.coalesce(observed, F.lit(False))
    return cells.agg(
        F.count_if(o).alias("foreground"), F.count_if(e).alias("expected"), F.count_if(e != o).alias("mismatched"),
        F.count_if(o & ~e).alias("false_positives"), F.count_if(e & ~o).alias("false_negatives"),
    ).withColumn("exact_match", F.col("mismatched") == 0)


def masked_mean(cells: DataFrame, mask: Column, value: str = "value") -> DataFrame:
    """Mean over the mask with its count and a status: empty, non_finite or computed."""
    v = F.col(value).cast("double")
    return cells.agg(
        F.count_if(mask).alias("voxels"), F.avg(F.when(mask, v)).alias("mean"), F.count_if(mask & ~finite(F.col(value))).alias("bad")
    ).select("voxels", "mean", F.when(F.col("voxels") == 0, "empty").when(F.col("bad") > 0, "non_finite").otherwise("computed").alias("status"))


def coarse_histogram(hist: DataFrame, coarse: int = 1024) -> DataFrame:
    """``k, c`` of all ``coarse`` equal parts of the 16-bit range, zeros included."""
    sums = hist.groupBy(F.floor(F.col("bin") * coarse / (TOP_BIN + 1)).cast("int").alias("__k")).agg(F.sum("c").alias("__c"))
    every = hist.sparkSession.range(coarse).select(F.col("id").cast("int").alias("k"))
    return every.join(sums, F.col("k") == F.col("__k"), "left").select("k", F.coalesce("__c", F.lit(0)).cast("double").alias("c"))


def smoothed(rows: DataFrame, n: int, sigma: float, truncate: float = 4.0) -> DataFrame:
    """``k, v`` for k = 0..n-1: Gaussian sums of ``c`` about each place, mirrored at both ends with the end value repeated; to nine digits.

    A place asks the places around it by an equi-join on their (mirrored)
    numbers. The kernel is no wider than the rows are many.
    """
    radius = int(truncate * sigma + 0.5)
    if radius >= n:
        raise ValueError("the kernel is wider than the histogram")
    taps = [math.exp(-0.5 * (o / sigma) ** 2) for o in range(-radius, radius + 1)]
    offsets = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(w / sum(taps)).alias("w")) for o, w in zip(range(-radius, radius + 1), taps)])
    asked = rows.select("k", F.explode(offsets).alias("t")).select("k", (F.col("k") + F.col("t.o")).alias("at"), "t.w")
    inside = F.when(F.col("at") < 0, -F.col("at") - 1).when(F.col("at") >= n, 2 * n - 1 - F.col("at")).otherwise(F.col("at"))
    other = rows.select(F.col("k").alias("__k"), "c")
    return asked.join(other, inside == F.col("__k")).groupBy("k").agg(F.round(F.sum(F.col("w") * F.col("c")), 9).alias("v"))


def peak_rows(rows: DataFrame, distance: int, prominence: float, least: float = 1.0) -> DataFrame:
    """``k, v, prominence`` of the peaks of a series ``k, v`` (k = 0.. without gaps, a few thousand rows).

    A peak is the middle of a run of equal values with lower runs on both
    sides. Higher peaks (then later ones) keep others less than ``distance``
    away out. A peak stands out by its height over the higher of the two
    lowest places between it and higher ground, which must be ``prominence``
    times the highest value, and ``least``. The series is one row of arrays.
    """
    along = Window.orderBy("k")  # a coarse histogram: bounded by its bins
    runs = rows.withColumn("__new", F.coalesce((F.col("v") != F.lag("v").over(along)).cast("int"), F.lit(1)))
    runs = runs.withColumn("__run", F.sum("__new").over(along)).groupBy("__run").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.first("v").alias("v"))
    by = Window.orderBy("__run")
    tops = runs.withColumns({"__l": F.lag("v").over(by), "__r": F.lead("v").over(by)}).where("v > __l and v > __r").select(F.floor((F.col("a") + F.col("b")) / 2).cast("int").alias("k"), "v")
    ranked = tops.agg(F.sort_array(F.collect_list(F.struct(F.col("v").alias("v"), F.col("k").alias("k"))), asc=False).alias("tops"))
    kept = F.aggregate(
        "tops", F.expr("cast(array() as array<struct<v:double,k:int>>)"),
        lambda s, t: F.when(F.exists(s, lambda x: F.abs(x["k"] - t["k"]) < distance), s).otherwise(F.concat(s, F.array(t))),
    )
    series = rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("vs"))
    peaks = ranked.select(F.explode(kept).alias("p")).join(series).select("p.*", "vs")  # one row of values
    higher = lambda from_, to: F.filter(F.sequence(from_, to), lambda i: F.get("vs", i) > F.col("v"))
    last = F.size("vs") - 1
    left = F.coalesce(F.when(F.col("k") > 0, F.array_max(higher(F.lit(0), F.col("k") - 1))), F.lit(-1))
    right = F.coalesce(F.when(F.col("k") < last, F.array_min(higher(F.col("k") + 1, last))), F.size("vs"))
    lowest = lambda a, b: F.array_min(F.slice("vs", a + 1, b - a + 1))
    stands = F.col("v") - F.greatest(lowest(left + 1, F.col("k")), lowest(F.col("k"), right - 1))
    return peaks.select("k", "v", stands.alias("prominence"), F.array_max("vs").alias("__top")).where(
        F.col("prominence") >= F.greatest(F.lit(float(least)), F.lit(float(prominence)) * F.col("__top"))
    ).drop("__top")


def intensity_modes(hist: DataFrame, coarse: int = 1024, sigma: float = 2.0, prominence: float = 0.003) -> DataFrame:
    """``mode, v, prominence``: peaks of the smoothed coarse histogram, at the middle of their part of the range."""
    found = peak_rows(smoothed(coarse_histogram(hist, coarse), coarse, sigma), max(2, coarse // 128), prominence)
    return found.select(((F.col("k") + 0.5) * (TOP_BIN + 1) / coarse).alias("mode"), "v", "prominence")


def replay(hist: DataFrame) -> DataFrame:
    """One row: ``threshold, separability, modes`` (how many), whether each check holds, and the ``gate``; none for an empty histogram."""
    found = diagnostics(hist, otsu(hist)).join(intensity_modes(hist).agg(F.count("*").alias("modes")))  # one row each
    rows = found.withColumn("modes_ok", F.col("modes") >= LEAST_PEAKS)
    good = F.col("fraction_ok") & F.col("separability_ok") & F.col("separation_ok") & F.col("modes_ok")
    return rows.select("threshold", "separability", "modes", "fraction_ok", "separability_ok", "separation_ok", "modes_ok", F.when(good, "pass").otherwise("manual_review").alias("gate"))
