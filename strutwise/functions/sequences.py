"""Column expressions on ordered numeric series held as arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def longest_run(flags: Column) -> Column:
    """Length of the longest run of true values; null counts as false, an empty array has 0."""
    step = lambda s, x: F.struct(
        F.when(F.coalesce(x, F.lit(False)), s["run"] + 1).otherwise(0).alias("run"),
        F.greatest(s["best"], F.when(F.coalesce(x, F.lit(False)), s["run"] + 1).otherwise(0)).alias("best"),
    )
    return F.aggregate(flags, F.struct(F.lit(0).alias("run"), F.lit(0).alias("best")), step, lambda s: s["best"])


def longest_gap(flags: Column) -> Column:
    return longest_run(F.transform(flags, lambda x: ~F.coalesce(x, F.lit(False))))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + F.coalesce(x.cast("double"), F.lit(0.0)))


def mean(values: Column) -> Column:
    return total(values) / F.nullif(F.size(values).cast("double"), F.lit(0.0))


def share(flags: Column) -> Column:
    """Share of true values; null for an empty array."""
    return mean(F.transform(flags, lambda x: F.coalesce(x, F.lit(False)).cast("double")))


def quantile(values: Column, q: float) -> Column:
    """Linear quantile between the two nearest ranks; null for an empty array."""
    ranked, n = F.sort_array(values), F.size(values)
    place = F.lit(float(q)) * (n - 1)
    low = F.floor(place).cast("int")
    high = F.least(low + 1, n - 1)
    a, b = F.get(ranked, low), F.get(ranked, high)
    return a + (b - a) * (place - low)


def moving_average(values: Column, width: int = 3) -> Column:
    """Averages of every full window of ``width`` values; shorter arrays give none."""
    n = F.size(values) - width + 1
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(at, lambda k: mean(F.slice(values, k + 1, width)))


def smoothed(values: Column, passes: int = 1) -> Column:
    """Weights 1, 2, 1 over neighbours, ends kept, ``passes`` times."""
    for _ in range(passes):
        values = _once(values)
    return values


def _once(values: Column) -> Column:
    n = F.size(values)
    return F.transform(
        values, lambda x, k: F.when((k == 0) | (k == n - 1), x).otherwise((F.get(values, k - 1) + 2 * x + F.get(values, k + 1)) / 4)
    )


def filled(values: Column) -> Column:
    """Nulls replaced along a line between their neighbours; at the ends by the nearest value."""
    n = F.size(values)
    at = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    known = F.filter(at, lambda k: F.get(values, k).isNotNull())

    def one(x: Column, k: Column) -> Column:
        before, after = F.array_max(F.filter(known, lambda j: j <= k)), F.array_min(F.filter(known, lambda j: j >= k))
        a, b = F.get(values, before), F.get(values, after)
        line = a + (b - a) * (k - before) / F.nullif(after - before, F.lit(0))
        return F.coalesce(x, F.when(before.isNull(), b).when(after.isNull(), a).otherwise(line))

    return F.transform(values, one)


def filled_rows(df: DataFrame, key: str, values: str) -> DataFrame:
    """``key, i, value``: the series of each row as :func:`filled` fills them, in time in proportion to their lengths."""

    def run(frames):
        for f in frames:
            out = [pd.DataFrame({key: np.zeros(0, dtype=np.int64), "i": np.zeros(0, dtype=np.int32), "value": np.zeros(0), "bare": np.zeros(0, dtype=bool)})]
            for k, own, there in zip(f[key], f["held"], f["there"]):
                if own is not None and len(own):
                    v, at, there = np.asarray(own, dtype=float), np.arange(len(own), dtype=np.int32), np.asarray(there, dtype=bool)
                    if there.any():
                        v = np.where(there, v, np.interp(at, at[there], v[there]))
                    out.append(pd.DataFrame({key: k, "i": at, "value": v, "bare": not there.any()}))
            yield pd.concat(out)

    held = F.transform(values, lambda x: F.coalesce(x.cast("double"), F.lit(0.0))).alias("held")
    rows = df.select(F.col(key).cast("long").alias(key), held, F.transform(values, lambda x: x.isNotNull()).alias("there")).mapInPandas(run, f"{key} long, i int, value double, bare boolean")
    # pandas has one sign for null and NaN
    return rows.select(key, "i", F.when(~F.col("bare"), F.coalesce("value", F.lit(float("nan")))).alias("value"))


def chord_rms(values: Column, least: int = 5) -> Column:
    """Root mean square distance of a series from the line between its ends; 0 below ``least`` values."""
    n = F.size(values)
    a, b = F.get(values, F.lit(0)), F.get(values, n - 1)
    gaps = F.transform(values, lambda x, k: F.pow(x - (a + (b - a) * k / F.nullif((n - 1).cast("double"), F.lit(0.0))), F.lit(2.0)))
    return F.when(n < least, F.lit(0.0)).otherwise(F.sqrt(mean(gaps)))


def head_mean(values: Column, most: int = 3) -> Column:
    """Mean of the first min(most, max(1, half)) values."""
    return mean(F.slice(values, F.lit(1), F.least(F.lit(most), F.greatest(F.lit(1), F.floor(F.size(values) / 2).cast("int")))))


def tail_mean(values: Column, most: int = 3) -> Column:
    return head_mean(F.reverse(values), most)


def third_shares(flags: Column) -> tuple[Column, Column]:
    """Shares of true values in the first and the last third (one value at least)."""
    n = F.greatest(F.lit(1), F.floor(F.size(flags) / 3).cast("int"))
    return share(F.slice(flags, F.lit(1), n)), share(F.slice(F.reverse(flags), F.lit(1), n))


def linspace(a: Column, b: Column, n: int) -> Column:
    if n == 1:
        return F.array(a)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: a + (b - a) * k / F.lit(float(n - 1)))
