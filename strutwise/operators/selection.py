"""Order statistics and quantiles without buffers of values.

A value becomes a number of 64 bits that sorts alike. Four histograms, each over
16 bits more of the values that still count, find the values at any ranks of all
groups at once. A histogram has 65,536 rows for each group and wanted rank at
most and is combined before it is shuffled, so nothing grows with the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strutwise.sources.storage import stored

_LOW = np.int64((1 << 63) - 1)


@F.pandas_udf(T.LongType())
def order_bits(values: pd.Series) -> pd.Series:
    """Doubles as integers in the same order; -0.0 is 0.0, NaN the greatest."""
    a = values.to_numpy(np.float64) + 0.0
    bits = np.where(np.isnan(a), _LOW, a.view(np.int64))
    return pd.Series(np.where(bits >= 0, bits, bits ^ _LOW))


@F.pandas_udf(T.DoubleType())
def from_order_bits(bits: pd.Series) -> pd.Series:
    b = bits.to_numpy(np.int64)
    return pd.Series(np.where(b >= 0, b, b ^ _LOW).view(np.float64))


def _met(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """A join on columns of the same names, nulls being equal; they come out once."""
    other = right.withColumnsRenamed({c: f"__{c}" for c in names})
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(other, on, how).drop(*[f"__{c}" for c in names])


def order_values(rows: DataFrame, ranks: DataFrame, groups: list[str]) -> DataFrame:
    """``groups, rank, bits, left, equal``: the value at each rank (from 0), how many equal ones come before it and how many there are.

    ``rows``: groups and ``bits`` (any long), read four times; ``ranks``: groups
    and ``rank``, few rows for each group. Ranks that a group doesn't have give
    no row.
    """
    picks = ranks.select(*groups, "rank", F.col("rank").alias("left"))
    for shift in (48, 32, 16, 0):
        bin_ = F.shiftright("bits", shift)
        if shift == 48:
            own, within = rows, list(groups)
        else:
            wanted = picks.select(*groups, F.col("bin").alias("above")).distinct()
            narrow = rows.withColumn("above", F.shiftright("bits", shift + 16))
            own, within = _met(narrow, wanted, [*groups, "above"], "left_semi"), [*groups, "above"]
        hist = own.groupBy(*within, bin_.alias("to")).agg(F.count("*").alias("n"))
        hist = hist.withColumn("upto", F.sum("n").over(Window.partitionBy(*within).orderBy("to")))
        before = picks if shift == 48 else picks.withColumnRenamed("bin", "above")
        met = _met(before.drop("equal"), hist, within).where((F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("n")))
        picks = met.select(*groups, "rank", F.col("to").alias("bin"), (F.col("left") - F.col("upto") + F.col("n")).alias("left"), F.col("n").alias("equal"))
    return picks.withColumnRenamed("bin", "bits")


def linear_quantiles(rows: DataFrame, value: str, shares: list[float], groups: list[str]) -> DataFrame:
    """``groups, n, at``: counts of the values that aren't null, and their linear quantiles in the order of ``shares``.

    Exact: each lies between the two order values around ``(n - 1) * share``. A
    group without values gives no row.
    """
    known = stored(rows.where(F.col(value).isNotNull()).select(*groups, order_bits(F.col(value).cast("double")).alias("bits")), "order-bits")
    sizes = known.groupBy(*groups).agg(F.count("*").alias("n"))
    places = F.array(*[F.lit(float(s)) for s in shares])
    around = F.flatten(F.transform(places, lambda s: F.array(F.floor(s * (F.col("n") - 1)), F.ceil(s * (F.col("n") - 1)))))
    sizes = sizes.where("n > 0")
    ranks = sizes.select(*groups, F.explode(F.array_distinct(around)).alias("rank"))
    found = order_values(known, ranks, groups).withColumn("value", from_order_bits("bits"))
    by_rank = found.groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("values"))
    joined = _met(sizes, by_rank, groups)

    def at(s):
        place = s * (F.col("n") - 1)
        low, high = (F.element_at("values", f(place)) for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))

    return joined.select(*groups, "n", F.transform(places, at).alias("at"))
