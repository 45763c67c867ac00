"""Where defects lie: class shares, medians, axis thirds, bounds, quantiles, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strutwise.operators.ranking import numbered
from strutwise.operators.selection import linear_quantiles


def class_fractions(rows: DataFrame, classes: list[str], kind: str = "class") -> DataFrame:
    """``class, n, fraction`` for each class in order, zeros included."""
    named = rows.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in classes])).alias("place", "name"))
    counted = rows.groupBy(F.col(kind).alias("k")).agg(F.count("*").alias("c"))
    whole = rows.agg(F.count("*").alias("total"))
    return named.join(counted, F.col("name") == F.col("k"), "left").join(whole).select(
        F.col("name").alias("class"), F.coalesce("c", F.lit(0)).alias("n"), (F.coalesce("c", F.lit(0)) / F.nullif(F.col("total").cast("double"), F.lit(0.0))).alias("fraction")
    )


def medians(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Median of the finite values by key; null where there is none."""
    number = lambda c: F.col(c).cast("double")
    ok = lambda c: F.when(~F.isnan(number(c)) & (F.abs(number(c)) != float("inf")), number(c))
    long = rows.select(F.col(key).alias("key"), F.inline(F.array(*[F.struct(F.lit(c).alias("name"), ok(c).alias("value")) for c in values])))
    found = linear_quantiles(long, "value", [0.5], ["key", "name"])
    one = found.groupBy(F.col("key").alias("__key")).agg(*[F.max(F.when(F.col("name") == c, F.get("at", F.lit(0)))).alias(f"median_{c}") for c in values])
    every = rows.select(key).distinct()
    return every.join(one, every[key].eqNullSafe(one["__key"]), "left").drop("__key")


def quantiles(rows: DataFrame, value: str, shares=(0.1, 0.5, 0.9, 0.95, 0.99), *keys: str) -> DataFrame:
    """Linear quantiles ``p10, p50, ...`` of a column, by keys if given; null for keys without values."""
    names = [f"p{round(100 * s)}" for s in shares]
    found = linear_quantiles(rows, value, list(shares), list(keys)).withColumnsRenamed({k: f"__{k}" for k in keys}).drop("n")
    counted = rows.groupBy(*keys).agg(F.count(value).alias("n"))
    on = F.lit(True)
    for k in keys:
        on = on & counted[k].eqNullSafe(found[f"__{k}"])
    return counted.join(found, on, "left").select(*keys, "n", *[F.get("at", F.lit(k)).alias(n) for k, n in enumerate(names)])


def thirds(points: DataFrame, axes: str = "xyz") -> DataFrame:
    """``axis, third, n``: points in equal thirds of each axis' range; a range of 0 counts in the middle."""
    ends = points.agg(*[f(c).alias(f"{n}{c}") for c in axes for n, f in (("low_", F.min), ("high_", F.max))])
    span = lambda c: F.col(f"high_{c}") - F.col(f"low_{c}")
    bin_of = lambda c: F.when(span(c) == 0, 1).otherwise(F.least(F.lit(2), F.greatest(F.lit(0), F.floor(3 * (F.col(c) - F.col(f"low_{c}")) / F.nullif(span(c).cast("double"), F.lit(0.0))).cast("int"))))
    long = points.join(F.broadcast(ends)).select(F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), bin_of(c).alias("third")) for c in axes])).alias("s")).select("s.*")
    return long.groupBy("axis", "third").agg(F.count("*").alias("n"))


def bounds(points: DataFrame, axes: str = "xyz") -> DataFrame:
    """One row: least and largest coordinate and span of each axis."""
    out = points.agg(*[f(c).alias(f"{n}_{c}") for c in axes for n, f in (("low", F.min), ("high", F.max))])
    return out.select("*", *[(F.col(f"high_{c}") - F.col(f"low_{c}")).alias(f"span_{c}") for c in axes])


def equal_count_parts(rows: DataFrame, axis: str, key: str, parts: int = 5) -> DataFrame:
    """``rows`` with ``part`` (1 to ``parts``): groups of equal counts along an axis, ordered by place, then key.

    Group sizes differ by one at most, larger ones first. Places come from a
    range sort, so no task orders all rows.
    """
    placed, total = numbered(rows, [axis, key], "__place")
    small, more = divmod(total, parts)
    split = more * (small + 1)
    div = lambda x, by: F.floor(x / F.lit(float(max(1, by)))).cast("int")
    part = F.when(F.col("__place") < split, div(F.col("__place"), small + 1)).otherwise(more + div(F.col("__place") - split, small)) + 1
    return placed.withColumn("part", part).drop("__place")


def equal_count_bias(rows: DataFrame, axis: str, value: str, key: str, parts: int = 5) -> DataFrame:
    """``part, n, median`` over the groups of :func:`equal_count_parts`."""
    placed = equal_count_parts(rows.select(axis, key, F.col(value).cast("double").alias("__value")), axis, key, parts)
    return quantiles(placed, "__value", (0.5,), "part").withColumnRenamed("p50", "median")


def gate(rows: DataFrame, gates: dict[str, Column], hard: list[str], *keys: str) -> DataFrame:
    """``gate`` (pass, manual_review, halt) by keys: halt if a hard gate fails anywhere, review if any other does.

    A null outcome counts as failed. ``failed`` lists the failed gates in order of name.
    """
    sums = rows.groupBy(*keys).agg(*[F.bool_and(F.coalesce(c, F.lit(False))).alias(f"__{n}") for n, c in gates.items()])
    all_of = lambda names: F.forall(F.array(F.lit(True), *[F.col(f"__{n}") for n in names]), lambda x: x)
    failed = F.filter(F.array(*[F.when(~F.col(f"__{n}"), F.lit(n)) for n in sorted(gates)]), lambda x: x.isNotNull())
    return sums.select(
        *keys, F.when(~all_of(hard), "halt").when(~all_of(list(gates)), "manual_review").otherwise("pass").alias("gate"), F.array_join(failed, ",").alias("failed")
    )
