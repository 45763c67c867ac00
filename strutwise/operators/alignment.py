"""Trimmed similarity fits of whole point clouds, all starts side by side.

The number of a start is a column, so every round serves all starts that still
move: one search among the targets' cells, one selection of the nearest share of
each start's pairs, one row of sums for each start. On the driver are only the
starts' transforms. Starts that have settled take no part in further rounds.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.operators.neighbours import moment_sums, nearest_spots, spots_of
from strutwise.operators.selection import from_order_bits, linear_quantiles, order_bits, order_values
from strutwise.sources.storage import stored

Transform = tuple[float, np.ndarray, np.ndarray]


def moved(points: DataFrame, transforms: dict[int, Transform], keep: list[str]) -> DataFrame:
    """``start``, ``keep`` and ``x, y, z`` of every point under each of a few transforms."""
    rows = []
    for k, (s, r, t) in transforms.items():
        place = [sum((F.lit(float(s * r[a][b])) * F.col(c) for b, c in enumerate("xyz")), F.lit(float(t[a]))).alias(f"__{c}") for a, c in enumerate("xyz")]
        rows.append(F.struct(F.lit(k).alias("start"), *place))
    inline = points.select(*keep, F.inline(F.array(*rows)))
    return inline.select("start", *keep, *[F.col(f"__{c}").alias(c) for c in "xyz"])


def nearest_share(pairs: DataFrame, size: int) -> DataFrame:
    """The ``size`` pairs of least distance of each start (``start, id, distance``), the least id first among equals.

    The last distance that counts is an order statistic, and so is the last id
    among the pairs that have it; nothing is sorted.
    """
    rows = stored(pairs.withColumn("bits", order_bits("distance")), "pairs")
    ranks = rows.select("start").distinct().withColumn("rank", F.lit(size - 1).cast("long"))
    cut = stored(order_values(rows.select("start", "bits"), ranks, ["start"]).select(F.col("start").alias("__start"), F.col("bits").alias("__cut"), "left", "equal"), "cuts")
    met = rows.join(cut, F.col("start") == F.col("__start"))
    if cut.where("left + 1 < equal").isEmpty():
        return met.where("bits <= __cut").select(*pairs.columns)
    ties = met.where("bits = __cut").select("start", F.col("id").alias("bits"))
    last = order_values(ties, cut.select(F.col("__start").alias("start"), F.col("left").alias("rank")), ["start"]).select(F.col("start").alias("__tied"), F.col("bits").alias("__last"))
    return met.join(last, F.col("start") == F.col("__tied")).where("bits < __cut or (bits = __cut and id <= __last)").select(*pairs.columns)


def _pairs(points: DataFrame, spots: DataFrame, cell: float, transforms: dict[int, Transform]) -> DataFrame:
    own = points.select("id", "x", "y", "z", *[F.col(c).alias(f"p{c}") for c in "xyz"])
    found = nearest_spots(moved(own, transforms, ["id", "px", "py", "pz"]), spots, cell, ["start", "id", "px", "py", "pz"])
    return found.select("start", "id", "px", "py", "pz", *[F.col(f"t{c}").alias(f"q{c}") for c in "xyz"], "distance")


def round_sums(points: DataFrame, spots: DataFrame, cell: float, transforms: dict[int, Transform], size: int) -> DataFrame:
    """One round: for each start the sums of its ``size`` best pairs (see ``moment_sums``), ``mean`` and largest (``cut``) of their distances."""
    kept = stored(nearest_share(_pairs(points, spots, cell, transforms), size), "kept-pairs")
    far = kept.groupBy(F.col("start").alias("__start")).agg(F.avg("distance").alias("mean"), F.max("distance").alias("cut"))
    return moment_sums(kept, "start").join(far, F.col("start") == F.col("__start")).drop("__start")


def trimmed_fits(points: DataFrame, targets: DataFrame, starts: list[Transform], keep: float = 0.7, rounds: int = 60, still: float = 1e-5) -> list[dict]:
    """Each start's iterated fit of ``points`` to ``targets`` (``id, x, y, z``) on its nearest ``keep`` share of pairs.

    A row for each start: ``start, transform, objective, rounds, settled,
    error``, equal to :func:`kernels.trimmed_fit` on the same clouds. All points
    take part. Fewer than four points or targets are an error; a start whose
    kept pairs can't be fitted ends with its reason. Points that share an id or
    aren't finite are an error of the caller.
    """
    points = stored(points.select("id", "x", "y", "z"), "points")
    spots, cell = spots_of(targets)
    n = points.count()
    if n < 4 or cell is None or spots.limit(4).count() < 4:
        raise ValueError("a fit needs four points and four places of targets")
    size = max(min(4, n), math.ceil(n * keep - 1e-9))
    now, last = dict(enumerate(starts)), {}
    out = {k: {"start": k, "rounds": 0, "settled": False, "error": None} for k in now}
    live = list(now)
    for _ in range(rounds):
        if not live:
            break
        sums = round_sums(points, spots, cell, {k: now[k] for k in live}, size).collect()  # a row for each start
        for r in (row.asDict() for row in sums):
            k = r["start"]
            out[k]["rounds"] += 1
            p, q = (np.array([r[f"s_{s}{c}"] for c in "xyz"]) / r["n"] for s in "pq")
            cov = np.array([[r[f"s_{a}{b}"] for b in "xyz"] for a in "xyz"]) / r["n"] - np.outer(q, p)
            try:
                now[k] = K.from_moments(r["n"], p, q, cov, r["s_pp"] / r["n"] - float(p @ p))
            except (ValueError, np.linalg.LinAlgError) as e:
                out[k]["error"] = str(e)
            out[k]["settled"] = abs(last.get(k, math.inf) - r["mean"]) < still
            last[k] = r["mean"]
        live = [k for k in live if not out[k]["settled"] and out[k]["error"] is None]
    good = {k: t for k, t in now.items() if out[k]["error"] is None}
    if good:
        final = nearest_share(_pairs(points, spots, cell, good).select("start", "id", "distance"), size)
        objective = dict(final.groupBy("start").agg(F.avg("distance")).collect())
    return [out[k] | ({"transform": now[k], "objective": objective[k]} if k in good else {"transform": None, "objective": None}) for k in out]


def box(points: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """How many points there are, their mean, and the ends of the box around them."""
    r = points.agg(F.count("*"), *[f(c) for f in (F.avg, F.min, F.max) for c in "xyz"]).first()
    if not r[0]:
        raise ValueError("no points")
    mean, low, high = (np.array(r[1 + 3 * k : 4 + 3 * k], dtype=float) for k in range(3))
    return r[0], mean, low, high


def shift_quantiles(points: DataFrame, base: Transform, others: dict[int, Transform], share: float = 0.95) -> tuple[dict[int, float], float]:
    """That quantile of how far each transform moves the points from where ``base`` puts them; and of all these together."""
    differ = {k: (1.0, s * r - base[0] * base[1], t - base[2]) for k, (s, r, t) in others.items()}
    shifts = moved(points, differ, ["id"]).select("start", F.sqrt(sum((F.col(c) * F.col(c) for c in "xyz"), F.lit(0.0))).alias("d"))
    each = {r.start: r["at"][0] for r in linear_quantiles(shifts, "d", [share], ["start"]).collect()}
    return each, linear_quantiles(shifts, "d", [share], []).first()["at"][0]


def held_out(points: DataFrame, share: float, seed: int) -> DataFrame:
    """``points`` with ``held``: the round(n * share) rows (one at least) whose ids have the least digests, with the seed, are held out."""
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"))), 1, 15)
    rows = stored(points.withColumn("bits", F.conv(digest, 16, 10).cast("long")), "split")
    n = rows.count()
    one = rows.limit(1).select(F.lit(max(1, round(n * share)) - 1).cast("long").alias("rank"))
    cut = order_values(rows.select("bits"), one, []).select(F.col("bits").alias("__cut"))
    return rows.join(F.broadcast(cut)).withColumn("held", F.col("bits") <= F.col("__cut")).drop("bits", "__cut")  # one row
