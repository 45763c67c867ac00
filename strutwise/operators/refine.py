"""Finer fits and cleaner masks: nodes at full resolution, affine maps, material near a design's centre lines."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.operators import labelling as L
from strutwise.operators.alignment import Transform, moved
from strutwise.operators.neighbours import moment_sums
from strutwise.operators.patches import at_places, on_patches
from strutwise.operators.selection import linear_quantiles
from strutwise.sources.storage import stored


@dataclass(frozen=True)
class RefinePolicy:
    """Lengths in voxels: of patches, of the ball in which a peak is looked for and that in which it weighs; limits of what counts."""

    patch: int = 10
    search: float = 8.0
    weigh: float = 3.5
    least_radius: float = 1.0
    most_radius: float = 12.0
    most_shift: float = 8.0
    keep: float = 0.8
    passes: int = 3
    threshold: float = 1.0


def _peak(row: dict, patch: np.ndarray, corner, policy: RefinePolicy) -> dict:
    out = {"id": row["id"], "lx": None, "ly": None, "lz": None, "radius": None, "shift": None}
    depth = np.sqrt(K.squared_distance(patch >= policy.threshold))
    at = np.indices(patch.shape) + np.array(corner).reshape(3, 1, 1, 1)
    start = np.array([row["z"], row["y"], row["x"]])
    near = ((at - start.reshape(3, 1, 1, 1)) ** 2).sum(axis=0) <= policy.search**2
    inside = np.where(near, depth, -1.0)
    top = np.unravel_index(int(inside.argmax()), patch.shape)
    radius = float(inside[top])
    if not np.isfinite(radius):  # a patch without background has no depth
        return out
    close = ((np.indices(patch.shape) - np.array(top).reshape(3, 1, 1, 1)) ** 2).sum(axis=0) <= policy.weigh**2
    weight = np.clip(np.where(np.isfinite(depth), depth, 0.0) - (radius - 1.0), 0.0, None) ** 2 * near * close
    if not weight.sum():
        return out | {"radius": radius}
    z, y, x = (float((weight * a).sum() / weight.sum()) for a in at)
    return out | {"lx": x, "ly": y, "lz": z, "radius": radius, "shift": float(np.linalg.norm(np.array([z, y, x]) - start))}


def peaks_near(nodes: DataFrame, blocks: DataFrame, policy: RefinePolicy = RefinePolicy()) -> DataFrame:
    """``id, lx, ly, lz, radius, shift``: the deepest material near each node (``id, x, y, z``), as a weighted centre.

    Depth is the distance to background inside the node's patch; the first of
    equal depths in scan order is the peak. A node whose patch has no
    background has no place, one without material near has radius 0, one outside
    the volume no row.
    """
    def peaks(boxes: DataFrame) -> DataFrame:
        for c in "zyx":
            boxes = boxes.withColumns({f"l{c}": F.rint(c).cast("int") - policy.patch, f"h{c}": F.rint(c).cast("int") + policy.patch})
        return on_patches(boxes, blocks, lambda row, patch, corner: _peak(row, patch, corner, policy), "id long, lx double, ly double, lz double, radius double, shift double")

    return at_places(nodes, peaks)


def refined(points: DataFrame, blocks: DataFrame, transform: Transform, policy: RefinePolicy = RefinePolicy()) -> tuple[Transform, list[dict]]:
    """A transform refitted, pass after pass, to where the volume's material is deepest near the points it predicts.

    Every pass keeps the valid places with the least shifts. The history has
    ``valid, kept, cutoff, median, p95`` and the transform of each pass; fewer
    than four valid places are an error.
    """
    points, history = points.select("id", "x", "y", "z"), []
    named = points.select("id", *[F.col(c).alias(f"p{c}") for c in "xyz"])
    for _ in range(policy.passes):
        found = peaks_near(moved(points, {0: transform}, ["id"]).drop("start"), blocks, policy)
        valid = F.col("lx").isNotNull() & F.col("radius").between(policy.least_radius, policy.most_radius) & (F.col("shift") < policy.most_shift)
        good = stored(found.where(valid).join(named, "id"), "peaks")
        at = linear_quantiles(good, "shift", [policy.keep, 0.5, 0.95], []).first()
        if at is None or at.n < 4:
            raise ValueError("fewer than four nodes have a valid place")
        kept = good.where(F.col("shift") <= at["at"][0]).select(*[f"p{c}" for c in "xyz"], *[F.col(f"l{c}").alias(f"q{c}") for c in "xyz"])
        r = moment_sums(kept).first().asDict()
        p, q = (np.array([r[f"s_{s}{c}"] for c in "xyz"]) / r["n"] for s in "pq")
        cov = np.array([[r[f"s_{a}{b}"] for b in "xyz"] for a in "xyz"]) / r["n"] - np.outer(q, p)
        transform = K.from_moments(r["n"], p, q, cov, r["s_pp"] / r["n"] - float(p @ p))
        history.append({"valid": at.n, "kept": r["n"], "cutoff": at["at"][0], "median": at["at"][1], "p95": at["at"][2], "transform": transform})
    return transform, history


def affine(pairs: DataFrame) -> DataFrame:
    """``axis, mx, my, mz, shift``: the least-squares affine map from ``px, py, pz`` to ``qx, qy, qz``, a row for each axis of the target.

    One aggregate makes the normal equations about the means; one row is
    solved. Fewer than four pairs, or pairs in a plane, are an error.
    """
    mean = pairs.agg(*[F.avg(f"{s}{c}").alias(f"m_{s}{c}") for s in "pq" for c in "xyz"])
    d = {f"{s}{c}": F.col(f"{s}{c}") - F.col(f"m_{s}{c}") for s in "pq" for c in "xyz"}
    sums = pairs.join(F.broadcast(mean)).agg(  # one row of means
        F.count("*").alias("n"), *[F.first(f"m_{k}").alias(f"m_{k}") for k in d],
        *[F.sum(d[f"p{a}"] * d[f"p{b}"]).alias(f"s_{a}{b}") for a in "xyz" for b in "xyz" if a <= b], *[F.sum(d[f"q{a}"] * d[f"p{b}"]).alias(f"t_{a}{b}") for a in "xyz" for b in "xyz"],
    )

    def solve(frames):
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                if r["n"] < 4:
                    raise ValueError("an affine map needs four pairs")
                own = np.array([[r[f"s_{min(a, b)}{max(a, b)}"] for b in "xyz"] for a in "xyz"])
                if np.linalg.matrix_rank(own) < 3:
                    raise ValueError("the source points lie in a plane")
                for a in "xyz":
                    m = np.linalg.solve(own, np.array([r[f"t_{a}{b}"] for b in "xyz"]))
                    out.append((a, *map(float, m), r[f"m_q{a}"] - sum(x * r[f"m_p{b}"] for x, b in zip(m, "xyz"))))
            yield pd.DataFrame(out, columns=["axis", "mx", "my", "mz", "shift"])

    return sums.coalesce(1).mapInPandas(solve, "axis string, mx double, my double, mz double, shift double")


def affine_residuals(pairs: DataFrame, fit: DataFrame) -> DataFrame:
    """``pairs`` with ``residual``, the distance from where the map puts each source."""
    row = fit.agg(*[F.max(F.when(F.col("axis") == a, F.col(k))).alias(f"__{a}{k}") for a in "xyz" for k in ("mx", "my", "mz", "shift")])
    off = [sum((F.col(f"__{a}m{b}") * F.col(f"p{b}") for b in "xyz"), F.col(f"__{a}shift")) - F.col(f"q{a}") for a in "xyz"]
    return pairs.join(F.broadcast(row)).withColumn("residual", F.sqrt(sum((o * o for o in off), F.lit(0.0)))).select(*pairs.columns, "residual")  # one row


def centre_cells(placed: DataFrame, shape: tuple[int, int, int], samples: int) -> DataFrame:
    """Distinct ``z, y, x`` of ``samples`` evenly spaced places along each segment ``ax..bz``, rounded half to even and moved into the volume."""
    t = F.col("k") / F.lit(float(samples - 1))
    points = placed.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    cell = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.rint(F.col(f"a{c}") + t * (F.col(f"b{c}") - F.col(f"a{c}"))).cast("int"))).alias(c)
    return points.select(*[cell(c, n) for c, n in zip("zyx", shape)]).distinct()


def merged_runs(runs: DataFrame) -> DataFrame:
    """``z, y, x0, x1`` (both ends included) of each line, overlapping and adjoining runs joined."""
    line = Window.partitionBy("z", "y").orderBy("x0", "x1")
    before = F.max("x1").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opened = runs.withColumn("__opens", F.coalesce((F.col("x0") > before + 1).cast("int"), F.lit(1)))
    parts = opened.withColumn("__run", F.sum("__opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy("z", "y", "__run").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("__run")


def grown_runs(cells: DataFrame, reach: int, shape: tuple[int, int, int]) -> DataFrame:
    """Cells within ``reach`` of a given cell on every axis, as runs ``z, y, x0, x1``: grown along x, then y, then z, and merged each time."""
    nz, ny, nx = shape
    runs = merged_runs(cells.select("z", "y", F.greatest(F.lit(0), F.col("x") - reach).alias("x0"), F.least(F.lit(nx - 1), F.col("x") + reach).alias("x1")))
    for c, n in (("y", ny), ("z", nz)):
        spread = F.explode(F.sequence(F.greatest(F.lit(0), F.col(c) - reach), F.least(F.lit(n - 1), F.col(c) + reach)))
        runs = merged_runs(runs.withColumn(c, spread))
    return runs


def near_cells(cells: DataFrame, runs: DataFrame) -> DataFrame:
    """The cells ``z, y, x`` that lie in one of the runs; runs of a line don't overlap."""
    other = runs.select(F.col("z").alias("rz"), F.col("y").alias("ry"), "x0", "x1")
    return cells.join(other, (F.col("z") == F.col("rz")) & (F.col("y") == F.col("ry")) & F.col("x").between(F.col("x0"), F.col("x1"))).select("z", "y", "x")


def cleaned(cells: DataFrame, placed: DataFrame, shape: tuple[int, int, int], reach: int = 4, samples: int | None = None, size: int = L.PART) -> DataFrame:
    """The largest 26-connected component (the first of equals) of the mask's cells near the segments' centre lines.

    ``samples`` places along each segment, by default two more than the longest
    is long. Nothing near gives no cells.
    """
    if samples is None:
        length = F.sqrt(sum(((F.col(f"b{c}") - F.col(f"a{c}")) * (F.col(f"b{c}") - F.col(f"a{c}")) for c in "xyz"), F.lit(0.0)))
        samples = math.ceil(placed.agg(F.max(length)).first()[0] or 0.0) + 2
    near = near_cells(cells, grown_runs(centre_cells(placed, shape, samples), reach, shape))
    parts = L.labelled(L.cell_parts(near, shape, size), shape)
    sums = stored(L.component_sums(parts), "component-sums")
    largest = sums.orderBy(F.desc("size"), "component").limit(1).select(F.col("component").alias("__largest"))
    kept = L.component_cells(parts, shape).join(F.broadcast(largest), F.col("component") == F.col("__largest"))  # one row
    _, ny, nx = shape
    return kept.select(*[F.expr(e).cast("int").alias(c) for c, e in (("z", f"node div {ny * nx}"), ("y", f"node div {nx} % {ny}"), ("x", f"node % {nx}"))])
