"""Bringing a nominal lattice onto detected nodes by a similarity transform."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.operators import alignment as A
from strutwise.operators import labelling as L
from strutwise.operators.neighbours import moment_sums, nearest
from strutwise.operators.ranking import numbered
from strutwise.operators.sampling import central_slices
from strutwise.operators.selection import linear_quantiles


@dataclass(frozen=True)
class FitPolicy:
    keep: float = 0.7
    rounds: int = 60
    scales: tuple[float, ...] = (0.95, 1.0, 1.05)
    tilts: tuple[tuple[float, float, float], ...] = ((0, 0, 0), (5, 0, 0), (-5, 0, 0), (0, 5, 0), (0, -5, 0), (0, 0, 5), (0, 0, -5))
    near_ratio: float = 1.05
    near_step: float = 1e-5
    least_near: int = 3
    least_settled: float = 0.5
    most_spread: float = 1.0
    holdout: float = 0.2
    most_holdout_error: float = 8.0


def fit_from_pairs(pairs: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    """Similarity from matched points (``px..qz``): sums in Spark, a 3x3 decomposition on the driver."""
    r = moment_sums(pairs).first().asDict()
    n = r["n"]
    if n < 4:
        raise ValueError("a similarity needs four pairs")
    p, q = (np.array([r[f"s_{s}{c}"] for c in "xyz"]) / n for s in "pq")
    cov = np.array([[r[f"s_{a}{b}"] for b in "xyz"] for a in "xyz"]) / n - np.outer(q, p)
    return K.from_moments(n, p, q, cov, r["s_pp"] / n - float(p @ p))


def rotation(degrees: tuple[float, float, float]) -> np.ndarray:
    """Rotation about x, then y, then z."""
    out = np.eye(3)
    for axis, d in enumerate(degrees):
        c, s = math.cos(math.radians(d)), math.sin(math.radians(d))
        i, j = [(1, 2), (2, 0), (0, 1)][axis]
        turn = np.eye(3)
        turn[i, i], turn[i, j], turn[j, i], turn[j, j] = c, -s, s, c
        out = turn @ out
    return out


def coarse(mean: np.ndarray, span: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Median ratio of spans as scale, no rotation, the points' mean on the centre of the targets' box."""
    if not (span > 0).any():
        raise ValueError("the points have no extent")
    scale = float(np.median((high - low)[span > 0] / span[span > 0]))
    return scale, np.eye(3), (low + high) / 2 - scale * mean


def around(base: tuple[float, np.ndarray, np.ndarray], mean: np.ndarray, policy: FitPolicy = FitPolicy()) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """All starts: scales and tilts about a first transform, which keep the mean of the points where it puts it."""
    centre, out = base[0] * base[1] @ mean + base[2], []
    for s in policy.scales:
        for tilt in policy.tilts:
            r = rotation(tilt)
            out.append((base[0] * s, r, centre - base[0] * s * r @ mean))
    return out


def coarse_start(p: np.ndarray, q: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The first transform, from arrays."""
    return coarse(p.mean(axis=0), np.ptp(p, axis=0), q.min(axis=0), q.max(axis=0))


def starts(p: np.ndarray, q: np.ndarray, policy: FitPolicy = FitPolicy()) -> list[tuple[float, np.ndarray, np.ndarray]]:
    return around(coarse_start(p, q), p.mean(axis=0), policy)


def split(ids: list[int], share: float, seed: int) -> tuple[list[int], list[int]]:
    """(fit, held out) ids by a seeded permutation, both in order; one at least is held out."""
    ids = sorted(ids)
    held = max(1, round(len(ids) * share))
    order = np.random.default_rng(seed).permutation(len(ids))
    return sorted(ids[k] for k in order[held:]), sorted(ids[k] for k in order[:held])


def thinned(points: np.ndarray, most: int) -> np.ndarray:
    return points if len(points) <= most else points[np.linspace(0, len(points) - 1, most, dtype=int)]


_FITS = "case int, scale double, rotation array<double>, shift array<double>, objective double, rounds int, settled boolean, error string"


def fits(spark: SparkSession, cases: list[tuple[np.ndarray, np.ndarray, tuple]], policy: FitPolicy = FitPolicy()) -> list[dict]:
    """One trimmed fit per case (source, target, start), a row each, run side by side; a failure is a row with its reason."""
    shared = spark.sparkContext.broadcast(cases)  # clouds of the suites, which their callers thin

    def run(frames):
        for f in frames:
            out = []
            for k in f["case"]:
                p, q, start = shared.value[k]
                try:
                    (s, r, t), objective, rounds, settled = K.trimmed_fit(p, q, start, policy.keep, policy.rounds)
                    out.append((k, s, r.ravel().tolist(), t.tolist(), objective, rounds, settled, None))
                except (ValueError, np.linalg.LinAlgError) as e:
                    out.append((k, None, None, None, None, 0, False, str(e)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _FITS.split(", ")])

    rows = spark.range(0, len(cases), 1, len(cases)).select(F.col("id").cast("int").alias("case")).mapInPandas(run, _FITS).orderBy("case").collect()
    return [r.asDict() for r in rows]


def transform_of(row: dict) -> tuple[float, np.ndarray, np.ndarray]:
    return row["scale"], np.array(row["rotation"]).reshape(3, 3), np.array(row["shift"])


def _near(objectives: dict[int, float], policy: FitPolicy) -> tuple[int, list[int]]:
    """The best start (the first of equals) and all that are about as good."""
    best = min(objectives, key=lambda k: (objectives[k], k))
    limit = max(objectives[best] * policy.near_ratio, objectives[best] + policy.near_step)
    return best, [k for k, o in objectives.items() if o <= limit]


def _checks(near: list[int], each: list[float], spread: float, policy: FitPolicy) -> dict[str, bool]:
    agree = sum(x <= policy.most_spread for x in each) / len(each)
    return {"near_optimal": len(near) >= policy.least_near, "agreement": spread <= policy.most_spread, "settled": agree >= policy.least_settled}


def multistart(points: DataFrame, targets: DataFrame, policy: FitPolicy = FitPolicy()) -> dict:
    """The best of all starts on whole clouds (``id, x, y, z``), and whether enough starts agree with it."""
    _, mean, low, high = A.box(points)
    _, _, *ends = A.box(targets)
    rows = A.trimmed_fits(points, targets, around(coarse(mean, high - low, *ends), mean, policy), policy.keep, policy.rounds)
    good = {r["start"]: r for r in rows if r["error"] is None}
    if not good:
        raise ValueError("no start could be fitted")
    best, near = _near({k: r["objective"] for k, r in good.items()}, policy)
    each, spread = A.shift_quantiles(points, good[best]["transform"], {k: good[k]["transform"] for k in near})
    return {
        "transform": good[best]["transform"], "objective": good[best]["objective"], "near": len(near), "spread": spread,
        "checks": _checks(near, [each[k] for k in near], spread, policy), "fits": rows,
    }


def multistart_arrays(spark: SparkSession, p: np.ndarray, q: np.ndarray, policy: FitPolicy = FitPolicy()) -> dict:
    """The same on arrays, a task for each start: for suites of many small fits."""
    rows = fits(spark, [(p, q, s) for s in starts(p, q, policy)], policy)
    good = {r["case"]: r for r in rows if r["error"] is None}
    if not good:
        raise ValueError("no start could be fitted")
    best, near = _near({k: r["objective"] for k, r in good.items()}, policy)
    base = K.apply(transform_of(good[best]), p)
    shifts = [np.linalg.norm(K.apply(transform_of(good[k]), p) - base, axis=1) for k in near]
    spread = float(np.quantile(np.concatenate(shifts), 0.95))
    checks = _checks(near, [float(np.quantile(x, 0.95)) for x in shifts], spread, policy)
    return {"transform": transform_of(good[best]), "objective": good[best]["objective"], "near": len(near), "spread": spread, "checks": checks, "fits": rows}


def register(nominal: DataFrame, detected: DataFrame, shape: tuple[int, int, int], policy: FitPolicy = FitPolicy(), seed: int = 0) -> dict:
    """Fits nominal nodes (``id, x, y, z``) to detected ones and gates the result; a failed gate halts.

    Nodes that share a place are one, under their least id. A share of them is
    held out of the fit and measured after it. All work on nodes is Spark's;
    transforms and gates are the driver's.
    """
    nodes = A.held_out(nominal.groupBy("x", "y", "z").agg(F.min("id").alias("id")), policy.holdout, seed)
    found = multistart(nodes.where("not held"), detected, policy)
    one = {0: found["transform"]}
    errors = nearest(A.moved(nodes.where("held"), one, ["id"]).drop("start"), detected)
    median = linear_quantiles(errors, "distance", [0.5], []).first()["at"][0]
    placed = A.moved(nodes, one, ["id", "held"])
    outside = F.lit(False)
    for c, n in zip("xyz", shape[::-1]):
        outside = outside | (F.col(c) < 0) | (F.col(c) > n - 1)
    total, out, held = placed.agg(F.count("*"), F.count_if(outside), F.count_if("held")).first()
    seen = detected.count()
    checks = found["checks"] | {"holdout_error": median <= policy.most_holdout_error, "inside": out == 0, "candidates": seen >= 0.25 * total, "disjoint": 0 < held < total}
    return found | {"checks": checks, "holdout_median": median, "held_out": held, "gate": "pass" if all(checks.values()) else "halt"}


def recovery_suite(spark: SparkSession, p: np.ndarray, cases: int = 12, noise: float = 0.35, missing: float = 0.2, outliers: float = 0.25, seed: int = 0, policy: FitPolicy = FitPolicy(), most_error: float = 1.0) -> dict:
    """Seeded transforms of p with noise, missing and stray points, fitted again; passes if 9 of 10 come back."""
    made = []
    for k in range(cases):
        rng = np.random.default_rng([seed, k])
        true = (float(rng.uniform(0.97, 1.03)), rotation(tuple(rng.uniform(-2, 2, 3))), rng.uniform(-1, 1, 3))
        q = K.apply(true, p)
        kept = q[rng.random(len(q)) >= missing] + 0.0
        kept = kept + rng.normal(0, noise, kept.shape)
        stray = rng.uniform(q.min(axis=0), q.max(axis=0), (int(len(p) * outliers), 3))
        made.append((p, np.vstack([kept, stray]), true))
    rows = fits(spark, [(p, q, coarse_start(p, q)) for p, q, _ in made], policy)
    errors = [float(np.median(np.linalg.norm(K.apply(transform_of(r), p) - K.apply(true, p), axis=1))) if r["error"] is None else math.inf for r, (_, _, true) in zip(rows, made)]
    good = sum(e <= most_error for e in errors)
    return {"errors": errors, "recovered": good, "pass": good >= 0.9 * cases}


#: How each fit of the robustness suite departs from the first: threshold, depth of a place, step, share kept by trimming, seed.
CASES = (
    ("as_is", {}), ("lower_threshold", {"threshold": -500.0}), ("higher_threshold", {"threshold": 500.0}), ("shallower_places", {"least_distance": -0.25}),
    ("deeper_places", {"least_distance": 0.25}), ("less_trimming", {"keep": 0.9}), ("other_split", {"seed": 1}),
)


def robustness_suite(
    spark: SparkSession, nominal: np.ndarray, blocks: DataFrame, shape: tuple[int, int, int], threshold: float, base, policy: FitPolicy = FitPolicy(), seed: int = 0,
    cases=CASES, most_points: int = 500, most_spread: float = 10.0, least_fitted: int = 4, **detection,
) -> dict:
    """Detection and fit repeated under changed settings; predictions must stay together and enough cases must succeed.

    A case that fails is a rejected row with its reason. Shifts are measured
    against the transform ``base`` on all nominal points, thinned.
    """
    p, rows, shifts = thinned(nominal, most_points), [], []
    start = {"step": 2, "least_distance": 2.0} | detection
    for name, change in cases:
        used = start | {k: start[k] + v for k, v in change.items() if k == "least_distance"} | {k: v for k, v in change.items() if k == "step"}
        level = threshold + change.get("threshold", 0.0)
        try:
            seen = detect_nodes(blocks, shape, level, **used)
            at = {n["id"]: (n["x"], n["y"], n["z"]) for n in seen}
            fit_ids, held = split(list(at), policy.holdout, change.get("seed", seed))
            found = multistart_arrays(spark, p, np.array([at[k] for k in fit_ids]), replace(policy, keep=change.get("keep", policy.keep)))
            moved = K.apply(found["transform"], p)
            far, _ = K.nearest_rows(np.array([at[k] for k in held]), moved)
            shifts.append(np.linalg.norm(moved - K.apply(base, p), axis=1))
            rows.append({"name": name, "status": "fitted", "threshold": level, "nodes": len(seen), "holdout_median": float(np.median(far)), "checks": found["checks"]})
        except (ValueError, np.linalg.LinAlgError, ZeroDivisionError) as e:
            rows.append({"name": name, "status": "rejected", "threshold": level, "reason": str(e)})
    spread = float(np.quantile(np.concatenate(shifts), 0.95)) if shifts else math.inf
    return {"cases": rows, "fitted": len(shifts), "spread": spread, "pass": len(shifts) >= least_fitted and spread <= most_spread}


def disturbed_suite(spark: SparkSession, p: np.ndarray, q: np.ndarray, start, policy: FitPolicy = FitPolicy(), seed: int = 0, most_spread: float = 10.0) -> dict:
    """Seven fits of disturbed points; their predictions must stay together and four must succeed."""
    rng = np.random.default_rng(seed)
    jitter = lambda a, s: a + rng.normal(0, s, a.shape)
    some = lambda a, share: a[rng.random(len(a)) < share]
    cases = [(p, q, start), (some(p, 0.8), q, start), (p, some(q, 0.8), start), (jitter(p, 0.25), q, start), (p, jitter(q, 0.25), start), (some(p, 0.6), some(q, 0.9), start), (p, np.vstack([q, rng.uniform(q.min(axis=0), q.max(axis=0), (len(q) // 10 + 1, 3))]), start)]
    rows = fits(spark, cases, policy)
    places = [K.apply(transform_of(r), p) for r in rows if r["error"] is None]
    spread = max((float(np.quantile(np.linalg.norm(x - places[0], axis=1), 0.95)) for x in places), default=math.inf)
    return {"fits": ["rejected" if r["error"] else "fitted" for r in rows], "spread": spread, "pass": len(places) >= 4 and spread <= most_spread}


def detected(blocks: DataFrame, shape: tuple[int, int, int], threshold: float, step: int = 2, margin: float = 0.05, least_distance: float = 2.0, least: int = 2, most: int = 999, size: int = L.PART) -> DataFrame:
    """Thick places of a downsampled mask as ``id, x, y, z, size`` in full-size voxels.

    Distances and components are those of the whole (central) volume, whatever
    the size of the parts: no place is cut, and none that is too long is taken
    for a short one.
    """
    first, stop = central_slices(shape[0], margin, step)
    small = (max(0, stop - first), -(-shape[1] // step), -(-shape[2] // step))
    parts = L.mask_parts(blocks, threshold, step, (first, stop), size)
    core = L.at_least(L.squared_distances(parts, small, size), least_distance**2)
    found = L.component_sums(L.labelled(core, small, full=False), full=False).where(F.col("size").between(least, most))
    centre = lambda c, o=0: ((F.col(c) / F.col("size") + o) * step).alias(c)
    placed, _ = numbered(found.select(centre("z", first), centre("y"), centre("x"), "size"), ["z", "y", "x"], "id")
    return placed.select("id", "x", "y", "z", "size")


def detect_nodes(blocks: DataFrame, shape: tuple[int, int, int], threshold: float, step: int = 2, margin: float = 0.05, least_distance: float = 2.0, least: int = 2, most: int = 999) -> list[dict]:
    """The rows of ``detected``, for fits on the driver: as many as the volume has nodes."""
    return [r.asDict() for r in detected(blocks, shape, threshold, step, margin, least_distance, least, most).orderBy("id").collect()]
