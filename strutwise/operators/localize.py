"""Moving predicted nodes to the material around them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.operators.patches import at_places, on_patches


@dataclass(frozen=True)
class LocalizePolicy:
    patch: int = 10
    sigma: float = 1.25
    bandwidth: float = 3.0
    search: float = 8.0
    agree: float = 2.0
    least_agreement: float = 0.7
    least_support: float = 0.05
    least_gain: float = 0.01
    reaches: tuple[float, ...] = (3.0, 5.0, 7.0)
    threshold: float = 1.0


LOCATED = (
    "id long, x double, y double, z double, match_class string, accepted boolean, boundary boolean, shift double, agreement double, "
    "spread double, support double, support_before double, reasons array<string>"
)


def _support(mask: np.ndarray, at: np.ndarray, directions: np.ndarray, policy: LocalizePolicy) -> float:
    """Material at a node and some way along its struts: 0.7 of the core, 0.3 of the median arm."""
    core = np.array([[a, b, c] for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)], dtype=float)
    middle = float(K.trilinear(mask, at + core).mean())
    if not len(directions):
        return middle
    arms = [K.trilinear(mask, at + np.outer(policy.reaches, d)).mean() for d in directions]
    return 0.7 * middle + 0.3 * float(np.median(arms))


def locate(row: dict, patch: np.ndarray, corner, shape, policy: LocalizePolicy) -> dict:
    start = np.array([row["z"], row["y"], row["x"]], dtype=float)
    mask = (patch >= policy.threshold).astype(float)
    here = start - np.array(corner)
    cut = any(s < 2 * policy.patch + 1 for s in patch.shape)
    out = {"id": row["id"], "x": row["x"], "y": row["y"], "z": row["z"], "match_class": "fallback", "accepted": False, "boundary": cut, "shift": 0.0, "agreement": 0.0, "spread": None, "support": 0.0, "support_before": 0.0, "reasons": []}
    if not mask.any():
        return out | {"reasons": ["no_foreground"]}
    smooth = K.gaussian(mask, policy.sigma) ** 2
    seeds = [here] + [here + d for d in np.vstack([2 * np.eye(3), -2 * np.eye(3)])]
    ends = np.array([K.mean_shift(smooth, s, policy.bandwidth, policy.search) for s in seeds])
    _, near = K.medoid_group(ends, policy.agree)
    place = K.mean_shift(smooth, np.median(ends[near], axis=0), policy.bandwidth, policy.search)
    share = float(near.mean())
    directions = np.array(row.get("directions") if row.get("directions") is not None else [], dtype=float).reshape(-1, 3)[:, ::-1]
    after, before = _support(mask, place, directions, policy), _support(mask, here, directions, policy)
    gained = (after - before) / max(before, 1e-12) >= policy.least_gain
    shift = float(np.linalg.norm(place - here))
    reasons = [name for name, bad in (("low_agreement", share < policy.least_agreement), ("shift_too_large", shift > policy.search), ("low_support", max(after, before) < policy.least_support), ("truncated_patch", cut)) if bad]
    out |= {"agreement": share, "spread": float(np.quantile(np.linalg.norm(ends[near] - place, axis=1), 0.95)), "support": after, "support_before": before, "shift": shift, "reasons": reasons}
    if reasons:
        return out | {"match_class": "ambiguous" if share < policy.least_agreement else "fallback"}
    if not gained:
        return out | {"match_class": "stable_coarse", "accepted": True}
    z, y, x = (float(v) for v in place + np.array(corner))
    return out | {"x": x, "y": y, "z": z, "match_class": "primary", "accepted": True}


def localized(nodes: DataFrame, blocks: DataFrame, shape: tuple[int, int, int], directions: DataFrame | None = None, policy: LocalizePolicy = LocalizePolicy()) -> DataFrame:
    """Each node (``id, x, y, z``) at the material near it, or where it was, with why.

    ``directions``: ``junction, ux, uy, uz`` of the struts at each node.
    """
    def found(boxes: DataFrame) -> DataFrame:
        for c in "zyx":
            boxes = boxes.withColumn(f"l{c}", (F.rint(c) - policy.patch).cast("int")).withColumn(f"h{c}", (F.rint(c) + policy.patch).cast("int"))
        return on_patches(boxes, blocks, lambda row, patch, corner: locate(row, patch, corner, shape, policy), LOCATED)

    if directions is None:
        return at_places(nodes, found)
    arms = directions.groupBy(F.col("junction").alias("__j")).agg(F.flatten(F.collect_list(F.array("ux", "uy", "uz"))).alias("directions"))
    boxes = nodes.select("id", *[F.col(c).cast("double").alias(c) for c in "xyz"])
    return found(boxes.join(arms, F.col("id") == F.col("__j"), "left").drop("__j"))


def location_gate(located: DataFrame) -> dict:
    """Shares of accepted, fallback and ambiguous nodes, and the gate they give."""
    r = located.agg(
        F.count("*").alias("n"), *[F.avg(c.cast("double")).alias(k) for k, c in (
            ("accepted", F.col("accepted")), ("fallback", F.col("match_class") == "fallback"), ("ambiguous", F.col("match_class") == "ambiguous"), ("boundary", F.col("boundary")))],
        F.count_if(F.isnan("x") | F.isnan("y") | F.isnan("z")).alias("nonfinite"),
    ).first().asDict()
    checks = {"accepted": (r["accepted"] or 0) >= 0.95, "fallback": (r["fallback"] or 0) <= 0.05, "ambiguous": (r["ambiguous"] or 0) <= 0.05, "boundary": (r["boundary"] or 0) <= 0}
    halt = r["n"] == 0 or r["nonfinite"] > 0 or not r["accepted"]
    return {"counts": r, "checks": checks, "gate": "halt" if halt else "pass" if all(checks.values()) else "manual_review"}
