"""Material along each strut: occupancy, gaps, connection, thickness and bending of its corridor."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.operators.neighbours import farthest_picks
from strutwise.operators.patches import boxes_around, on_patches


@dataclass(frozen=True)
class CorridorPolicy:
    """Sampling and measuring limits; lengths in voxels, shares of the strut's length."""

    pad: float = 0.1
    interior: tuple[float, float] = (0.2, 0.8)
    support: float = 0.10
    end_window: float = 2.0
    collar_window: float = 1.0
    junction_radius: float = 3.0
    least_valid: float = 0.99
    threshold: float = 1.0


def frame(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Axes across and along a segment; the first from the world axis least along it."""
    z = (b - a) / np.linalg.norm(b - a)
    ref = np.eye(3)[int(np.abs(z).argmin())]
    x = ref - z * (ref @ z)
    x /= np.linalg.norm(x)
    return x, np.cross(z, x), z


def axial_places(length: float, pad: float) -> np.ndarray:
    """Places along a strut about a voxel apart: both ends exactly, and ``pad * length`` beyond each."""
    m = pad * length
    side = max(2, math.ceil(m) + 1)
    return np.concatenate([np.linspace(-m, 0, side)[:-1], np.linspace(0, length, math.ceil(length) + 1), np.linspace(length, length + m, side)[1:]])


def sample_cuboid(mask: np.ndarray, corner, shape, a, b, half: int, pad: float):
    """(p, valid, x, z): mask values on a grid of (z, y, x) around a segment; places are given as x, y, z."""
    ex, ey, ez = frame(a, b)
    across = np.arange(-half, half + 0.5, 1.0)
    along = axial_places(float(np.linalg.norm(b - a)), pad)
    grid = a + along[:, None, None, None] * ez + across[None, :, None, None] * ey + across[None, None, :, None] * ex
    flat = grid.reshape(-1, 3)[:, ::-1]  # volumes are indexed z, y, x
    valid = ((flat >= 0) & (flat <= np.array(shape) - 1)).all(axis=1)
    local = np.pad(mask.astype(np.float32), 1)  # cells that the patch lacks hold nothing
    p = np.where(valid, K.trilinear(local, flat - np.array(corner) + 1), 0.0)
    size = (len(along), len(across), len(across))
    return p.reshape(size), valid.reshape(size), across, along


def _touching(labels: np.ndarray, z: np.ndarray, at: float, half: float) -> set[int]:
    near = np.abs(z - at) <= half
    return set(np.unique(labels[near])) - {0} if near.any() else set()


def _connection(labels, z, first, second) -> tuple[bool, int]:
    both = _touching(labels, z, *first) & _touching(labels, z, *second)
    return bool(both), int(np.isin(labels, list(both)).sum()) if both else 0


def _share(counts: np.ndarray, seen: np.ndarray, window: np.ndarray) -> float:
    """Material among the cells of a window that lie in the volume; 0 if none does."""
    return float(counts[window].sum() / seen[window].sum()) if seen[window].sum() else 0.0


def measure(row: dict, patch: np.ndarray, corner, shape, radius: float, half: int, policy: CorridorPolicy) -> dict:
    a, b = np.array([row[f"a{c}"] for c in "xyz"]), np.array([row[f"b{c}"] for c in "xyz"])
    length = float(np.linalg.norm(b - a))
    p, valid, across, z = sample_cuboid(patch >= policy.threshold, corner, shape, a, b, half, policy.pad)
    disk = (across[:, None] ** 2 + across[None, :] ** 2 <= radius**2)[None]
    inside = valid & disk
    material = (p.astype(np.float32) >= 0.5) & inside
    counts, seen = material.sum(axis=(1, 2)), inside.sum(axis=(1, 2))
    fg = np.where(seen > 0, counts / np.maximum(seen, 1), 0.0)
    low, high = policy.interior[0] * length, policy.interior[1] * length
    design, inner = (z >= -1e-9) & (z <= length + 1e-9), (z >= low - 1e-9) & (z <= high + 1e-9)
    absent = fg[inner] < policy.support
    gap = K.longest_true(absent)
    labels, _ = K.label(material)
    ends = ((0.0, policy.end_window), (length, policy.end_window))
    collars = ((low, policy.collar_window), (high, policy.collar_window))
    joined, joined_size = _connection(labels, z, *ends)
    near0, near0_size = _connection(labels, z, ends[0], collars[0])
    near1, near1_size = _connection(labels, z, collars[1], ends[1])
    span = (across[None, :, None] ** 2 + across[None, None, :] ** 2) + np.zeros((len(z), 1, 1))
    clear = (np.minimum(np.abs(z), np.abs(length - z))[:, None, None] ** 2 + span) > policy.junction_radius**2
    masked, _ = K.label(material & design[:, None, None] & clear)
    collar_joined, collar_size = _connection(masked, z, *collars)
    parts = np.bincount(masked.ravel())[1:]
    few = min(3, max(1, int(design.sum()) // 2))
    thick = [math.sqrt(K.squared_distance(s)[disk[0]].max(initial=0)) for s in material[inner]]
    thick = [t for t in thick if t > 0 and math.isfinite(t)]
    kept = np.flatnonzero(inner)
    centres = np.array([[(material[k] * across[None, :]).sum() / counts[k], (material[k] * across[:, None]).sum() / counts[k]] if counts[k] else [np.nan, np.nan] for k in kept])
    share = float(valid.mean())
    return {
        "id": row["id"], "length": length, "corridor_foreground_fraction": float(fg[design].mean()),
        "interior_minimum": float(fg[inner].min()), "interior_median": float(np.median(fg[inner])), "interior_maximum": float(fg[inner].max()),
        "maximum_axial_gap_samples": gap, "gap_fraction": gap / max(1, int(inner.sum())), "interior_component_count": len(parts),
        "largest_component_fraction": float(parts.max() / parts.sum()) if len(parts) else 0.0,
        "endpoint0_support_fraction": float(fg[design][:few].mean()), "endpoint1_support_fraction": float(fg[design][-few:].mean()),
        "connected": joined, "connected_voxels": joined_size, "endpoint0_connected": near0, "endpoint0_voxels": near0_size, "endpoint1_connected": near1, "endpoint1_voxels": near1_size,
        "collar_connected": collar_joined, "collar_voxels": collar_size, "both_endpoint_segments_observed": near0 and near1,
        "collar0_fraction": _share(counts, seen, np.abs(z - low) <= policy.collar_window), "collar1_fraction": _share(counts, seen, np.abs(z - high) <= policy.collar_window),
        "radius_voxels": float(np.median(thick)) if thick else 0.0, "curvature_rms": bending(centres), "valid_fraction": share, "roi_valid": share + 1e-12 >= policy.least_valid,
        "axial_t": (z / length).tolist(), "foreground_fraction": fg.tolist(),
    }


def bending(centres: np.ndarray, least: int = 5) -> float:
    """RMS distance of a smoothed centre line from its chord; gaps are bridged, fewer than ``least`` centres give 0."""
    known = np.isfinite(centres).all(axis=1) if len(centres) else np.zeros(0, dtype=bool)
    if known.sum() < least:
        return 0.0
    at = np.arange(len(centres))
    line = np.stack([np.interp(at, at[known], centres[known, k]) for k in range(2)], axis=1)
    for _ in range(2):
        inner = (line[:-2] + 2 * line[1:-1] + line[2:]) / 4
        line = np.vstack([line[:1], inner, line[-1:]])
    chord = line[0] + (line[-1] - line[0]) * (at / (len(at) - 1))[:, None]
    return float(np.sqrt(((line - chord) ** 2).sum(axis=1).mean()))


METRICS = (
    "id long, length double, corridor_foreground_fraction double, interior_minimum double, interior_median double, interior_maximum double, "
    "maximum_axial_gap_samples long, gap_fraction double, interior_component_count long, largest_component_fraction double, endpoint0_support_fraction double, endpoint1_support_fraction double, connected boolean, connected_voxels long, "
    "endpoint0_connected boolean, endpoint0_voxels long, endpoint1_connected boolean, endpoint1_voxels long, collar_connected boolean, collar_voxels long, "
    "both_endpoint_segments_observed boolean, collar0_fraction double, collar1_fraction double, radius_voxels double, curvature_rms double, "
    "valid_fraction double, roi_valid boolean, axial_t array<double>, foreground_fraction array<double>"
)


def half_width(radius: float) -> int:
    return math.ceil(radius + max(2.0, 0.2 * radius))


def strut_metrics(placed: DataFrame, blocks: DataFrame, shape: tuple[int, int, int], radius: float, policy: CorridorPolicy = CorridorPolicy()) -> DataFrame:
    """The metrics of each placed strut (``id, ax..bz`` in voxels, x y z) in a volume of (z, y, x) ``shape``.

    Struts of length 0 are left out; a strut wholly outside the volume has no row.
    """
    half = half_width(radius)
    some = placed.where("ax <> bx or ay <> by or az <> bz")
    # the cuboid reaches pad * length beyond the ends and half its diagonal across
    reach = F.lit(half * math.sqrt(2) + 2)
    length = F.sqrt(sum(((F.col(f"b{c}") - F.col(f"a{c}")) * (F.col(f"b{c}") - F.col(f"a{c}")) for c in "xyz"), F.lit(0.0)))
    boxes = boxes_around(some.select("id", *[f"{e}{c}" for e in "ab" for c in "xyz"], (reach + policy.pad * length).alias("__r")), 0.0)
    boxes = boxes.withColumns({f"l{c}": (F.col(f"l{c}") - F.ceil("__r")).cast("int") for c in "zyx"} | {f"h{c}": (F.col(f"h{c}") + F.ceil("__r")).cast("int") for c in "zyx"}).drop("__r")
    return on_patches(boxes, blocks, lambda row, patch, corner: measure(row, patch, corner, shape, radius, half, policy), METRICS)


def metrics_file_rows(metrics: DataFrame, struts: DataFrame, radius: float, policy: CorridorPolicy = CorridorPolicy()) -> DataFrame:
    """The columns of the metrics file for measured struts, ends by ``struts`` (``id, junction0, junction1``)."""
    from strutwise.sources.documents import METRIC_COLUMNS

    ends = struts.select(F.col("id"), F.col("junction0").cast("long").alias("junction0_id"), F.col("junction1").cast("long").alias("junction1_id"))
    named = metrics.join(ends, "id", "left").withColumns({
        "strut_id": F.col("id"), "length_voxels": F.col("length"), "corridor_radius_voxels": F.lit(float(radius)), "cuboid_half_width_voxels": F.lit(float(half_width(radius))),
        "axial_padding_fraction_total": F.lit(2 * policy.pad), "minimum_foreground_fraction": F.col("interior_minimum"), "median_foreground_fraction": F.col("interior_median"),
        "maximum_foreground_fraction": F.col("interior_maximum"), "maximum_axial_gap_fraction": F.col("gap_fraction"), "a_collar_foreground_fraction": F.col("collar0_fraction"),
        "b_collar_foreground_fraction": F.col("collar1_fraction"), "same_material_component_connects_a_to_b": F.col("connected"), "same_component_connects_collar_a_to_b": F.col("collar_connected"),
        "shared_component_voxel_count_in_corridor": F.col("connected_voxels"), "endpoint0_to_collar_component_voxel_count_in_corridor": F.col("endpoint0_voxels"),
        "endpoint1_to_collar_component_voxel_count_in_corridor": F.col("endpoint1_voxels"), "junction_masked_collar_shared_component_voxel_count_in_corridor": F.col("collar_voxels"),
        "edt_radius_median_voxels": F.col("radius_voxels"), "centerline_curvature_rms_voxels": F.col("curvature_rms"), "roi_in_bounds_fraction": F.col("valid_fraction"),
    })
    return named.select(*METRIC_COLUMNS)


def with_profiles(metrics: DataFrame, profiles: DataFrame, key: str = "strut_id") -> DataFrame:
    """Metrics joined to their profiles by strut; a strut that either side lacks raises an error that counts them."""
    alone = metrics.select(key).join(profiles.select(key), key, "left_anti").count(), profiles.select(key).join(metrics.select(key), key, "left_anti").count()
    if any(alone):
        raise ValueError(f"{alone[0]} struts have metrics alone, {alone[1]} profiles alone")
    return metrics.join(profiles, key)


def gates(metrics: DataFrame, expected: DataFrame) -> dict:
    """One row a strut, none missing or extra: else halt; any invalid region: manual review."""
    from strutwise.operators.lattice import coverage, duplicates

    cover = coverage(expected, metrics).first()
    checks = {"ids_unique": duplicates(metrics, "id").limit(1).count() == 0, "ids_exhaustive": bool(cover.equal), "roi_valid": metrics.where("not roi_valid").limit(1).count() == 0}
    hard = checks["ids_unique"] and checks["ids_exhaustive"]
    return {"checks": checks, "gate": "halt" if not hard else "pass" if checks["roi_valid"] else "manual_review"}


def _extent(row: dict, patch: np.ndarray, corner, shape, bound: int, policy: CorridorPolicy) -> dict:
    a, b = np.array([row[f"a{c}"] for c in "xyz"]), np.array([row[f"b{c}"] for c in "xyz"])
    length = float(np.linalg.norm(b - a))
    p, valid, across, z = sample_cuboid(patch >= policy.threshold, corner, shape, a, b, bound, policy.pad)
    centre = np.flatnonzero((z >= policy.interior[0] * length) & (z <= policy.interior[1] * length))
    away = np.sqrt(across[:, None] ** 2 + across[None, :] ** 2)
    found = []
    for k in centre:
        labels, n = K.label((p[k] >= 0.5) & valid[k])
        parts = [(float(away[labels == j].min()), -int((labels == j).sum()), j) for j in range(1, n + 1) if (labels == j).sum() >= 5]
        if parts and min(parts)[0] <= 8:
            own = labels == min(parts)[2]
            if not (own[0].any() or own[-1].any() or own[:, 0].any() or own[:, -1].any()):
                found.append(float(away[own].max()))
    ok = len(centre) > 0 and len(found) >= 0.75 * len(centre)
    return {"id": row["id"], "accepted": ok, "extent": float(np.median(found)) if ok else None}


def calibrated_radius(placed: DataFrame, blocks: DataFrame, shape: tuple[int, int, int], picks: int = 24, bound: int = 12, least: int = 6, policy: CorridorPolicy = CorridorPolicy()) -> float:
    """Corridor radius from material found around spread-out struts that lie well inside the volume.

    All such struts are candidates; their midpoints are picked from where they lie.
    """
    length = F.sqrt(sum(((F.col(f"b{c}") - F.col(f"a{c}")) * (F.col(f"b{c}") - F.col(f"a{c}")) for c in "xyz"), F.lit(0.0)))
    margin = bound + policy.pad * length + 1
    ok = length > 0
    for c, n in zip("xyz", shape[::-1]):
        ok = ok & (F.least(f"a{c}", f"b{c}") >= margin) & (F.greatest(f"a{c}", f"b{c}") <= n - 1 - margin)
    middle = placed.where(ok).select("id", *[((F.col(f"a{c}") + F.col(f"b{c}")) / 2).alias(c) for c in "xyz"])
    chosen = [i for i, _ in farthest_picks(middle, picks)]
    if not chosen:
        raise ValueError("no strut lies inside the volume")
    own = placed.where(F.col("id").isin(chosen)).select("id", *[f"{e}{c}" for e in "ab" for c in "xyz"])
    some = boxes_around(own, bound * math.sqrt(2) + 2 + policy.pad * length)
    found = on_patches(some, blocks, lambda row, patch, corner: _extent(row, patch, corner, shape, bound, policy), "id long, accepted boolean, extent double")
    extents = [r.extent for r in found.where("accepted").collect()]
    if len(extents) < least:
        raise ValueError(f"{len(extents)} struts could be measured, {least} are needed")
    return float(np.clip(math.ceil(np.quantile(extents, 0.9) + 0.5), 1, bound - 1))
