"""Whole analyses made of the operators: quality gates, spatial statistics, reports, lookups."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.operators import corridors as R
from strutwise.operators import histogram as H
from strutwise.operators import lattice as L
from strutwise.operators import sampling as P
from strutwise.operators import spatial as S
from strutwise.operators.classify import CLASSES
from strutwise.operators.patches import BRICK
from strutwise.sources.documents import digest, envelope
from strutwise.sources.storage import stored
from strutwise.sources.volumes import blocks_of


def with_overrides(policy, overrides: dict):
    """A policy with some values replaced; unknown names, other kinds and non-finite numbers raise an error."""
    known = {f.name: getattr(policy, f.name) for f in fields(policy)}
    for name, value in overrides.items():
        if name not in known:
            raise ValueError(f"no such setting: {name}")
        if isinstance(known[name], (int, float)) and not isinstance(known[name], bool):
            if isinstance(value, bool) or not isinstance(value, (int, float)) or not np.isfinite(value):
                raise ValueError(f"{name} must be a finite number")
        elif not isinstance(value, type(known[name])):
            raise ValueError(f"{name} must be like {known[name]!r}")
    return replace(policy, **overrides)


def merged(settings: dict, overrides: dict, within: str = "") -> dict:
    """Settings with some values replaced, group by group; neither is changed.

    Unknown names, groups in place of values (or the other way round), other
    kinds and non-finite numbers raise an error that names the setting.
    """
    out = dict(settings)
    for name, value in overrides.items():
        at = f"{within}{name}"
        if name not in settings:
            raise ValueError(f"no such setting: {at}")
        known = settings[name]
        if isinstance(known, dict) or isinstance(value, dict):
            if not (isinstance(known, dict) and isinstance(value, dict)):
                raise ValueError(f"{at} must be like {known!r}")
            out[name] = merged(known, value, f"{at}.")
        elif isinstance(known, bool) or not isinstance(known, (int, float)):
            if known is not None and not isinstance(value, type(known)):
                raise ValueError(f"{at} must be like {known!r}")
            out[name] = value
        elif isinstance(value, bool) or not isinstance(value, (int, float)) or not np.isfinite(value):
            raise ValueError(f"{at} must be a finite number")
        else:
            out[name] = value
    return out


def checked(settings: dict, ranges: dict[str, tuple[float, float]], shares: tuple[tuple[str, ...], ...] = ()) -> dict:
    """The settings, if all named ones (``group.name``) lie in their ranges and each tuple of shares sums to 1; else an error that lists what doesn't."""
    def get(path: str):
        value = settings
        for part in path.split("."):
            value = value[part]
        return value

    wrong = [f"{path} is not between {low} and {high}" for path, (low, high) in ranges.items() if not low <= get(path) <= high]
    wrong += [f"{', '.join(names)} don't sum to 1" for names in shares if abs(sum(map(get, names)) - 1.0) > 1e-9]
    if wrong:
        raise ValueError("; ".join(wrong))
    return settings


def modes(hist: DataFrame, coarse: int = 1024, sigma: float = 2.0, prominence: float = 0.003) -> list[float]:
    """Intensity modes in ascending order, ``coarse / 8`` at most."""
    return [r.mode for r in H.intensity_modes(hist, coarse, sigma, prominence).orderBy("mode").collect()]


def replay_threshold(hist: DataFrame) -> dict:
    """Threshold, diagnostics, modes and gates of a histogram, with the hash of all its bins."""
    t = H.otsu(hist)
    row = H.diagnostics(hist, t).first()
    if row is None:
        return envelope("error", "halt", "the histogram is empty")
    dense = np.zeros(65_536, dtype=">u8")
    for r in hist.collect():  # 65,536 bins at most
        dense[r.bin] = r.c
    import hashlib

    found = modes(hist)
    checks = {"fraction": row.fraction_ok, "separability": row.separability_ok, "separation": row.separation_ok, "modes": len(found) >= H.LEAST_PEAKS}
    return envelope("ok", "pass" if all(checks.values()) else "manual_review", f"threshold {row.threshold}", {"diagnostics": row.asDict(), "modes": found, "checks": checks}, hashes={"histogram": hashlib.sha256(dense.tobytes()).hexdigest()})


@dataclass(frozen=True)
class SupportPolicy:
    """How a placed lattice must be supported by the image; places along a strut run from ``ends`` to 1 - ``ends`` of its length."""
    junction_radius: int = 2
    corridor_radius: int = 24
    angles: int = 24
    steps: int = 13
    ends: float = 0.15
    confident: float = 0.9
    least_probability: float = 0.5
    least_junction: float = 0.85
    least_corridor: float = 0.08
    most_spread: float = 0.25
    most_distance: float = 5.0
    parts: int = 5


def image_support(corridors: DataFrame, placed: DataFrame, patches: DataFrame, distances: DataFrame, policy: SupportPolicy = SupportPolicy()) -> DataFrame:
    """One row of what supports a placed lattice in the image.

    ``corridors`` are those of :func:`corridors.corridors`, ``patches`` of
    ``sampling.patch_means`` around all junctions, ``distances`` (``distance``)
    lie between candidates kept out of the fit and the nearest node. Here a
    corridor's share counts samples outside the volume as empty, in all and by
    ring. ``unsupported`` is the share of struts with no material at any place,
    ``confident_share`` the share that a confident strut has at least, and
    ``confident`` how many there are. Of empty tables the measures are null and
    the counts 0.
    """
    each = F.col("foreground") / F.col("samples")
    rows = stored(corridors.select("id", each.alias("share"), "longest_gap", "samples", "ring_foreground"), "support")
    rings = rows.select("samples", F.posexplode("ring_foreground").alias("ring", "hits")).groupBy("ring").agg(F.sum("hits").alias("hits"), F.count("*").alias("n"))
    places = F.when(F.col("ring") == 0, 1).otherwise(policy.angles) * policy.steps
    likely = F.col("hits") / (F.col("n") * places) >= policy.least_probability
    found = stored(S.quantiles(rows, "share", tuple(sorted({0.1, 0.5, 0.9, policy.confident}))), "corridor-quantiles")
    at = found.select(F.col("n").alias("struts"), *[F.col(f"p{k}").alias(f"corridor_p{k}") for k in (10, 50, 90)])
    limit = found.select(F.col(f"p{round(100 * policy.confident)}").alias("confident_share"))
    confident = rows.join(F.broadcast(limit)).agg(F.count_if(F.col("share") >= F.col("confident_share")).alias("confident"), F.avg((F.col("longest_gap") == policy.steps).cast("double")).alias("unsupported"))
    patches = stored(patches.select("fraction", "foreground"), "patches")
    spread = axis_spreads(placed, rows, "share", policy.parts).agg(*[F.max(F.when(F.col("axis") == c, F.col("spread"))).alias(f"spread_{c}") for c in "xyz"])
    return _one_row([
        patches.agg(F.count("*").alias("junctions"), F.avg("fraction").alias("junction_mean"), F.avg((F.col("foreground") > 0).cast("double")).alias("junction_any")),
        S.quantiles(patches, "fraction", (0.5,)).select(F.col("p50").alias("junction_median")),
        S.quantiles(distances, "distance", (0.5, 0.95)).select(F.col("n").alias("candidates"), F.col("p50").alias("distance_median"), F.col("p95").alias("distance_p95")),
        at, limit, confident, rings.agg(F.coalesce(F.max(F.when(likely, F.col("ring"))), F.lit(0)).cast("int").alias("radius")), spread,
    ])


def support_gates(support: DataFrame, policy: SupportPolicy = SupportPolicy()) -> DataFrame:
    """``gate, value, passed`` of each check of one row of :func:`image_support`; a value that isn't known fails."""
    spread = F.greatest(*[F.col(f"spread_{c}") for c in "xyz"])
    checks = [
        ("junctions_filled", F.col("junction_mean"), F.col("junction_mean") >= policy.least_junction), ("corridors_filled", F.col("corridor_p50"), F.col("corridor_p50") >= policy.least_corridor),
        ("even_in_space", spread, spread <= policy.most_spread), ("candidates_near", F.col("distance_median"), F.col("distance_median") <= policy.most_distance),
        ("radius_measured", F.col("radius"), F.col("radius") > 0),
    ]
    return support.select(F.inline(F.array(*[F.struct(F.lit(g).alias("gate"), v.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("passed")) for g, v, ok in checks])))


@dataclass(frozen=True)
class QualityPolicy:
    junction_radius: int = 2
    corridor_radius: float = 6.0
    angles: int = 8
    steps: int = 9
    least_junction: float = 0.85
    least_corridor: float = 0.08
    most_spatial_range: float = 0.25
    least_inside: float = 0.99
    most_ratio: float = 1.0


def axis_spreads(placed: DataFrame, occupied: DataFrame, share: str = "fraction", parts: int = 5) -> DataFrame:
    """``axis, spread``: the largest difference of median occupancy between parts of equal counts of the struts' midpoints along each axis."""
    where = stored(placed.select("id", *[((F.col(f"a{c}") + F.col(f"b{c}")) / 2).alias(f"m{c}") for c in "xyz"]).join(occupied.select("id", share), "id"), "placed")
    every = None
    for c in "xyz":
        one = S.equal_count_parts(where.select(F.lit(c).alias("axis"), F.col(f"m{c}").alias("m"), "id", share), "m", "id", parts)
        every = one if every is None else every.unionByName(one)
    return S.quantiles(every, share, (0.5,), "axis", "part").groupBy("axis").agg((F.max("p50") - F.min("p50")).alias("spread"))


def _one_row(rows: list[DataFrame]) -> DataFrame:
    out = rows[0]
    for r in rows[1:]:
        out = out.join(r)  # one row each
    return out


def quality_measures(corridors: DataFrame, patches: DataFrame, placed: DataFrame, junctions: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """One row: ``junction_mean, corridor_median, contained, radius, spread, outside``.

    ``corridors`` are those of :func:`corridors.corridors`, ``patches`` the means
    around all junctions. ``spread`` is the largest difference of median
    occupancy between fifths of the struts along an axis; ``outside`` counts
    junctions that aren't in the volume.
    """
    occupied = stored(corridors, "corridors")
    inside = P.inside((F.col("x"), F.col("y"), F.col("z")), shape[::-1])
    return _one_row([
        patches.agg(F.avg("fraction").alias("junction_mean")), S.quantiles(occupied, "fraction", (0.5,)).select(F.col("p50").alias("corridor_median")),
        occupied.agg(F.avg(F.col("contained").cast("double")).alias("contained")), P.measured_radius(R.ring_profile(occupied)),
        axis_spreads(placed, occupied).agg(F.max("spread").alias("spread")), junctions.agg(F.count_if(~inside).alias("outside")),
    ])


def quality_gates(measures: DataFrame, uncertainty: float | None = None, stability: float = 0.0, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """``kind, gate, value, passed`` of each check of one row of measures; a value that isn't known fails."""
    ratio = F.lit(None).cast("double") if uncertainty is None else F.lit(uncertainty + stability) / F.nullif(F.col("radius").cast("double"), F.lit(0.0))
    checks = [
        ("image", "junctions_filled", F.col("junction_mean"), F.col("junction_mean") >= policy.least_junction), ("image", "corridors_filled", F.col("corridor_median"), F.col("corridor_median") >= policy.least_corridor),
        ("image", "even_in_space", F.col("spread"), F.col("spread") <= policy.most_spatial_range), ("image", "nodes_inside", F.col("outside"), F.col("outside") == 0),
        ("region", "corridors_inside", F.col("contained"), F.col("contained") >= policy.least_inside), ("metrology", "radius_measured", F.col("radius"), F.col("radius") > 0),
        ("metrology", "uncertainty_known", F.lit(uncertainty), F.lit(uncertainty is not None)), ("metrology", "uncertainty_small", ratio, ratio <= policy.most_ratio),
    ]
    structs = [F.struct(F.lit(kind).alias("kind"), F.lit(gate).alias("gate"), value.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("passed")) for kind, gate, value, ok in checks]
    return measures.select(F.inline(F.array(*structs)))


def registration_quality(placed: DataFrame, junctions: DataFrame, voxels: DataFrame, shape: tuple[int, int, int], integrity: dict[str, bool], uncertainty: float | None = None, stability: float = 0.0, policy: QualityPolicy = QualityPolicy()) -> dict:
    """How well a placed lattice lies on the material: image, region and metrology checks, and the gate.

    A failed integrity check halts; a failed image or region check, or a
    measurement whose uncertainty is not known or too large, asks for review.
    """
    blocks = blocks_of(voxels.select("z", "y", "x", F.col("fg").cast("int").alias("value")), shape, "u1", BRICK)
    corridors = stored(R.corridors(placed, blocks, shape, 1, policy.corridor_radius, policy.angles, policy.steps), "corridors")
    measures = stored(quality_measures(corridors, P.patch_means(junctions, voxels, policy.junction_radius), placed, junctions, shape), "measures")
    row = measures.first()
    found = quality_gates(measures, uncertainty, stability, policy).collect()  # eight gates
    image = {g.gate: g.passed for g in found if g.kind == "image"}
    failed = [f"integrity.{n}" for n, ok in integrity.items() if not ok] + [f"{g.kind}.{g.gate}" for g in found if not g.passed]
    gate = "halt" if not all(integrity.values()) else "manual_review" if failed else "pass"
    ratio = next(g.value for g in found if g.gate == "uncertainty_small")
    ranges = {c: None for c in "xyz"} | {r.axis: r.spread for r in axis_spreads(placed, corridors).collect()}
    return {"gate": gate, "failed": failed, "junction_mean": row.junction_mean, "corridor_median": row.corridor_median, "spatial_range": ranges, "measured_radius": row.radius, "ratio": ratio, "allowed": {"screening": all(image.values()), "metrology": gate == "pass"}}


def spatial_statistics(classified: DataFrame, struts: DataFrame, junctions: DataFrame) -> dict:
    """Counts and fractions by class, clusters of defects, axis thirds and bounds of their midpoints."""
    unknown = classified.where(~F.col("class").isin(*CLASSES)).limit(1).count()
    if unknown:
        raise ValueError("an unknown class")
    cover = L.coverage(struts, classified).first()
    if not cover.equal:
        raise ValueError(f"classes don't cover the struts: missing {cover.first_missing}, extra {cover.first_extra}")
    bad = classified.where("class <> 'present'").select("id", "class")
    middle = L.with_endpoints(struts.join(bad, "id"), junctions).select("id", "class", *[((F.col(f"a{c}") + F.col(f"b{c}")) / 2).alias(c) for c in "xyz"])
    sizes = L.cluster_sizes(L.shared_junction_clusters(struts.join(bad, "id", "left_semi")))
    top = sizes.orderBy(F.desc("size"), "cluster").limit(20).collect()
    return {
        "classes": {r["class"]: {"n": r.n, "fraction": r.fraction} for r in S.class_fractions(classified, list(CLASSES)).collect()},
        "clusters": sizes.count(), "largest": [{"cluster": r.cluster, "size": r["size"]} for r in top],
        "thirds": {f"{r.axis}{r.third}": r.n for r in S.thirds(middle).collect()}, "bounds": S.bounds(middle).first().asDict(),
    }


def strut_report(strut_id: int, classified: DataFrame, metrics: DataFrame, evidence: DataFrame | None = None) -> dict:
    """Everything on one strut; exactly one class and one metrics row must exist."""
    kind = classified.where(F.col("id") == strut_id).limit(2).collect()
    row = metrics.where(F.col("id") == strut_id).limit(2).collect()
    if len(kind) != 1 or len(row) != 1:
        raise ValueError(f"strut {strut_id} has {len(kind)} classes and {len(row)} metrics rows")
    found = evidence.where(F.col("id") == strut_id).collect() if evidence is not None else []
    return {"strut_id": strut_id, "class": kind[0].asDict(), "metrics": row[0].asDict(), "evidence": [r.asDict() for r in found]}


def report_text(statistics: dict) -> str:
    """The population table and largest clusters of spatial statistics as plain text."""
    lines = ["class | struts | share"]
    lines += [f"{name} | {v['n']} | {100 * (v['fraction'] or 0):.2f} %" for name, v in statistics["classes"].items()]
    lines.append(f"clusters of defects: {statistics['clusters']}")
    lines += [f"cluster {c['cluster']}: {c['size']} struts" for c in statistics["largest"][:10]]
    return "\n".join(lines)


def missing_geometry(struts: DataFrame, nodes: DataFrame, strut_gaps: DataFrame, node_gaps: DataFrame, limit: float = 0.5) -> DataFrame:
    """One row: struts and physical nodes farther than ``limit`` from any surface, counts and percent.

    ``strut_gaps`` and ``node_gaps``: ``id, distance``; a strut or node without one counts as missing.
    """
    def side(rows: DataFrame, gaps: DataFrame, name: str) -> DataFrame:
        far = F.coalesce(F.col("distance") > limit, F.lit(True))
        return rows.select("id").join(gaps.select("id", "distance"), "id", "left").agg(F.count("*").alias(name), F.count_if(far).alias(f"missing_{name}"))

    out = side(struts, strut_gaps, "struts").join(side(nodes, node_gaps, "nodes"))
    return out.select("*", *[(100 * F.col(f"missing_{n}") / F.nullif(F.col(n).cast("double"), F.lit(0.0))).alias(f"percent_{n}") for n in ("struts", "nodes")])


def external_cases(cases: DataFrame, scans: int = 3, geometries: int = 2, share: float = 0.9) -> DataFrame:
    """One row: whether enough scans and geometries passed. ``cases``: ``scan, geometry, passed``."""
    sums = cases.agg(F.count_distinct("scan").alias("scans"), F.count_distinct("geometry").alias("geometries"), F.avg(F.coalesce("passed", F.lit(False)).cast("double")).alias("share"))
    return sums.withColumn("sufficient", (F.col("scans") >= scans) & (F.col("geometries") >= geometries) & F.coalesce(F.col("share") >= share, F.lit(False)))


def tolerance(uncertainties: list[float], margin: float, radius: float) -> dict:
    """Whether the largest of several uncertainties leaves a margin within the strut radius."""
    worst = max(uncertainties)
    return {"uncertainty": worst, "left": radius - worst, "ratio": worst / radius if radius else None, "pass": bool(radius) and worst + margin <= radius}


def volume_summary(cells: DataFrame, skeleton: DataFrame) -> dict:
    """Masked mean intensity and skeleton counts. ``cells``: ``value, fg``; ``skeleton``: ``z, y, x``."""
    return {"mask": H.masked_mean(cells, F.col("fg")).first().asDict(), "skeleton": P.skeleton_points(skeleton).first().asDict()}


def projections(volume: np.ndarray) -> dict[str, np.ndarray]:
    """Largest values of an aligned cuboid along each of its axes."""
    return {name: volume.max(axis=k) for k, name in enumerate("zyx")}


def bound_hashes(parts: dict[str, object]) -> dict[str, str]:
    """The digest of each part and one over all of them, to bind a result to what it was made from."""
    own = {k: digest(v) for k, v in sorted(parts.items())}
    return own | {"all": digest(own)}
