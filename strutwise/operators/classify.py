"""Features of axial profiles, defect rules, and how their findings are merged."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strutwise.functions import sequences as S

CLASSES = ("missing", "broken", "thin", "present", "deferred")


@dataclass(frozen=True)
class DefectPolicy:
    """Cut-offs of the profile rules."""

    span: tuple[float, float] = (0.2, 0.8)
    window: int = 3
    presence: float = 0.05
    reference_quantile: float = 0.9
    deficit_share: float = 0.5
    missing_present: float = 0.10
    broken_deficit: float = 0.15
    broken_run: int = 3
    collar: float = 0.05
    endpoint_voxels: int = 500
    unresolved: str = "review"


@dataclass(frozen=True)
class LegacyPolicy:
    missing_occupancy: float = 0.8
    missing_gap: float = 0.1
    broken_gap: float = 0.9
    broken_component: float = 0.05
    thin_radius: float = 0.1
    bent_curvature: float = 10.0


def profile_features(profiles: DataFrame, policy: DefectPolicy = DefectPolicy(), central: Column | None = None) -> DataFrame:
    """Adds the features of the central span of ``fg`` (array by axial place ``t``).

    ``central`` may say itself which (t, place) lies in the span. A span shorter
    than the smoothing window, or none, gives null features.
    """
    low, high = policy.span
    picked = central if central is not None else F.filter(F.arrays_zip("t", "fg"), lambda p: (p["t"] >= low) & (p["t"] <= high))
    rows = profiles.withColumn("__span", F.transform(picked, lambda p: p["fg"].cast("double")))
    rows = rows.withColumn("__ok", F.coalesce(F.size("__span") >= policy.window, F.lit(False)))
    span = F.when(F.col("__ok"), F.col("__span"))
    rows = rows.withColumn("__span", span).withColumn("reference", S.quantile(F.col("__span"), policy.reference_quantile))
    rows = rows.withColumn("cutoff", F.col("reference") * policy.deficit_share)
    span = F.col("__span")
    deficient = F.transform(span, lambda x: x < F.col("cutoff"))
    present = F.transform(span, lambda x: x >= policy.presence)
    loss = F.transform(span, lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - x / F.col("reference"))))
    smooth = S.moving_average(span, policy.window)
    left, right = S.third_shares(present)
    return (
        rows.withColumn("samples", F.size(span))
        .withColumn("present_fraction", S.share(present))
        .withColumn("longest_absent", S.longest_gap(present))
        .withColumn("deficit_fraction", S.share(deficient))
        .withColumn("deficit_run", S.longest_run(deficient))
        .withColumn("material_loss", F.when(span.isNull(), None).when(F.col("reference") > 0, S.mean(loss)).otherwise(1.0))
        .withColumn("minimum", F.array_min(span))
        .withColumn("relative_minimum", F.when(F.col("reference") > 0, F.array_min(span) / F.col("reference")))
        .withColumn("smoothed_minimum", F.array_min(smooth))
        .withColumn("left_present", left)
        .withColumn("right_present", right)
        .drop("__span", "__ok")
    )


def endpoint_evidence(policy: DefectPolicy = DefectPolicy()) -> Column:
    """Material at both ends: segments observed, collars filled, enough voxels."""
    return (
        F.coalesce(F.col("both_observed"), F.lit(False))
        & (F.least("collar_a", "collar_b") >= policy.collar)
        & (F.least("voxels_a", "voxels_b") >= policy.endpoint_voxels)
    )


def missing_rule(policy: DefectPolicy = DefectPolicy()) -> Column:
    """positive or negative: not connected and hardly any central sample present."""
    hit = ~F.coalesce(F.col("connected"), F.lit(False)) & (F.col("present_fraction") <= policy.missing_present)
    return F.when(F.coalesce(hit, F.lit(False)), "positive").otherwise("negative")


def broken_rule(policy: DefectPolicy = DefectPolicy()) -> tuple[Column, Column]:
    """(disposition, reason) of struts that are not missing but have a deficit between two ends with material."""
    connected = F.coalesce(F.col("connected"), F.lit(False))
    deficit = F.coalesce((F.col("deficit_fraction") >= policy.broken_deficit) | (F.col("deficit_run") >= policy.broken_run), F.lit(False))
    missing = missing_rule(policy) == "positive"
    hit = deficit & F.coalesce(endpoint_evidence(policy), F.lit(False))
    kind = F.when(missing, "negative").when(hit, "positive").when(~connected, policy.unresolved).otherwise("negative")
    reason = (
        F.when(missing, "missing").when(hit & connected, "connected_bite").when(hit, "disconnected_fragment")
        .when(~connected, "unresolved_disconnection").otherwise("no_deficit")
    )
    return kind, reason


#: What a specialist that isn't there yet says of every strut.
DEFERRED_REASON = "specialist_not_implemented"


def finding(kind: str, disposition: Column, reasons: Column, evidence_required: Column) -> Column:
    """What one specialist says of a strut."""
    return F.struct(F.lit(kind).alias("kind"), disposition.alias("disposition"), reasons.alias("reasons"), evidence_required.alias("evidence_required"))


def deferred_finding(kind: str) -> Column:
    """What an absent specialist says of every strut."""
    return finding(kind, F.lit("deferred"), F.array(F.lit(f"{kind}_{DEFERRED_REASON}")), F.lit(False))


def findings_of(struts: DataFrame, said: list[Column], key: str = "strut_id") -> DataFrame:
    """A row for each strut and :func:`finding`: ``kind, disposition, reasons, evidence_required``; struts are read once and stay where they are."""
    return struts.select(key, F.inline(F.array(*said)))


def deferred_findings(struts: DataFrame, kinds: tuple[str, ...] = ("thin", "bent"), key: str = "strut_id") -> DataFrame:
    """A row for each strut and absent specialist, all deferred."""
    return findings_of(struts.select(key).distinct(), [deferred_finding(k) for k in kinds], key)


def findings_wide(findings: DataFrame, key: str = "strut_id") -> DataFrame:
    """One row a strut with a disposition for each kind, as ``merge`` takes them, and all reasons in order."""
    of = lambda k: F.max(F.when(F.col("kind") == k, F.col("disposition"))).alias(k)
    reasons = F.array_sort(F.array_distinct(F.flatten(F.collect_list("reasons")))).alias("reasons")
    return findings.groupBy(key).agg(*[of(k) for k in ("missing", "broken", "thin", "bent")], reasons)


def merge(findings: DataFrame, specialists_complete: bool = True) -> DataFrame:
    """Class by precedence from ``missing, broken, thin, bent`` dispositions of each strut.

    missing, then broken, then thin if positive; any review, then any deferred
    specialist gives deferred; else present. ``bent`` (boolean) stays apart and
    is null while its specialist is deferred.
    """
    pos = lambda k: F.coalesce(F.col(k) == "positive", F.lit(False))
    any_of = lambda v: sum((F.coalesce(F.col(k) == v, F.lit(False)).cast("int") for k in ("missing", "broken", "thin", "bent")), F.lit(0)) > 0
    kind = (
        F.when(pos("missing"), "missing").when(pos("broken"), "broken").when(pos("thin"), "thin")
        .when(any_of("review"), "deferred").when(any_of("deferred"), "deferred").otherwise("present")
    )
    reason = (
        F.when(pos("missing"), "missing_positive").when(pos("broken"), "broken_positive").when(pos("thin"), "thin_positive")
        .when(any_of("review"), "specialist_review_required").when(any_of("deferred"), "specialist_implementation_deferred").otherwise("all_negative")
    )
    bent = F.when(F.col("bent") == "deferred", None).otherwise(pos("bent"))
    out = findings.withColumn("class", kind).withColumn("reason", reason).withColumn("is_bent", bent)
    return out.withColumn("evidence_required", F.col("class").isin("missing", "broken", "thin") | F.coalesce(F.col("is_bent"), F.lit(False)) | any_of("review"))


def legacy_class(policy: LegacyPolicy = LegacyPolicy()) -> tuple[Column, Column]:
    """(class, bent) from ``occupancy, gap, component, radius, curvature``; null metrics count as 0."""
    v = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    kind = (
        F.when((v("occupancy") <= policy.missing_occupancy) & (v("gap") >= policy.missing_gap), "missing")
        .when((v("gap") >= policy.broken_gap) | (v("component") <= policy.broken_component), "broken")
        .when(v("radius") <= policy.thin_radius, "thin").otherwise("present")
    )
    return kind, v("curvature") >= policy.bent_curvature


def report_remap(rows: DataFrame, plane: Column) -> DataFrame:
    """``class`` as reports show it, the first branch that holds: deferred; on the crop plane; connected broken.

    All three become present; the branch is appended to ``reasons``.
    """
    faulty = F.col("class").isin("missing", "broken")
    connected = F.coalesce(F.col("connected"), F.lit(False))
    why = (
        F.when(F.col("class") == "deferred", "deferred_to_present").when(faulty & F.coalesce(plane, F.lit(False)), "exclude_crop_plane")
        .when((F.col("class") == "broken") & connected, "connected_broken_to_present")
    )
    added = rows.withColumn("__why", why)
    return (
        added.withColumn("original_class", F.col("class"))
        .withColumn("class", F.when(F.col("__why").isNotNull(), "present").otherwise(F.col("class")))
        .withColumn("reasons", F.when(F.col("__why").isNotNull(), F.array_append(F.coalesce("reasons", F.array().cast("array<string>")), F.col("__why"))).otherwise(F.col("reasons")))
        .drop("__why")
    )


def touches_plane(a: Column, b: Column, at: float, tolerance: float = 1e-9) -> Column:
    """Whether either end lies on the plane."""
    return (F.abs(a - F.lit(at)) <= tolerance) | (F.abs(b - F.lit(at)) <= tolerance)


def split_without_connection(present: Column, a_observed: Column, b_observed: Column, cut: float = 0.10) -> Column:
    """missing, broken or review for struts known not to be connected."""
    return F.when(present <= cut, "missing").when(F.coalesce(a_observed & b_observed, F.lit(False)), "broken").otherwise("review")


def material_loss_label(crop: Column, connected: Column, present: Column, deficit: Column, policy: DefectPolicy = DefectPolicy()) -> Column:
    """One of five labels for every strut: crop edges first, then what the profile shows."""
    return (
        F.when(F.coalesce(crop, F.lit(False)), "intentional_edge_crop")
        .when(~F.coalesce(connected, F.lit(False)) & (present <= policy.missing_present), "missing")
        .when(~F.coalesce(connected, F.lit(False)) & (deficit >= policy.broken_deficit), "broken")
        .when(~F.coalesce(connected, F.lit(False)), "not_connected_review")
        .when(deficit >= policy.broken_deficit, "connected_loss").otherwise("present")
    )


def edge_quality(struts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Match class of each strut, the worse of its ends', and what it may be used for.

    ``nodes``: ``id, match_class, accepted, boundary``. An unknown end is ambiguous.
    """
    order = ["primary", "stable_coarse", "fallback", "ambiguous"]
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in order]), F.col("match_class")).cast("int"), F.lit(4))
    known = nodes.select(
        "id", rank.alias("rank"), (~F.col("boundary") & (rank < 4)).alias("roi"), (F.col("accepted") & ~F.col("boundary")).alias("metrology")
    )
    end = lambda p: known.select(*[F.col(c).alias(f"{p}_{c}") for c in known.columns])
    both = struts.join(end("a"), F.col("junction0") == F.col("a_id"), "left").join(end("b"), F.col("junction1") == F.col("b_id"), "left")
    worst = F.greatest(F.coalesce("a_rank", F.lit(4)), F.coalesce("b_rank", F.lit(4)))
    yes = lambda c: F.coalesce(F.col(f"a_{c}"), F.lit(False)) & F.coalesce(F.col(f"b_{c}"), F.lit(False))
    return both.select(
        "id",
        F.element_at(F.array(*[F.lit(x) for x in order]), worst).alias("match_class"), yes("roi").alias("usable_for_roi"), yes("metrology").alias("usable_for_metrology"),
    )
