import numpy as np
import pytest
from pyspark.sql import functions as F

from strutwise.operators import classify as C
from strutwise.operators import evaluate as E
from strutwise.operators import lattice as L
from strutwise.operators import sampling as P
from strutwise.plans import analyses as A

JUNCTIONS = [(10, 0.0, 0.0, 0.0), (20, 10.0, 0.0, 0.0), (30, 20.0, 0.0, 0.0), (40, 30.0, 0.0, 0.0)]
STRUTS = [(101, 10, 20), (205, 20, 30), (999, 30, 40)]


@pytest.fixture(scope="module")
def chain(spark):
    return (spark.createDataFrame(STRUTS, "id long, junction0 long, junction1 long"), spark.createDataFrame(JUNCTIONS, "id long, x double, y double, z double"))


def kinds(spark, **by):
    return spark.createDataFrame([(int(k[1:]), v) for k, v in by.items()], "id long, class string")


def test_spatial_statistics(spark, chain):
    struts, junctions = chain
    got = A.spatial_statistics(kinds(spark, s101="missing", s205="broken", s999="present"), struts, junctions)
    assert got["clusters"] == 1 and got["largest"] == [{"cluster": 101, "size": 2}]
    assert got["classes"]["missing"] == {"n": 1, "fraction": 1 / 3} and got["classes"]["thin"]["n"] == 0
    assert got["bounds"]["low_x"] == 5.0 and "missing | 1" in A.report_text(got)
    with pytest.raises(ValueError, match="cover"):
        A.spatial_statistics(kinds(spark, s101="missing"), struts, junctions)
    with pytest.raises(ValueError, match="unknown"):
        A.spatial_statistics(kinds(spark, s101="odd", s205="broken", s999="present"), struts, junctions)


def test_one_strut(spark, chain):
    classes = kinds(spark, s101="missing")
    metrics = spark.createDataFrame([(101, 2.0)], "id long, length double")
    assert A.strut_report(101, classes, metrics, metrics)["evidence"] == [{"id": 101, "length": 2.0}]
    with pytest.raises(ValueError):
        A.strut_report(205, classes, metrics)


def profile(spark):
    t = [round(-0.1 + 0.1 * k, 1) for k in range(13)]
    rows = [(1, False, [0.8] * 3 + [0.0] * 7 + [0.8] * 3), (2, False, [0.8] * 3 + [0.1] * 2 + [0.8] * 8), (3, True, [0.8] * 3 + [0.1] * 2 + [0.8] * 8), (4, True, [0.8] * 13)]
    df = spark.createDataFrame([(i, c, t, f) for i, c, f in rows], "strut_id long, connected boolean, t array<double>, fg array<double>")
    return df.select("*", F.lit(True).alias("both_observed"), F.lit(0.2).alias("collar_a"), F.lit(0.2).alias("collar_b"), F.lit(1000).alias("voxels_a"), F.lit(1000).alias("voxels_b"))


def test_rules_on_four_profiles(spark):
    kind, reason = C.broken_rule()
    rows = C.profile_features(profile(spark)).withColumn("missing", C.missing_rule()).withColumn("reason", reason).withColumn("broken", kind)
    got = {r.strut_id: (r.missing, r.broken, r.reason) for r in rows.collect()}
    assert got == {1: ("positive", "negative", "missing"), 2: ("negative", "positive", "disconnected_fragment"), 3: ("negative", "positive", "connected_bite"), 4: ("negative", "negative", "no_deficit")}
    merged = C.merge(rows.withColumn("thin", F.lit("deferred")).withColumn("bent", F.lit("deferred")).drop("reason"))
    out = {r.strut_id: (r["class"], r.is_bent) for r in merged.collect()}
    assert out == {1: ("missing", None), 2: ("broken", None), 3: ("broken", None), 4: ("deferred", None)}


def test_short_and_empty_profiles(spark):
    df = spark.createDataFrame([(1, [0.5], [0.1]), (2, [], []), (3, [0.2, 0.5, 0.8], [0.0, 0.0, 0.0]), (4, None, None)], "strut_id long, t array<double>, fg array<double>")
    got = {r.strut_id: r for r in C.profile_features(df).collect()}
    assert got[1].reference is None and got[2].material_loss is None and got[4].present_fraction is None
    assert got[3].material_loss == 1.0 and got[3].relative_minimum is None and got[3].deficit_fraction == 0.0


def test_legacy_rule(spark):
    df = spark.createDataFrame([(303, 0.5, 0.2, 1.0, 1.0, 20.0), (1, None, None, None, None, None), (2, 0.9, 0.95, 1.0, 1.0, 0.0), (3, 0.9, 0.0, 0.5, 0.05, 0.0), (4, 0.9, 0.0, 0.5, 1.0, 0.0)], "id long, occupancy double, gap double, component double, radius double, curvature double")
    kind, bent = C.legacy_class()
    got = {r.id: (r[1], r[2]) for r in df.select("id", kind, bent).collect()}
    assert got == {303: ("missing", True), 1: ("broken", False), 2: ("broken", False), 3: ("thin", False), 4: ("present", False)}


def test_labels_in_four_layouts(spark):
    for doc in ('{"strut_ids":[3,4]}', '{"missing_strut_ids":[3,4]}', '{"sealed_strut_ids":[3,4]}', '{"labels":[{"strut_id":3,"class":"missing"},{"strut_id":4,"class":"broken"}]}'):
        df = spark.read.json(spark.sparkContext.parallelize([doc]))
        assert {r.strut_id for r in E.label_layouts(df).collect()} == {3, 4}
    with pytest.raises(ValueError):
        E.label_layouts(spark.range(1))


def test_detection(spark):
    sealed = spark.createDataFrame([(k,) for k in range(10)], "strut_id long")
    predicted = spark.createDataFrame([(k, "missing" if k < 5 else "broken" if k < 7 else "present") for k in range(9)], "strut_id long, class string")
    r = E.detection(sealed, predicted).first()
    assert (r.strict_recall, r.lenient_recall, r.unpredicted) == (0.5, 0.7, 1) and abs(r.strict_low - 0.2366) < 1e-3
    assert E.detection(sealed.limit(0), predicted).first().strict_recall is None


def test_integrity_and_topology(spark, chain):
    struts, junctions = chain
    bad = struts.unionAll(spark.createDataFrame([(101, 20, 10), (5, 10, 10), (6, 10, 77)], struts.schema))
    assert L.problems(bad, junctions).first().asDict() == {"repeated_struts": 1, "repeated_junctions": 0, "repeated_pairs": 1, "self_loops": 1, "unknown_ends": 1}
    assert L.topology_differences(struts, struts).first().equal
    assert L.coverage(struts, struts.limit(0)).first().first_missing == [101, 205, 999]
    assert L.membership(spark.createDataFrame([(7, [9, 3])], "id long, struts array<bigint>")).collect() == [(7, 0, 3), (7, 1, 9)]
    assert L.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("chunk", [5, 60, 1 << 20])
def test_components_over_chunks_and_rounds(spark, monkeypatch, chunk):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, 5000), (1000, 1001)]
    near = {a: {a} for p in pairs for a in p}
    for a, b in pairs:
        joined = near[a] | near[b]
        for k in joined:
            near[k] = joined
    monkeypatch.setattr(L, "CHUNK", chunk)
    got = sorted(map(tuple, L.components(spark.createDataFrame(pairs, "u long, v long").repartition(4)).collect()))
    assert got == sorted((k, min(own)) for k, own in near.items())


def test_components_of_paths_whose_edges_never_meet(spark, monkeypatch):
    """Each edge is joined by itself, so that no task sees two of a path; the tables written stay few."""
    written, stored = [], L.stored

    def counted(df, name):
        written.append(name)
        assert len(written) < 150, "rounds don't end"
        return stored(df, name)

    monkeypatch.setattr(L, "stored", counted)
    monkeypatch.setattr(L, "CHUNK", 1)
    pairs = [(k, k + 1) for k in range(40)] + [(k + 1, k) for k in range(100, 110)]
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 1)
    try:
        got = sorted(map(tuple, L.components(spark.createDataFrame(pairs, "u long, v long")).collect()))
    finally:
        spark.conf.set(batch, before)
    assert got == [(k, 0) for k in range(41)] + [(k, 100) for k in range(100, 111)]


def test_cubes_and_skeletons(spark):
    cells = [(k, 6, 6) for k in range(3, 9)] + [(6, k, 6) for k in range(3, 9) if k != 6]
    got = P.skeleton_points(spark.createDataFrame(cells, "z int, y int, x int")).first()
    assert got.voxels == 11 and got.branch_points > 0
    line = spark.createDataFrame([(k, 1, 1) for k in range(40)], "z int, y int, x int")
    assert tuple(P.skeleton_points(line).first()) == (40, 2, 0)
    nodes = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 5.0, 5.0, 5.0)], "id long, z double, y double, x double")
    cut = {r.id: (r.truncated, r.z0, r.z1) for r in P.cropped(nodes, 2, (11, 11, 11)).collect()}
    assert cut == {1: (True, 0, 2), 2: (False, 3, 7)}


def test_quality_gate(spark, chain):
    vox = spark.range(30 * 30 * 30).select(*[(F.floor(F.col("id") / n) % 30).cast("int").alias(c) for c, n in (("z", 900), ("y", 30), ("x", 1))])
    vox = vox.withColumn("fg", (F.abs(F.col("z") - 15) <= 3) & (F.abs(F.col("y") - 15) <= 3))
    j = spark.createDataFrame([(1, 8.0, 15.0, 15.0), (2, 22.0, 15.0, 15.0)], "id long, x double, y double, z double")
    s = L.with_endpoints(spark.createDataFrame([(1, 1, 2)], "id long, junction0 long, junction1 long"), j)
    policy = A.with_overrides(A.QualityPolicy(), {"corridor_radius": 3.0})
    got = A.registration_quality(s, j, vox, (30, 30, 30), {"hashes": True}, uncertainty=1.0, policy=policy)
    assert got["gate"] == "pass" and got["measured_radius"] == 3 and got["junction_mean"] == 1.0
    assert A.registration_quality(s, j, vox, (30, 30, 30), {"hashes": True}, policy=policy)["failed"] == ["metrology.uncertainty_known", "metrology.uncertainty_small"]
    assert A.registration_quality(s, j, vox, (30, 30, 30), {"hashes": False}, uncertainty=1.0, policy=policy)["gate"] == "halt"


def test_settings():
    assert A.with_overrides(C.DefectPolicy(), {"presence": 0.1}).presence == 0.1
    for bad in ({"nope": 1}, {"presence": float("nan")}, {"presence": "x"}, {"unresolved": 3}):
        with pytest.raises(ValueError):
            A.with_overrides(C.DefectPolicy(), bad)


def test_grouped_settings():
    base = {"fit": {"keep": 0.7, "rounds": 60, "name": "icp"}, "weights": {"core": 0.7, "arms": 0.3}, "on": True, "note": None}
    got = A.merged(base, {"fit": {"keep": 1}, "on": False, "note": "x"})
    assert got == {"fit": {"keep": 1, "rounds": 60, "name": "icp"}, "weights": {"core": 0.7, "arms": 0.3}, "on": False, "note": "x"} and base["fit"]["keep"] == 0.7
    for bad, why in (({"fat": 1}, "fat"), ({"fit": {"kept": 1}}, "fit.kept"), ({"fit": 1}, "fit"), ({"on": {"a": 1}}, "on"), ({"on": 1}, "on"), ({"fit": {"keep": float("inf")}}, "fit.keep"), ({"fit": {"rounds": True}}, "fit.rounds"), ({"fit": {"name": 3}}, "fit.name")):
        with pytest.raises(ValueError, match=why):
            A.merged(base, bad)
    shares = (("weights.core", "weights.arms"),)
    assert A.checked(base, {"fit.keep": (0, 1)}, shares) is base
    with pytest.raises(ValueError, match="fit.keep.*sum to 1"):
        A.checked(A.merged(base, {"fit": {"keep": 2}, "weights": {"core": 0.8}}), {"fit.keep": (0, 1)}, shares)


def test_small_tables(spark, chain):
    struts, junctions = chain
    gaps = spark.createDataFrame([(101, 0.1), (205, 0.9)], "id long, distance double")
    r = A.missing_geometry(struts, junctions, gaps, gaps).first()
    assert (r.struts, r.missing_struts, r.nodes, r.missing_nodes) == (3, 2, 4, 4)
    cases = spark.createDataFrame([("a", "g", True), ("b", "g", True), ("c", "h", None)], "scan string, geometry string, passed boolean")
    assert tuple(A.external_cases(cases).first()) == (3, 2, 2 / 3, False)
    assert A.tolerance([0.1, 0.5, 0.2], 0.2, 1.0)["pass"] and not A.tolerance([0.9], 0.2, 1.0)["pass"]
    assert {k: v.shape for k, v in A.projections(np.zeros((2, 3, 4))).items()} == {"z": (3, 4), "y": (2, 4), "x": (2, 3)}
    assert A.bound_hashes({"a": 1})["all"] != A.bound_hashes({"a": 2})["all"]


def test_replay(spark):
    rng = np.random.default_rng(0)
    values = np.r_[rng.normal(20_000, 2000, 8000), rng.normal(50_000, 2000, 2000)].astype(int)
    hist = spark.createDataFrame([(int(v),) for v in values], "value int").groupBy(F.col("value").alias("bin")).agg(F.count("*").alias("c"))
    got = A.replay_threshold(hist)
    assert got["gate"] == "pass" and len(got["result"]["modes"]) >= 2 and 25_000 < got["result"]["diagnostics"]["threshold"] < 45_000
    assert A.replay_threshold(hist.limit(0))["gate"] == "halt"
