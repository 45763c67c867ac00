"""Struts and nodes measured in small synthetic volumes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strutwise.operators import localize as N
from strutwise.operators import strut_metrics as S
from strutwise.operators.patches import bricks
from strutwise.sources import volumes as V

SCHEMA = "id long, ax double, ay double, az double, bx double, by double, bz double"


def cylinders():
    """Four rods along x of radius 3, a fifth place empty; rod 2 has a gap of six voxels."""
    a = np.zeros((72, 72, 72), dtype=np.uint16)
    z, y = np.mgrid[0:72, 0:72]
    places = [(18, 18), (18, 54), (54, 18), (36, 36), (54, 54)]
    for k, (cz, cy) in enumerate(places[:4]):
        rod = ((z - cz) ** 2 + (y - cy) ** 2 <= 9)[:, :, None] & np.ones(33, dtype=bool)
        if k == 1:
            rod[:, :, 14:20] = False
        a[:, :, 20:53][rod] = 100
    return a, [(k + 1, 20.0, float(cy), float(cz), 52.0, float(cy), float(cz)) for k, (cz, cy) in enumerate(places)]


@pytest.fixture(scope="module")
def rods(spark, tmp_path_factory):
    a, struts = cylinders()
    path = tmp_path_factory.mktemp("rods") / "v.npy"
    np.save(path, a)
    return V.read_volume(spark, str(path), slab_cells=72 * 72 * 10), spark.createDataFrame(struts, SCHEMA), a


def test_axial_places():
    z = S.axial_places(32.0, 0.1)
    assert abs(z[0] + 3.2) < 1e-9 and abs(z[-1] - 35.2) < 1e-9 and 0.0 in z and 32.0 in z and (np.diff(z) > 0).all()


def test_frames():
    x, y, z = S.frame(np.zeros(3), np.array([0.0, 0, 2]))
    assert x.tolist() == [1, 0, 0] and z.tolist() == [0, 0, 1] and np.allclose(np.cross(z, x), y)


def test_bricks_hold_every_cell_once(rods):
    blocks, _, a = rods
    got = bricks(blocks, 32).select(F.sum(F.col("nz") * F.col("ny") * F.col("nx")), F.count_distinct("bz", "by", "bx")).first()
    assert got[0] == a.size and got[1] == 27


@pytest.mark.parametrize("size", [16, 64])
def test_rods(spark, rods, size, monkeypatch):
    from strutwise.operators import patches

    monkeypatch.setattr(patches, "BRICK", size)
    blocks, struts, a = rods
    policy = S.CorridorPolicy(threshold=50)
    rows = S.strut_metrics(struts, blocks, a.shape, 5.0, policy)
    got = {r.id: r for r in rows.collect()}
    assert got.keys() == {1, 2, 3, 4, 5}
    for k in (1, 3, 4):
        assert got[k].connected and got[k].collar_connected and got[k].maximum_axial_gap_samples == 0 and got[k].roi_valid
        assert got[k].interior_component_count == 1 and 3 <= got[k].radius_voxels <= 4 and got[k].curvature_rms < 1e-6
        assert got[k].corridor_foreground_fraction > 0.3 and abs(got[k].length - 32) < 1e-9
    assert not got[2].connected and got[2].both_endpoint_segments_observed and 5 <= got[2].maximum_axial_gap_samples <= 7 and got[2].interior_component_count == 2
    assert got[5].corridor_foreground_fraction == 0 and not got[5].connected and got[5].radius_voxels == 0 and got[5].interior_component_count == 0
    assert S.gates(rows, struts) == {"checks": {"ids_unique": True, "ids_exhaustive": True, "roi_valid": True}, "gate": "pass"}


def test_metrics_file(spark, rods, tmp_path):
    from strutwise.sources import documents as D

    blocks, struts, a = rods
    policy = S.CorridorPolicy(threshold=50)
    ends = struts.select("id", (F.col("id") * 10).alias("junction0"), (F.col("id") * 10 + 1).alias("junction1"))
    rows = S.metrics_file_rows(S.strut_metrics(struts, blocks, a.shape, 5.0, policy), ends, 5.0, policy)
    assert tuple(rows.columns) == D.METRIC_COLUMNS and len(rows.columns) == 30
    D.write_csv(rows, str(tmp_path / "metrics"), list(D.METRIC_COLUMNS))
    back = D.read_metrics(spark, str(tmp_path / "metrics"), set(D.METRIC_COLUMNS))
    for got, want in zip(back.orderBy("strut_id").collect(), rows.orderBy("strut_id").collect()):
        for c in D.METRIC_COLUMNS:
            assert got[c] == want[c] if not isinstance(want[c], float) else abs(got[c] - want[c]) < 1e-9, c
    by = {r.strut_id: r for r in back.collect()}
    assert by[2].largest_component_fraction < 0.7 and by[1].largest_component_fraction == 1.0 and by[5].largest_component_fraction == 0.0
    assert by[1].endpoint0_support_fraction > 0.3 and by[5].endpoint1_support_fraction == 0.0 and by[3].junction1_id == 31 and by[3].cuboid_half_width_voxels == 7.0
    profiles = S.strut_metrics(struts, blocks, a.shape, 5.0, policy).select(F.col("id").alias("strut_id"), F.col("foreground_fraction").alias("fg"))
    assert S.with_profiles(rows, profiles).count() == 5
    with pytest.raises(ValueError, match="1 struts have metrics alone"):
        S.with_profiles(rows, profiles.where("strut_id <> 3"))


def test_a_strut_at_the_edge_needs_review(spark, rods):
    blocks, _, a = rods
    edge = spark.createDataFrame([(9, 2.0, 2.0, 2.0, 30.0, 2.0, 2.0), (10, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0)], SCHEMA)
    rows = S.strut_metrics(edge, blocks, a.shape, 5.0, S.CorridorPolicy(threshold=50))
    r, = rows.collect()
    assert r.id == 9 and not r.roi_valid
    assert S.gates(rows, edge.where("id = 9"))["gate"] == "manual_review" and S.gates(rows, edge)["gate"] == "halt"


def test_bent_rods_show():
    line = np.stack([np.sin(np.linspace(0, np.pi, 40)) * 3, np.zeros(40)], axis=1)
    assert S.bending(line) > 1.5 and S.bending(line * 0) == 0 and S.bending(line[:4]) == 0
    line[10:15] = np.nan
    assert S.bending(line) > 1.5


def test_calibration(spark, tmp_path):
    a = np.zeros((80, 80, 80), dtype=np.uint16)
    z, y = np.mgrid[0:80, 0:80]
    struts, k = [], 0
    for cz in (24, 40, 56):
        for cy in (24, 40, 56):
            a[:, :, 10:70][((z - cz) ** 2 + (y - cy) ** 2 <= 9)] = 100
            struts.append((k := k + 1, 25.0, float(cy), float(cz), 55.0, float(cy), float(cz)))
    np.save(tmp_path / "v.npy", a)
    blocks, placed = V.read_volume(spark, str(tmp_path / "v.npy")), spark.createDataFrame(struts, SCHEMA)
    policy = S.CorridorPolicy(threshold=50)
    assert 3 <= S.calibrated_radius(placed, blocks, a.shape, bound=7, policy=policy) <= 5
    with pytest.raises(ValueError):
        S.calibrated_radius(placed.limit(3), blocks, a.shape, bound=7, policy=policy)


def test_a_star_is_found(spark, tmp_path):
    z, y, x = np.mgrid[0:49, 0:49, 0:49].astype(float)
    a = (((z - 24) ** 2 + (y - 24) ** 2 + (x - 24) ** 2) <= 16).astype(np.uint16)
    for u, v in ((y, x), (z, x), (z, y)):
        a |= (((u - 24) ** 2 + (v - 24) ** 2) <= 6.25).astype(np.uint16)
    np.save(tmp_path / "v.npy", a)
    blocks = V.read_volume(spark, str(tmp_path / "v.npy"))
    nodes = spark.createDataFrame([(1, 25.5, 23.0, 25.0), (2, 2.0, 2.0, 2.0)], "id long, x double, y double, z double")
    arms = spark.createDataFrame([(1, *map(float, d)) for d in np.vstack([np.eye(3), -np.eye(3)])], "junction long, ux double, uy double, uz double")
    got = {r.id: r for r in N.localized(nodes, blocks, a.shape, arms).collect()}
    r = got[1]
    assert r.accepted and r.agreement >= 0.7 and r.match_class == "primary"
    assert np.linalg.norm(np.array([r.x, r.y, r.z]) - 24) < np.linalg.norm([1.5, -1, 1])
    assert not got[2].accepted and got[2].match_class == "fallback" and (got[2].x, got[2].y, got[2].z) == (2, 2, 2) and got[2].boundary
    assert N.location_gate(N.localized(nodes.where("id = 1"), blocks, a.shape, arms))["gate"] == "pass"
    assert N.location_gate(N.localized(nodes, blocks, a.shape))["gate"] == "manual_review"


def test_farthest_picks_of_all_points(spark, monkeypatch):
    from strutwise.operators import neighbours as N

    monkeypatch.setattr(N, "PICKS", 3)
    p = np.vstack([np.random.default_rng(2).integers(0, 5, (60, 3)).astype(float), [[np.nan, 0, 0]]])
    rows = [(int(k), *map(float, x)) for k, x in enumerate(p)]
    points = spark.createDataFrame(rows, "id long, x double, y double, z double").repartition(3)
    own = p[:60]
    picks = [int(np.argmin(np.linalg.norm(own - own.mean(axis=0), axis=1)))]
    gap = np.linalg.norm(own - own[picks[0]], axis=1)
    while len(picks) < 10:
        gap[picks] = -1.0
        picks.append(int(np.argmax(gap)))
        gap = np.minimum(gap, np.linalg.norm(own - own[picks[-1]], axis=1))
    assert [i for i, _ in N.farthest_picks(points, 10)] == picks
    assert len(N.farthest_picks(points.limit(4), 10)) == 4 and N.farthest_picks(points.limit(0), 3) == []
