import numpy as np
import pytest

from strutwise.functions import kernels as K
from strutwise.operators import refine as R
from strutwise.operators.registration import rotation
from strutwise.sources import volumes as V

POINTS = "id long, x double, y double, z double"
PAIRS = ", ".join(f"{s}{c} double" for s in "pq" for c in "xyz")


def test_refinement_at_full_resolution(spark, tmp_path):
    grid = np.array([[i, j, k] for i in range(3) for j in range(3) for k in range(3)], float)
    true = (14.0, rotation((1, -1, 2)), np.array([10.0, 11.0, 10.0]))
    z, y, x = np.mgrid[0:52, 0:52, 0:52]
    a = np.zeros((52, 52, 52), dtype=np.uint16)
    for p in K.apply(true, grid):
        a[(x - p[0]) ** 2 + (y - p[1]) ** 2 + (z - p[2]) ** 2 <= 16] = 9
    np.save(tmp_path / "v.npy", a)
    blocks = V.read_volume(spark, str(tmp_path / "v.npy"))
    points = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(grid)], POINTS)
    start = (14.2, rotation((0, 0, 0)), np.array([10.5, 10.5, 10.0]))
    got, history = R.refined(points, blocks, start, R.RefinePolicy(patch=7, search=6.0, threshold=5, passes=2, keep=0.9))
    error = lambda t: np.linalg.norm(K.apply(t, grid) - K.apply(true, grid), axis=1).max()
    assert error(got) < 0.5 < error(start) and [h["valid"] for h in history] == [27, 27] and history[1]["median"] < history[0]["median"]
    with pytest.raises(ValueError):
        R.refined(points.limit(3), blocks, start, R.RefinePolicy(threshold=5))


def test_a_patch_without_background_has_no_place_and_one_without_material_no_depth(spark, tmp_path):
    a = np.zeros((12, 12, 30), dtype=np.uint8)
    a[:, :, :14] = 1
    np.save(tmp_path / "v.npy", a)
    nodes = spark.createDataFrame([(1, 4.0, 6.0, 6.0), (2, 25.0, 6.0, 6.0), (3, 13.0, 6.0, 6.0)], POINTS)
    got = {r.id: r for r in R.peaks_near(nodes, V.read_volume(spark, str(tmp_path / "v.npy")), R.RefinePolicy(patch=3, search=2.0)).collect()}
    assert got[1].lx is None and got[2].radius == 0 and got[3].lx < 13 and got[3].radius == 3.0


def test_affine_maps(spark):
    p = np.random.default_rng(0).normal(size=(40, 3)) + 100
    m, t = np.array([[2, 0.1, 0], [0, 1.5, -0.2], [0.3, 0, 0.9]]), np.array([5.0, -3.0, 7.0])
    q = p @ m.T + t + np.random.default_rng(1).normal(size=p.shape) * 0.01
    df = spark.createDataFrame([tuple(map(float, (*a, *b))) for a, b in zip(p, q)], PAIRS)
    want, shift, residual = K.affine_fit(p, q)
    fit = R.affine(df)
    got = {r.axis: r for r in fit.collect()}
    for k, a in enumerate("xyz"):
        assert np.allclose([got[a].mx, got[a].my, got[a].mz], want[k], atol=1e-9) and abs(got[a].shift - shift[k]) < 1e-6
    assert np.allclose(sorted(r.residual for r in R.affine_residuals(df, fit).collect()), sorted(residual), atol=1e-8)
    for bad in (df.limit(3), df.withColumn("pz", df.px)):
        with pytest.raises(Exception, match="four pairs|plane"):
            R.affine(bad).collect()


@pytest.mark.parametrize("reach", [0, 1, 4])
def test_grown_runs(spark, reach):
    shape, rng = (9, 12, 20), np.random.default_rng(reach)
    mask = rng.random(shape) < 0.01
    cells = spark.createDataFrame([tuple(map(int, p)) for p in np.argwhere(mask)], "z int, y int, x int").repartition(3)
    out = np.zeros(shape, dtype=int)
    for r in R.grown_runs(cells, reach, shape).collect():
        out[r.z, r.y, r.x0 : r.x1 + 1] += 1
    assert (out == K.dilate(mask, reach)).all()


def test_cleaned_masks(spark):
    shape = (20, 20, 40)
    mask = np.zeros(shape, bool)
    mask[8:12, 8:12, 2:30] = mask[9, 9, 35] = mask[0, 0, :] = True
    rows = [tuple(map(int, p)) for p in np.argwhere(mask)]
    placed = spark.createDataFrame([(2.0, 10.0, 10.0, 37.0, 10.0, 10.0)], "ax double, ay double, az double, bx double, by double, bz double")
    cells = spark.createDataFrame(rows, "z int, y int, x int")
    got = {tuple(r) for r in R.cleaned(cells, placed, shape, size=8).collect()}
    assert got == {p for p in rows if 8 <= p[0] < 12 and p[2] < 30}
    assert R.cleaned(cells.limit(0), placed, shape).count() == 0


def test_query_localized_nodes(spark, sf):
    from strutwise.operators import localize as Z
    from strutwise.plans import queries_refine as Q
    from strutwise.plans import views

    a = np.zeros(views.SHAPE, dtype=np.uint16)
    for r in views.voxels(spark, sf).collect():
        a[r.z, r.y, r.x] = r.value
    policy, at = Z.LocalizePolicy(patch=3, search=3.0, threshold=8), {r.id: r.asDict() for r in Q._nodes(spark, sf).collect()}
    got = {r.id: r for r in Q.localized_nodes(spark, sf).collect()}
    assert set(got) == set(at)
    for k, row in at.items():
        low = [max(0, round(row[c]) - 3) for c in "zyx"]
        patch = a[tuple(slice(o, round(row[c]) + 4) for o, c in zip(low, "zyx"))]
        want = Z.locate(row, patch, low, a.shape, policy)
        assert (got[k].match_class, got[k].accepted, got[k].reasons) == (want["match_class"], want["accepted"], ",".join(want["reasons"]))
        assert np.allclose([got[k].x, got[k].y, got[k].z, got[k].support], [want[c] for c in ("x", "y", "z", "support")], atol=1e-9)


def test_nodes_at_one_place_are_looked_at_once(spark, monkeypatch):
    nodes = spark.createDataFrame([(k, 2.0, 2.0, float(k % 2)) for k in range(40)] + [(99, 3.0, 2.0, 0.0)], "id long, x double, y double, z double")
    cells = spark.createDataFrame([(z, y, x, 70_000) for z in range(2) for y in range(2) for x in range(5)], "z int, y int, x int, value long")
    blocks, seen = V.blocks_of(cells, (2, 5, 5), "u4"), []
    on_patches = R.on_patches

    def counted(boxes, *rest):
        seen.append(boxes.count())
        return on_patches(boxes, *rest)

    monkeypatch.setattr(R, "on_patches", counted)
    got = {r.id: tuple(r)[1:] for r in R.peaks_near(nodes, blocks, R.RefinePolicy(patch=2, search=2.0, weigh=2.0, threshold=65_537)).collect()}
    assert seen == [3] and sorted(got) == [*range(40), 99]
    assert len({got[k] for k in range(0, 40, 2)}) == len({got[k] for k in range(1, 40, 2)}) == 1 and got[0] != got[1] and got[0][3] > 0
