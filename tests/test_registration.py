from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.operators import alignment as A
from strutwise.operators import registration as R
from strutwise.sources import volumes as V

GRID = np.argwhere(np.ones((4, 4, 5))) * 4.5
POINTS = "id long, x double, y double, z double"


def rows(p):
    return [(k, *map(float, x)) for k, x in enumerate(p)]


def test_fit_from_sums(spark):
    p = np.random.default_rng(7).normal(size=(100, 3))
    true = (12.5, R.rotation((0, 0, 1)), np.array([4.0, 5, 6]))
    q = K.apply(true, p)
    df = spark.createDataFrame([tuple(map(float, (*a, *b))) for a, b in zip(p, q)], ", ".join(f"{s}{c} double" for s in "pq" for c in "xyz"))
    scale, rotation, shift = R.fit_from_pairs(df)
    assert abs(scale - 12.5) < 1e-8 and np.allclose(rotation, true[1], atol=1e-8) and np.allclose(shift, true[2], atol=1e-7)
    with pytest.raises(ValueError):
        R.fit_from_pairs(df.limit(3))


def test_split():
    fit, held = R.split(list(range(50)), 0.2, 1)
    assert len(held) == 10 and not set(fit) & set(held) and sorted(fit + held) == list(range(50)) and R.split(list(range(50)), 0.2, 1) == (fit, held)
    assert len(R.split([1, 2, 3], 0.01, 0)[1]) == 1
    assert len(R.thinned(np.arange(30).reshape(10, 3), 4)) == 4


def test_registration(spark):
    true = (1.5, R.rotation((1, 2, -1)), np.array([10.0, 12, 9]))
    q = K.apply(true, GRID)
    rng = np.random.default_rng(0)
    seen = np.vstack([q[rng.random(len(q)) < 0.9], rng.uniform(0, 40, (5, 3))])
    nominal, detected = spark.createDataFrame(rows(GRID), POINTS), spark.createDataFrame(rows(seen), POINTS)
    policy = R.FitPolicy(scales=(1.0,), tilts=((0, 0, 0), (3, 0, 0), (0, 3, 0)), most_holdout_error=1.0, rounds=8)
    got = R.register(nominal, detected, (64, 64, 64), policy)
    assert got["gate"] == "pass", got["checks"]
    assert abs(got["transform"][0] - 1.5) < 0.02 and got["holdout_median"] < 0.5 and len(got["fits"]) == 3
    assert R.register(nominal, detected, (20, 20, 20), replace(policy, rounds=1))["gate"] == "halt"


def test_suites(spark):
    assert R.recovery_suite(spark, GRID, cases=4)["pass"]
    got = R.disturbed_suite(spark, GRID, GRID + 0.2, (1.0, np.eye(3), np.zeros(3)))
    assert got["pass"] and len(got["fits"]) == 7
    failed = R.fits(spark, [(GRID[:2], GRID, (1.0, np.eye(3), np.zeros(3)))])
    assert failed[0]["error"]


def test_nodes_of_a_grid(spark, tmp_path):
    z, y, x = np.mgrid[0:40, 0:40, 0:40]
    a = np.zeros((40, 40, 40), dtype=np.uint16)
    places = [(k, j, i) for k in (10, 28) for j in (10, 28) for i in (10, 28)]
    for p in places:
        a[(z - p[0]) ** 2 + (y - p[1]) ** 2 + (x - p[2]) ** 2 <= 36] = 9
    np.save(tmp_path / "v.npy", a)
    found = R.detect_nodes(V.read_volume(spark, str(tmp_path / "v.npy"), slab_cells=40 * 40 * 7), a.shape, 5, margin=0.0, least=1)
    got = np.array([(n["z"], n["y"], n["x"]) for n in found])
    d, _ = K.nearest_rows(np.array(places, float), got)
    assert len(found) == 8 and d.max() <= 1.0
    # small parts find the same places, each once
    again = R.detected(V.read_volume(spark, str(tmp_path / "v.npy"), slab_cells=40 * 40 * 7), a.shape, 5, margin=0.0, least=1, size=5).orderBy("id").collect()
    assert [(r.z, r.y, r.x, r.size) for r in again] == [(n["z"], n["y"], n["x"], n["size"]) for n in found]


@pytest.mark.parametrize("size", [8, 64, 240])
def test_a_long_rod_is_no_node(spark, tmp_path, size):
    a = np.zeros((240, 14, 14), dtype=np.uint16)
    a[:, 3:12, 3:12] = 9
    a[100:140, 0:1, 0:1] = 9
    np.save(tmp_path / "v.npy", a)
    blocks = V.read_volume(spark, str(tmp_path / "v.npy"), slab_cells=14 * 14 * 50)
    assert R.detected(blocks, a.shape, 5, step=1, margin=0.0, least_distance=4.0, size=size).count() == 0
    rod = R.detected(blocks, a.shape, 5, step=1, margin=0.0, least_distance=4.0, most=3000, size=size).collect()
    assert [(r.z, r.y, r.x) for r in rod] == [(119.5, 7.0, 7.0)] and rod[0].size > 999


def test_robustness_of_detection_and_fit(spark, tmp_path):
    grid = np.array([[i, j, k] for i in range(4) for j in range(4) for k in range(4)], float) + np.random.default_rng(1).uniform(-0.1, 0.1, (64, 3))
    true = (9.0, np.eye(3), np.array([8.0, 8.0, 8.0]))
    places = K.apply(true, grid)
    z, y, x = np.mgrid[0:46, 0:46, 0:46]
    a = np.zeros((46, 46, 46), dtype=np.uint16)
    for p in places:
        a[(x - p[0]) ** 2 + (y - p[1]) ** 2 + (z - p[2]) ** 2 <= 9] = 1000
    np.save(tmp_path / "v.npy", a)
    blocks = V.read_volume(spark, str(tmp_path / "v.npy"))
    policy = R.FitPolicy(scales=(1.0,), tilts=((0, 0, 0), (2, 0, 0), (0, 2, 0)))
    got = R.robustness_suite(spark, grid, blocks, a.shape, 600, true, policy, step=1, margin=0.0, least=1, least_distance=1.5)
    assert got["pass"] and got["fitted"] >= 4 and got["spread"] < 1.0 and len(got["cases"]) == 7
    none = R.robustness_suite(spark, grid, blocks, a.shape, 50_000, true, policy, step=1, margin=0.0, least=1)
    assert not none["pass"] and {c["status"] for c in none["cases"]} == {"rejected"}


def test_fits_of_whole_clouds_equal_the_kernel(spark):
    rng = np.random.default_rng(11)
    p = np.round(rng.uniform(0, 6, (60, 3)), 1)
    p[50:] = p[:10]  # shared places: ties by id
    true = (2.0, R.rotation((2, -1, 3)), np.array([1.0, 2.0, 3.0]))
    q = np.vstack([K.apply(true, p)[rng.random(60) < 0.8], rng.uniform(0, 15, (12, 3))])
    starts = [(2.02, R.rotation((1, 0, 2)), np.array([1.2, 1.8, 3.1])), (1.0, np.eye(3), np.array([3.0, 3.0, 3.0])), (2.1, np.eye(3), np.array([0.5, 2.5, 3.0]))]
    got = A.trimmed_fits(spark.createDataFrame(rows(p), POINTS).repartition(3), spark.createDataFrame(rows(q), POINTS), starts, keep=0.7, rounds=3)
    for s, g in zip(starts, got):
        (scale, rotation, shift), objective, count, settled = K.trimmed_fit(p, q, s, 0.7, 3)
        assert (g["rounds"], g["settled"], g["error"]) == (count, settled, None)
        assert abs(g["transform"][0] - scale) < 1e-9 and np.allclose(g["transform"][1], rotation, atol=1e-9) and np.allclose(g["transform"][2], shift, atol=1e-8)
        assert abs(g["objective"] - objective) < 1e-9
    with pytest.raises(ValueError):
        A.trimmed_fits(spark.createDataFrame(rows(p[:3]), POINTS), spark.createDataFrame(rows(q), POINTS), starts)


def test_share_with_ties(spark):
    pairs = spark.createDataFrame([(s, i, d) for s, ds in ((0, [3.0, 1.0, 1.0, 1.0, 0.0]), (1, [0.0] * 5), (2, [5.0, 4.0, 3.0, 2.0, 1.0])) for i, d in enumerate(ds)], "start int, id long, distance double")
    got = {(r.start, r.id) for r in A.nearest_share(pairs, 3).collect()}
    assert got == {(0, 4), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 4), (2, 3), (2, 2)}


def test_held_out_rows(spark):
    points = spark.range(0, 101).select("id", *[F.col("id").cast("double").alias(c) for c in "xyz"])
    one, same, other = ({r.id for r in A.held_out(points, 0.2, k).where("held").collect()} for k in (1, 1, 2))
    assert len(one) == len(other) == 20 and one == same != other
    assert A.held_out(points.limit(3), 0.01, 0).where("held").count() == 1
