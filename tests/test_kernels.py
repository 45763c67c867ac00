"""Kernels against brute force on small blocks."""

import numpy as np
import pytest

from strutwise.functions import kernels as K

RNG = np.random.default_rng(7)


def flood(mask, full):
    out, n = np.zeros(mask.shape, dtype=int), 0
    steps = K.offsets(mask.ndim, full)
    steps = steps + [tuple(-s for s in x) for x in steps]
    for at in np.argwhere(mask):
        if out[tuple(at)]:
            continue
        n += 1
        todo = [tuple(at)]
        out[tuple(at)] = n
        while todo:
            c = todo.pop()
            for s in steps:
                x = tuple(a + b for a, b in zip(c, s))
                if all(0 <= v < m for v, m in zip(x, mask.shape)) and mask[x] and not out[x]:
                    out[x] = n
                    todo.append(x)
    return out, n


@pytest.mark.parametrize("full", [True, False])
@pytest.mark.parametrize("shape", [(6, 7, 8), (12, 9), (1, 1, 1)])
def test_labels(shape, full):
    for share in (0.1, 0.3, 0.6, 1.0):
        mask = RNG.random(shape) < share
        got, n = K.label(mask, full)
        want, m = flood(mask, full)
        assert n == m and (got == want).all()
    assert K.label(np.zeros(shape, dtype=bool))[1] == 0


def test_distances():
    for shape in ((7, 6, 5), (9, 4)):
        mask = RNG.random(shape) < 0.8
        holes = np.argwhere(~mask)
        want = [((holes - p) ** 2).sum(axis=1).min() for p in np.argwhere(np.ones(shape))]
        assert (K.squared_distance(mask).ravel() == want).all()
    assert np.isinf(K.squared_distance(np.ones((2, 2)).astype(bool))).all()


def test_gaussian_keeps_mass_inside_and_constants_at_mirrors():
    one = np.zeros((21, 21))
    one[10, 10] = 1
    out = K.gaussian(one, 1.25)
    assert abs(out.sum() - 1) < 1e-9 and out[10, 10] == out.max() and np.allclose(out, out.T)
    assert np.allclose(K.gaussian(np.full(30, 3.0), 2.0, reflect=True), 3.0)


def test_trilinear():
    z, y, x = np.mgrid[0:4, 0:5, 0:6]
    volume = 2.0 * z - y + 3 * x + 1
    at = RNG.random((200, 3)) * [3, 4, 5]
    assert np.allclose(K.trilinear(volume, at), 2 * at[:, 0] - at[:, 1] + 3 * at[:, 2] + 1, atol=1e-5)
    assert K.trilinear(volume, np.array([[3.0, 4.0, 5.0], [-0.1, 0, 0], [0, 4.01, 0]])).tolist() == [18.0, 0.0, 0.0]
    assert K.trilinear(np.full((1, 1, 1), 4.0), np.zeros((1, 3))).tolist() == [4.0]


def test_peaks():
    v = np.array([0, 5, 0, 1, 0, 4, 4, 4, 0, 0.2, 0, 9, 0])
    assert K.peaks(v, 1, 1).tolist() == [1, 3, 6, 11]
    assert K.peaks(v, 1, 2).tolist() == [1, 6, 11]
    assert K.peaks(v, 6, 0).tolist() == [1, 11]
    assert K.peaks(np.array([5, 4, 3]), 1, 0).tolist() == []


def test_similarity_is_recovered():
    p = RNG.normal(size=(100, 3))
    a = np.radians(1)
    turn = np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1]])
    q = K.apply((12.5, turn, np.array([4.0, 5, 6])), p)
    scale, rotation, shift = K.similarity(p, q)
    assert abs(scale - 12.5) < 1e-8 and np.allclose(rotation, turn) and np.allclose(shift, [4, 5, 6])
    assert abs(K.rotation_angle(np.eye(3), rotation) - 1) < 1e-6
    flipped = K.similarity(p, p * [1, 1, -1])[1]
    assert abs(np.linalg.det(flipped) - 1) < 1e-9
    with pytest.raises(ValueError):
        K.similarity(p[:3], q[:3])
    with pytest.raises(ValueError):
        K.similarity(np.zeros((5, 3)), q[:5])


def test_trimmed_fit_stands_outliers():
    grid = np.argwhere(np.ones((5, 5, 5))) * 4.5
    p = grid[RNG.random(125) < 0.8]
    q = K.apply((1.02, np.eye(3), np.array([0.5, -0.3, 0.2])), grid)
    far = np.vstack([q, RNG.random((20, 3)) * 100 + 40])
    transform, objective, rounds, settled = K.trimmed_fit(p, far, (1.0, np.eye(3), np.zeros(3)))
    assert settled and rounds < 60 and objective < 1e-6 and abs(transform[0] - 1.02) < 1e-6


def test_farthest_points():
    line = np.array([[0.0, 0, 0], [1, 0, 0], [2, 0, 0], [3, 0, 0], [10, 0, 0]])
    assert K.farthest_points(line, 3) == [3, 4, 0]
    assert K.farthest_points(line[:0], 3) == [] and len(K.farthest_points(line, 99)) == 5


def test_mean_shift_finds_a_ball():
    z, y, x = np.mgrid[0:21, 0:21, 0:21]
    ball = ((z - 12) ** 2 + (y - 9) ** 2 + (x - 11) ** 2 <= 9).astype(float)
    assert np.allclose(K.mean_shift(ball, np.array([10.0, 10, 10]), 3.0, 8.0), [12, 9, 11], atol=0.05)
    start = np.array([1.0, 1, 1])
    assert np.linalg.norm(K.mean_shift(ball, start, 30.0, 2.0) - start) <= 2 + 1e-9
    assert (K.mean_shift(np.zeros((3, 3, 3)), start, 1, 1) == start).all()


def test_medoid_affine_masks():
    best, near = K.medoid_group(np.array([[0.0, 0, 0], [1, 0, 0], [2, 0, 0], [50, 0, 0]]), 1.5)
    assert best == 1 and near.tolist() == [True, True, True, False]
    p = RNG.normal(size=(30, 3))
    m, t, r = K.affine_fit(p, p @ np.diag([1, 2, 3]) + [4, 5, 6])
    assert np.allclose(m, np.diag([1, 2, 3])) and np.allclose(t, [4, 5, 6]) and r.max() < 1e-9
    mask = np.zeros((7, 7, 7), dtype=bool)
    mask[3, 3, 3] = True
    assert K.dilate(mask).sum() == 27 and K.dilate(mask, 2).sum() == 125
    mask[0, 0, 0:2] = True
    assert K.largest(mask).sum() == 2 and K.largest(mask[:0]).size == 0
    assert K.longest_true(np.array([1, 1, 0, 1, 1, 1, 0])) == 3 and K.longest_true(np.zeros(0)) == 0


def test_thinning_keeps_connection_and_ends():
    bar = np.zeros((5, 5, 20), dtype=bool)
    bar[1:4, 1:4, 2:18] = True
    line = K.thinned(bar)
    assert 10 <= line.sum() <= 20 and K.label(line)[1] == 1
    ring = np.zeros((3, 9, 9), dtype=bool)
    ring[1, 1:8, 1:8] = True
    ring[1, 3:6, 3:6] = False
    thin = K.thinned(ring)
    assert K.label(thin)[1] == 1 and 8 <= thin.sum() <= 24
    single = np.zeros((3, 3, 7), dtype=bool)
    single[1, 1, 1:6] = True
    assert (K.thinned(single) == single).all()
