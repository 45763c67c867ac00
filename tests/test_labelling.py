import numpy as np
import pytest

from strutwise.functions import kernels as K
from strutwise.operators import labelling as L
from strutwise.sources import volumes as V


def cells(spark, mask):
    return spark.createDataFrame([tuple(map(int, p)) for p in np.argwhere(mask)] + [(-1, 0, 0), (0, 0, 99)], "z int, y int, x int").repartition(3)


def names(mask, full):
    labels, n = K.label(mask, full)
    first = {k: int(np.flatnonzero(labels.ravel() == k)[0]) for k in range(1, n + 1)}
    return {int(i): first[k] for i, k in zip(np.flatnonzero(mask.ravel()), labels[mask])}, labels, n


@pytest.mark.parametrize("full", [True, False])
@pytest.mark.parametrize("shape,share,size", [((9, 10, 11), 0.3, 4), ((9, 10, 11), 0.12, 3), ((1, 7, 20), 0.5, 2), ((6, 6, 6), 1.1, 2), ((12, 5, 5), 0.45, 64)])
def test_components_over_parts(spark, shape, share, size, full):
    mask = np.random.default_rng(len(shape) + size).random(shape) < share
    parts = L.labelled(L.cell_parts(cells(spark, mask), shape, size), shape, full)
    want, labels, n = names(mask, full)
    assert {r.node: r.component for r in L.component_cells(parts, shape, full).collect()} == want
    sums = {r.component: (r.size, r.z, r.y, r.x) for r in L.component_sums(parts, full).collect()}
    at = np.argwhere(mask)
    assert sums == {f: (int((labels[mask] == k).sum()), *map(int, at[labels[mask] == k].sum(axis=0))) for k, f in enumerate(sorted(set(want.values())), 1)}


@pytest.mark.parametrize("shape,share,size", [((9, 10, 11), 0.9, 4), ((5, 30, 4), 0.99, 3), ((4, 4, 4), 1.1, 2), ((1, 9, 9), 0.8, 64)])
def test_distances_over_parts(spark, shape, share, size):
    mask = np.random.default_rng(size).random(shape) < share
    want = K.squared_distance(mask)
    want = np.where(np.isinf(want), K.FAR, want)
    got = {(r.z, r.y, r.x): r.value for r in L.part_cells(L.squared_distances(L.cell_parts(cells(spark, mask), shape, size), shape, size)).collect()}
    assert got == {tuple(p): int(want[tuple(p)]) for p in np.argwhere(mask)}


def test_parts_of_slabs_and_slices(spark):
    a = np.random.default_rng(5).integers(0, 9, (11, 6, 7)).astype("<u2")
    rows = [tuple(map(int, (*p, a[tuple(p)]))) for p in np.argwhere(a)]
    blocks = V.blocks_of(spark.createDataFrame(rows, "z int, y int, x int, value long"), a.shape, "u2", 4)
    whole = np.zeros_like(a)
    for r in blocks.collect():
        whole[r.z0 : r.z0 + r.nz] = V.block_array(r)
    assert (whole == a).all()
    got = {(r.z, r.y, r.x) for r in L.part_cells(L.mask_parts(blocks, 5, 2, (1, 5), 3), "u1").collect()}
    assert got == {tuple(p) for p in np.argwhere(a[2:9:2, ::2, ::2] >= 5)}


def test_no_cells(spark):
    parts = L.labelled(L.cell_parts(cells(spark, np.zeros((3, 3, 3), bool)), (3, 3, 3)), (3, 3, 3))
    assert L.component_cells(parts, (3, 3, 3)).count() == 0 and L.component_sums(parts).count() == 0
    assert L.squared_distances(L.cell_parts(cells(spark, np.zeros((3, 3, 3), bool)), (3, 3, 3)), (3, 3, 3)).count() == 0


def test_envelope_keeps_ties_and_gaps():
    f = np.array([[4, K.FAR, 0], [K.FAR, K.FAR, 0], [0, K.FAR, K.FAR], [K.FAR, K.FAR, 1], [9, K.FAR, 0]])
    want = [[min([int(f[j, c]) + (i - j) ** 2 for j in range(5) if f[j, c] < K.FAR], default=K.FAR) for c in range(3)] for i in range(5)]
    assert K.envelope(f).tolist() == want


def solid(seed, shape=(17, 14, 19)):
    """Rods, a plate with a hole and noise."""
    rng, a = np.random.default_rng(seed), np.zeros(shape, bool)
    a[3:7, 3:7, :] = a[:, 8:11, 5:8] = True
    a[10:13, 1:12, 9:18] = True
    a[10:13, 5:7, 12:14] = False
    return a | (rng.random(shape) < 0.03)


@pytest.mark.parametrize("size", [8, 5, 64])
def test_thinning_over_parts_equals_the_whole_array(spark, size):
    mask = solid(size)
    want = {tuple(p) for p in np.argwhere(K.thinned(mask))}
    got = L.thinned_parts(L.cell_parts(cells(spark, mask), mask.shape, size), size)
    assert {(r.z, r.y, r.x) for r in L.part_cells(got, "u1").collect()} == want and 0 < len(want) < mask.sum()


def test_thinning_keeps_connection_and_is_thin():
    mask = solid(1)
    thin = K.thinned(mask)
    assert K.label(thin)[1] == K.label(mask)[1] and not (thin & ~mask).any()
    at = np.argwhere(thin)
    padded = np.pad(thin, 1)
    cubes = np.stack([padded[tuple((at + 1 + d).T)] for d in K._AROUND], axis=1)
    assert not K.simple(cubes).any()  # nothing more can go but line ends


@pytest.mark.parametrize("size", [4, 64])
def test_ends_and_branches(spark, size):
    cross = np.zeros((11, 11, 11), bool)
    cross[5, 5, :] = cross[5, :, 5] = True
    r = L.skeleton_points(L.cell_parts(cells(spark, cross), cross.shape, size), size).first()
    padded = np.pad(cross, 1).astype(int)
    counts = [padded[z : z + 3, y : y + 3, x : x + 3].sum() - 1 for z, y, x in np.argwhere(cross)]
    assert tuple(r) == (21, 4, sum(c > 2 for c in counts)) and counts.count(1) == 4
    none = L.skeleton_points(L.cell_parts(cells(spark, np.zeros((3, 3, 3), bool)), (3, 3, 3), size), size).first()
    assert tuple(none) == (0, 0, 0)


def test_query_thinned_mask(spark, sf):
    from strutwise.plans import queries_volume as Q

    mask = np.zeros(Q.SHAPE, bool)
    for r in Q._whole(spark, sf).collect():
        mask[r.z, r.y, r.x] = True
    assert {tuple(r) for r in Q.thinned_mask(spark, sf).collect()} == {tuple(p) for p in np.argwhere(K.thinned(mask))}
