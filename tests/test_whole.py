"""Queries over whole tables against brute force, beside their SQL."""

import math
import re

import numpy as np
import pandas as pd
import pytest

from strutwise.operators import neighbours as N
from strutwise.plans import registry
from strutwise.plans import views as V
from strutwise.plans.queries_graph import _corridor, _placed


#: Here the mask has more than 400 voxels.
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def placed(spark, sf):
    return _placed(spark, sf).toPandas().sort_values("id", ignore_index=True)


@pytest.fixture(scope="module")
def junctions(spark, sf):
    return V.junctions(spark, sf).toPandas()


def run(spark, sf, name):
    return registry.QUERIES[name](spark, sf).toPandas()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ends(frame):
    return frame[["ax", "ay", "az"]].to_numpy(), frame[["bx", "by", "bz"]].to_numpy()


@pytest.fixture(scope="module")
def corridors(placed):
    """id, step, ring, k, x, y, z of every strut that has a length."""
    rows = []
    for i, a, b in zip(placed.id, *ends(placed)):
        if (a == b).all():
            continue
        u = (b - a) / np.linalg.norm(b - a)
        e = np.cross(u, (0.0, 1.0, 0.0) if abs(u[0]) >= 0.8 else (1.0, 0.0, 0.0))
        e = e / np.linalg.norm(e)
        f = np.cross(u, e)
        for step in range(9):
            at = a + (-0.2 + 1.4 * step / 8) * (b - a)
            rows.append((i, step, 0, 0, *at))
            for ring, r in ((1, 1.0), (2, 1.5)):
                for k in range(6):
                    rows.append((i, step, ring, k, *(at + r * math.cos(math.pi * k / 3) * e + r * math.sin(math.pi * k / 3) * f)))
    return pd.DataFrame(rows, columns=["id", "step", "ring", "k", "x", "y", "z"])


def test_corridors_of_all_struts(spark, sf, corridors):
    key = ["id", "step", "ring", "k"]
    got = _corridor(spark, sf).toPandas().sort_values(key, ignore_index=True)
    want = corridors.sort_values(key, ignore_index=True)
    assert (got[key].to_numpy() == want[key].to_numpy()).all()
    assert np.allclose(got[["x", "y", "z"]], want[["x", "y", "z"]], atol=2e-6)
    assert got.id.nunique() > 1000
    whole = run(spark, sf, "corridor_coords").set_index(["id", "ring"]).sort_index()
    by = want.groupby(["id", "ring"])
    assert (whole.samples == by.size()).all() and np.allclose(whole[["low_x", "high_z"]], np.column_stack([by.x.min(), by.z.max()]), atol=2e-6)


def test_occupancy_and_rings_of_all_struts(spark, sf, corridors):
    at = np.rint(corridors[["x", "y", "z"]].round(6)).astype(int).to_numpy()
    valid = ((at >= 0) & (at <= 18)).all(axis=1)
    marks = corridors[["id", "ring"]].assign(valid=valid, foreground=valid & ((at @ [7, 5, 3]) % 4 == 0))
    for name, by in (("corridor_sample", "id"), ("radial_probability", "ring")):
        got = run(spark, sf, name).set_index(by).sort_index()
        want = marks.groupby(by)[["valid", "foreground"]].sum()
        assert got[["valid", "foreground"]].equals(want.set_index(want.index.astype(got.index.dtype)).astype("int64"))
    assert (run(spark, sf, "corridor_sample").samples == 117).all()


def free_struts(placed, spots):
    a, b = ends(placed)
    free = np.ones(len(placed), dtype=bool)
    for k in range(9):
        p = a + (0.4 + 0.2 * k / 8) * (b - a)
        for lot in np.array_split(np.arange(len(p)), 10):
            free[lot] &= (((p[lot, None] - spots) ** 2).sum(axis=2) > 1.3 * 1.3).all(axis=1)
    return sorted(placed.id[free])


def test_tubes_of_all_struts_and_junctions(spark, sf, placed, junctions):
    want = free_struts(placed, junctions[["x", "y", "z"]].to_numpy())
    assert sorted(N.empty_tubes(_placed(spark, sf), V.junctions(spark, sf), 1.3).toPandas().id) == want
    # hardly a strut of these tables is that far from all junctions, so fewer targets too
    some = junctions[junctions.id % 10 == 3]
    got = N.empty_tubes(_placed(spark, sf), V.junctions(spark, sf).where("id % 10 = 3"), 1.3).toPandas()
    assert sorted(got.id) == free_struts(placed, some[["x", "y", "z"]].to_numpy()) and len(got) > 100


@pytest.fixture(scope="module")
def labelled(spark):
    """Place to (least packed id, neighbours) of the whole mask."""
    vox = V.voxels(spark, MIDDLE).toPandas()
    cut = vox.value.sort_values(ignore_index=True)[math.ceil(0.9 * len(vox)) - 1]
    mask = {tuple(int(c) for c in p) for p in vox[vox.value >= cut][["z", "y", "x"]].to_numpy()}
    moves = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) != (0, 0, 0)]
    around = {p: [q for m in moves if (q := tuple(i + j for i, j in zip(p, m))) in mask] for p in mask}
    label: dict = {}
    for p in sorted(mask):
        todo = [p]
        while todo:
            q = todo.pop()
            if q not in label:
                label[q] = (p[0] * 32 + p[1]) * 32 + p[2]
                todo += around[q]
    return label, {p: len(q) for p, q in around.items()}


def test_labels_of_the_whole_mask(spark, labelled):
    label, near = labelled
    assert len(label) > 400
    got = run(spark, MIDDLE, "components_26")
    assert dict(zip(got.node, got.component)) == {(z * 32 + y) * 32 + x: c for (z, y, x), c in label.items()} and len(got) == len(label)
    one = run(spark, MIDDLE, "skeleton_degree").iloc[0]
    n = list(near.values())
    assert (one.voxels, one.endpoints, one.branch_points) == (len(n), n.count(1), sum(k > 2 for k in n))


def test_reports_on_the_whole_mask(spark, labelled):
    want = pd.DataFrame([(c, *p) for p, c in labelled[0].items()], columns=["component", "z", "y", "x"])
    size = want.groupby("component").size()
    got = run(spark, MIDDLE, "component_filter")
    assert dict(zip(got.component, got["size"])) == size[size.between(2, 99)].to_dict()
    got = run(spark, MIDDLE, "label_centroids").set_index("component").sort_index()
    assert (got["size"] == size).all() and np.allclose(got[["z", "y", "x"]], want.groupby("component")[["z", "y", "x"]].mean() * 2 + 1, atol=1e-6)
    one = run(spark, MIDDLE, "component_summary").iloc[0]
    assert one.components == len(size) and np.allclose([one.largest_share, one.small_share], [size.max() / size.sum(), size[size < 27].sum() / size.sum()], atol=1e-6)


def test_matches_of_the_whole_lattice(spark, sf, placed, junctions):
    a, b = ends(placed)
    both = np.vstack([a, b])
    mid = (both.min(axis=0) + both.max(axis=0)) / 2
    turned = lambda p: np.column_stack([mid[0] - (p[:, 1] - mid[1]), mid[1] + (p[:, 0] - mid[0]), p[:, 2]]).round(6) + 0.0
    key = lambda p, q: [tuple(sorted((tuple(x), tuple(y)))) for x, y in zip(p.tolist(), q.tolist())]
    at: dict = {}
    for i, k in zip(placed.id, key(a, b)):
        at.setdefault(k, []).append(i)
    want = sorted((i, m) for i, k in zip(placed.id, key(turned(a), turned(b))) for m in at.get(k, []))
    got = run(spark, sf, "symmetry_remap")
    assert sorted(zip(got.id, got.match)) == want and len(want) > 0


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_positions_of_all_junctions(spark, scale):
    d = f"/root/testdata/sf{scale}"
    j = V.junctions(spark, d).toPandas()
    same = j.assign(value=(j.id % 97).astype(float)).groupby(["x", "y", "z"]).value
    want = pd.DataFrame({"id": j.id, "n": same.transform("size"), "value": same.transform("mean")}).sort_values("id", ignore_index=True)
    got = run(spark, d, "position_match").sort_values("id", ignore_index=True)
    assert (got[["id", "n"]] == want[["id", "n"]]).all(axis=None) and np.allclose(got.value, want.value, atol=1e-6)


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_clusters_of_all_defects(spark, scale):
    d = f"/root/testdata/sf{scale}"
    s = V.struts(spark, d).toPandas().merge(V.classes(spark, d).select("id", "class").toPandas(), on="id")
    bad = s[s["class"] != "present"]
    assert {"missing", "broken", "thin"} == set(bad["class"])
    by_end: dict = {}
    for i, *js in bad[["id", "junction0", "junction1"]].to_numpy():
        for j in js:
            by_end.setdefault(j, []).append(i)
    ends_of = {i: js for i, *js in bad[["id", "junction0", "junction1"]].to_numpy()}
    label: dict = {}
    for i in sorted(ends_of):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in label:
                label[k] = i
                for j in ends_of[k]:
                    todo += by_end.pop(j, [])
    got = run(spark, d, "defect_clusters")
    assert dict(zip(got.strut_id, got.cluster)) == label and len(got) == len(label)
    sizes = run(spark, d, "cluster_sizes")
    assert dict(zip(sizes.cluster, sizes["size"])) == pd.Series(label).value_counts().to_dict()


@pytest.mark.parametrize("name", ["perp_basis", "strut_frame"])
def test_struts_without_length_go_before_their_frames_are_computed(spark, sf, name):
    from __spark_entry__ import queries

    plan = queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert max(len(line) for line in plan.splitlines()) < 1000


def test_a_task_groups_a_bounded_number_of_items(spark, sf, monkeypatch):
    monkeypatch.setattr(V, "ROWS", 100)
    asked = -(-V.table(spark, sf, "lineitem").count() // 100)
    for view in (V.struts, V.classes):
        assert f"hashpartitioning(id, {asked})" in re.sub(r"#\d+L?", "", plan_of(view(spark, sf)))
    found = {"missing": "missing", "broken": "broken"}
    told = V.classes(spark, sf).toPandas()
    got = run(spark, sf, "merged_findings").set_index("strut_id")["class"]
    assert got.to_dict() == {i: found.get(c, "deferred") for i, c in zip(told.id, told["class"])} and len(got) == len(told)


def test_findings_are_merged_where_their_struts_lie(spark, sf):
    from __spark_entry__ import queries

    plan = plan_of(queries()["merged_findings"](spark, sf))
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1


def test_samples_of_struts_are_tested_where_struts_lie(spark, sf, monkeypatch):
    from __spark_entry__ import queries

    plan = plan_of(found := queries()["tube_emptiness"](spark, sf))
    assert plan.count("Exchange hashpartitioning") == 1
    want = sorted(found.toPandas().id)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin [cx" in plan_of(queries()["tube_emptiness"](spark, sf))
        monkeypatch.setattr(N, "PLACES", 0)  # more places than are broadcast
        found = queries()["tube_emptiness"](spark, sf)
        assert "Broadcast" not in plan_of(found)
        assert sorted(found.toPandas().id) == want and len(want) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
