import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from strutwise.operators import neighbours as N
from strutwise.operators import review as R


def test_topology_is_that_of_canonical_json(spark):
    j = spark.createDataFrame([(30,), (10,)], "id long")
    s = spark.createDataFrame([(99, 30, 10), (5, 10, 30)], "id long, junction0 long, junction1 long")
    c = spark.createDataFrame([(7, [99, 5]), (2, [])], "id long, struts array<bigint>")
    want = json.dumps({"junction_ids": [10, 30], "struts": [[5, 10, 30], [99, 10, 30]], "unit_cells": [[2, []], [7, [5, 99]]]}, sort_keys=True, separators=(",", ":"))
    assert R.topology_json(j, s, c).first() == (hashlib.sha256(want.encode()).hexdigest(), 2, 2, 2)
    empty = R.topology_json(j.limit(0), s.limit(0), c.limit(0)).first()
    assert empty[0] == hashlib.sha256(b'{"junction_ids":[],"struts":[],"unit_cells":[]}').hexdigest()


def test_slices_keep_apart():
    counts = [(0, 5), (1, 9), (2, 8), (10, 7), (20, 6), (30, 0)]
    assert R.spaced_slices(counts, [20, 99], 3, 5) == [1, 10, 20]
    assert R.spaced_slices(counts, [], 4, 50) == [1, 2, 10, 20] and R.spaced_slices([], [1], 2, 1) == []


def test_sides_and_evidence(spark):
    rows = spark.createDataFrame([(1, "A", 2.0), (1, "B", 3.0), (2, "A", 1.0), (3, "A", 1.0), (3, "A", 1.0), (4, "A", 1.0), (4, "B", 1.0), (4, "C", 1.0)], "id long, side string, v double")
    got = {r.id: (r.v_a, r.v_b, r.complete) for r in R.widened(rows, "id", "side", ["v"]).collect()}
    assert got == {1: (2.0, 3.0, True), 2: (1.0, None, False), 3: (1.0, None, False), 4: (1.0, 1.0, False)}
    need, have = spark.createDataFrame([(1,), (2,), (3,)], "id long"), spark.createDataFrame([(2,), (3,), (3,), (9,)], "id long")
    assert {tuple(r) for r in R.evidence_problems(need, have).collect()} == {(1, "missing"), (3, "repeated"), (9, "not_required")}


def test_yen_and_contrast(spark):
    hist = spark.createDataFrame([(b, c) for b, c in zip((1, 2, 3, 50, 51, 52), (100, 300, 100, 20, 40, 20))], "bin int, c long")
    assert 3 <= R.yen(hist).first()[0] < 50 and R.yen(hist.limit(1)).count() == 0
    flat = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert {r.shade for r in R.contrast(flat, "v").collect()} == {0}


def test_a_quarter_turn_maps_a_square_to_itself(spark):
    ring = [(1, 0, 0, 2, 0), (2, 2, 0, 2, 2), (3, 2, 2, 0, 2), (4, 0, 2, 0, 0)]
    s = spark.createDataFrame([(i, float(a), float(b), 0.0, float(c), float(d), 0.0) for i, a, b, c, d in ring], "id long, ax double, ay double, az double, bx double, by double, bz double")
    got = {tuple(r) for r in R.turned_ids(s, s, ((0, -1, 0), (1, 0, 0), (0, 0, 1))).collect()}
    assert got == {(1, 2), (2, 3), (3, 4), (4, 1)}


def test_nearest_without_targets_nulls_and_ties(spark):
    schema = "id long, x double, y double, z double"
    a = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 1000.0, 0.0, 0.0), (3, None, 0.0, 0.0)], schema)
    b = spark.createDataFrame([(8, 1.0, 0.0, 0.0), (5, -1.0, 0.0, 0.0), (9, 1.0, 0.0, 0.0)], schema)
    assert {tuple(r) for r in N.nearest(a, b, 0.5).collect()} == {(1, 5, 1.0), (2, 8, 999.0)}
    assert N.nearest(a, b.limit(0), 0.5).count() == 0 == N.nearest(a.limit(0), b, 0.5).count()
    odd = spark.createDataFrame([(70, float("nan"), 0.0, 0.0), (71, float("inf"), 0.0, 0.0), (72, None, 0.0, 0.0)], "id long, x double, y double, z double")
    assert N.nearest(a.unionByName(odd), b.unionByName(odd), 0.5).count() == N.nearest(a, b).count() == 2
    kept = N.trimmed(N.nearest(a, b, 0.5), 0.5)
    assert kept.count() == 2


def test_scales_and_errors(spark):
    p = spark.createDataFrame([(k, float(k % 3), float(k // 3), 0.5) for k in range(9)], "id long, x double, y double, z double")
    got = {r.scale: r.best for r in R.scale_search(p.select("id", *[(F.col(c) / 2).alias(c) for c in "xyz"]), p, [1.0, 2.0], 0.3).collect()}
    assert got == {1.0: False, 2.0: True}
    e = R.node_errors(p.withColumn("x", F.col("x") + 3), p).first()
    assert (e.n, e.mean, e.largest, e.bias_x, e.bias_y) == (9, 3.0, 3.0, 3.0, 0.0)


def test_topology_digest_in_pieces(spark, monkeypatch):
    """As the whole text gives it, over several pieces and of empty tables; no row holds the document."""
    import hashlib

    kept, stored = [], R.stored

    def seen(df, name):
        kept.append(stored(df, name))
        return kept[-1]

    monkeypatch.setattr(R, "stored", seen)
    monkeypatch.setattr(R, "ENTRIES", 7)
    j = spark.createDataFrame([(k * 37 % 101,) for k in range(101)], "id long")
    s = spark.createDataFrame([(k * 11 % 50, k % 7, (k * 3) % 5) for k in range(50)], "id long, junction0 long, junction1 long")
    c = spark.createDataFrame([(k, [k + 2, k, k + 1]) for k in (12, 3, 5)], "id long, struts array<bigint>")
    ends = {k * 11 % 50: sorted((k % 7, (k * 3) % 5)) for k in range(50)}
    text = '{"junction_ids":[' + ",".join(map(str, range(101))) + '],"struts":[' + ",".join(f"[{k},{u},{v}]" for k, (u, v) in sorted(ends.items())) + '],"unit_cells":[[3,[3,4,5]],[5,[5,6,7]],[12,[12,13,14]]]}'
    assert tuple(R.topology_json(j, s, c).first()) == (hashlib.sha256(text.encode()).hexdigest(), 101, 50, 3)
    assert max(len(r.piece) for r in kept[0].collect()) < 100
    assert R.topology_json(j.limit(0), s.limit(0), c.limit(0)).first().topology_sha256 == hashlib.sha256(b'{"junction_ids":[],"struts":[],"unit_cells":[]}').hexdigest()


def test_scales_tried_from_places_that_many_share(spark, monkeypatch):
    from strutwise.operators import neighbours

    looked, nearest_spots = [], neighbours.nearest_spots

    def counted(left, *rest):
        looked.append(left.count())
        return nearest_spots(left, *rest)

    monkeypatch.setattr(R, "nearest_spots", counted)
    p = spark.createDataFrame([(k, float(k % 4), 0.0, float(k % 2)) for k in range(80)], "id long, x double, y double, z double")
    got = {r.scale: (r.n, r.best) for r in R.scale_search(p, p, [1.0, 2.0]).collect()}
    assert got == {1.0: (80, True), 2.0: (80, False)} and looked == [8]


def test_series_are_filled_in_one_pass(spark):
    from strutwise.functions import sequences as Q

    rows = [(1, [None, 1.0, None, None, 4.0, None]), (2, [None, None]), (3, []), (4, [2.0]), (5, [1.0, float("nan"), 3.0])]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    got = Q.filled_rows(df, "k", "v")
    want = df.select("k", F.posexplode(Q.filled(F.col("v"))).alias("i", "value"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 12
    assert "ArrayMax" not in got._jdf.queryExecution().analyzed().toString()


def test_turned_struts_meet_by_one_number_and_the_ends_decide(spark, monkeypatch):
    line = lambda i, p, q: (i, *map(float, p), *map(float, q))
    rows = [line(1, (0, 0, 0), (2, 0, 0)), line(2, (2, 0, 0), (2, 2, 0)), line(3, (2, 2, 0), (2, 0, 0)), line(4, (0, 2, 0), (0, 0, 0)), line(5, (0, 2, 0), (2, 2, 0)), line(6, (0, 0, 0), (2, 2, 0)), line(7, (-0.0, 0, 1e-9), (2, 0, 0))]
    s = spark.createDataFrame(rows, "id long, ax double, ay double, az double, bx double, by double, bz double")
    quarter = ((0, -1, 0), (1, 0, 0), (0, 0, 1))
    want = [(1, 2), (1, 3), (2, 5), (3, 5), (4, 1), (4, 7), (5, 4), (7, 2), (7, 3)]
    found = R.turned_ids(s, s, quarter)
    assert sorted(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner, \(+id_key#\d+L = match_key#\d+L\)", plan) and plan.count(" = ") == 1
    monkeypatch.setattr(R.F, "xxhash64", lambda *ends: F.size(F.array(*ends)).cast("long") + F.hash(ends[0]) % 2)
    assert sorted(map(tuple, R.turned_ids(s, s, quarter).collect())) == want


@pytest.mark.parametrize("places,pairs", [(20, 0), (20_000, 1 << 20)])
def test_many_spots_are_shuffled_and_crowds_get_small_cells(spark, monkeypatch, places, pairs):
    """Nearest as brute force finds them; with more than PLACES spots no round broadcasts them, at any size of theirs."""
    import numpy as np

    plans, stored = [], N.stored

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(N, "PLACES", places)
    monkeypatch.setattr(N, "PAIRS", pairs, raising=False)
    monkeypatch.setattr(N, "stored", seen)
    rng = np.random.default_rng(5)
    b = np.vstack([rng.normal(0, 0.3, (300, 3)), rng.uniform(-5, 5, (30, 3))])
    a = np.vstack([rng.normal(0, 0.4, (60, 3)), rng.uniform(-6, 6, (20, 3))])
    frame = lambda p: spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(p)], "id long, x double, y double, z double")
    got = {r.id: (r.target, r.distance) for r in N.nearest(frame(a), frame(b)).collect()}
    far = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    assert {k: v[0] for k, v in got.items()} == dict(enumerate(far.argmin(axis=1).tolist()))
    assert np.allclose([got[k][1] for k in range(len(a))], far.min(axis=1))
    rounds = [p for n, p in plans if n == "nearest"]
    assert len(rounds) > 1 and any("BroadcastHashJoin" in p for p in rounds) == (places == 20_000)
    _, size = N.spots_of(frame(b))
    cells = np.unique(np.floor(b / size), axis=0, return_counts=True)[1]
    assert ((cells * cells).sum() <= 8 * len(b)) == (places == 20)
