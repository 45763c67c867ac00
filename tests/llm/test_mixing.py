import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from strutwise.llm import mixing as M


def water_fill(sizes: dict, weights=(5, 2, 1), cap=3.0) -> dict:
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(full.values())
        shares = {s: rest * w[s] / sum(w[x] for x in free) for s in free} if free else {}
        over = [s for s in free if shares[s] >= cap * sizes[s]]
        if not over:
            return {**full, **shares}
        full |= {s: cap * sizes[s] for s in over}


def test_targets(spark):
    sizes = {"a": 10, "b": 500, "c": 40, "é": 7, "z": 300, None: 90, "zero": 0}
    units = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["__source"]: r.target for r in M.targets(units, "size", "source").collect()}
    want = water_fill(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_flight_keeps_both_sums_and_leaves_two():
    rng = np.random.default_rng(0)
    sizes = rng.integers(0, 500, 400).astype(float)
    for p in (0.1, 0.5, 0.93):
        pi = M.flight(np.full(400, p), sizes, np.random.default_rng(1))
        assert ((pi > 0) & (pi < 1)).sum() <= 2 and abs(pi.sum() - 400 * p) < 1e-5 and abs(pi @ sizes - p * sizes.sum()) < 1e-3


def test_flight_of_equal_sizes_and_none():
    assert len(M.flight(np.zeros(0), np.zeros(0), np.random.default_rng(1))) == 0
    pi = M.flight(np.full(50, 0.5), np.full(50, 7.0), np.random.default_rng(1))
    assert ((pi > 0) & (pi < 1)).sum() <= 2 and abs(pi.sum() - 25) < 1e-6


def test_many_blocks_come_near_the_target(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 64)
    units = spark.range(3000).select("id", (F.col("id") * 37 % 101).alias("size"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    got = M.mixed(units).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("k"), F.max("copies").alias("m")).collect()
    assert all(abs(r.t - r.k) <= 101 and r.m <= 3 for r in got)


def test_every_row_once_and_reruns_agree(docs, clashing, rows):
    units = docs.select("doc_id", F.length("text").alias("size"), "source")
    a, b = M.mixed(units).collect(), M.mixed(units.repartition(5)).collect()
    key = lambda r: str(r)
    assert len(a) == len(rows) and sorted(a, key=key) == sorted(b, key=key)
    assert all(r.copies <= 3 for r in a)
    own = clashing.select("*", *[F.lit(f"own {c}").alias(c) for c in M.OWN])
    assert M.mixed(own.drop("text").withColumn("size", F.col("n_chars"))).count() == len(rows)
    wide = M.mixed(clashing.withColumn("size", F.col("n_chars")), size="size")
    assert wide.count() == len(rows) and dict(wide.dtypes)["target"] == "double"


def test_empty(spark, none):
    assert M.mixed(none.select("doc_id", F.lit(1).alias("size"), "source")).count() == 0
    assert M.mix_stage(spark, none, "").count() == 0


def test_stage_repeats_whole_rows(spark, docs):
    got = M.mix_stage(spark, docs, "")
    assert got.columns == docs.columns and got.exceptAll(docs.unionAll(docs).unionAll(docs)).count() == 0


def test_many_sources_are_not_broadcast(spark, monkeypatch):
    units = spark.range(400).select("id", (F.col("id") * 37 % 101).alias("size"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    want = sorted(M.mixed(units).collect())
    monkeypatch.setattr(M, "SOURCES", 2)
    assert sorted(M.mixed(units).collect()) == want


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    source = {r.doc_id: r.source for r in rows}
    whole = defaultdict(int)
    for i, s in source.items():
        whole[s] += size[i]
    goal, taken, largest = water_fill(whole), defaultdict(int), defaultdict(int)
    got = M.op3_cube_mix(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(size)
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == whole[s] and abs(r.target - goal[s]) < 1e-6 * max(1.0, goal[s])
        assert r.taken % max(1, r["size"]) == 0 and r.taken <= 3 * r["size"]
        # a row is taken as often as its source's ratio says, or once more
        low = int(goal[s] / whole[s] + 1e-9) if whole[s] else 1
        assert r["size"] == 0 or r.taken // r["size"] in (low, low + 1)
        taken[s] += r.taken
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in goal)
