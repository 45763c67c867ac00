from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strutwise.llm import forest as L
from strutwise.llm.components import components


def brute(rows, n=5, threshold=0.8):
    """(id, text) -> (class id, class size, links), by comparing all pairs."""
    sets = []
    for i, t in rows:
        w = tuple((t or "").encode().split())
        sets.append(frozenset(w[k : k + n] for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([w]) if w else frozenset())
    m = len(rows)
    parent, links = list(range(m)), [0] * m

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(m):
        for b in range(a):
            u = len(sets[a] | sets[b])
            if u == 0 or len(sets[a] & sets[b]) >= threshold * u - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for k in range(m):
        groups[root(k)].append(k)
    out = []
    for own in groups.values():
        ids = [rows[k][0] for k in own if rows[k][0] is not None]
        out += [(rows[k][0], min(ids) if ids else None, len(own), links[k]) for k in own]
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.class_id, r.class_size, r.n_links) for r in df.collect())


@pytest.mark.parametrize("limits", [{}, {"bucket": 2, "block": 2}])
def test_odd_documents(docs, clashing, rows, limits):
    want = brute([r[:2] for r in rows])
    assert got(L.near_duplicates(docs, **limits)) == want
    assert got(L.near_duplicates(clashing, **limits)) == want


@pytest.mark.parametrize("limits", [{}, {"bucket": 4, "block": 6}])
def test_a_large_group_of_near_copies(spark, limits):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 500, 120)]
    rows = []
    for i in range(90):
        w = list(base)
        for p in rng.integers(0, len(w), i % 6):
            w[p] = f"x{rng.integers(0, 1000)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"y{k}" for k in rng.integers(0, 9999, 60))) for i in range(30)]
    assert got(L.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **limits)) == brute(rows)


def test_components_of_long_texts_are_split(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(L, "PART_SHINGLES", 300)
    assert got(L.near_duplicates(docs)) == brute([r[:2] for r in rows])


def test_prefix_depth_meets_the_recall():
    d = L.prefix_depth()
    assert 1 - (1 - L.THRESHOLD**d) ** L.TREES >= L.RECALL > 1 - (1 - L.THRESHOLD ** (d + 1)) ** L.TREES
    assert L.prefix_depth(trees=1) == 1


def test_tries_list_the_company_of_every_prefix():
    rng = np.random.default_rng(2)
    trees, depth, least, count = 3, 5, 2, 200
    signature = rng.integers(0, 2, (count, trees * depth)).astype(np.uint32)
    batch = pa.RecordBatch.from_pydict({"row": pa.array(range(count), pa.int64()), "signature": pa.array([x.tobytes() for x in signature], pa.binary())})
    sent = pa.Table.from_batches(list(L._send_paths(1, trees, depth, least)([batch])))
    found = L._tries(depth, least)(sent).to_pylist()
    got = {}
    for r in found:
        for key, many in np.frombuffer(r["shared"], np.uint64).reshape(2, -1).T.tolist():
            got.setdefault((r["depth"], key, many), set()).add(r["row"])
    want = set()
    for t in range(trees):
        for d in range(least, depth + 1):
            runs = defaultdict(set)
            for k in range(count):
                runs[tuple(signature[k, t * depth : t * depth + d])].add(k)
            deeper = defaultdict(set)
            for k in range(count):
                deeper[tuple(signature[k, t * depth : t * depth + d + 1])].add(k) if d < depth else deeper[k].add(k)
            want |= {(d, frozenset(x)) for x in runs.values() if len(x) > 1 and x not in deeper.values()}
    assert all(len(x) == many for (_, _, many), x in got.items())
    assert {(d, frozenset(x)) for (d, _, _), x in got.items()} == want


def spread(share: float, pairs: int):
    """Pairs of texts that share about this part of their shingles, nothing else alike."""
    rng = np.random.default_rng(int(1000 * share))
    out = []
    for p in range(pairs):
        w = [f"p{p}w{k}" for k in range(204)]
        keep = round(200 * 2 * share / (1 + share))
        out += [(2 * p, " ".join(w)), (2 * p + 1, " ".join(w[: keep + 4] + [f"q{p}w{k}" for k in range(200 - keep)]))]
    return out


def test_prefixes_are_shortened_as_far_as_the_links_need(spark):
    def rounds(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert got(L.near_duplicates(docs)) == brute(rows)
        sets = L.shingles(pa.array([t for _, t in rows]))
        classes = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(L.signatures(sets, L.TREES * L.DEPTH))], "row long, signature binary")
        return L.candidate_links(classes, len(rows), L.THRESHOLD, L.TREES, L.DEPTH, L.RECALL, L.BUCKET)[1]

    near, far = rounds(spread(0.98, 150)), rounds(spread(0.81, 40))
    assert [d for d, _ in near] == [6] and [d for d, _ in far] == [6, 5, 4]
    assert near[-1][1] >= L.RECALL and far[-1][1] >= L.RECALL > far[0][1] and far[0][1] < far[1][1]


def test_empty(none):
    assert L.near_duplicates(none).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 10), (10, 9)] + [(k, k + 1) for k in range(100, 160)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 8, 9: 8, 10: 8} | {k: 100 for k in range(100, 161)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_one_of_each_class(spark, docs, rows):
    left = L.near_duplicate_stage(spark, docs, "")
    assert left.columns == docs.columns
    want = brute([r[:2] for r in rows])
    assert left.count() == sum(1 / size * n for (_, _, size, _), n in want.items())
    assert {r.doc_id for r in left.collect()} >= {c for (_, c, _, _) in want if c is not None}


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(L.op5_forest_join(spark, sf)) == brute(rows)
