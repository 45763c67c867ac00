import numpy as np
import pytest
from pyspark.sql import functions as F

from strutwise.llm import mih as M

SCHEMA = "id long, code binary"


def brute(rows, queries, k):
    out = []
    for q, c in {(q, bytes(c)) for q, c in rows if q is not None and c is not None and queries(q)}:
        d = sorted({(int(np.bitwise_count(np.frombuffer(c, "<u8") ^ np.frombuffer(x, "<u8")).sum()), i) for i, x in rows if i is not None and x is not None})
        out += [(q, r + 1, i, dist) for r, (dist, i) in enumerate(d[:k])]
    return sorted(out)


@pytest.mark.parametrize("words,clusters,k", [(1, 1, 3), (1, 40, 10), (2, 5, 10), (1, 400, 500)])
def test_against_brute_force(spark, words, clusters, k):
    rng = np.random.default_rng(words * clusters)
    centres = rng.integers(0, 1 << 63, (clusters, words), dtype=np.uint64)
    codes = centres[rng.integers(0, clusters, 400)] ^ (np.uint64(1) << rng.integers(0, 64, (400, words), dtype=np.uint64)) * rng.integers(0, 2, (400, words)).astype(np.uint64)
    rows = [(i, bytearray(c.astype("<u8").tobytes())) for i, c in enumerate(codes)] + [(7, bytearray(codes[7].astype("<u8").tobytes())), (None, bytearray(8 * words)), (990, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("query_id", F.lit("own")).withColumn("block", F.lit(1))
    got = M.hamming_top_k(df, F.col("id") % 20 == 0, k, index_block=64, query_block=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda q: q % 20 == 0, k)


def test_a_hot_code_and_few_rows(spark):
    rows = [(i, bytearray(8)) for i in range(300)] + [(300, bytearray(b"\x01" + bytes(7)))]
    got = M.hamming_top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") == 300, 5).orderBy("rank").collect()
    assert [(r.id, r.distance) for r in got] == [(300, 0), (0, 1), (1, 1), (2, 1), (3, 1)]
    assert M.hamming_top_k(spark.createDataFrame(rows[:2], SCHEMA), F.col("id") == 0, 5).count() == 2


def test_search_stops_once_covered():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, (2000, 1), dtype=np.uint64)
    index = M.SegmentIndex(codes, 64)
    (place, distance), = index.nearest(codes[:1], 1, np.ones(2000, dtype=np.int64))
    assert distance.min() == 0 and 0 in place and len(place) < 50


def test_a_bound_ends_the_search():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 63, (3000, 1), dtype=np.uint64)
    queries = rng.integers(0, 1 << 63, (50, 1), dtype=np.uint64)
    index, many = M.SegmentIndex(codes, 64), np.ones(3000, dtype=np.int64)
    far = np.bitwise_count(queries ^ codes.T)
    bound = np.sort(far, axis=1)[:, 4].astype(np.int64)
    for q, (place, distance) in enumerate(index.nearest(queries, 10, many, bound)):
        assert sorted(place) == np.flatnonzero(far[q] <= bound[q]).tolist() and (distance == far[q][place]).all()


def test_sign_codes(spark):
    rows = [(1, [0.5, -1.0, 0.0]), (2, None), (3, []), (4, [None, 2.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    got = {r.id: r.code[0] for r in M.sign_codes(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v").collect()}
    assert got == {1: 1, 4: 6, None: 7}


def test_empty_and_mixed_lengths(spark):
    assert M.hamming_top_k(spark.createDataFrame([], SCHEMA), F.col("id") == 1).count() == 0
    with pytest.raises(ValueError):
        M.hamming_top_k(spark.createDataFrame([(1, bytearray(8)), (2, bytearray(16))], SCHEMA), F.col("id") == 1)


def test_query(spark, sf):
    rows = [tuple(r) for r in M.sign_codes(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in M.op2_mih_top_k(spark, sf).collect()) == brute(rows, lambda q: q % 20 == 0, 10)
