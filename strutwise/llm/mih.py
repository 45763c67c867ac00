"""Exact Hamming top-k by incremental multi-index hashing.

Codes are cut into segments; two codes that differ in ``d`` bits differ in at
most ``d div m`` bits of some of the ``m`` segments. A search grows the radius
around each query segment, one segment after another; after segment ``j`` at
radius ``r`` every code within ``m * r + j`` bits has been met, so it ends when
the k-th verified distance is no more than that.

Distinct codes and distinct query codes are packed into blocks of bounded size;
each pair of blocks is one group and one search, so a task holds one pair at a
time. Each block of queries first meets one block of the index; no k-th nearest
row lies farther than the k-th found there, so searches in the other blocks end
once that distance is covered. The k nearest of each block are merged.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strutwise.llm.common import stored

#: Distinct codes of an index block and of a query block; queries searched at once.
INDEX_BLOCK, QUERY_BLOCK, AT_ONCE = 16_384, 16_384, 128


@lru_cache(maxsize=256)
def _flips(bits: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), radius)], dtype=np.int64)


class SegmentIndex:
    """Segment tables over an array of codes, (n, words) uint64, of ``bits`` bits."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.codes, self.n = codes, len(codes)
        size = min(bits, max(4, int(np.ceil(np.log2(max(2, self.n))))), 16)
        self.m = -(-bits // size)
        edges = np.linspace(0, bits, self.m + 1).round().astype(int)
        self.cuts = list(zip(edges[:-1], edges[1:]))
        self.tables = []
        for a, b in self.cuts:
            value = self.segment(codes, a, b)
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << (b - a)) + 1))))

    @staticmethod
    def segment(codes: np.ndarray, a: int, b: int) -> np.ndarray:
        out = np.zeros(len(codes), dtype=np.int64)
        for bit in range(a, b):
            out |= ((codes[:, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1)).astype(np.int64) << (bit - a)
        return out

    def nearest(self, queries: np.ndarray, k: int, many: np.ndarray, bound: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the codes (places, distances) that hold its k nearest rows; code i stands for ``many[i]`` rows.

        With ``bound`` only rows within that distance of a query are wanted.
        """
        found = []
        bound = np.full(len(queries), self.codes.shape[1] * 64) if bound is None else bound
        for a in range(0, len(queries), AT_ONCE):
            found += self._some(queries[a : a + AT_ONCE], k, many, bound[a : a + AT_ONCE])
        return found

    def _some(self, queries, k, many, bound):
        nq = len(queries)
        seen = np.zeros((nq, self.n), dtype=bool)
        most = self.codes.shape[1] * 64 + 1
        rows_at = np.zeros((nq, most), dtype=np.int64)  # verified rows by distance
        got = [[] for _ in range(nq)]
        live = np.arange(nq)
        wanted = min(k, int(many.sum()))
        values = [self.segment(queries, a, b) for a, b in self.cuts]
        for radius in range(max(b - a for a, b in self.cuts) + 1):
            for j, (a, b) in enumerate(self.cuts):
                if not len(live):
                    break
                order, starts = self.tables[j]
                if radius <= b - a:
                    probe = (values[j][live, None] ^ _flips(b - a, radius)[None, :]).ravel()
                    count = starts[probe + 1] - starts[probe]
                    owner = np.repeat(np.repeat(live, len(probe) // len(live)), count)
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    place = order[step + np.repeat(starts[probe], count)]
                    new = ~seen[owner, place]
                    owner, place = owner[new], place[new]
                    seen[owner, place] = True
                    distance = np.bitwise_count(queries[owner] ^ self.codes[place]).sum(axis=1, dtype=np.int64)
                    np.add.at(rows_at, (owner, distance), many[place])
                    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)])
                    for x, y in zip(cut, np.r_[cut[1:], len(owner)][: len(cut)]):
                        got[owner[x]].append((place[x:y], distance[x:y]))
                covered = self.m * radius + j
                live = live[(rows_at[live, : covered + 1].sum(axis=1) < wanted) & (covered < bound[live])]
            if not len(live):
                break
        out = []
        for q in range(nq):
            if not got[q]:
                out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
                continue
            place, distance = (np.concatenate(x) for x in zip(*got[q]))
            last = int(np.searchsorted(np.cumsum(rows_at[q]), wanted))  # the k-th distance; all within it count
            keep = distance <= min(last, int(bound[q]))
            out.append((place[keep], distance[keep]))
        return out


def sign_codes(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and ``code`` (binary): a bit for each element above 0. Null or empty vectors and null elements: no bit; rows without a vector go."""

    def run(batches):
        for batch in batches:
            keep = [k for k, v in enumerate(batch.column(1).to_pylist()) if v]
            codes = []
            for v in batch.column(1).take(pa.array(keep, pa.int64())).to_pylist():
                bits = np.array([x is not None and x > 0 for x in v], dtype=bool)
                codes.append(np.packbits(np.pad(bits, (0, -len(bits) % 64)), bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(codes, pa.binary())], names=["id", "code"])

    return vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(run, "id long, code binary")


def _pack(table: pa.Table) -> pa.Table:
    codes = table["code"].to_pylist()
    return pa.table({"block": table["block"].slice(0, 1), "codes": pa.array([b"".join(codes)], pa.binary()), "ids": pa.array([table["ids"].to_pylist()], pa.list_(pa.list_(pa.int64())))})


def _pack_queries(table: pa.Table) -> pa.Table:
    bounds = np.array(table["bound"].to_pylist(), dtype="<i4").tobytes()
    return pa.table({"g": table["g"].slice(0, 1), "queries": pa.array([b"".join(table["code"].to_pylist())], pa.binary()), "bounds": pa.array([bounds], pa.binary())})


def _search(k: int, width: int):
    def run(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"code": [], "distance": [], "id": []}
        if blocks.num_rows and asked.num_rows:
            ids = blocks["ids"][0].as_py()
            index = SegmentIndex(np.frombuffer(blocks["codes"][0].as_buffer(), "<u8").reshape(-1, width // 8), width * 8)
            queries = np.frombuffer(asked["queries"][0].as_buffer(), "<u8").reshape(-1, width // 8)
            many = np.array([len(x) for x in ids], dtype=np.int64)
            bounds = np.frombuffer(asked["bounds"][0].as_buffer(), "<i4").astype(np.int64)
            for q, (place, distance) in zip(queries, index.nearest(queries, k, many, bounds)):
                rows = sorted((int(d), i) for p, d in zip(place, distance) for i in ids[p])[:k]
                out["code"] += [q.tobytes()] * len(rows)
                out["distance"] += [d for d, _ in rows]
                out["id"] += [i for _, i in rows]
        return pa.table({"code": pa.array(out["code"], pa.binary()), "distance": pa.array(out["distance"], pa.int32()), "id": pa.array(out["id"], pa.int64())})

    return run


def hamming_top_k(rows: DataFrame, queries: Column, k: int = 10, index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, id, distance``: the k nearest rows of each query, itself included, nearest and then least id first.

    ``rows`` has ``id`` and ``code`` (binary, whole 8-byte words, all of one
    length; different lengths raise an error).
    ``queries`` picks the rows that ask. Equal codes are searched once; of those
    only the k least ids can matter. A null id is left out. Fewer than k rows
    give fewer ranks, an empty table none.
    """
    rows = stored(rows.where(F.col("id").isNotNull() & F.col("code").isNotNull()), "codes")
    widths = [r[0] for r in rows.groupBy(F.octet_length("code")).count().limit(2).collect()]
    if len(widths) > 1:
        raise ValueError("codes of different lengths")
    schema = "query_id long, rank int, id long, distance int"
    if not widths:
        return rows.sparkSession.createDataFrame([], schema)
    first = Window.partitionBy("code").orderBy("id")
    few = rows.select("id", "code").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k)
    distinct = stored(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "distinct")
    blocks = max(1, -(-distinct.count() // index_block))
    index = distinct.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int")).groupBy("block").applyInArrow(_pack, "block int, codes binary, ids array<array<bigint>>")
    asking = stored(rows.where(queries).select(F.col("id").alias("query_id"), "code").distinct(), "queries")
    asked = asking.select("code").distinct()
    groups = max(1, -(-asked.count() // query_block))
    asked = asked.withColumn("g", F.pmod(F.xxhash64("code", F.lit(1)), F.lit(groups)).cast("int"))
    best = Window.partitionBy("code").orderBy("distance", "id")

    def met(queries: DataFrame, pairs: Column) -> DataFrame:
        """The k nearest rows of queries (``code, g, bound``) in each index block that is paired with theirs."""
        packed = queries.groupBy("g").applyInArrow(_pack_queries, "g int, queries binary, bounds binary")
        left = index.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).where(pairs)
        right = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).where(pairs)
        return left.groupBy("block", "g").cogroup(right.groupBy("block", "g")).applyInArrow(_search(k, widths[0]), "code binary, distance int, id long")

    farthest = 8 * widths[0]
    own = F.col("block") == F.col("g") % F.lit(blocks)
    found = met(asked.withColumn("bound", F.lit(farthest)), own)
    if blocks > 1:  # the first block's k-th distance bounds the search in all others
        found = stored(found, "nearest")
        kth = found.groupBy("code").agg(F.count("*").alias("n"), F.max("distance").alias("far")).where(F.col("n") == k)
        bounded = asked.join(kth.select("code", "far"), "code", "left").select("code", "g", F.coalesce("far", F.lit(farthest)).alias("bound"))
        found = found.unionByName(met(bounded, ~own))
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return asking.join(top, "code").select("query_id", "rank", "id", "distance")


def op2_mih_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every embedding whose id is divisible by 20, among all."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hamming_top_k(sign_codes(vectors, "vec_id", "embedding"), F.col("id") % 20 == 0, 10)


OP2_SQL = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: (x > 0)::INT) AS b FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS id,
         list_sum(list_transform(list_zip(q.b, c.b), lambda z: (z[1] <> z[2])::INT))::INT AS distance
  FROM c q, c WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INT AS rank, id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM p
) WHERE rank <= 10
"""
