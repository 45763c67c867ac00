import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strutwise.llm import tries as T

SCHEMA = "conv_id long, turn int, role string, text string"


def sequences(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(own)] for c, own in convs.items()}


def brute(convs):
    """Every column of every node, by listing all prefixes."""
    at = lambda c: T.LAST if c is None else c
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for k in members:
        if k:
            children[k[:-1]].add(k)
    out, least = [], {k: min(m, key=at) for k, m in members.items()}
    for k, m in members.items():
        tree = [x for x in members if x[: len(k)] == k]
        ends = sorted((c for c in m if len(convs[c]) == len(k)), key=at)
        out.append((
            least[k], len(k), least[k[:-1]] if k else None, len(m), len(children[k]), sum(not children[x] for x in tree),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in tree if x), hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def got(trie):
    rows = trie.nodes.join(T.end_digests(trie.ends), T._KEY, "left").select(*COLUMNS, F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("e")).collect()
    return sorted((tuple(r) for r in rows), key=str)


def turns(seed, convs, most, kinds):
    rng = np.random.default_rng(seed)
    return [(int(c), k, ["user", "assistant"][k % 2], f"t{rng.integers(0, kinds)}é") for c in rng.permutation(convs) for k in range(rng.integers(0, most))]


ODD = [
    (1, 0, "user", "a"), (1, 1, None, None), (2, 0, "user", "a"), (2, 1, "", ""), (2, 1, "", ""), (3, None, "user", "a"), (3, 5, "x", "😀" * 40), (4, 0, "usera", ""),
    (5, 0, "user", "a"), (5, 0, "user", "a"), (6, 2, "user", "b"), (6, 2, "user", "a"), (7, 0, "user", "long " * 30_000), (8, 0, "user", "long " * 30_000), (None, 0, "user", "a"),
    (None, None, "z", None), (-9, 0, "user", "a"), (1 << 50, 0, None, ""),
]


def test_odd_conversations(spark):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    more = df.select("*", *[F.lit("own").alias(c) for c in ("c", "pos", "depth", "print", "part", "variant", "before", "above", "start", "like", "symbol")])
    assert got(T.prefix_trie(more)) == brute(sequences(ODD))


@pytest.mark.parametrize("seed,convs,most,kinds", [(1, 60, 6, 2), (2, 8, 90, 1), (3, 40, 12, 3)])
def test_random_tries(spark, seed, convs, most, kinds):
    rows = turns(seed, convs, most, kinds)
    names = spark.range(convs).select(F.col("id").alias("conv_id"))
    want = brute({c: [] for c in range(convs)} | sequences(rows))
    assert got(T.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), names, block=4)) == want


@pytest.mark.parametrize("bits", [0, 1])
def test_collisions_are_split(spark, bits):
    rows = turns(7, 25, 5, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(T.prefix_trie(df, symbol_bits=bits)) == brute(sequences(rows))
    assert T.prefix_trie(df, symbol_bits=bits).nodes.agg(F.max("variant")).first()[0] > 0


def test_a_conversation_over_many_partitions(spark):
    rows = [(c, k, "user", f"{k % 3}") for c in (1, 2) for k in range(900 + c)] + [(3, 0, "user", "0")]
    scan = T.scanned(spark.createDataFrame(rows, SCHEMA).repartition(4))
    found = {(r.c, r.pos): (r.before, r.print) for r in scan.collect()}
    assert len(found) == len(rows)
    assert all(found[1, k] == found[2, k] for k in range(901)) and all(found[1, k][1] == found[1, k + 1][0] for k in range(900))
    assert found[3, 0] == found[1, 0] and found[1, 0][0] == 0 and len({p for _, p in found.values()}) == 902
    out = got(T.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(4), block=100))
    assert len(out) == 903 and sum(n for _, _, _, n, *_ in out) == len(rows) + 3


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.prefix_trie(empty).nodes.count() == 0
    assert got(T.prefix_trie(empty, spark.range(2).select(F.col("id").alias("conv_id")))) == brute({0: [], 1: []})


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    own = sequences(rows)
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    assert sorted((tuple(r) for r in T.op12_prefix_trie(spark, sf).collect()), key=str) == brute(rebuilt)
