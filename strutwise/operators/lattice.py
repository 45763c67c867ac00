"""Graph tables of a lattice: endpoints, integrity, comparison, degrees, clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.sources.storage import stored


def with_endpoints(struts: DataFrame, junctions: DataFrame) -> DataFrame:
    """Struts with both ends' positions ``ax, ay, az, bx, by, bz``; struts with an unknown end go."""
    end = lambda p, k: junctions.select(F.col("id").alias(f"__{p}"), *[F.col(c).alias(f"{p}{c}") for c in "xyz"])
    return struts.join(end("a", 0), F.col("junction0") == F.col("__a")).join(end("b", 1), F.col("junction1") == F.col("__b")).drop("__a", "__b")


def unknown_references(struts: DataFrame, junctions: DataFrame) -> DataFrame:
    """``strut_id, junction`` for every end that names no junction."""
    ends = struts.select(F.col("id").alias("strut_id"), F.explode(F.array("junction0", "junction1")).alias("junction"))
    return ends.join(junctions.select(F.col("id").alias("junction")), "junction", "left_anti").select("strut_id", "junction")


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def problems(struts: DataFrame, junctions: DataFrame) -> DataFrame:
    """One row of counts: repeated ids, repeated unordered pairs, self loops, unknown ends."""
    pair = struts.select(F.least("junction0", "junction1").alias("u"), F.greatest("junction0", "junction1").alias("v"))
    count = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [
        count(duplicates(struts, "id"), "repeated_struts"), count(duplicates(junctions, "id"), "repeated_junctions"),
        count(duplicates(pair, "u", "v"), "repeated_pairs"), count(struts.where("junction0 = junction1"), "self_loops"),
        count(unknown_references(struts, junctions), "unknown_ends"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p)  # one row each
    return out


def coverage(expected: DataFrame, given: DataFrame, key: str = "id", preview: int = 5) -> DataFrame:
    """Whether two id sets are equal: counts of missing and extra ids and the first few of each.

    The first few are cut per task before they meet, so no list of all is built.
    """
    sides = expected.select(key).distinct().withColumn("e", F.lit(1)).join(given.select(key).distinct().withColumn("g", F.lit(1)), key, "full_outer")
    kind = F.when(F.col("g").isNull(), "missing").when(F.col("e").isNull(), "extra").otherwise("both")
    marked = sides.select(key, kind.alias("kind"))
    counts = marked.agg(F.count_if(F.col("kind") == "missing").alias("missing"), F.count_if(F.col("kind") == "extra").alias("extra"))
    first = lambda k: marked.where(F.col("kind") == k).orderBy(key).limit(preview).agg(F.sort_array(F.collect_list(key)).alias(f"first_{k}"))
    return counts.join(first("missing")).join(first("extra")).withColumn("equal", (F.col("missing") == 0) & (F.col("extra") == 0))


def topology_differences(nominal: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row: struts only in one graph and struts whose ends differ."""
    side = lambda df, p: df.select("id", F.col("junction0").alias(f"{p}0"), F.col("junction1").alias(f"{p}1"), F.lit(True).alias(p))
    both = side(nominal, "n").join(side(candidate, "c"), "id", "full_outer")
    known = F.col("n").isNotNull() & F.col("c").isNotNull()
    return both.agg(
        F.count_if(F.col("c").isNull()).alias("only_nominal"), F.count_if(F.col("n").isNull()).alias("only_candidate"),
        F.count_if(known & ~(F.col("n0").eqNullSafe(F.col("c0")) & F.col("n1").eqNullSafe(F.col("c1")))).alias("changed_ends"),
    ).withColumn("equal", (F.col("only_nominal") + F.col("only_candidate") + F.col("changed_ends")) == 0)


def graph_stats(junctions: DataFrame, struts: DataFrame) -> DataFrame:
    """One row: sizes, id ranges and whether ids are contiguous."""
    j = junctions.agg(F.count("*").alias("junctions"), F.min("id").alias("junction_low"), F.max("id").alias("junction_high"), F.count_distinct("id").alias("junction_ids"))
    s = struts.agg(F.count("*").alias("struts"), F.min("id").alias("strut_low"), F.max("id").alias("strut_high"))
    return j.join(s).withColumn("contiguous", F.col("junction_high") - F.col("junction_low") + 1 == F.col("junction_ids"))


def degrees(struts: DataFrame, special: Column | None = None) -> DataFrame:
    """``junction, degree`` and how many of its struts are special (null: none is)."""
    flag = F.coalesce(special, F.lit(False)) if special is not None else F.lit(False)
    ends = struts.select(F.explode(F.array("junction0", "junction1")).alias("junction"), flag.alias("s"))
    return ends.groupBy("junction").agg(F.count("*").alias("degree"), F.count_if("s").alias("special"))


def incident_directions(placed: DataFrame) -> DataFrame:
    """Both directions of every placed strut: ``junction, strut_id, ux, uy, uz`` of length 1; loops of length 0 go."""
    def way(at: str, a: str, b: str) -> DataFrame:
        d = [F.col(f"{b}{c}") - F.col(f"{a}{c}") for c in "xyz"]
        size = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
        return placed.select(F.col(at).alias("junction"), F.col("id").alias("strut_id"), *[v.alias(f"d{c}") for v, c in zip(d, "xyz")], size.alias("size")).where("size > 0").select(
            "junction", "strut_id", *[(F.col(f"d{c}") / F.col("size")).alias(f"u{c}") for c in "xyz"]
        )

    return way("junction0", "a", "b").unionByName(way("junction1", "b", "a"))


def physical_nodes(junctions: DataFrame) -> DataFrame:
    """``x, y, z, node, records``: junction records at one position, named by their least id."""
    return junctions.groupBy("x", "y", "z").agg(F.min("id").alias("node"), F.count("*").alias("records"))


def membership(cells: DataFrame) -> DataFrame:
    """``cell_id, strut_id, place``: members of each unit cell in ascending order."""
    return cells.select(F.col("id").alias("cell_id"), F.posexplode(F.sort_array("struts")).alias("place", "strut_id"))


#: Edges that a task joins at once.
CHUNK = 1 << 20


def _rank(nodes: np.ndarray, turn: int) -> np.ndarray:
    """A place for each node in an order that is another for each turn; no two nodes share one (the mixing steps of splitmix64)."""
    with np.errstate(over="ignore"):
        x = nodes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(turn + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))).view(np.int64)


def _contracted(chunk: int, turn: int):
    """Stars ``node, root, rank`` in place of a task's edges: what its edges join, some at a time; the root is the node of least rank."""

    def run(frames):
        held, size = [], 0

        def stars():
            nodes, index = np.unique(np.concatenate(held), return_inverse=True)
            part, rank = K.roots_of(len(nodes), index.reshape(-1, 2).T), _rank(nodes, turn)
            down, least = np.argsort(rank)[::-1], np.zeros(len(nodes), dtype=np.int64)
            least[part[down]] = down  # the last one written has the least rank
            return pd.DataFrame({"node": nodes, "root": nodes[least[part]], "rank": rank[least[part]]})

        for f in frames:
            if len(f):
                held.append(f[["u", "v"]].to_numpy())
                size += len(f)
            if size >= chunk:
                yield stars()
                held, size = [], 0
        if held:
            yield stars()

    return run


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, component`` (least node) of an undirected edge table; loops and repeated edges are allowed.

    Every round joins the edges that lie in one partition, whatever they are
    (Spark sizes the partitions), then merges each node into the root of least
    rank among those it got. Ranks are drawn anew each round, so that of any
    graph that still has edges a share of the nodes goes, wherever the edges
    lie; the next round has only the merged nodes and what links them. It ends
    when every node has one root; the empty table has no components. Each round
    is a few tables in the shared folder.
    """
    now = edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).where("u is not null and v is not null")
    merged = []
    while True:
        run = _contracted(CHUNK, len(merged))
        stars = stored(stored(now.hint("rebalance"), "edges").mapInPandas(run, "node long, root long, rank long"), "stars")
        least = F.min(F.struct("rank", "root"))["root"].alias("into")
        roots = stored(stars.groupBy("node").agg(least, (F.min("root") != F.max("root")).alias("several")), "roots")
        merged.append(roots.select("node", "into"))
        if roots.where("several").isEmpty():
            break
        own = stars.join(merged[-1], "node").select(F.col("into").alias("u"), "root").distinct()
        now = own.join(merged[-1], F.col("root") == F.col("node")).where("u <> into").select("u", F.col("into").alias("v")).distinct()
    found = merged.pop()
    for table in reversed(merged):
        last = found.select(F.col("node").alias("into"), F.col("into").alias("last"))
        found = table.join(last, "into", "left").select("node", F.coalesce("last", "into").alias("into"))
    found = found if not merged else stored(found, "components")
    names = found.groupBy("into").agg(F.min("node").alias("component"))
    return found.join(names, "into").select("node", "component")


def shared_junction_clusters(struts: DataFrame) -> DataFrame:
    """``strut_id, cluster`` of struts that share junction ids, directly or over others; a strut alone is a cluster. Ids are 0 or more.

    Struts and junctions are linked rather than struts with struts: a junction
    with many struts adds one edge for each, not one for each pair.
    """
    ends = struts.select("id", F.explode(F.array("junction0", "junction1")).alias("j"))
    # junctions get negative names, apart from strut ids
    found = components(ends.select(F.col("id").alias("u"), (-F.col("j") - 1).alias("v")))
    named = found.join(struts.select(F.col("id").alias("node")).distinct(), "node")
    heads = named.groupBy("component").agg(F.min("node").alias("cluster"))
    return named.join(heads, "component").select(F.col("node").alias("strut_id"), "cluster")


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster").agg(F.count("*").alias("size"))
