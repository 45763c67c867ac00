"""Mixing sources to target weights by balanced (cube-method) sampling.

Each source gets a target by weight, capped at a multiple of its size with the
excess reshared (water filling). A unit of a source with ``ratio = target /
size`` is taken ``floor(ratio)`` times for sure and once more with probability
``frac(ratio)``. These extra takes are drawn by the cube method: inclusion
probabilities move along null-space directions of the two constraints (words
and documents) until all but two in a block are 0 or 1. Blocks have bounded
rows; what stays fractional of many blocks meets again in the next level, until
one block of a source is left. That block holds ten units of graded sizes back
from the flight; with the two that it leaves at most they make the landing
problem, solved over all its subsets for the least distance in words, then rows.

Draws depend on the seed, source, level, block and rows only: reruns agree.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strutwise.llm.common import keeps_columns, stored, word_count

#: Rows of a block of the flight phase.
BLOCK = 4096
#: Units of a source that the last block keeps for its landing problem, which has two more at most.
RESERVED = 10
EDGE = 1e-9
#: Rows, one for each source, that are broadcast to the units (some 6 MB); with more sources the units are shuffled by them.
SOURCES = 100_000
#: Columns that the operator makes for itself.
OWN = ("__size", "__source", "__units", "__ratio", "__base", "__pi", "__key", "__n", "__blocks", "__block")


def targets(units: DataFrame, size: str, source: str, weights=(5, 2, 1), cap: float = 3.0) -> DataFrame:
    """One row per source: ``__source, source_size, units, target``.

    Sources in code point order, null last, take the weights in turn and share
    the sum of all sizes; none gets more than ``cap`` times its size. A source
    is at its cap if ``cap * size / weight`` is at most the level that the
    sources at or above it share; these ratios are sorted, so running sums
    decide all at once. One row per source is windowed, no documents.
    """
    per = units.groupBy(F.col(source).alias("__source")).agg(
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("source_size"), F.count("*").alias("units")
    )
    by_name = Window.orderBy(F.col("__source").isNull(), F.col("__source"))
    ranked = per.withColumn(
        "__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    )
    by_ratio = Window.orderBy(F.lit(float(cap)) * F.col("source_size") / F.col("__w"), F.col("__source").isNull(), F.col("__source"))
    everything = Window.partitionBy()
    full = F.lit(float(cap)) * F.col("source_size")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum(full).over(before), F.lit(0.0))
    ) / F.sum("__w").over(onward)
    found = ranked.withColumn("__level", level).withColumn("__capped", full <= F.col("__level") * F.col("__w"))
    shared = F.max(F.when(~F.col("__capped"), F.col("__level"))).over(everything)
    return found.withColumn("target", F.when(F.col("__capped"), full).otherwise(shared * F.col("__w"))).select(
        "__source", "source_size", "units", "target"
    )


def flight(pi: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves probabilities to 0 or 1, keeping sum(pi) and sum(pi * size); at most two stay between."""
    out = pi.astype(float).copy()
    draws = rng.random(len(out) + 4)
    live: list[int] = []
    d = 0
    for i in range(len(out) + 1):
        while len(live) >= (3 if i < len(out) else 2):
            a, b = live[0], live[1]
            if len(live) >= 3:
                c = live[2]
                u = [sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b]]
                if u[0] == u[1] == u[2] == 0:
                    u = [1.0, -1.0, 0.0]
                who = (a, b, c)
            elif sizes[a] == sizes[b]:
                u, who = [1.0, -1.0], (a, b)
            else:
                break
            up = min((1 - out[k]) / x if x > 0 else out[k] / -x for k, x in zip(who, u) if x)
            down = min(out[k] / x if x > 0 else (1 - out[k]) / -x for k, x in zip(who, u) if x)
            step = up if draws[d] * (up + down) < down else -down
            d = (d + 1) % len(draws)
            for k, x in zip(who, u):
                v = out[k] + step * x
                out[k] = 0.0 if v < EDGE else 1.0 if v > 1 - EDGE else v
            left = [k for k in live if 0.0 < out[k] < 1.0]
            if len(left) == len(live):  # rounding: the nearest to an end is put there
                k = min(who, key=lambda k: min(out[k], 1 - out[k]))
                out[k] = float(round(out[k]))
                left = [x for x in live if x != k]
            live = left
        if i < len(out) and 0.0 < out[i] < 1.0:
            live.append(i)
    return out


def reserve(pi: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Up to ``RESERVED`` fractional units near halves, quarters, ... of the largest size, kept for landing."""
    live = np.flatnonzero((pi > 0) & (pi < 1))
    kept: list[int] = []
    goal = float(sizes[live].max(initial=0.0))
    while len(kept) < RESERVED and len(kept) < len(live):
        goal /= 2
        rest = np.setdiff1d(live, kept)
        kept.append(int(rest[np.argmin(np.abs(sizes[rest] - goal))]))
    return np.array(kept, dtype=np.int64)


def land(pi: np.ndarray, sizes: np.ndarray, target: float, count: float) -> np.ndarray:
    """Settles the last units: of all their subsets, the one whose words, then rows, come nearest the sums wanted."""
    out = pi.copy()
    rest = np.flatnonzero((out > 0) & (out < 1))
    if len(rest):
        picks = (np.arange(1 << len(rest))[:, None] >> np.arange(len(rest)) & 1).astype(float)
        words = np.abs(picks @ sizes[rest] - (target - sizes[out == 1].sum()))
        rows = np.abs(picks.sum(axis=1) - (count - (out == 1).sum()))
        out[rest] = picks[np.lexsort((rows, words))[0]]
    return out


def _few(per_source: DataFrame) -> DataFrame:
    """A stored row per source, marked for a broadcast if there are ``SOURCES`` at most: a source with very many units is not gathered."""
    rows = stored(per_source, "sources")
    return F.broadcast(rows) if rows.limit(SOURCES + 1).count() <= SOURCES else rows


def mixed(units: DataFrame, size: str = "size", source: str = "source", weights=(5, 2, 1), cap: float = 3.0, seed: int = 0) -> DataFrame:
    """``units`` with ``source_size``, ``target`` and ``copies`` (times to take each row).

    A null size counts as 0; a null source is a source of its own. Rows that
    are equal are separate units, drawn apart. Units of size 0 are drawn like
    others and change no sum. Empty input gives an empty result. No other
    column takes part but in the hash that orders draws; columns named
    ``source_size``, ``target``, ``copies`` or as in ``OWN`` are replaced. Keep ``units`` narrow: its columns are carried along.
    """
    units = units.drop("source_size", "target", "copies", *[c for c in OWN if c not in (size, source)]).withColumn("__size", F.coalesce(F.col(size), F.lit(0)).cast("long"))
    goal = _few(targets(units, "__size", source, weights, cap).withColumnRenamed("units", "__units"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    names = [c for c in units.columns if c != "__size"]
    joined = (
        units.join(goal, F.col(source).eqNullSafe(F.col("__source")), "left")
        .withColumn("__ratio", ratio)
        .withColumn("__base", F.floor("__ratio").cast("int"))
        .withColumn("__pi", F.col("__ratio") - F.col("__base"))
        .withColumn("__pi", F.when(F.col("__pi") < EDGE, 0.0).when(F.col("__pi") > 1 - EDGE, 1.0).otherwise(F.col("__pi")))
        .withColumn("__key", F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in names]))
        .drop("__source", "__ratio")
    )
    level, done = 0, []
    between = (F.col("__pi") > 0) & (F.col("__pi") < 1)
    left = joined.where(between)
    done.append(joined.where(~between))
    while True:
        if level:
            n = _few(left.groupBy(F.col(source).alias("__source")).agg(F.count("*").alias("__n")))
            left = left.join(n, F.col(source).eqNullSafe(F.col("__source")), "left").drop("__source")
        else:
            left = left.withColumn("__n", F.col("__units"))
        left = left.withColumn("__blocks", F.ceil(F.col("__n") / F.lit(BLOCK)).cast("long")).withColumn(
            "__block", F.pmod(F.xxhash64("__key", F.lit(level)), F.col("__blocks"))
        )
        schema = T.StructType([f for f in left.schema if f.name not in ("__n", "__blocks", "__block")])
        moved = stored(left.groupBy(F.col(source).alias("__s"), F.col("__block").alias("__b")).applyInArrow(_mover(source, seed, level), schema), "mixing")
        done.append(moved.where(~between))
        left = moved.where(between)
        level += 1
        if left.limit(1).count() == 0:
            break
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select(*[F.col(f"`{c}`") for c in names], "source_size", "target", (F.col("__base") + F.col("__pi").cast("int")).alias("copies"))


def _mover(source: str, seed: int, level: int):
    def move(table: pa.Table) -> pa.Table:
        sizes = table["__size"].to_numpy().astype(float)
        order = np.lexsort((table["__key"].to_numpy(), -sizes))
        table = table.take(pa.array(order))
        sizes, pi = sizes[order], table["__pi"].to_numpy().copy()
        name = table[source][0].as_py()
        rng = np.random.default_rng([seed, level, zlib.crc32(str(name).encode("utf-8", "surrogatepass")), int(name is None), int(table["__block"][0].as_py())])
        if table["__blocks"][0].as_py() == 1:
            words, rows = float(pi @ sizes), float(pi.sum())
            kept = reserve(pi, sizes)
            moved = np.setdiff1d(np.arange(len(pi)), kept)
            pi[moved] = flight(pi[moved], sizes[moved], rng)
            pi = land(pi, sizes, words, rows)
        else:
            pi = flight(pi, sizes, rng)
        table = table.drop_columns(["__n", "__blocks", "__block"])
        return table.set_column(table.schema.get_field_index("__pi"), "__pi", pa.array(pi))

    return move


def op3_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 5, 2, 1 to the sum of all sizes, at most 3 times each.

    A null or empty text has size 0; a null source is a source, after all
    others; repeated rows are drawn apart. An empty table gives no rows. Other
    columns are not read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", word_count(F.col("text")).alias("size"), "source")
    docs = stored(docs, "sizes")
    return mixed(docs, seed=3).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


@keeps_columns
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out as the mix takes them; the columns of ``docs``.

    Rows that are equal in id, source and text are one unit, taken together. A
    null text has no words and is drawn like others of size 0; a null source is
    a source, after all others. Columns of any other name are kept. An empty
    table gives no rows.
    """
    names = docs.columns
    keyed = docs.withColumn("__text", F.xxhash64("text"))
    units = stored(
        keyed.groupBy("doc_id", "source", "__text").agg(F.sum(word_count(F.col("text"))).cast("long").alias("__words")), "units"
    )
    copies = mixed(units, size="__words", seed=3).where("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__src"), F.col("__text").alias("__t"), "copies"
    )
    same = keyed["doc_id"].eqNullSafe(F.col("__id")) & keyed["source"].eqNullSafe(F.col("__src")) & keyed["__text"].eqNullSafe(F.col("__t"))
    return (
        keyed.join(copies, same)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*[F.col(f"`{c}`") for c in names])
    )
