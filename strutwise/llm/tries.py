"""A prefix trie over conversations, without walking it level by level.

Turns are range-sorted by conversation and scanned once: a polynomial rolling
fingerprint of every prefix is a running sum over the turns' symbols, so a
conversation may lie in many partitions (sums are moved on by what stands in
front, two rows for each partition at most). Prefixes of equal depth and
fingerprint are candidates for one node. What they hold is combined first (equal
last turn, equal parent), then every kind is held against that of the group's
representative, its smallest conversation, role and text in full. Kinds that
differ are collisions and become nodes of their own, until nothing differs:
equal parents and equal last turns then make equal prefixes, by induction.

Sums over subtrees need no rounds either. The nodes whose smallest member is
one conversation form a chain down that conversation, so a node's subtree is the
rest of its own chain and, for each other member whose chain begins further
down, all of that chain: one sum along each conversation and one grouped sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strutwise.llm.common import stored
from strutwise.llm.words import mixed

#: Stands for a conversation without an id: after all others.
LAST = (1 << 63) - 1
#: Bits of a turn's symbol; turns along a conversation that are summed as one block.
SYMBOL_BITS, BLOCK = 64, 4096
#: Ids that are joined to one piece before a node's list of ends is hashed.
PIECE = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_KEY = ["depth", "print", "variant"]
_SCAN = "c long, role string, text string, part int, pos long, before long, print long"


class Trie(NamedTuple):
    """``nodes``: depth, print, variant (together a node's key), conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens; ``ends``: depth, print, variant, c of the node at which each conversation ends (no id: ``LAST``)."""

    nodes: DataFrame
    ends: DataFrame


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and prefix fingerprints of sorted turns, counted from the conversation's first turn in this partition."""
    part, last, done, carried = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        c = batch.column(0).to_numpy(zero_copy_only=False)
        symbol = mixed(batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64) + np.uint64(_BASE))
        opens = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        pos = np.arange(n) - np.repeat(opens, np.diff(np.r_[opens, n]))
        powers = np.full(int(pos.max()) + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        with np.errstate(over="ignore"):
            terms = symbol * np.cumprod(powers)[pos]
            sums = np.cumsum(terms)
            prints = sums - np.repeat(np.r_[np.uint64(0), sums][opens], np.diff(np.r_[opens, n]))
            before = prints - terms
            if last == c[0]:
                z = int(opens[1]) if len(opens) > 1 else n
                factor, front = np.uint64(pow(_BASE, done, 1 << 64)), np.uint64(carried)
                prints[:z], before[:z] = prints[:z] * factor + front, before[:z] * factor + front
                pos[:z] += done
        last, done, carried = c[-1], int(pos[-1]) + 1, int(prints[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.full(n, part, dtype=np.int32)), pa.array(pos), pa.array(before.view(np.int64)), pa.array(prints.view(np.int64))],
            names=["c", "role", "text", "part", "pos", "before", "print"],
        )


def scanned(turns: DataFrame, symbol_bits: int = SYMBOL_BITS) -> DataFrame:
    """``c, role, text, pos, before, print`` of all turns: the place in the conversation, and fingerprints of what ends before and with each turn.

    Turns go by number (null first); ties by role, the first 64 code points of
    the text, then a hash of it. Null role and text count as empty.
    """
    symbol = F.xxhash64("role", "text")
    rows = turns.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(LAST)).alias("c"), "turn", *[F.coalesce(x, F.lit("")).alias(x) for x in ("role", "text")])
    rows = rows.withColumn("symbol", symbol if symbol_bits >= 64 else symbol.bitwiseAND(F.lit((1 << symbol_bits) - 1)))
    rows = rows.withColumn("start", F.left("text", F.lit(64))).withColumn("like", F.xxhash64("text"))
    order = ["c", F.col("turn").asc_nulls_first(), "role", "start", "like"]
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("c", "role", "text", "symbol").mapInArrow(_scanned, _SCAN), "turn-scan")
    # conversations in several partitions: two rows for each partition of the sort at most
    along = Window.partitionBy("c")
    runs = placed.groupBy("c", "part").agg(F.count("*").alias("n"), F.max_by("print", "pos").alias("print"))
    runs = runs.withColumn("parts", F.count("*").over(along)).where("parts > 1").orderBy("c", "part").collect()
    moved, last, skip, front = {}, None, 0, 0
    for r in runs:
        if r.c != last:
            last, skip, front = r.c, 0, 0
        moved[r.c, r.part] = (skip, front)
        front = (front + pow(_BASE, skip, 1 << 64) * (r.print & _MASK)) & _MASK
        skip += r.n
    return placed.mapInArrow(_moved(moved), "c long, role string, text string, pos long, before long, print long") if moved else placed.drop("part")


def _moved(offsets: dict):
    """Adds what partitions before this one hold of a conversation."""
    own = {k: (skip, front, pow(_BASE, skip, 1 << 64)) for k, (skip, front) in offsets.items()}
    convs = np.array(sorted({c for c, _ in own}), dtype=np.int64)

    def run(batches):
        for batch in batches:
            c, part = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 3))
            pos, before, prints = (batch.column(k).to_numpy(zero_copy_only=False).copy() for k in (4, 5, 6))
            rows = np.flatnonzero(np.isin(c, convs))
            with np.errstate(over="ignore"):
                for key in set(zip(c[rows].tolist(), part[rows].tolist())):
                    skip, front, factor = own[key]
                    at = rows[(c[rows] == key[0]) & (part[rows] == key[1])]
                    pos[at] += skip
                    for x in (before, prints):
                        x[at] = (x[at].view(np.uint64) * np.uint64(factor) + np.uint64(front)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(pos), pa.array(before), pa.array(prints)], names=["c", "role", "text", "pos", "before", "print"])

    return run


def _verified(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the variant of their node, and the nodes: candidates are split until every group is one prefix.

    ``rows``: ``c, depth, print, before, role, text``, a root row of depth 0 for each conversation.
    """
    rows = stored(rows.select("*", F.lit(0).alias("variant"), F.lit(0).alias("above")), "prefixes")
    kind = ["before", "above", "role", "text"]
    while True:
        kinds = stored(rows.groupBy(*_KEY, *kind).agg(F.min("c").alias("c"), F.count("*").alias("n_convs")), "prefix-kinds")
        mixed_up = kinds.groupBy(*_KEY).agg(F.count("*").alias("kinds"), F.min_by(F.struct(*kind), "c").alias("first")).where("kinds > 1")
        other = kinds.join(mixed_up, _KEY).where(F.struct(*kind) != F.col("first")).select(*_KEY, *kind)
        if other.isEmpty():
            return rows, kinds
        # how often each prefix moves on is small: the rows of collisions only
        moves = stored(rows.join(other, [*_KEY, *kind]).select("c", "depth", (F.col("variant") + 1).alias("to")), "collisions")
        down = moves.select("c", (F.col("depth") + 1).alias("depth"), F.col("to").alias("to_above"))
        rows = stored(
            rows.join(moves, ["c", "depth"], "left").join(down, ["c", "depth"], "left")
            .withColumns({"variant": F.coalesce("to", "variant"), "above": F.coalesce("to_above", "above")}).drop("to", "to_above"),
            "prefixes",
        )


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, symbol_bits: int = SYMBOL_BITS, block: int = BLOCK) -> Trie:
    """The trie of all prefixes of conversations ``turns`` (``conv_id, turn, role, text``), and where each conversation ends.

    ``conversations`` (``conv_id``) names those that may have no turns. A node
    is a distinct sequence of (role, text) from a conversation's beginning; the
    root has depth 0. ``conv_id`` is its smallest member, ``n_leaves`` and
    ``saved_tokens`` are sums over its subtree, the latter of (n_convs - 1)
    times the code points of the last text. Null roles and texts count as empty;
    turns without a number come first, ties go by role and text; repeated rows
    are turns of their own; turns without a conversation are one conversation,
    after all others. Further columns are ignored, whatever their names. Without
    any conversation there is no node, not even a root.
    """
    scan = scanned(turns, symbol_bits)
    ids = turns.select("conv_id") if conversations is None else conversations.select("conv_id").unionByName(turns.select("conv_id"))
    roots = ids.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(LAST)).alias("c")).distinct()
    nothing = {"depth": F.lit(0).cast("long"), "print": F.lit(0).cast("long"), "before": F.lit(0).cast("long"), "role": F.lit(""), "text": F.lit("")}
    rows, kinds = _verified(scan.select("c", (F.col("pos") + 1).alias("depth"), "print", "before", "role", "text").unionByName(roots.withColumns(nothing)))
    short = rows.select("c", *_KEY)

    up = [(F.col("depth") - 1).alias("depth"), F.col("before").alias("print"), F.col("above").alias("variant")]
    children = kinds.where("depth > 0").select(*up).groupBy(*_KEY).agg(F.count("*").alias("n_children"))
    nodes = stored(
        kinds.select(*_KEY, "before", "above", "c", "n_convs", ((F.col("n_convs") - 1) * F.char_length("text")).alias("own"))
        .join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
        "nodes",
    )
    # sums down each chain, in blocks of its turns
    weighed = nodes.select(*_KEY, "c", F.expr("cast(n_children = 0 as bigint)").alias("leaves"), "own").withColumn("block", F.floor(F.col("depth") / block))
    sums = {"leaves": "l", "own": "s"}
    below = Window.partitionBy("c", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("c").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = weighed.groupBy("c", "block").agg(*[F.sum(a).alias(b) for a, b in sums.items()])
    after = blocks.select("c", "block", *[F.coalesce(F.sum(b).over(later), F.lit(0)).alias(b) for b in sums.values()])
    chain = weighed.withColumns({a: F.sum(a).over(below) for a in sums}).join(after, ["c", "block"]).select(*_KEY, F.expr("leaves + l").alias("leaves"), F.expr("own + s").alias("own"))
    # chains of other members hang below the nodes above their tops
    tops = nodes.groupBy("c").agg(F.min("depth").alias("top"))
    whole = tops.join(blocks.groupBy("c").agg(*[F.sum(b).alias(b) for b in sums.values()]), "c")
    hung = short.join(whole, "c").where("depth < top").groupBy(*_KEY).agg(*[F.sum(b).alias(b) for b in sums.values()])
    parents = nodes.select(F.col("depth").alias("d"), F.col("print").alias("p"), F.col("variant").alias("v"), F.col("c").alias("parent"))
    shown = lambda x: F.nullif(F.col(x), F.lit(LAST))
    out = (
        nodes.drop("own").join(chain, _KEY).join(hung, _KEY, "left")
        .join(parents, (F.col("depth") - 1 == F.col("d")) & (F.col("before") == F.col("p")) & (F.col("above") == F.col("v")), "left")
        .select(
            *_KEY, shown("c").alias("conv_id"), shown("parent").alias("parent_conv_id"), "n_convs", "n_children",
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("own") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        )
    )
    ends = short.groupBy("c").agg(F.max("depth").alias("depth"), F.max_by("print", "depth").alias("print"), F.max_by("variant", "depth").alias("variant"))
    return Trie(out, ends.select(*_KEY, "c"))


_PIECES = "depth long, print long, variant int, part int, at long, piece string"


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of sorted ids, joined by commas; a piece is of one node."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)])
        c = batch.column(3).to_pylist()
        opens = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if len(c) else []
        for a, b in zip(opens, np.r_[opens[1:], len(c)]):
            for x in range(int(a), int(b), PIECE):
                piece = ",".join("" if i == LAST else str(i) for i in c[x : min(x + PIECE, int(b))])
                yield pa.RecordBatch.from_pylist(
                    [{"depth": int(keys[0, a]), "print": int(keys[1, a]), "variant": int(keys[2, a]), "part": part, "at": at, "piece": piece}],
                    schema=pa.schema([("depth", pa.int64()), ("print", pa.int64()), ("variant", pa.int32()), ("part", pa.int32()), ("at", pa.int64()), ("piece", pa.string())]),
                )
                at += 1


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node in turn; only one is under way at a time."""
    schema = pa.schema([("depth", pa.int64()), ("print", pa.int64()), ("variant", pa.int32()), ("ends_sha256", pa.string())])
    key, digest = None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            own = (row["depth"], row["print"], row["variant"])
            if own != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(row["piece"].encode())
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in done], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, digest.hexdigest())))], schema=schema)


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth, print, variant, ends_sha256``: the hash of each node's ids, ascending and joined by commas; one without an id comes last, as an empty text.

    A hash runs over all of a node's ids in turn, so what one task reads of a
    busy node are pieces of 65,536 ids; none is held beyond its turn.
    """
    pieces = ends.repartitionByRange(*_KEY, "c").sortWithinPartitions(*_KEY, "c").mapInArrow(_joined, _PIECES)
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "part", "at").mapInArrow(_hashed, "depth long, print long, variant int, ends_sha256 string")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt on the first turns of its hundred's first.

    Nulls, ties, repeated rows and empty tables are as :func:`prefix_trie` says;
    a conversation without an id keeps its own turns.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    scan = scanned(turns).select("c", "pos", "role", "text")
    h = F.when(F.col("c") == LAST, F.lit(0)).otherwise(F.crc32(F.col("c").cast("string").cast("binary")) % 6)
    convs = turns.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(LAST)).alias("c")).distinct().withColumn("h", h)
    # a conversation's first turns go to the 200 conversations of its hundred at most
    fronts = convs.withColumn("base", F.col("c") - F.col("c") % 100).join(scan.where("pos < 5").withColumnRenamed("c", "base"), "base").where("pos < h")
    rest = scan.withColumn("h", h).where("pos >= h")
    rebuilt = fronts.select("c", "pos", "role", "text").unionByName(rest.select("c", "pos", "role", "text"))
    named = lambda rows: rows.withColumn("conv_id", F.nullif(F.col("c"), F.lit(LAST)))
    trie = prefix_trie(named(rebuilt).withColumnRenamed("pos", "turn"), named(convs))
    return trie.nodes.join(end_digests(trie.ends), _KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    )


#: All prefixes as lists of turns; CRC-32 of an id bit by bit.
OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), o AS (
  SELECT conv_id, list({'s': length(role) || ':' || role || text, 'n': length(text)} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, xor(4294967295::BIGINT, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))) % 6 AS h
  FROM o
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns FROM h c LEFT JOIN h b ON b.conv_id = c.conv_id - c.conv_id % 100
), p AS (
  SELECT conv_id, d, turns[1:d] AS k FROM (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS d FROM r)
), n AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY ALL
), f AS (
  SELECT a.d, a.k, count(*) AS n_children FROM n a JOIN n b ON b.d = a.d + 1 AND b.k[1:a.d] = a.k GROUP BY ALL
), w AS (
  SELECT d, k, conv_id, n_convs, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * k[d].n END AS saved FROM n LEFT JOIN f USING (d, k)
), s AS (
  SELECT a AS d, k[1:a] AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(generate_series(0, d)) AS a FROM w) GROUP BY ALL
), e AS (
  SELECT len(turns) AS d, turns AS k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM r GROUP BY ALL
)
SELECT w.conv_id, w.d::BIGINT AS depth, up.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM w JOIN s USING (d, k) LEFT JOIN e USING (d, k) LEFT JOIN n up ON up.d = w.d - 1 AND up.k = w.k[1:w.d - 1]
"""
