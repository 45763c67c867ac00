"""N-gram Jaccard join by a MinHash LSH forest, verified exactly.

A document is the set of its five-word shingles; two documents are linked if
the Jaccard similarity of their sets is at least the threshold. Documents with
equal sets form one class, joined once.

Each class has a signature: ``trees`` sequences of ``depth`` MinHash values, the
paths of as many prefix tries. A trie is its paths in sorted order: classes that
share a prefix lie next to each other, and what neighbours have in common gives
each class, for every prefix length, the company it has there. Matching starts
at whole paths and shortens them value by value. Each round adds the classes
that meet at the shorter prefix only, as far as compact signatures say that they
may reach the threshold, and then estimates from the links found so far which
share of all links this prefix finds: a link of similarity ``s`` is found with
probability ``1 - (1 - s^d)^trees`` and stands for one over that many; one link
just at the threshold is always supposed to be missing. Rounds end when the
estimate reaches the target recall. At the latest that is where the formula
gives the target for a link at the threshold, so shorter prefixes never matter
and the paths up to there are kept as one hash.

What was found is grouped into components, whose members are then compared by
their whole sets. Pairs never become rows: buckets and components pass on stars
and counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strutwise.llm.batches import by_size
from strutwise.llm.common import by_shard, keeps_columns, stored
from strutwise.llm.components import components
from strutwise.llm.words import mixed, sequences, word_hashes

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 24, 6, 0.99999
#: Signature bytes that must agree, of 1: six standard errors below the threshold.
LEAST_AGREED = 0.6
#: Entries of a shard of bucket keys; members of one bucket and one component that are compared in one task.
SHARD, BUCKET, BLOCK = 1 << 20, 16_384, 4096
#: Bits that tell which texts are compared, at most (1 MB); more texts than bits make it useless, not wrong.
MARKS = 1 << 23
#: Shingles compared in one task.
PART_SHINGLES = 4 << 20
_TEXT_SLICE = 4 << 20


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets with the target recall; 1 at least. Matching never goes below."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(texts: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``n`` words; a shorter text is one shingle, none without words."""
    flat, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    runs = sequences(flat, n)
    return [
        np.unique(runs[e - c : e - n + 1] if c >= n else sequences(flat[e - c : e], int(c))) if c else flat[:0]
        for e, c in zip(ends.tolist(), counts.tolist())
    ]


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    return rng.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """(sets, count) MinHash values as uint32; every set holds at least one value."""
    flat = np.concatenate(sets)
    low = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), count), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(zip(*_multipliers(count))):
            out[:, k] = np.minimum.reduceat(low * a + b, starts)
    return out


def _roots(signature: np.ndarray, trees: int, depth: int, least: int) -> np.ndarray:
    """For each row and tree a hash of the tree and the first ``least`` values of its path."""
    rows = signature.reshape(len(signature), trees, depth)[:, :, :least].astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mixed(np.arange(1, trees + 1, dtype=np.uint64)), rows.shape[:2]).copy()
        for k in range(least):
            key = _longer(key, rows[:, :, k])
    return key


def _longer(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The hash of a prefix with one more value."""
    with np.errstate(over="ignore"):
        return mixed(key * np.uint64(0x9E3779B97F4A7C15) + value.astype(np.uint64))


def _coarse(signature: np.ndarray) -> np.ndarray:
    return (signature >> np.uint32(13)).astype(np.uint8)


def _describe(n: int, count: int):
    """Each text's set as (size, two sums that tell sets apart, signature)."""

    def run(batches):
        for batch in by_size(batches, "text", _TEXT_SLICE):
            sets = shingles(batch.column(2), n)
            full = [k for k, s in enumerate(sets) if len(s)]
            first, second, found = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64), [None] * len(sets)
            if full:
                with np.errstate(over="ignore"):
                    flat = np.concatenate([sets[k] for k in full])
                    starts = np.cumsum([0, *(len(sets[k]) for k in full[:-1])])
                    first[full] = np.add.reduceat(mixed(flat), starts).view(np.int64)
                    second[full] = np.add.reduceat(mixed(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts).view(np.int64)
                for a in range(0, len(full), 256):
                    signature = signatures([sets[k] for k in full[a : a + 256]], count)
                    for j, k in enumerate(full[a : a + 256]):
                        found[k] = signature[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(first), pa.array(second), pa.array(found, pa.binary())],
                names=["doc_id", "text_hash", "size", "first", "second", "signature"],
            )

    return run


def _by_shard(keys: np.ndarray, shards: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (shard, body): for each shard the columns of the entries whose keys go there, one after another."""
    shard = (keys >> np.uint64(20)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(shard[order].astype(np.int64)) != 0])
    found, bodies = [], []
    for a, z in zip(cut, np.r_[cut[1:], len(order)]):
        own = order[a:z]
        found.append(int(shard[own[0]]))
        bodies.append(b"".join(c[own].tobytes() for c in columns))
    return pa.RecordBatch.from_pydict({"shard": pa.array(found, pa.int32()), "body": pa.array(bodies, pa.binary())})


def _send_paths(shards: int, trees: int, depth: int, least: int):
    """Every path to the shard of its tree's branch: its class, the hash of its first values and the others."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                b = batch.slice(at, 8192)
                signature = np.frombuffer(b"".join(x.as_py() for x in b.column(1)), np.uint32).reshape(b.num_rows, -1)
                roots = _roots(signature, trees, depth, least).ravel()
                rest = np.ascontiguousarray(signature.reshape(-1, depth)[:, least:])
                yield _by_shard(roots, shards, [np.repeat(b.column(0).to_numpy(), trees), roots, rest])

    return run


def _tries(depth: int, least: int):
    """For each class and prefix length the prefixes at which it has more company than at longer ones, with all that share them.

    A shard's paths are sorted; a prefix of length ``d`` is a run of them.
    """

    def run(table: pa.Table) -> pa.Table:
        rows, roots, rest = [], [], []
        for x in table["body"]:
            body, m = x.as_buffer(), depth - least
            n = len(body) // (16 + 4 * m)
            rows.append(np.frombuffer(body, np.int64, n))
            roots.append(np.frombuffer(body, np.uint64, n, 8 * n))
            rest.append(np.frombuffer(body, np.uint32, n * m, 16 * n).reshape(n, m))
        rows, roots, rest = np.concatenate(rows), np.concatenate(roots), np.concatenate(rest)
        order = np.lexsort((*rest.T[::-1], roots))
        rows, roots, rest = rows[order], roots[order], rest[order]
        opens = [np.r_[True, roots[1:] != roots[:-1]]]  # at each length, where a prefix differs from the one before
        keys = [roots]
        for k in range(rest.shape[1]):
            opens.append(opens[-1] | np.r_[True, rest[1:, k] != rest[:-1, k]])
            keys.append(_longer(keys[-1], rest[:, k]))
        longer, out = np.ones(len(rows), dtype=np.int64), []
        for k in range(rest.shape[1], -1, -1):
            cut = np.flatnonzero(opens[k])
            sizes = np.diff(np.r_[cut, len(rows)])
            many = np.repeat(sizes, sizes)
            # a run that only repeats what its longest prefix found is left out whole
            new = np.repeat(np.minimum.reduceat(longer, cut) < sizes, sizes)
            own = np.flatnonzero(new)
            own = own[np.argsort(rows[own], kind="stable")]
            longer = many
            ends = np.flatnonzero(np.r_[rows[own][1:] != rows[own][:-1], True][: len(own)]) + 1
            begin = 0
            for z in ends:
                mine = own[begin:z]
                out.append((int(rows[mine[0]]), least + k, np.stack([keys[k][mine], many[mine].astype(np.uint64)]).tobytes()))
                begin = z
        return pa.table({"row": pa.array([x[0] for x in out], pa.int64()), "depth": pa.array([x[1] for x in out], pa.int32()), "shared": pa.array([x[2] for x in out], pa.binary())})

    return run


def _send_members(shards: int, bucket: int):
    """Classes with their signature bytes to the shards of their shared keys; a large bucket in pairs of its blocks."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                small = _coarse(np.frombuffer(b"".join(x.as_py() for x in b.column(1)), np.uint32).reshape(b.num_rows, -1))
                lists = [[np.frombuffer(x, np.uint64).reshape(2, -1) for x in own] for own in b.column(2).to_pylist()]
                both = np.concatenate([x for own in lists for x in own], axis=1)
                place = np.repeat(np.arange(b.num_rows), [sum(x.shape[1] for x in own) for own in lists])
                keys, many = both[0], both[1]
                rows = b.column(0).to_numpy().astype(np.int64)
                # block j of a large bucket meets each other one, and itself
                blocks = np.maximum(1, -(-many.astype(np.int64) // bucket))
                j = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                keys, place, blocks = np.repeat(keys, blocks), np.repeat(place, blocks), np.repeat(blocks, blocks)
                own = (mixed(rows.view(np.uint64))[place] % blocks.astype(np.uint64)).astype(np.int64)
                pair = np.minimum(own, j) * blocks + np.maximum(own, j)
                keys = np.where(blocks == 1, keys, _longer(keys, (pair + 1).astype(np.uint64)))
                yield _by_shard(keys, shards, [keys, rows[place], small[place]])

    return run


def _agree(one: np.ndarray, others: np.ndarray, least: float) -> np.ndarray:
    """Whether rows of signature bytes agree in enough places, chance agreement of bytes allowed for."""
    return (one == others).mean(axis=-1) >= least + (1 - least) / 256


def _stars(width: int, least: float):
    """Edges that join classes of a bucket whose signatures agree, directly or over others, with the share that agrees."""

    def run(table: pa.Table) -> pa.Table:
        keys, rows, small = [], [], []
        for x in table["body"]:
            body = x.as_buffer()
            n = len(body) // (16 + width)
            keys.append(np.frombuffer(body, np.uint64, n))
            rows.append(np.frombuffer(body, np.int64, n, 8 * n))
            small.append(np.frombuffer(body, np.uint8, n * width, 16 * n).reshape(n, width))
        keys, rows, small = np.concatenate(keys), np.concatenate(rows), np.concatenate(small)
        order = np.lexsort((rows, keys))
        keys, rows, small = keys[order], rows[order], small[order]
        cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[cut, len(keys)])
        head = np.repeat(cut, sizes)
        with_head = np.zeros(len(keys), dtype=bool)
        for a in range(0, len(keys), 1 << 16):
            with_head[a : a + (1 << 16)] = _agree(small[head[a : a + (1 << 16)]], small[a : a + (1 << 16)], least)
        with_head[cut] = True
        found = [np.stack([head, np.arange(len(rows))], axis=1)[with_head]]
        alone = np.add.reduceat((~with_head).astype(np.int64), cut)
        for g in np.flatnonzero(alone):
            members = np.arange(cut[g], cut[g] + sizes[g])
            found += _grow(small, members[with_head[members]], members[~with_head[members]], least)
        edges = np.concatenate(found)
        edges = edges[rows[edges[:, 0]] != rows[edges[:, 1]]]
        ends, one = np.unique(np.sort(rows[edges], axis=1), axis=0, return_index=True)
        edges = edges[one]
        agreed = np.empty(len(edges))
        for a in range(0, len(edges), 1 << 16):
            x = edges[a : a + (1 << 16)]
            agreed[a : a + (1 << 16)] = (small[x[:, 0]] == small[x[:, 1]]).mean(axis=1)
        return pa.table({"a": pa.array(ends[:, 0], pa.int64()), "b": pa.array(ends[:, 1], pa.int64()), "agreed": pa.array(agreed, pa.float64())})

    return run


def _grow(small, front, rest, least) -> list[np.ndarray]:
    """Single linkage of what the first member's group (``front``) left over."""
    found = []
    while len(rest):
        while len(front) and len(rest):
            near, by = np.zeros(len(rest), dtype=bool), np.zeros(len(rest), dtype=np.int64)
            step = max(1, (1 << 24) // max(1, len(rest) * small.shape[1]))
            for a in range(0, len(front), step):
                same = _agree(small[front[a : a + step], None], small[None, rest], least)
                hit = same.any(axis=0) & ~near
                by[hit] = front[a : a + step][same.argmax(axis=0)[hit]]
                near |= hit
            found.append(np.stack([by[near], rest[near]], axis=1))
            front, rest = rest[near], rest[~near]
        front, rest = rest[:1], rest[1:]
    return found


def _compare(threshold: float):
    """Exact links among the members of each group: counts by class, and stars of linked classes."""

    def run(table: pa.Table) -> pa.Table:
        group = table["part_group"].to_numpy()
        out: list[tuple[int, int, int]] = []
        order = np.argsort(group, kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0])
        rows, many, block = table["row"].to_numpy(), table["many"].to_numpy(), table["block"].to_numpy()
        pairs = table["pair"].to_numpy()
        column = table["set"].combine_chunks() if table["set"].num_chunks != 1 else table["set"].chunk(0)
        for a, z in zip(cut, np.r_[cut[1:], len(order)]):
            _, own = np.unique(rows[order[a:z]], return_index=True)
            own = order[a:z][own]
            sets = [np.frombuffer(column[int(k)].as_buffer(), np.uint64) for k in own]
            out += _links(sets, rows[own], many[own], block[own], int(pairs[own[0]]), threshold)
        return pa.table({"row": pa.array([x[0] for x in out], pa.int64()), "links": pa.array([x[1] for x in out], pa.int64()), "root": pa.array([x[2] for x in out], pa.int64())})

    return run


def _links(sets, rows, many, block, pair, threshold) -> list[tuple[int, int, int]]:
    """``pair`` below 0: all members are compared; 0: within one block is left to others; else across two blocks."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[code] > 1
    owner, code = owner[keep], code[keep]
    _, code = np.unique(code, return_inverse=True)
    width = int(code.max()) + 1 if len(code) else 0
    by_code = np.argsort(code, kind="stable")
    owner, code = owner[by_code], code[by_code]
    links, parent = np.zeros(n, dtype=np.int64), np.arange(n)

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    edges = np.searchsorted(code, np.arange(0, width + 2048, 2048))
    for a in range(0, n, 1024):
        common = np.zeros((min(1024, n - a), n), dtype=np.float32)
        for c, (x, y) in enumerate(zip(edges[:-1], edges[1:])):
            part = np.zeros((n, min(2048, width - 2048 * c)), dtype=np.float32)
            part[owner[x:y], code[x:y] - 2048 * c] = 1
            common += part[a : a + 1024] @ part.T
        union = sizes[a : a + 1024, None] + sizes[None, :] - common
        linked = common >= threshold * union - 1e-9 * union
        linked[np.arange(len(linked)), a + np.arange(len(linked))] = False
        if pair >= 0:
            other = block[a : a + 1024, None] != block[None, :]
            linked &= other if pair else ~other
        links[a : a + 1024] += linked @ many
        for i in np.flatnonzero(linked.any(axis=1)):
            mine = root(a + int(i))
            for j in np.flatnonzero(linked[i] & (parent != mine)):
                theirs = root(int(j))
                if theirs != mine:
                    parent[max(mine, theirs)] = min(mine, theirs)
                    mine = min(mine, theirs)
    return [(int(rows[k]), int(links[k]), int(rows[root(k)])) for k in range(n)]


def _sets(n: int):
    def run(batches):
        for batch in by_size(batches, "text", _TEXT_SLICE):
            found = [x.tobytes() for x in shingles(batch.column(batch.schema.get_field_index("text")), n)]
            at = batch.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays([*[c for k, c in enumerate(batch.columns) if k != at], pa.array(found, pa.binary())], names=[*[c for k, c in enumerate(batch.schema.names) if k != at], "set"])

    return run


def _blocks(total: str, most: int):
    """Blocks of a component so that two of them hold about ``most`` at most."""
    return F.when(F.col(total) > most, F.ceil(F.col(total) / F.lit(most / 2)).cast("int")).otherwise(F.lit(1))


def _recall(edges: DataFrame, d: int, threshold: float, trees: int) -> float:
    """The share of all links that prefixes of length ``d`` find, estimated from those found."""
    chance = F.lit(1 / 256)  # of two bytes to agree by accident
    alike = F.least(F.lit(1.0), (F.col("agreed") - chance) / (1 - chance))
    missed = 1 / (1 - F.pow(1 - F.pow(alike, F.lit(d)), F.lit(trees))) - 1
    links, lost = edges.where(alike >= threshold).agg(F.count("*"), F.coalesce(F.sum(missed), F.lit(0.0))).first()
    supposed = 1 / (1 - (1 - threshold**d) ** trees) - 1
    return (links + 1) / (links + 1 + lost + supposed)


def candidate_links(classes: DataFrame, total: int, threshold: float, trees: int, depth: int, recall: float, bucket: int) -> tuple[DataFrame, list[tuple[int, float]]]:
    """Links ``a, b, agreed`` between classes (``row, signature``) that may be alike, and the rounds: prefix length, estimated recall."""
    least = prefix_depth(threshold, trees, depth, recall)
    shards = max(8, -(-total * trees // SHARD))
    tries = stored(
        by_shard(classes.select("row", "signature").mapInArrow(_send_paths(shards, trees, depth, least), "shard int, body binary"), shards).applyInArrow(_tries(depth, least), "row long, depth int, shared binary"),
        "tries",
    )
    found, rounds = None, []
    for d in range(depth, least - 1, -1):
        meeting = tries.where(F.col("depth") == d).groupBy("row").agg(F.collect_list("shared").alias("shared"))
        members = classes.select("row", "signature").join(meeting, "row").select("row", "signature", "shared")
        edges = by_shard(members.mapInArrow(_send_members(shards, bucket), "shard int, body binary"), shards).applyInArrow(_stars(trees * depth, LEAST_AGREED), "a long, b long, agreed double")
        every = edges if found is None else edges.unionByName(found)
        found = stored(every.groupBy("a", "b").agg(F.max("agreed").alias("agreed")), "links")
        rounds.append((d, _recall(found, d, threshold, trees)))
        if rounds[-1][1] >= recall:
            break
    return found, rounds


def _marked(ids: DataFrame, many: int) -> Column:
    """Whether a row (``doc_id, text_hash``) may be one of ``ids`` (``__id, __hash``): a bitmap of MARKS bits at most."""
    bits = max(64, min(MARKS, 1 << (8 * max(1, many) - 1).bit_length()))
    slot = lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(bits))
    words = ids.select(slot("__id", "__hash").alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
    held = dict(words.collect())  # bits / 64 rows at most
    fixed = F.split(F.lit(",".join(str(held.get(k, 0)) for k in range(bits // 64))), ",").cast("array<bigint>")
    own = slot("doc_id", "text_hash")
    return F.getbit(F.get(fixed, F.shiftright(own, 6).cast("int")), own.bitwiseAND(F.lit(63)).cast("int")) == 1


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, threshold: float = THRESHOLD,
    trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, bucket: int = BUCKET, block: int = BLOCK,
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, class_id, class_size, n_links, first_text``.

    ``class_id`` is the least id among the documents linked to each other,
    directly or over others; ``n_links`` counts the other documents with a
    similarity of ``threshold`` or more, copies included. A text of fewer than
    ``n`` words is one shingle; texts without words (null, empty) are alike and
    form a class. Ids may be null or repeat: rows are told apart by id and
    text, a null id is the last. ``first_text`` marks the row that stands for
    its class (repeated rows all carry the mark). Other columns are ignored,
    whatever their names. An empty table gives an empty result.
    """
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    described = stored(
        plain.mapInArrow(_describe(n, trees * depth), "doc_id long, text_hash long, size long, first long, second long, signature binary"), "sets"
    )
    same = ["size", "first", "second"]
    classes = stored(
        described.groupBy(*same)
        .agg(F.count("*").alias("many"), F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash")).alias("one"), F.first("signature").alias("signature"))
        .withColumn("row", F.monotonically_increasing_id()),
        "classes",
    )
    edges, _ = candidate_links(classes.where("size > 0"), classes.count(), threshold, trees, depth, recall, bucket)
    candidates = stored(components(edges), "candidates")
    # what is compared: classes in components of two or more, each with its set, large components in pairs of blocks
    counts = candidates.join(classes.select(F.col("row").alias("node"), "size", "many", "one"), "node")
    sizes = counts.groupBy("root").agg(F.count("*").alias("members"), F.sum("size").alias("shingles"))
    wanted = stored(counts.join(sizes, "root"), "wanted")
    volume, many = wanted.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    parts = max(8, -(-int(volume) // PART_SHINGLES))
    placed = (
        wanted.withColumn("blocks", F.greatest(_blocks("members", block), _blocks("shingles", PART_SHINGLES)))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("pair", F.when(F.col("blocks") == 1, -1).when(F.col("j") == F.col("block"), 0).otherwise(1))
        .withColumn("part_group", F.when(F.col("blocks") == 1, F.col("root")).otherwise(F.xxhash64("root", F.least("j", "block"), F.greatest("j", "block"))))
        .withColumn("part", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(parts))).otherwise(F.col("part_group")))
        .select(F.col("node").alias("row"), "many", "block", "pair", "part_group", "part", F.col("one.doc_id").alias("__id"), F.col("one.text_hash").alias("__hash"))
    )
    # both sides grow with the corpus: sorted and merged at every size, never broadcast
    heads = wanted.select(F.col("one.doc_id").alias("__id"), F.col("one.text_hash").alias("__hash"))
    texts = plain.where(_marked(heads, many)).join(placed.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("text_hash").eqNullSafe(F.col("__hash"))).select("row", "many", "block", "pair", "part_group", "part", "text")
    compared = stored(
        texts.mapInArrow(_sets(n), "row long, many long, block int, pair int, part_group long, part long, set binary").groupBy("part").applyInArrow(_compare(threshold), "row long, links long, root long"),
        "compared",
    )
    roots = components(compared, "row", "root")
    links = compared.groupBy("row").agg(F.sum("links").alias("links"))
    settled = (
        classes.select("row", "many", "one", *same)
        .join(roots.withColumnRenamed("node", "row"), "row", "left")
        .join(links, "row", "left")
        .withColumn("root", F.coalesce("root", "row"))
    )
    heads = settled.groupBy("root").agg(F.min("one").alias("head"), F.sum("many").alias("class_size"))
    settled = settled.join(heads, "root").select(*same, "head", "class_size", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    return described.drop("signature").join(settled, same).select(
        "doc_id", "text_hash", F.col("head.doc_id").alias("class_id"), "class_size", "n_links",
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & F.col("text_hash").eqNullSafe(F.col("head.text_hash"))).alias("first_text"),
    )


def op5_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class and its number of links."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "class_id", "class_size", "n_links")


@keeps_columns
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class; the columns of ``docs``, whatever others there are.

    A null id is the last; of rows with that id and text one stays. Documents
    without words are one class. An empty table gives an empty result.
    """
    names = docs.columns
    found = near_duplicates(docs).where("first_text")
    heads = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).groupBy("__id", "__hash").agg(F.count("*").alias("__n"))
    heads = stored(heads, "heads")
    marked = docs.withColumn("__text", F.xxhash64("text"))
    left = marked.join(heads, marked["doc_id"].eqNullSafe(F.col("__id")) & marked["__text"].eqNullSafe(F.col("__hash")))
    if heads.where("__n > 1").limit(1).count():
        left = left.dropDuplicates(["__id", "__hash"])
    return left.select(*[F.col(f"`{c}`") for c in names])


#: All pairs that share a shingle; the classes by a recursion over labels.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS many FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 10 * common >= 8 * (x.many + y.many - common)
  UNION ALL
  SELECT x.doc_id, y.doc_id FROM w x JOIN w y ON x.doc_id <> y.doc_id WHERE len(x.ws) = 0 AND len(y.ws) = 0
), reached AS (
  SELECT doc_id, doc_id AS label FROM w
  UNION
  SELECT b, label FROM reached JOIN links ON a = reached.doc_id WHERE label < b
), classes AS (
  SELECT doc_id, min(label) AS class_id FROM reached GROUP BY doc_id
)
SELECT doc_id, class_id, (count(*) OVER (PARTITION BY class_id))::BIGINT AS class_size,
  (SELECT count(*) FROM links WHERE a = classes.doc_id)::BIGINT AS n_links
FROM classes
"""
