"""Token ids in files: canonical length-limited Huffman codes in independent blocks.

A written folder holds ``codebook`` (one row: the code length of each id, from
counts over the whole corpus) and ``blocks``. A block is one row: the documents
in it, the number of ids before it, and a payload of

    b"HUF1", ids (uint32), spacing (uint32), checkpoints (uint32 bit offsets of
    every ``spacing``-th id), bits

all little-endian, bits most significant first. Codes have at most 16 bits, so
a table of 65,536 entries decodes each id with one look; all stretches between
checkpoints of a block are decoded side by side. No document crosses a block.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strutwise.llm.batches import by_size
from strutwise.llm.common import new_path

MOST_BITS = 16
#: Ids after which a block is closed at the end of a document.
BLOCK_IDS = 1 << 18
SPACING = 256
MAGIC = b"HUF1"


# --- codes -------------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits (package-merge); 0 for ids that never occur."""
    used = np.flatnonzero(counts > 0)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} ids don't fit codes of {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    row, leaf_rows = leaves, [np.ones(len(leaves), dtype=bool)]
    for _ in range(most - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        row = both[by]
        leaf_rows.append(by < len(leaves))
    lengths, take = np.zeros(len(leaves), dtype=np.int64), 2 * len(leaves) - 2
    for is_leaf in reversed(leaf_rows):
        n = int(is_leaf[:take].sum())
        lengths[:n] += 1
        take = 2 * (min(take, len(is_leaf)) - n)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes by length, then id, and their decoding table."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        sizes = np.int64(1) << (MOST_BITS - self.lengths[order])
        ends = np.cumsum(sizes)
        if len(ends) and ends[-1] > 1 << MOST_BITS:
            raise ValueError("code lengths overflow")
        self.codes = np.zeros(len(lengths), dtype=np.int64)
        self.codes[order] = (ends - sizes) >> (MOST_BITS - self.lengths[order])
        self.symbols = np.zeros(1 << MOST_BITS, dtype=np.uint32)
        self.steps = np.zeros(1 << MOST_BITS, dtype=np.int64)
        if len(order):
            self.symbols[: ends[-1]] = np.repeat(order, sizes)
            self.steps[: ends[-1]] = np.repeat(self.lengths[order], sizes)

    def encode(self, ids: np.ndarray, spacing: int = SPACING) -> bytes:
        lens = self.lengths[ids]
        if len(ids) and not lens.all():
            raise ValueError("an id has no code")
        ends = np.cumsum(lens)
        starts = ends - lens
        total = int(ends[-1]) if len(ids) else 0
        at, shifted = starts >> 4, self.codes[ids] << (32 - lens - (starts & 15))
        words = np.bincount(at, weights=shifted >> 16, minlength=total // 16 + 2)
        words += np.bincount(at + 1, weights=shifted & 0xFFFF, minlength=total // 16 + 2)
        bits = words.astype(">u2").tobytes()[: (total + 7) // 8]
        head = np.array([len(ids), spacing], dtype="<u4").tobytes()
        return MAGIC + head + starts[::spacing].astype("<u4").tobytes() + bits

    def decode(self, payload: bytes) -> np.ndarray:
        if payload[:4] != MAGIC:
            raise ValueError("not a block of ids")
        n, spacing = (int(x) for x in np.frombuffer(payload, "<u4", 2, 4))
        lanes = -(-n // spacing)
        if not n:
            return np.zeros(0, dtype=np.uint32)
        at = np.frombuffer(payload, "<u4", lanes, 12).astype(np.int64)
        raw = np.frombuffer(payload, np.uint8, -1, 12 + 4 * lanes)
        raw = np.concatenate([raw, np.zeros(2 * spacing + 4, dtype=np.uint8)]).astype(np.uint32)
        wide = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
        out = np.empty((spacing, lanes), dtype=np.uint32)
        for k in range(spacing):
            seen = wide[at >> 3] >> (8 - (at & 7)).astype(np.uint32) & 0xFFFF
            out[k] = self.symbols[seen]
            at += self.steps[seen]
        return out.T.ravel()[:n]


# --- tokenizer ---------------------------------------------------------------


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def same_order(spec: dict) -> bool:
    """Whether merging by the least id of the result is merging by the order of the file's list, for byte-level BPE."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if model.get("type") != "BPE" or not plain or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec.get("normalizer"):
        return False
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    ids = [model["vocab"].get(a + b, -1) for a, b in pairs]
    single = max((i for token, i in model["vocab"].items() if len(token) == 1), default=-1)
    return bool(ids) and ids[0] > single and all(a < b for a, b in zip(ids, ids[1:]))


class ByteTokens:
    """Ids as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them.

    Ordinary text goes through a faster engine that is built from the same
    file's vocabulary; texts that hold a special token's string go to the
    library itself. The engine merges the pair whose joined token has the least
    id, the library the pair that comes first in its list of merges. They are
    the same where the ids of the merges' results rise along the list, which is
    looked up in the file (``same_order``). Any other file, or a machine
    without the engine, uses the library alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.fast = self._fast(spec)

    def _fast(self, spec: dict):
        try:
            import public_tokenizers
            import tiktoken
        except ImportError:
            return None
        if not same_order(spec):
            return None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        engine = tiktoken.Encoding("from-file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: engine.encode_to_numpy(text, disallowed_special=())

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return self._library(text)
        return self.fast(text)


@lru_cache(maxsize=2)
def tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


# --- writing and reading -----------------------------------------------------

_PACKED = "part int, block int, first long, ids_in long, doc_ids array<bigint>, counts array<bigint>, ids binary"


def _packer(path: str, end: int, block_ids: int):
    def pack(batches):
        encode, schema = tokens(path), None
        wide = np.uint16 if encode.size <= 1 << 16 else np.uint32
        held, docs, counts, n, first, block, part = [], [], [], 0, 0, 0, None
        stop = np.array([end], dtype=wide)

        def row():
            return pa.RecordBatch.from_pydict(
                {"part": [part], "block": [block], "first": [first], "ids_in": [n], "doc_ids": [docs], "counts": [counts], "ids": [np.concatenate(held).tobytes()]},
                schema=schema,
            )

        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("ids_in", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("ids", pa.binary())])
        for batch in by_size(batches, "__text"):
            part = batch.column(batch.schema.get_field_index("__part"))[0].as_py()
            keys = batch.column(batch.schema.get_field_index("__id")).to_pylist()
            for key, text in zip(keys, batch.column(batch.schema.get_field_index("__text")).to_pylist()):
                found = encode(text or "").astype(wide)
                held += [found, stop]
                docs.append(key)
                counts.append(len(found) + 1)
                n += len(found) + 1
                if n >= block_ids:
                    yield row()
                    first, block, held, docs, counts, n = first + n, block + 1, [], [], [], 0
        if n:
            yield row()

    return pack


def write_ids(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of every text, ``end`` appended to each, in ascending order of ``doc_id``.

    A null text counts as empty, a null id comes first, rows with equal ids
    follow each other in the order of their texts. An empty table gives an
    empty folder that can be read. Texts are dealt out by ranges of ids and
    sorted once; the packed ids are kept in the shared folder between counting
    and coding, so each text is tokenized once.
    """
    tokenizer = tokenizer or tokenizer_path()
    vocabulary = tokens(tokenizer).size
    narrow = df.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text"))
    in_order = narrow.repartitionByRange("__id").sortWithinPartitions("__id", "__text").withColumn("__part", F.spark_partition_id())
    spark = df.sparkSession
    kept = new_path(spark, "packed")
    in_order.mapInArrow(_packer(tokenizer, end, block_ids), _PACKED).write.option("compression", "zstd").parquet(kept)
    packed = spark.read.schema(_PACKED).parquet(kept)
    wide = np.uint16 if vocabulary <= 1 << 16 else np.uint32

    def count(batches):
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), wide), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    counts = np.zeros(vocabulary, dtype=np.int64)
    # one row for each id of the vocabulary at most
    for row in packed.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()), end)], "lengths binary, end int").coalesce(1).write.parquet(f"{path}/codebook")
    parts = packed.groupBy("part").agg(F.sum("ids_in").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("part").alias("__p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    # one row for each partition of the sort
    placed = packed.join(F.broadcast(offsets), F.col("part") == F.col("__p")).select(
        "part", "block", (F.col("first") + F.col("__offset")).alias("start"), "doc_ids", "counts", "ids"
    )

    def code(batches):
        book = Codebook(lengths)
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                payload = book.encode(np.frombuffer(one.column(5)[0].as_buffer(), wide))
                yield pa.RecordBatch.from_arrays([*one.columns[:5], pa.array([payload], pa.binary())], names=[*one.schema.names[:5], "payload"])

    placed.mapInArrow(code, "part int, block int, start long, doc_ids array<bigint>, counts array<bigint>, payload binary").write.option(
        "compression", "uncompressed"
    ).parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: ``doc_id, start, n_tokens, ids`` (little-endian uint32); blocks are read apart."""
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/codebook").first().lengths), dtype=np.uint8)
    blocks = spark.read.schema("start long, doc_ids array<bigint>, counts array<bigint>, payload binary").parquet(f"{path}/blocks")

    def decode(batches):
        book = Codebook(lengths)
        for batch in batches:
            for k in range(batch.num_rows):
                ids = book.decode(batch.column(3)[k].as_py()).astype("<u4")
                counts = batch.column(2)[k].values.to_numpy().astype(np.int64)
                ends = np.cumsum(counts)
                offsets = np.r_[0, ends] * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1)[k].values,
                        pa.array(batch.column(0)[k].as_py() + ends - counts),
                        pa.array(counts),
                        pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)]),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def op4_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as coded ids and read back from the files."""
    path = new_path(spark, "ids")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
