"""Reproducible shuffle and sharding by a Feistel permutation of row numbers.

Row number ``r`` of ``n`` goes to position ``p = permute(r)``, a bijection on
``0..n-1``; its shard is ``p mod shards`` and its slot ``p div shards``. Shards
differ by one row at most, slots have no gaps, and both follow from ``r``, ``n``
and the seed alone, so any row can be found without a table.

Its round function is the head of an MD5 sum, which any engine can repeat. The
Feistel network runs on pairs (l, r) with ``l < a``, ``r < b`` and
``a * b`` just above ``n``; values at or above ``n`` are walked along their
cycle until they fall below it. Everything is a column expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strutwise.llm.common import numbered

ROUNDS = 6
#: Walks along a cycle. Below 10,000 rows at most ``a <= 100`` values lie outside, so ``a`` walks
#: always end; above, one walk fails with less than 1 in 100, and what is left raises an error.
WALKS = 24


def domain(n: int) -> tuple[int, int]:
    """Sides (a, b) of the smallest near-square grid with at least ``n`` cells."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by))


def _drawn(x: Column, seed: int, turn: int) -> Column:
    """A number below 2**32 that depends on a number, the seed and the round alone: the head of an MD5 sum."""
    return F.conv(F.substring(F.md5(F.concat(x.cast("string"), F.lit(f":{seed}:{turn}"))), 1, 8), 16, 10).cast("long")


def _once(x: Column, a: int, b: int, seed: int) -> Column:
    left, right = _div(x, b), x % F.lit(b)
    for k in range(ROUNDS):
        if k % 2 == 0:
            left = (left + _drawn(right, seed, k)) % F.lit(a)
        else:
            right = (right + _drawn(left, seed, k)) % F.lit(b)
    return left * F.lit(b) + right


def permuted(row: Column, n: int, seed: int = 0) -> Column:
    """Position of row number ``row`` among ``n`` rows: a permutation of 0..n-1."""
    a, b = domain(n)
    walks = a if n <= 10_000 else WALKS
    first = _once(row.cast("long"), a, b, seed)
    last = F.aggregate(
        F.sequence(F.lit(1), F.lit(walks)),
        first,
        lambda x, _: F.when(x < F.lit(n), x).otherwise(_once(x, a, b, seed)),
    )
    return F.when(last < F.lit(n), last).otherwise(F.raise_error(F.lit("a cycle walk did not end")).cast("long"))


def sharded(df: DataFrame, order: list[Column], shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``shard`` and ``slot`` by the permuted rank of each row in ``order``.

    Nulls in the order columns come first; rows that tie take neighbouring
    numbers. Repeated rows are numbered one by one. An empty table gives an
    empty result. Columns named ``shard``, ``slot`` or ``__*`` are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    rows, n = numbered(df.drop("shard", "slot"), order, "__row")
    at = rows.withColumn("__at", permuted(F.col("__row"), n, seed) if n else F.col("__row"))
    return (
        at.withColumn("shard", (F.col("__at") % F.lit(shards)).cast("int"))
        .withColumn("slot", _div(F.col("__at"), shards))
        .drop("__row", "__at")
    )


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 under the law ``rows``.

    Row numbers follow id, size and checksum; a null id comes first, a null
    text has size 1. Repeated rows are placed one by one. An empty table gives
    no rows. Other columns are not read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharded(docs, [F.col("doc_id"), F.col("size"), F.col("text_crc32")], 16, seed=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _round_sql(turn: int) -> str:
    mine, other, side = (("l", "r", "a"), ("r", "l", "b"))[turn % 2]
    return f"r{turn + 1} AS (SELECT x, a, b, {other}, ({mine} + ('0x' || md5({other}::VARCHAR || ':8:{turn}')[1:8])::BIGINT) % {side} AS {mine} FROM r{turn})"


#: The permutation of all cells by its rounds, walks along its cycles, and checksums byte by byte.
OP8_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS v, 0 AS k FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), bytes AS (
  SELECT list(v ORDER BY i) AS known FROM bits WHERE k = 8
), read AS (
  SELECT doc_id, (coalesce(strlen(text), 0) + 1)::BIGINT AS size,
    CASE WHEN coalesce(text, '') = '' THEN []::BIGINT[]
      ELSE list_transform(string_split(rtrim(regexp_replace(hex(encode(text)), '(..)', '\1 ', 'g')), ' '), lambda x: ('0x' || x)::BIGINT) END AS raw
  FROM documents
), docs AS (
  SELECT doc_id, size, xor(list_reduce(raw, lambda c, x: xor(c >> 8, known[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM read, bytes
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row, count(*) OVER () AS n FROM docs
), grid AS (
  SELECT n, floor(sqrt(n - 1))::BIGINT + 1 AS a, ceil(n / (floor(sqrt(n - 1)) + 1))::BIGINT AS b FROM (SELECT count(*) AS n FROM documents)
), r0 AS (
  SELECT x, a, b, x // b AS l, x % b AS r FROM (SELECT unnest(generate_series(0, a * b - 1)) AS x, a, b FROM grid)
), """ + ", ".join(_round_sql(k) for k in range(ROUNDS)) + f""", turned AS (
  SELECT x, l * b + r AS y FROM r{ROUNDS}
), walked AS (
  SELECT row, y, n FROM numbered JOIN turned ON x = row
  UNION ALL
  SELECT w.row, t.y, w.n FROM walked w JOIN turned t ON t.x = w.y WHERE w.y >= w.n
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (y % 16)::INT AS shard, y // 16 AS slot, NULL::INT AS grown_shard
FROM numbered JOIN walked USING (row) WHERE y < walked.n
"""
