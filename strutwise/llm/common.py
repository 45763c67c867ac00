"""What the training-data operators share: word rules, shared folders, row order."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strutwise.sources.storage import discard, shared_folder, stored

#: Tasks over shards at most; beyond them a task takes several shards, one after another.
TASKS = 1 << 15

__all__ = ["by_shard", "discard", "keeps_columns", "new_path", "numbered", "shared_folder", "stored", "word_count"]

#: A word is a longest run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/strutwise/{name}-{uuid.uuid4().hex}"


def by_shard(rows: DataFrame, shards: int):
    """Rows grouped by their ``shard`` (0 to ``shards - 1``), a task for each: no two heavy shards meet by their hashes."""
    return rows.repartitionById(min(shards, TASKS), F.col("shard")).groupBy("shard")


#: The columns of documents, which stages look at.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage):
    """A stage of the pipeline for documents with further columns of any name, which come out as they went in."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        aside = [c if c in DOCUMENT else f"extra_{k}" for k, c in enumerate(names)]
        return stage(spark, docs.toDF(*aside), sf_dir).toDF(*names)

    return run


def word_count(text: Column) -> Column:
    """Words in a text as BIGINT; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: list[Column], out: str = "row_number") -> tuple[DataFrame, int]:
    """Rows with gapless numbers from 0 in the given order, and their count.

    Rows are range-partitioned and sorted once and written with their place in
    their partition; the partitions' counts (one row each) give the offsets.
    No window runs over all rows. Rows that tie in ``order`` are numbered in an
    order fixed when they are written.
    """
    placed = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("__place", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("__part").alias("__at"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
    )
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    # one row for each partition of the sort: the broadcast is bounded by their number
    rows = (
        placed.join(F.broadcast(offsets), part == F.col("__at"))
        .withColumn(out, F.col("__offset") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__place", "__at", "__offset")
    )
    return rows, int(total)
