"""Places in a global order without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strutwise.sources.storage import stored


def numbered(rows: DataFrame, order: list[Column | str], out: str = "place") -> tuple[DataFrame, int]:
    """Rows with gapless places from 0 in the given order, and how many there are.

    One range sort writes each row with its place in its partition; the counts
    of the partitions, a row each, move the places on.
    """
    at = "__sorted"
    written = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(at), 33)
    sizes = written.groupBy(part.alias("__part")).agg(F.count("*").alias("__size"))
    onward = Window.orderBy("__part")
    skips = sizes.select(F.col("__part"), (F.sum("__size").over(onward) - F.col("__size")).alias("__skip"))
    total = sizes.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
    inside = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return written.join(F.broadcast(skips), part == F.col("__part")).withColumn(out, F.col("__skip") + inside).drop(at, "__part", "__skip"), int(total)
