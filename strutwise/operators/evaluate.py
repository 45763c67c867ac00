"""Detection metrics against sealed labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The 97.5 % point of the normal distribution.
Z = 1.959963984540054


def wilson(k: Column, n: Column, z: float = Z) -> tuple[Column, Column]:
    """Wilson interval of a share, within 0 and 1; null where n is 0."""
    kk, nn = k.cast("double"), F.nullif(n.cast("double"), F.lit(0.0))
    p, zz = kk / nn, z * z
    mid, half = p + zz / (2 * nn), z * F.sqrt(p * (1 - p) / nn + zz / (4 * nn * nn))
    low, high = (mid - half) / (1 + zz / nn), (mid + half) / (1 + zz / nn)
    return F.greatest(F.lit(0.0), low), F.least(F.lit(1.0), high)


def confusion(pairs: DataFrame, classes: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """``actual, predicted, n`` for every pair of classes, zeros included."""
    kinds = F.explode(F.array(*[F.lit(c) for c in classes]))
    spark = pairs.sparkSession
    every = spark.range(1).select(kinds.alias("actual")).withColumn("predicted", kinds)
    counted = pairs.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    return every.join(counted, (F.col("actual") == F.col("a")) & (F.col("predicted") == F.col("p")), "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def detection(sealed: DataFrame, predicted: DataFrame, key: str = "strut_id") -> DataFrame:
    """Recall over all sealed ids: strict (predicted missing) and lenient (missing or broken), with Wilson bounds.

    A sealed id without a prediction is counted in ``unpredicted``; no
    precision is reported, since unsealed ids are not known to be sound.
    """
    joined = sealed.select(key).distinct().join(predicted.select(key, "class"), key, "left")
    sums = joined.agg(
        F.count("*").alias("sealed"), F.count_if(F.col("class") == "missing").alias("strict_hits"),
        F.count_if(F.col("class").isin("missing", "broken")).alias("lenient_hits"), F.count_if(F.col("class").isNull()).alias("unpredicted"),
    )
    out = sums
    for kind in ("strict", "lenient"):
        low, high = wilson(F.col(f"{kind}_hits"), F.col("sealed"))
        out = out.withColumn(f"{kind}_recall", F.col(f"{kind}_hits") / F.nullif(F.col("sealed").cast("double"), F.lit(0.0))).withColumn(f"{kind}_low", low).withColumn(f"{kind}_high", high)
    return out


def label_layouts(documents: DataFrame) -> DataFrame:
    """``strut_id, class`` from any of four layouts: three lists of ids (class missing) or ``labels``.

    ``documents`` has the columns of the layouts that occur, null where absent.
    """
    lists = [F.col(c) for c in ("strut_ids", "missing_strut_ids", "sealed_strut_ids") if c in documents.columns]
    parts = []
    if lists:
        parts.append(documents.select(F.explode(F.coalesce(*lists)).alias("strut_id"), F.lit("missing").alias("class")))
    if "labels" in documents.columns:
        parts.append(documents.select(F.explode("labels").alias("x")).select(F.col("x.strut_id").alias("strut_id"), F.coalesce("x.class", F.lit("missing")).alias("class")))
    if not parts:
        raise ValueError("no label layout among the columns")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
