"""Streaming forms of the mergeable aggregates: an extension, the batch operators state the semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strutwise.operators.histogram import exact_histogram, volume_stats


def running_histogram(samples: DataFrame, name: str, checkpoint: str, value: str = "value") -> StreamingQuery:
    """Keeps ``bin, c`` over all samples so far in the memory table ``name``."""
    return exact_histogram(samples, value).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()


def running_stats(samples: DataFrame, name: str, checkpoint: str, value: str = "value") -> StreamingQuery:
    return volume_stats(samples, value).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()


def class_counts(findings: DataFrame, at: str = "ts", late: str = "10 minutes", every: str = "5 minutes") -> DataFrame:
    """``window, class, n`` in fixed windows of event time; what comes later than ``late`` is not counted."""
    return findings.withWatermark(at, late).groupBy(F.window(at, every), "class").agg(F.count("*").alias("n"))
