"""A SparkSession with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, name: str = "strutwise", partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew splitting; shuffle partitions only where the caller fixes them."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
