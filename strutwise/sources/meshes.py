"""STL meshes as triangle tables: binary ones by ranges of their records, text ones facet by facet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strutwise.sources.volumes import TASKS, _files, _reader

TRIANGLE = np.dtype([("normal", "<f4", 3), ("corners", "<f4", (3, 3)), ("attribute", "<u2")])
#: Triangles of one range.
RANGE = 1 << 18
_SCHEMA = "path string, face long, " + ", ".join(f"{c}{k} float" for k in range(3) for c in "xyz")
_NAMES = [f"{c}{k}" for k in range(3) for c in "xyz"]
_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"


def counted(size: int, head: bytes) -> int:
    """How many triangles a binary STL of ``size`` bytes has: an 80-byte header, a count, 50 bytes each; sizes must agree."""
    if len(head) < 84:
        raise ValueError("too short for a binary STL")
    n = int(np.frombuffer(head, "<u4", 1, 80)[0])
    if size != 84 + 50 * n:
        raise ValueError(f"{n} triangles need {84 + 50 * n} bytes, there are {size}")
    return n


def decode(content: bytes) -> np.ndarray:
    """All triangles of a binary STL."""
    return np.frombuffer(content, TRIANGLE, counted(len(content), content[:84]), 84)


def read_stl(spark: SparkSession, path: str, triangles: int = RANGE) -> DataFrame:
    """``path, face, x0, y0, z0, ..., z2`` (single precision) of each triangle of binary meshes (a file, folder or glob).

    A file's head says how many triangles there are; each task then reads the
    bytes of its own range.
    """

    def plan(frames):
        for f in frames:
            out = []
            for p, content in zip(f["path"], f["content"]):
                with _reader(p, content) as file:
                    head = file.read(84)
                    file.seek(0, 2)
                    n = counted(file.tell(), head)
                out += [(p, a, min(triangles, n - a), content) for a in range(0, n, triangles)]
            yield pd.DataFrame(out, columns=["path", "first", "many", "content"])

    def read(frames):
        for f in frames:
            for r in f.itertuples(index=False):
                with _reader(r.path, r.content) as file:
                    file.seek(84 + 50 * r.first)
                    corners = np.frombuffer(file.read(50 * r.many), TRIANGLE)["corners"].reshape(-1, 9)
                out = pd.DataFrame(corners.astype(np.float32), columns=_NAMES)
                out.insert(0, "face", np.arange(r.first, r.first + r.many))
                out.insert(0, "path", r.path)
                yield out

    ranges = _files(spark, path).mapInPandas(plan, "path string, first long, many long, content binary")
    tasks = min(TASKS, max(1, ranges.select("first").count()))
    return ranges.repartition(tasks, "path", "first").mapInPandas(read, _SCHEMA)


def read_text_stl(spark: SparkSession, path: str) -> DataFrame:
    """``path, x0, y0, z0, ..., z2`` (single precision) of each facet of text meshes.

    A facet is a record that ends with ``endfacet``, so Spark splits a large
    file itself. Facets come in no order. A facet without exactly three
    vertices of three numbers is an error.
    """
    facets = spark.read.option("lineSep", "endfacet").text(path).withColumn("path", F.input_file_name())
    facets = facets.where(F.regexp_like("value", F.lit(r"(?i)\bfacet\s")))
    corner = rf"(?i)vertex\s+({_NUMBER})\s+({_NUMBER})\s+({_NUMBER})(?=\s)"
    vertices = F.expr("size(regexp_extract_all(value, '(?i)vertex', 0))")
    found = facets.select("path", "value", vertices.alias("many"), *[F.regexp_extract_all("value", F.lit(corner), F.lit(k + 1)).alias(c) for k, c in enumerate("xyz")])
    whole = (F.col("many") == 3) & (F.size("x") == 3)
    number = lambda c, k: F.when(whole, F.get(c, F.lit(k)).cast("float")).otherwise(F.raise_error(F.concat(F.lit("not a facet of three vertices: "), F.left("value", F.lit(200))))).alias(f"{c}{k}")
    return found.select("path", *[number(c, k) for k in range(3) for c in "xyz"])


def text_facets(triangles: DataFrame) -> DataFrame:
    """``value``: each triangle as the text of a facet, for ``write.text``. Normals are left to the reader (0 0 0)."""
    corner = lambda k: F.concat_ws(" ", F.lit("vertex"), *[F.col(f"{c}{k}").cast("string") for c in "xyz"])
    return triangles.select(F.concat_ws("\n", F.lit("facet normal 0 0 0"), F.lit("outer loop"), *[corner(k) for k in range(3)], F.lit("endloop"), F.lit("endfacet")).alias("value"))


def stl_chunks(triangles: DataFrame, many: int) -> Iterator[bytes]:
    """A binary STL of ``many`` triangles (``face`` from 0 without gaps, corners) in pieces of a range each, for one writer.

    Tasks encode whole ranges; the writer gets one after another.
    """
    yield b"\0" * 80 + np.uint32(many).tobytes()

    def encode(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("face")
        faces = np.zeros(len(f), TRIANGLE)
        faces["corners"] = f[_NAMES].to_numpy("<f4").reshape(-1, 3, 3)
        return pd.DataFrame({"range": [int(key[0])], "body": [faces.tobytes()]})

    ranges = triangles.withColumn("range", F.floor(F.col("face") / RANGE)).groupBy("range").applyInPandas(encode, "range long, body binary")
    for row in ranges.orderBy("range").toLocalIterator():
        yield bytes(row.body)


def centroids(triangles: DataFrame) -> DataFrame:
    """``path``, ``face`` where the mesh numbers them, and ``x, y, z``: the mean corner of each triangle, in single precision."""
    mean = lambda c: ((F.col(f"{c}0") + F.col(f"{c}1") + F.col(f"{c}2")) / 3).cast("float").alias(c)
    return triangles.select("path", *[c for c in ("face",) if c in triangles.columns], *[mean(c) for c in "xyz"])


def summary(triangles: DataFrame) -> DataFrame:
    """``path, faces, vertices`` and bounds of each mesh."""
    ends = [f(*[F.col(f"{c}{k}") for k in range(3)]) for c in "xyz" for f in (F.least, F.greatest)]
    names = [f"{n}_{c}" for c in "xyz" for n in ("low", "high")]
    return triangles.groupBy("path").agg(
        F.count("*").alias("faces"), (F.count("*") * 3).alias("vertices"), *[(F.min(e) if n.startswith("low") else F.max(e)).alias(n) for e, n in zip(ends, names)]
    )
