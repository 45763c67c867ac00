"""Cutting the part of a volume around each strut or node, and running a kernel on it.

Blocks are recut to bricks. Struts go to the bricks that their boxes meet, each
brick cuts out what belongs to them, and the cuts of one strut meet again: what
moves is the volume of the boxes, not bricks once per strut, and no task sees
more than a brick and a box.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strutwise.sources.storage import stored
from strutwise.sources.volumes import block_array

BRICK = 64


def bricks(blocks: DataFrame, size: int = BRICK) -> DataFrame:
    """``bz, by, bx, z0, y0, x0, nz, ny, nx, dtype, data``: blocks cut at multiples of ``size``."""

    def run(frames):
        for f in frames:
            for row in f.itertuples(index=False):
                a, out = block_array(row), []
                for z in range(row.z0 // size, (row.z0 + row.nz - 1) // size + 1):
                    z0, z1 = max(row.z0, z * size), min(row.z0 + row.nz, (z + 1) * size)
                    for y in range(-(-row.ny // size)):
                        for x in range(-(-row.nx // size)):
                            part = a[z0 - row.z0 : z1 - row.z0, y * size : (y + 1) * size, x * size : (x + 1) * size]
                            out.append((z, y, x, z0, y * size, x * size, *part.shape, row.dtype, np.ascontiguousarray(part).tobytes()))
                yield pd.DataFrame(out, columns=["bz", "by", "bx", "z0", "y0", "x0", "nz", "ny", "nx", "dtype", "data"])

    return blocks.mapInPandas(run, "bz int, by int, bx int, z0 int, y0 int, x0 int, nz int, ny int, nx int, dtype string, data binary")


def on_patches(boxes: DataFrame, blocks: DataFrame, kernel: Callable[[dict, np.ndarray, tuple[int, int, int]], dict], schema: str, size: int = BRICK) -> DataFrame:
    """``kernel(row, patch, corner)`` for each box, as rows of ``schema``.

    ``boxes`` has ``id``, the first and last cells ``lz, hz, ly, hy, lx, hx``
    and whatever the kernel needs. Cells of a box outside the volume are not in
    the patch; a box that meets no brick gives no row.
    """
    own = boxes.columns
    keyed = boxes
    for c in "zyx":
        keyed = keyed.withColumn(f"b{c}", F.explode(F.sequence(F.floor(F.greatest(F.lit(0), F.col(f"l{c}")) / size).cast("int"), F.floor(F.greatest(F.lit(0), F.col(f"h{c}")) / size).cast("int"))))
    met = keyed.select("id", *[f"{e}{c}" for c in "zyx" for e in "lh"], "bz", "by", "bx").join(bricks(blocks, size), ["bz", "by", "bx"])

    def cut(frames):
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                a = block_array(r)
                low = [max(0, l - o) for l, o in ((r.lz, r.z0), (r.ly, r.y0), (r.lx, r.x0))]
                high = [min(n, h - o + 1) for h, o, n in ((r.hz, r.z0, r.nz), (r.hy, r.y0, r.ny), (r.hx, r.x0, r.nx))]
                part = a[low[0] : high[0], low[1] : high[1], low[2] : high[2]]
                if part.size:
                    out.append((r.id, r.z0 + low[0], r.y0 + low[1], r.x0 + low[2], *part.shape, r.dtype, np.ascontiguousarray(part).tobytes()))
            yield pd.DataFrame(out, columns=["id", "z0", "y0", "x0", "nz", "ny", "nx", "dtype", "data"])

    cuts = met.mapInPandas(cut, "id long, z0 int, y0 int, x0 int, nz int, ny int, nx int, dtype string, data binary")
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(key, box: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        if not len(box) or not len(parts):
            return pd.DataFrame(columns=names)
        corner = tuple(int(parts[f"{c}0"].min()) for c in "zyx")
        shape = tuple(int((parts[f"{c}0"] + parts[f"n{c}"]).max()) - o for c, o in zip("zyx", corner))
        patch = np.zeros(shape, dtype=np.dtype(parts["dtype"].iloc[0]))
        for r in parts.itertuples(index=False):
            z, y, x = r.z0 - corner[0], r.y0 - corner[1], r.x0 - corner[2]
            patch[z : z + r.nz, y : y + r.ny, x : x + r.nx] = block_array(r)
        return pd.DataFrame([kernel(row, patch, corner) for row in box[own].to_dict("records")], columns=names)

    return boxes.groupBy("id").cogroup(cuts.groupBy("id")).applyInPandas(run, schema)


def at_places(nodes: DataFrame, found_at: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``found_at(places)`` (``id, x, y, z`` of distinct places, numbered) for every node ``id, x, y, z``: nodes at one place see one patch, so it is cut and looked at once."""
    at = nodes.select("id", *[F.col(c).cast("double").alias(f"__{c}") for c in "xyz"])
    # a table, so that a place keeps its number
    places = stored(at.select("__x", "__y", "__z").distinct().withColumn("__place", F.monotonically_increasing_id()), "places")
    found = found_at(places.select(F.col("__place").alias("id"), *[F.col(f"__{c}").alias(c) for c in "xyz"]))
    every = found.withColumnRenamed("id", "__place").join(places, "__place").drop("__place")
    return at.join(every, ["__x", "__y", "__z"]).select(found.columns)


def boxes_around(placed: DataFrame, reach: float | Column) -> DataFrame:
    """Adds the cells within ``reach`` of a segment's bounding box (``ax..bz``), not clipped."""
    out = placed
    for c in "zyx":
        low, high = F.least(f"a{c}", f"b{c}"), F.greatest(f"a{c}", f"b{c}")
        out = out.withColumn(f"l{c}", F.floor(low - reach).cast("int")).withColumn(f"h{c}", F.ceil(high + reach).cast("int"))
    return out
