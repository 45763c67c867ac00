"""Components and distances in volumes that no task holds: parts side by side, joined where they touch.

A part is a box of cells, cut at multiples of one size so that neighbours meet
in whole faces. Components are labelled inside each part; labels that touch
across faces (edges and corners too, if these connect) become links, and the
components of the links name those that go on from part to part. Counts and
centres are summed by label before labels are joined, so no row stands for a
voxel and no component is too long.

Distances are exact at any range: three passes, each over whole lines of one
axis, take the lower envelope of the parabolas that the pass before left.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strutwise.functions import kernels as K
from strutwise.operators.lattice import components
from strutwise.sources.storage import stored
from strutwise.sources.volumes import block_array

#: Cells along the side of a part, and in the lines that one task gets at once.
PART, LINES = 64, 1 << 20
_BOX = "z0 int, y0 int, x0 int, nz int, ny int, nx int, data binary"
_NAMES = ["z0", "y0", "x0", "nz", "ny", "nx", "data"]
_HALF = K.offsets(3, True)


def _array(row, dtype=np.uint8) -> np.ndarray:
    return np.frombuffer(row.data, dtype).reshape(row.nz, row.ny, row.nx)


def mask_parts(blocks: DataFrame, threshold: float, step: int = 1, slices: tuple[int, int] | None = None, size: int = PART) -> DataFrame:
    """Parts of the mask ``value >= threshold`` of every ``step``-th cell, whole or of the given (strided) slices; their first is slice 0."""

    def run(frames):
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                first, stop = slices or (0, 1 << 31)
                begin = max(-(-row.z0 // step), first)
                a = block_array(row)[begin * step - row.z0 :: step, ::step, ::step][: max(0, stop - begin)] >= threshold
                for z in range((begin - first) // size, (begin - first + len(a) - 1) // size + 1 if len(a) else 0):
                    z0, z1 = max(begin - first, z * size), min(begin - first + len(a), (z + 1) * size)
                    for y0 in range(0, a.shape[1], size):
                        for x0 in range(0, a.shape[2], size):
                            part = a[z0 - begin + first : z1 - begin + first, y0 : y0 + size, x0 : x0 + size]
                            out.append((z0, y0, x0, *part.shape, part.astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=_NAMES)

    return blocks.mapInPandas(run, _BOX)


def cell_parts(cells: DataFrame, shape: tuple[int, int, int], size: int = PART) -> DataFrame:
    """Parts of a mask whose true cells are the rows ``z, y, x``; parts without any are left out. Rows outside the shape are ignored, repeated ones count once."""
    inside = cells.where(" and ".join(f"{c} between 0 and {n - 1}" for c, n in zip("zyx", shape)))
    keyed = inside.select("z", "y", "x", *[F.floor(F.col(c) / size).cast("int").alias(f"b{c}") for c in "zyx"])

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        low = [int(k) * size for k in key]
        mask = np.zeros([min(size, n - o) for o, n in zip(low, shape)], dtype=np.uint8)
        mask[tuple(f[c].to_numpy() - o for c, o in zip("zyx", low))] = 1
        return pd.DataFrame([(*low, *mask.shape, mask.tobytes())], columns=_NAMES)

    return keyed.groupBy("bz", "by", "bx").applyInPandas(run, _BOX)


def labelled(parts: DataFrame, shape: tuple[int, int, int], full: bool = True) -> DataFrame:
    """Parts with the number of each cell's component inside the part (``data``, 0 outside) and what each number is called (``names``).

    A component's name is the packed place ``(z * ny + y) * nx + x`` of its
    first cell. ``full``: edges and corners connect, not only faces. Parts
    without a cell are left out. The result is a stored table.
    """

    def run(frames):
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                labels, n = K.label(_array(row) > 0, full)
                if n:
                    flat = labels.ravel()
                    seen, at = np.unique(flat, return_index=True)
                    z, y, x = np.unravel_index(at[seen > 0], labels.shape)
                    names = ((z + row.z0).astype(np.int64) * shape[1] + y + row.y0) * shape[2] + x + row.x0
                    out.append((row.z0, row.y0, row.x0, row.nz, row.ny, row.nx, labels.astype("<i4").tobytes(), names.tolist()))
            yield pd.DataFrame(out, columns=[*_NAMES, "names"])

    return stored(parts.mapInPandas(run, _BOX + ", names array<bigint>"), "labels")


def touching(parts: DataFrame, full: bool = True) -> DataFrame:
    """``u, v``: names of components of different parts that touch, each pair once or a few times.

    A part shows each neighbour the layer of cells that faces it; both layers
    meet under the place where the parts meet.
    """
    sides = [d for d in _HALF if full or sum(map(abs, d)) == 1]

    def show(frames):
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                labels = _array(row, "<i4")
                names = np.concatenate([[-1], row.names])
                low, high = (row.z0, row.y0, row.x0), (row.z0 + row.nz, row.y0 + row.ny, row.x0 + row.nx)
                for k, d in enumerate(sides):
                    for mine in (1, -1):
                        cut = tuple(slice(-1, None) if s * mine == 1 else slice(0, 1) if s * mine == -1 else slice(None) for s in d)
                        layer = labels[cut]
                        if layer.any():
                            meet = [h if s * mine == 1 else o for s, o, h in zip(d, low, high)]
                            out.append((k, *meet, mine, *layer.shape, names[layer].astype("<i8").tobytes()))
            yield pd.DataFrame(out, columns=["side", "mz", "my", "mx", "mine", "nz", "ny", "nx", "data"])

    def meet(frames):
        for f in frames:
            pairs = [np.zeros((0, 2), dtype=np.int64)]
            for row in f.itertuples(index=False):
                a, b = (np.frombuffer(x, "<i8").reshape(row.nz, row.ny, row.nx) for x in (row.data, row.other))
                reach = [(-1, 0, 1) if full and s == 0 else (0,) for s in sides[row.side]]
                for dz in reach[0]:
                    for dy in reach[1]:
                        for dx in reach[2]:
                            own = tuple(slice(max(0, -m), n - max(0, m)) for m, n in zip((dz, dy, dx), a.shape))
                            to = tuple(slice(max(0, m), n - max(0, -m)) for m, n in zip((dz, dy, dx), a.shape))
                            u, v = a[own].ravel(), b[to].ravel()
                            both = (u >= 0) & (v >= 0)
                            pairs.append(np.unique(np.stack([u[both], v[both]], axis=1), axis=0))
            found = np.unique(np.concatenate(pairs), axis=0)
            yield pd.DataFrame({"u": found[:, 0], "v": found[:, 1]})

    key = ["side", "mz", "my", "mx"]
    layers = parts.mapInPandas(show, "side int, mz int, my int, mx int, mine int, nz int, ny int, nx int, data binary")
    back = layers.where("mine = -1").select(*key, F.col("data").alias("other"))
    return layers.where("mine = 1").join(back, key).select("side", "nz", "ny", "nx", "data", "other").mapInPandas(meet, "u long, v long")


def joined(parts: DataFrame, full: bool = True) -> DataFrame:
    """``name, component``: every name of :func:`labelled` and its component's least name."""
    links = components(touching(parts, full)).withColumnRenamed("node", "name")
    every = parts.select(F.explode("names").alias("name"))
    return every.join(links, "name", "left").select("name", F.coalesce("component", "name").alias("component"))


def sums_by_name(parts: DataFrame) -> DataFrame:
    """``name, size, z, y, x``: how many cells each labelled component has inside its part, and the sums of their places."""

    def run(frames):
        for f in frames:
            out = [pd.DataFrame({c: np.zeros(0, dtype=np.int64) for c in ("name", "size", "z", "y", "x")})]
            for row in f.itertuples(index=False):
                labels = _array(row, "<i4")
                at, owner = np.nonzero(labels), labels[labels > 0]
                one = {c: np.bincount(owner, a + o, len(row.names) + 1)[1:].astype(np.int64) for c, a, o in zip("zyx", at, (row.z0, row.y0, row.x0))}
                out.append(pd.DataFrame({"name": np.asarray(row.names, dtype=np.int64), "size": np.bincount(owner, minlength=len(row.names) + 1)[1:], **one}))
            yield pd.concat(out)

    return parts.mapInPandas(run, "name long, size long, z long, y long, x long")


def component_sums(parts: DataFrame, full: bool = True) -> DataFrame:
    """``component, size, z, y, x``: cells and the sums of their places, of whole components."""
    return sums_by_name(parts).join(joined(parts, full), "name").groupBy("component").agg(*[F.sum(c).alias(c) for c in ("size", "z", "y", "x")])


def component_cells(parts: DataFrame, shape: tuple[int, int, int], full: bool = True) -> DataFrame:
    """``node, component``: the packed place of every true cell and its component's first cell."""

    def run(frames):
        for f in frames:
            for row in f.itertuples(index=False):
                labels = _array(row, "<i4")
                z, y, x = np.nonzero(labels)
                node = ((z + row.z0).astype(np.int64) * shape[1] + y + row.y0) * shape[2] + x + row.x0
                yield pd.DataFrame({"node": node, "name": np.asarray(row.names, dtype=np.int64)[labels[labels > 0] - 1]})

    return parts.mapInPandas(run, "node long, name long").join(joined(parts, full), "name").select("node", "component")


def _over_lines(parts: DataFrame, axis: int, length: int, kernel, into: str, out: str, size: int) -> DataFrame:
    """``kernel`` over arrays of whole lines of one axis (first axis of the array), as parts of the same cells."""
    tile = max(1, min(size, math.isqrt(max(1, LINES // max(1, length)))))
    others = [k for k in range(3) if k != axis]

    def cut(frames):
        for f in frames:
            rows = []
            for row in f.itertuples(index=False):
                a, low = _array(row, into), (row.z0, row.y0, row.x0)
                for i in range(low[others[0]] // tile, (low[others[0]] + a.shape[others[0]] - 1) // tile + 1):
                    for j in range(low[others[1]] // tile, (low[others[1]] + a.shape[others[1]] - 1) // tile + 1):
                        take, at = [slice(None)] * 3, list(low)
                        for k, t in zip(others, (i, j)):
                            begin, end = max(low[k], t * tile), min(low[k] + a.shape[k], (t + 1) * tile)
                            take[k], at[k] = slice(begin - low[k], end - low[k]), begin
                        part = a[tuple(take)]
                        rows.append((i, j, *at, *part.shape, np.ascontiguousarray(part).tobytes()))
            yield pd.DataFrame(rows, columns=["i", "j", *_NAMES])

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        low = [0 if k == axis else int(f[f"{c}0"].min()) for k, c in enumerate("zyx")]
        shape = [length if k == axis else int((f[f"{c}0"] + f[f"n{c}"]).max()) - o for k, (c, o) in enumerate(zip("zyx", low))]
        whole = np.zeros(shape, dtype=into)
        for row in f.itertuples(index=False):
            z, y, x = row.z0 - low[0], row.y0 - low[1], row.x0 - low[2]
            whole[z : z + row.nz, y : y + row.ny, x : x + row.nx] = _array(row, into)
        done = np.moveaxis(kernel(np.moveaxis(whole, axis, 0)), 0, axis).astype(out)
        return pd.DataFrame([(*low, *done.shape, np.ascontiguousarray(done).tobytes())], columns=_NAMES)

    return parts.mapInPandas(cut, f"i int, j int, {_BOX}").groupBy("i", "j").applyInPandas(run, _BOX)


def squared_distances(parts: DataFrame, shape: tuple[int, int, int], size: int = PART) -> DataFrame:
    """Parts (int32) of each cell's squared distance to the nearest false cell; ``kernels.FAR`` where the volume has none.

    Parts that aren't there hold false cells only. What lies outside ``shape``
    counts for nothing.
    """
    one = _over_lines(parts, 0, shape[0], K.line_distance, "u1", "<i4", size)
    two = _over_lines(one, 1, shape[1], K.envelope, "<i4", "<i4", size)
    return _over_lines(two, 2, shape[2], K.envelope, "<i4", "<i4", size)


def at_least(parts: DataFrame, squared: float) -> DataFrame:
    """Mask parts of the cells whose int32 value reaches ``squared``."""

    def run(frames):
        for f in frames:
            out = f.copy()
            out["data"] = [(_array(r, "<i4") >= squared).astype(np.uint8).tobytes() for r in f.itertuples(index=False)]
            yield out

    return parts.mapInPandas(run, _BOX)


def part_cells(parts: DataFrame, dtype: str = "<i4") -> DataFrame:
    """``z, y, x, value`` of the cells of parts that aren't 0."""

    def run(frames):
        for f in frames:
            for row in f.itertuples(index=False):
                a = _array(row, dtype)
                z, y, x = np.nonzero(a)
                yield pd.DataFrame({"z": z + row.z0, "y": y + row.y0, "x": x + row.x0, "value": a[a != 0].astype(np.int64)})

    return parts.mapInPandas(run, "z int, y int, x int, value long")


def haloed(parts: DataFrame, size: int, width: int) -> DataFrame:
    """Parts (cut at multiples of ``size``) with ``width`` cells of their surroundings on every side; empty parts may be absent and stay so.

    ``z0, y0, x0`` become those of the wider box, which may lie outside the volume.
    """
    reach = -(-width // size)
    moves = [d for d in np.ndindex(*[2 * reach + 1] * 3)]

    def show(frames):
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                a, low = _array(row) > 0, np.array([row.z0, row.y0, row.x0])
                for d in moves:
                    to = low // size + np.array(d) - reach
                    begin, end = np.maximum(low, to * size - width), np.minimum(low + a.shape, (to + 1) * size + width)
                    if (begin < end).all():
                        part = a[tuple(slice(b - o, e - o) for b, e, o in zip(begin, end, low))]
                        own = (to == low // size).all()
                        if own or part.any():
                            out.append((*map(int, to), bool(own), *map(int, begin), *part.shape, part.astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=["i", "j", "k", "own", *_NAMES])

    def gather(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        if not f["own"].any():
            return pd.DataFrame(columns=_NAMES)
        low = np.array([int(v) for v in key]) * size - width
        whole = np.zeros((size + 2 * width,) * 3, dtype=np.uint8)
        for row in f.itertuples(index=False):
            z, y, x = row.z0 - low[0], row.y0 - low[1], row.x0 - low[2]
            whole[z : z + row.nz, y : y + row.ny, x : x + row.nx] = _array(row)
        return pd.DataFrame([(*map(int, low), *whole.shape, whole.tobytes())], columns=_NAMES)

    return parts.mapInPandas(show, f"i int, j int, k int, own boolean, {_BOX}").groupBy("i", "j", "k").applyInPandas(gather, _BOX)


def thinned_parts(parts: DataFrame, size: int) -> DataFrame:
    """The one-voxel-wide skeleton of a mask in parts, equal to ``kernels.thinned`` of the whole volume.

    Every pass over one of six sides sees its part and the nine cells around
    it, all that the pass can depend on. Rounds of six passes go on until none
    takes a cell: about as many as half the thickest place has cells.
    """
    width = K.PEEL_REACH

    def over(axis: int, step: int):
        def run(frames):
            for f in frames:
                out = []
                for row in f.itertuples(index=False):
                    a = K.peeled(_array(row) > 0, axis, step, (row.z0, row.y0, row.x0))[width:-width, width:-width, width:-width]
                    if a.any():
                        out.append((row.z0 + width, row.y0 + width, row.x0 + width, *a.shape, a.astype(np.uint8).tobytes()))
                yield pd.DataFrame(out, columns=_NAMES)

        return run

    def cells(table: DataFrame) -> int:
        ones = F.length(F.regexp_replace(F.hex("data"), "0", ""))  # a cell is the byte 0 or 1
        return table.agg(F.coalesce(F.sum(ones), F.lit(0))).first()[0]

    now, before = stored(parts, "thinned"), None
    while (left := cells(now)) != before:
        before = left
        for axis, step in K.SIDES:
            now = haloed(now, size, width).mapInPandas(over(axis, step), _BOX)
        now = stored(now, "thinned")
    return now


def degrees(parts: DataFrame, size: int) -> DataFrame:
    """``neighbours, cells``: how many cells of a mask in parts have so many of their 26 neighbours in it."""

    def run(frames):
        for f in frames:
            out = [pd.DataFrame({"neighbours": [], "cells": []}, dtype=np.int64)]
            for row in f.itertuples(index=False):
                a = _array(row).astype(np.int64)
                around = sum(a[1 + z : a.shape[0] - 1 + z, 1 + y : a.shape[1] - 1 + y, 1 + x : a.shape[2] - 1 + x] for z in (-1, 0, 1) for y in (-1, 0, 1) for x in (-1, 0, 1))
                counts = np.bincount(around[a[1:-1, 1:-1, 1:-1] > 0] - 1, minlength=27)
                out.append(pd.DataFrame({"neighbours": np.arange(27), "cells": counts}))
            yield pd.concat(out).groupby("neighbours", as_index=False).sum()

    return haloed(parts, size, 1).mapInPandas(run, "neighbours long, cells long").groupBy("neighbours").agg(F.sum("cells").alias("cells")).where("cells > 0")


def skeleton_points(parts: DataFrame, size: int) -> DataFrame:
    """One row: voxels, endpoints (one neighbour) and branch points (more than two)."""
    count = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("cells"))), F.lit(0)).cast("long")
    n = F.col("neighbours")
    return degrees(parts, size).agg(count(n >= 0).alias("voxels"), count(n == 1).alias("endpoints"), count(n > 2).alias("branch_points"))
