"""Dense volumes as block tables: one row per z-slab, read from NPY and uncompressed TIFF files.

Only headers are read to plan the slabs; each task then reads the bytes of its
own slab. Files in a store that this machine's readers can't open piece by
piece come whole through Spark's reader, one file a task.
"""

from __future__ import annotations

import ast
import hashlib
import io
import math
import os
import re
import struct
import tempfile
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strutwise.sources import tiff

BLOCKS = "path string, z0 int, nz int, ny int, nx int, dtype string, data binary"
_SLABS = "path string, z0 int, nz int, ny int, nx int, dtype string, order string, offsets array<long>, sizes array<long>, data binary"
_PIECES = "path string, z0 int, nz int, ny int, nx int, dtype string, x0 int, many int, data binary"
#: Cells of one slab, about, and tasks that slabs are dealt to, at most.
SLAB_CELLS, TASKS = 1 << 22, 1 << 15


def npy_header(head: bytes) -> tuple[np.dtype, bool, tuple[int, ...], int]:
    """Type, whether in Fortran order, shape and length of the header of NPY bytes."""
    if head[:6] != b"\x93NUMPY":
        raise ValueError("not an NPY file")
    size, at = (struct.unpack("<H", head[8:10])[0], 10) if head[6] == 1 else (struct.unpack("<I", head[8:12])[0], 12)
    spec = ast.literal_eval(head[at : at + size].decode("latin1" if head[6] < 3 else "utf-8"))
    dtype = np.dtype(spec["descr"])
    if dtype.kind not in "buif" or dtype.names:
        raise ValueError(f"volumes hold real numbers, not {dtype}")
    return dtype, spec["fortran_order"], spec["shape"], at + size


def _text(dtype: np.dtype) -> str:
    return dtype.newbyteorder("=").str.lstrip("=<>|")


@dataclass(frozen=True)
class Layout:
    """Where the slices of a volume lie in its file: a list of (offset, bytes) for each, or Fortran order as a whole."""

    shape: tuple[int, ...]
    dtype: np.dtype
    fortran: bool
    slices: list[list[tuple[int, int]]]


def layout(f) -> Layout:
    """The layout of an open NPY or TIFF file, from its headers alone."""
    head = f.read(65_536)
    if head[:6] == b"\x93NUMPY":
        dtype, fortran, shape, at = npy_header(head)
        size = math.prod(shape[1:]) * dtype.itemsize
        if fortran or len(shape) != 3:
            return Layout(shape, dtype, fortran, [[(at, size * (shape[0] if shape else 1))]])
        return Layout(shape, dtype, False, [[(at + z * size, size)] for z in range(shape[0])])
    if head[:4] in tiff.MAGIC:
        pages = tiff.pages(f)
        shape, dtype, slices = tiff.stacked(pages)
        return Layout(shape, dtype, False, slices)
    raise ValueError("neither an NPY nor a TIFF file")


def _opened(path: str):
    fs, name = pyarrow.fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
    return fs.open_input_file(name)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, content`` of files; no content where each task can open a file itself."""
    found = spark.read.format("binaryFile").load(path)
    first = found.select("path").first()
    try:
        if first is not None:
            pyarrow.fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", first.path))
        return found.select("path", F.lit(None).cast("binary").alias("content"))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return found.select("path", "content")


def _reader(path: str, content: bytes | None):
    return _opened(path) if content is None else io.BytesIO(bytes(content))


def read_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, shape, dtype, byte_order, cells, fortran`` of each file, without its voxels' values."""

    def run(frames):
        for f in frames:
            rows = []
            for p, content in zip(f["path"], f["content"]):
                with _reader(p, content) as file:
                    found = layout(file)
                rows.append((p, list(found.shape), _text(found.dtype), "big" if found.dtype.byteorder == ">" else "little", int(math.prod(found.shape)), found.fortran))
            yield pd.DataFrame(rows, columns=["path", "shape", "dtype", "byte_order", "cells", "fortran"])

    return _files(spark, path).mapInPandas(run, "path string, shape array<int>, dtype string, byte_order string, cells long, fortran boolean")


def read_spacing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, axis, value, unit, source`` for the axes x, y, z of each file; unknown where its metadata doesn't say.

    The first of OME-XML, ImageJ's description and the resolution tags that
    knows an axis counts; NPY files know none.
    """

    def run(frames):
        for f in frames:
            rows = []
            for p, content in zip(f["path"], f["content"]):
                with _reader(p, content) as file:
                    known = tiff.spacing(tiff.pages(file, most=1)[0]) if file.read(4) in tiff.MAGIC else {}
                rows += [(p, axis, *known.get(axis, (None, "unknown", "unknown"))) for axis in "xyz"]
            yield pd.DataFrame(rows, columns=["path", "axis", "value", "unit", "source"])

    return _files(spark, path).mapInPandas(run, "path string, axis string, value double, unit string, source string")


def read_volume(spark: SparkSession, path: str | list[str], slab_cells: int = SLAB_CELLS, every: int = 1) -> DataFrame:
    """Block table of 3-D volumes (a file, folder or glob); other ranks and compressed pages raise an error.

    Values keep their type; byte order becomes little-endian. A file in Fortran
    order is read by columns of x, each once, which meet again by slab. With ``every`` k
    only slices 0, k, 2k, .. are read, a slab each, and no byte of the others.
    """

    def plan(frames):
        for f in frames:
            for p, content in zip(f["path"], f["content"]):
                with _reader(p, content) as file:
                    found = layout(file)
                if len(found.shape) != 3:
                    raise ValueError(f"{p}: {len(found.shape)} axes, a volume has 3")
                nz, ny, nx = found.shape
                depth = max(1, slab_cells // max(1, ny * nx)) if every == 1 else 1
                order = found.dtype.byteorder.replace("=", "<").replace("|", "<")
                rows = []
                if found.fortran:  # columns of x lie one after another
                    at, plane = found.slices[0][0][0], nz * ny * found.dtype.itemsize
                    for x in range(0, nx, width := max(1, slab_cells // max(1, nz * ny))):
                        many = min(width, nx - x)
                        rows.append((p, x, nz, ny, many, _text(found.dtype), "F" + order, [at + x * plane], [many * plane], content))
                    yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SLABS.split(", ")])
                    continue
                for z in range(0, nz, depth if every == 1 else every):
                    spans = [s for one in found.slices[z : z + depth] for s in one]
                    joined = [list(spans[0])]
                    for at, size in spans[1:]:
                        if joined[-1][0] + joined[-1][1] == at:
                            joined[-1][1] += size
                        else:
                            joined.append([at, size])
                    rows.append((p, z, min(depth, nz - z), ny, nx, _text(found.dtype), order, [x for x, _ in joined], [x for _, x in joined], content))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SLABS.split(", ")])

    def read(frames):
        for f in frames:
            for r in f.itertuples(index=False):
                with _reader(r.path, r.data) as file:
                    parts = []
                    for at, size in zip(r.offsets, r.sizes):
                        file.seek(int(at))
                        parts.append(file.read(int(size)))
                raw = b"".join(parts)
                flat = np.frombuffer(raw, np.dtype(r.order[-1] + r.dtype)).astype(np.dtype(r.dtype).newbyteorder("<"))
                if r.order[0] != "F":
                    yield pd.DataFrame([(r.path, r.z0, r.nz, r.ny, r.nx, r.dtype, 0, r.nx, flat.tobytes())], columns=pieces)
                    continue
                a = flat.reshape((r.nz, r.ny, r.nx), order="F")  # the columns z0 and on of the volume
                depth = max(1, slab_cells // max(1, r.ny * r.wide)) if every == 1 else 1
                for z in range(0, r.nz, depth if every == 1 else every):
                    part = np.ascontiguousarray(a[z : z + depth])
                    yield pd.DataFrame([(r.path, z, len(part), r.ny, r.wide, r.dtype, r.z0, r.nx, part.tobytes())], columns=pieces)

    def joined(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        first = f.iloc[0].to_dict()
        whole = np.zeros([first[c] for c in ("nz", "ny", "nx")], dtype=np.dtype(first["dtype"]).newbyteorder("<"))
        for r in f.itertuples(index=False):
            whole[:, :, r.x0 : r.x0 + r.many] = np.frombuffer(r.data, whole.dtype).reshape(r.nz, r.ny, r.many)
        return pd.DataFrame([(first["path"], first["z0"], *whole.shape, first["dtype"], whole.tobytes())], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    pieces = ["path", "z0", "nz", "ny", "nx", "dtype", "x0", "many", "data"]
    planned = _files(spark, path).mapInPandas(plan, _SLABS)
    wide = F.sum(F.when(F.col("order").startswith("F"), F.col("nx"))).over(Window.partitionBy("path"))  # a row for each slab
    slabs = planned.withColumn("wide", F.coalesce(wide, F.lit(0)))
    found = slabs.agg(F.count("*"), F.count_if(F.col("order").startswith("F"))).first()
    read_ = slabs.repartition(min(TASKS, max(1, found[0])), "path", "z0").mapInPandas(read, _PIECES)
    if not found[1]:
        return read_.drop("x0", "many")
    return read_.groupBy("path", "z0").applyInPandas(joined, BLOCKS)


def write_npy(blocks: DataFrame, path: str) -> bool:
    """Writes the blocks of one volume, slab after slab, as an NPY file on the driver's disk; says whether it changed.

    The file appears by one rename. A file that holds exactly this already is
    left alone; one that holds anything else raises an error.
    """
    size = blocks.agg(F.max(F.col("z0") + F.col("nz")), F.sum("nz"), F.max("ny"), F.max("nx"), F.count_distinct("ny", "nx", "dtype"), F.max("dtype")).first()
    if size[0] is None or size[0] != size[1] or size[4] != 1:
        raise ValueError("the blocks don't make one whole volume")
    dtype = np.dtype(size[5]).newbyteorder("<")
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(handle, "wb") as f:
            np.lib.format.write_array_header_1_0(f, {"descr": np.lib.format.dtype_to_descr(dtype), "fortran_order": False, "shape": (size[0], size[2], size[3])})
            for row in blocks.select("z0", "data").orderBy("z0").toLocalIterator():  # a slab at a time
                f.write(row.data)
            f.flush()
            os.fsync(f.fileno())
        if os.path.exists(path):
            if not _same_bytes(name, path):
                raise FileExistsError(f"{path} holds something else")
            return False
        os.replace(name, path)
        return True
    finally:
        if os.path.exists(name):
            os.unlink(name)


def _same_bytes(one: str, other: str, step: int = 1 << 24) -> bool:
    if os.path.getsize(one) != os.path.getsize(other):
        return False
    with open(one, "rb") as f, open(other, "rb") as g:
        while a := f.read(step):
            if a != g.read(step):
                return False
    return True


def block_array(row) -> np.ndarray:
    return np.frombuffer(bytes(row.data), np.dtype(row.dtype).newbyteorder("<")).reshape(row.nz, row.ny, row.nx)


def voxels(blocks: DataFrame) -> DataFrame:
    """``z, y, x, value`` of every cell, non-finite values included."""

    def run(frames):
        for f in frames:
            for row in f.itertuples(index=False):
                a = block_array(row)
                z, y, x = np.indices(a.shape)
                yield pd.DataFrame({"z": (z + row.z0).ravel().astype(np.int32), "y": y.ravel().astype(np.int32), "x": x.ravel().astype(np.int32), "value": a.ravel().astype(np.float64)})

    return blocks.mapInPandas(run, "z int, y int, x int, value double")


def blocks_of(cells: DataFrame, shape: tuple[int, int, int], dtype: str = "u2", depth: int = 1, path: str = "cells") -> DataFrame:
    """Block table of a volume given as rows ``z, y, x, value``: slabs of ``depth`` slices, 0 where no row is; rows outside the shape are ignored."""
    slabs = cells.sparkSession.range(0, -(-shape[0] // depth)).select(F.col("id").cast("int").alias("slab"))
    inside = cells.where(" and ".join(f"{c} between 0 and {n - 1}" for c, n in zip("zyx", shape))).select("z", "y", "x", "value", F.floor(F.col("z") / depth).cast("int").alias("slab"))

    def run(key: tuple, own: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        z0 = int(key[0]) * depth
        a = np.zeros((min(depth, shape[0] - z0), *shape[1:]), dtype=np.dtype(dtype).newbyteorder("<"))
        a[f["z"].to_numpy() - z0, f["y"].to_numpy(), f["x"].to_numpy()] = f["value"].to_numpy()
        return pd.DataFrame([(path, z0, *a.shape, dtype, a.tobytes())], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    return slabs.groupBy("slab").cogroup(inside.groupBy("slab")).applyInPandas(run, BLOCKS)


def histogram(blocks: DataFrame) -> DataFrame:
    """``bin, c`` of unsigned 16-bit blocks: one count array per task, then a sum by bin."""

    def run(frames):
        total = np.zeros(65_536, dtype=np.int64)
        for f in frames:
            for row in f.itertuples(index=False):
                if row.dtype != "u2":
                    raise ValueError("native bins need unsigned 16-bit values")
                total += np.bincount(block_array(row).ravel(), minlength=65_536)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bin": used.astype(np.int32), "c": total[used]})

    return blocks.mapInPandas(run, "bin int, c long").groupBy("bin").agg(F.sum("c").alias("c"))


def mask(blocks: DataFrame, threshold: float, below: bool = False) -> DataFrame:
    """Blocks of 0 and 1: whether each value reaches the threshold, or lies ``below`` it (never for NaN)."""

    def run(frames):
        for f in frames:
            out = f.copy()
            out["data"] = [(block_array(r) < threshold if below else block_array(r) >= threshold).astype(np.uint8).tobytes() for r in f.itertuples(index=False)]
            out["dtype"] = "u1"
            yield out

    return blocks.mapInPandas(run, BLOCKS)


def gathered(blocks: DataFrame, z0: int, z1: int) -> tuple[np.ndarray, int]:
    """Slices z0 <= z < z1 as one array on the driver, and the first one's number; for bounded windows only."""
    rows = blocks.where((F.col("z0") < z1) & (F.col("z0") + F.col("nz") > z0)).orderBy("z0").collect()
    if not rows:
        raise ValueError("no slices in that range")
    whole = np.concatenate([block_array(r) for r in rows])
    first = rows[0].z0
    return whole[max(0, z0 - first) : z1 - first], max(z0, first)


def _named(df: DataFrame) -> DataFrame:
    """Adds ``given``: the path as callers write that of a local file."""
    return df.withColumn("given", F.regexp_replace("path", "^file:(//)?(?=/)", ""))


def digests(spark: SparkSession, path: str | list[str], step: int = 1 << 24) -> DataFrame:
    """``path, bytes, sha256`` of files of any kind and size, each read in pieces of ``step`` bytes by the task that has it; an empty file gives no row."""

    def run(frames):
        for f in frames:
            rows = []
            for p, content in zip(f["path"], f["content"]):
                found, size = hashlib.sha256(), 0
                with _reader(p, content) as file:
                    while piece := file.read(step):
                        found.update(piece)
                        size += len(piece)
                rows.append((p, size, found.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "bytes", "sha256"])

    return _files(spark, path).mapInPandas(run, "path string, bytes long, sha256 string")


def inspect(spark: SparkSession, paths: list[str], statistics: bool = True, hashes: bool = True) -> DataFrame:
    """``place, path, shape, dtype, byte_order, cells, bytes, sha256`` and value statistics of volumes, in the order given.

    Statistics are range, mean and counts of finite and other values, merged
    from one row per slab; without them, and without ``hashes`` (then neither
    ``bytes`` nor ``sha256``), only headers are read.
    """
    order = spark.createDataFrame([(k, p) for k, p in enumerate(paths)], "place int, given string")
    out = order.join(_named(read_headers(spark, paths)), "given")
    if hashes:
        out = out.join(_named(digests(spark, paths)).drop("path"), "given")
    if statistics:
        out = out.join(_named(slab_stats(read_volume(spark, paths))), "given", "left")
    return out.select("place", F.col("given").alias("path"), *[c for c in out.columns if c not in ("place", "path", "given")]).orderBy("place")


def manifest(spark: SparkSession, paths: list[str], root: str, retention: str = "external", hashes: bool = True) -> DataFrame:
    """``place, ct_volume, ct_metadata``: what a manifest says of each volume, in the order given.

    ``ct_volume`` has the path below ``root``, the SHA-256 (null without
    ``hashes``), the role and how the file is kept; ``ct_metadata`` the format,
    shape, type, byte order and, by axis, the spacing where the file knows it
    (value null, unit and source ``unknown`` elsewhere). Values of cells aren't
    read. A path outside ``root``, of another kind or another way to keep it
    raise an error.
    """
    if retention not in ("committed", "external", "regenerable"):
        raise ValueError(f"files are not kept as {retention!r}")
    base = root.rstrip("/") + "/"
    for p in paths:
        if not p.startswith(base) or ".." in p[len(base) :].split("/"):
            raise ValueError(f"{p} is not below {root}")
        if not p.lower().endswith((".npy", ".tif", ".tiff")):
            raise ValueError(f"{p} is neither an NPY nor a TIFF file")
    found = inspect(spark, paths, statistics=False, hashes=hashes)
    axes = _named(read_spacing(spark, paths)).groupBy("given").agg(F.map_from_entries(F.collect_list(F.struct("axis", F.struct("value", "unit", "source")))).alias("voxel_spacing"))  # three axes a file
    # a type's long name: kind and bits, or bool
    kinds = F.create_map(*[F.lit(x) for pair in (("u", "uint"), ("i", "int"), ("f", "float")) for x in pair])
    name = F.when(F.col("dtype") == "b1", "bool").otherwise(F.concat(kinds[F.left("dtype", F.lit(1))], (F.substring("dtype", 2, 3).cast("int") * 8).cast("string")))
    order = F.when(F.col("dtype").isin("b1", "i1", "u1"), "not_applicable").otherwise(F.col("byte_order"))
    whole = F.struct(
        F.substr("path", F.lit(len(base) + 1)).alias("path"), (F.col("sha256") if hashes else F.lit(None).cast("string")).alias("sha256"), F.lit("ct_volume").alias("role"), F.lit(retention).alias("retention"),
    )
    form = F.when(F.lower("path").endswith(".npy"), "npy").otherwise("tiff").alias("format")
    return found.join(axes, F.col("path") == F.col("given")).select("place", whole.alias("ct_volume"), F.struct(form, "shape", name.alias("dtype"), order.alias("byte_order"), "voxel_spacing").alias("ct_metadata")).orderBy("place")


def slab_stats(blocks: DataFrame) -> DataFrame:
    """``path, minimum, maximum, mean, finite_count, nonfinite_count`` of block tables."""

    def run(frames):
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                a = block_array(row).astype(np.float64)
                good = a[np.isfinite(a)]
                out.append((row.path, float(good.min()) if len(good) else None, float(good.max()) if len(good) else None, float(good.sum()), len(good), a.size - len(good)))
            yield pd.DataFrame(out, columns=["path", "low", "high", "total", "good", "bad"])

    parts = blocks.mapInPandas(run, "path string, low double, high double, total double, good long, bad long")
    return parts.groupBy("path").agg(
        F.min("low").alias("minimum"), F.max("high").alias("maximum"), (F.sum("total") / F.nullif(F.sum("good").cast("double"), F.lit(0.0))).alias("mean"),
        F.sum("good").alias("finite_count"), F.sum("bad").alias("nonfinite_count"),
    )
