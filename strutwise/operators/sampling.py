"""Selecting and sampling voxels: windows, strides, corridors, stamps, neighbours on the grid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strutwise.functions import vectors as V


def inside(p: tuple[Column, ...], shape: tuple[int, ...], margin: float = 0.0) -> Column:
    """margin <= p < size - margin on every axis."""
    ok = F.lit(True)
    for c, n in zip(p, shape):
        ok = ok & (c >= F.lit(float(margin))) & (c < F.lit(float(n) - float(margin)))
    return ok


def voxel_index(points: DataFrame) -> DataFrame:
    """Adds the voxel (zi, yi, xi) that holds each point: coordinates rounded half to even."""
    return points.withColumns({f"{c}i": F.rint(F.col(c)).cast("int") for c in "zyx"})


def strided(voxels: DataFrame, step: int) -> DataFrame:
    return voxels.where((F.col("z") % step == 0) & (F.col("y") % step == 0) & (F.col("x") % step == 0))


def without_edge_slices(voxels: DataFrame, depth: int, cut: int) -> DataFrame:
    """Slices cut <= z < depth - cut; a filter on the slice column that reaches the scan."""
    return voxels.where(F.col("z").between(cut, depth - cut - 1))


def central_slices(depth: int, fraction: float, step: int) -> tuple[int, int]:
    """First and one past the last strided slice inside a margin of ``fraction`` of the depth at both ends."""
    margin = round(depth * fraction)
    return math.ceil(margin / step), (depth - margin - 1) // step + 1


def cropped(nodes: DataFrame, radius: int, shape: tuple[int, int, int]) -> DataFrame:
    """Adds patch bounds around each node's voxel, clipped to (z, y, x) sizes, and whether they were cut."""
    rows = voxel_index(nodes)
    for c, n in zip("zyx", shape):
        rows = rows.withColumn(f"{c}0", F.greatest(F.lit(0), F.col(f"{c}i") - radius)).withColumn(f"{c}1", F.least(F.lit(n - 1), F.col(f"{c}i") + radius))
    cut = F.lit(False)
    for c in "zyx":
        cut = cut | (F.col(f"{c}1") - F.col(f"{c}0") < 2 * radius)
    return rows.withColumn("truncated", cut)


def patch_means(nodes: DataFrame, voxels: DataFrame, radius: int) -> DataFrame:
    """``id, voxels, foreground, fraction`` of the cube around each node: a join on coarse cells, then on the cube.

    A node goes to the cells that its cube meets (8 at most), a voxel to its
    own cell, so each pair meets once; an empty patch has fraction 0.
    """
    side = 2 * radius + 1
    cell = lambda c: F.floor(c / F.lit(side)).cast("int")
    at = voxel_index(nodes)
    for c in "zyx":
        at = at.withColumn(f"c{c}", F.explode(F.sequence(cell(F.col(f"{c}i") - radius), cell(F.col(f"{c}i") + radius))))
    vox = voxels.select(*[F.col(c).alias(f"v{c}") for c in "zyx"], F.col("fg").alias("fg"), *[cell(F.col(c)).alias(f"k{c}") for c in "zyx"])
    on = F.lit(True)
    for c in "zyx":
        on = on & (F.col(f"c{c}") == F.col(f"k{c}"))
    near = F.lit(True)
    for c in "zyx":
        near = near & (F.abs(F.col(f"v{c}") - F.col(f"{c}i")) <= radius)
    sums = at.join(vox, on & near).groupBy("id").agg(F.count("*").alias("voxels"), F.count_if("fg").alias("foreground"))
    return nodes.select("id").join(sums, "id", "left").select(
        "id", F.coalesce("voxels", F.lit(0)).alias("voxels"), F.coalesce("foreground", F.lit(0)).alias("foreground"),
        F.coalesce(F.col("foreground") / F.nullif(F.col("voxels").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("fraction"),
    )


def disk_offsets(spark: SparkSession, radius: float, angles: int) -> DataFrame:
    """``ring, ru, rv``: the centre and ceil(radius) rings of ``angles`` points; ring k has radius min(k, radius)."""
    rings = spark.range(0, math.ceil(radius) + 1).select(F.col("id").cast("int").alias("ring"))
    points = rings.withColumn("k", F.explode(F.when(F.col("ring") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(angles - 1)))))
    turn, size = F.lit(2 * math.pi) * F.col("k") / F.lit(angles), F.least(F.col("ring").cast("double"), F.lit(float(radius)))
    return points.select("ring", "k", (size * F.cos(turn)).alias("ru"), (size * F.sin(turn)).alias("rv"))


def corridor(placed: DataFrame, radius: float, angles: int, steps: int, pad: float = 0.2) -> DataFrame:
    """``id, step, t, ring, k, x, y, z``: places along each strut times places across it.

    The places across are a table of fixed size, replicated by an explode; each
    strut makes ``steps * (1 + rings * angles)`` rows.
    """
    spark = placed.sparkSession
    across = [(r.ring, r.k, r.ru, r.rv) for r in disk_offsets(spark, radius, angles).orderBy("ring", "k").collect()]
    offsets = F.array(*[F.struct(F.lit(r).alias("ring"), F.lit(k).alias("k"), F.lit(u).alias("ru"), F.lit(v).alias("rv")) for r, k, u, v in across])
    rows = V.with_basis(placed.select("id", *[f"{e}{c}" for e in "ab" for c in "xyz"]))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))).withColumn("t", F.lit(-pad) + F.lit(1 + 2 * pad) * F.col("step") / F.lit(float(steps - 1)))
    rows = rows.withColumn("o", F.explode(offsets))
    place = lambda c: F.col(f"a{c}") + F.col("t") * (F.col(f"b{c}") - F.col(f"a{c}")) + F.col("o.ru") * F.col(f"e1{c}") + F.col("o.rv") * F.col(f"e2{c}")
    return rows.select("id", "step", "t", "o.ring", "o.k", *[place(c).alias(c) for c in "xyz"])


def sampled(points: DataFrame, voxels: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Adds ``valid`` and ``fg`` of the voxel nearest to each point; null outside, false where no voxel row is."""
    at = voxel_index(points)
    for c, n in zip("zyx", shape):
        at = at.withColumn(f"__{c}", F.col(f"{c}i").between(0, n - 1))
    at = at.withColumn("valid", F.col("__z") & F.col("__y") & F.col("__x")).drop("__z", "__y", "__x")
    # one packed key for the three places; points outside have none
    pack = lambda z, y, x: (F.col(z).cast("long") * shape[1] + F.col(y)) * shape[2] + F.col(x)
    vox = voxels.where(" and ".join(f"{c} between 0 and {n - 1}" for c, n in zip("zyx", shape))).select(pack("z", "y", "x").alias("__at"), F.col("fg").alias("vfg"))
    joined = at.join(vox, F.when(F.col("valid"), pack("zi", "yi", "xi")) == F.col("__at"), "left")
    return joined.withColumn("fg", F.when(F.col("valid"), F.coalesce("vfg", F.lit(False)))).drop("__at", "vfg")


def occupancy(samples: DataFrame, key: str = "id") -> DataFrame:
    """``id, samples, valid, foreground, fraction, contained`` of each corridor; fraction 0 if nothing is valid."""
    return samples.groupBy(key).agg(
        F.count("*").alias("samples"), F.count_if("valid").alias("valid"), F.count_if(F.col("valid") & F.col("fg")).alias("foreground"), F.bool_and("valid").alias("contained")
    ).withColumn("fraction", F.coalesce(F.col("foreground") / F.nullif(F.col("valid").cast("double"), F.lit(0.0)), F.lit(0.0)))


def ring_profile(samples: DataFrame) -> DataFrame:
    """``ring, valid, foreground, probability`` over all corridors."""
    sums = samples.groupBy("ring").agg(F.count_if("valid").alias("valid"), F.count_if(F.col("valid") & F.col("fg")).alias("foreground"))
    return sums.withColumn("probability", F.col("foreground") / F.nullif(F.col("valid").cast("double"), F.lit(0.0)))


def measured_radius(rings: DataFrame, least: float = 0.5) -> DataFrame:
    return rings.agg(F.coalesce(F.max(F.when(F.col("probability") >= least, F.col("ring"))), F.lit(0)).alias("radius"))


def stamped(marks: DataFrame) -> DataFrame:
    """``z, y, x, label``: voxels within each mark's radius, the highest label where marks overlap.

    ``marks``: ``z, y, x, radius`` (int centre) and ``label``; a mark makes the rows of its own box.
    """
    r = F.ceil("radius").cast("int")
    rows = marks
    for c in "zyx":
        rows = rows.withColumn(f"p{c}", F.explode(F.sequence(F.col(c).cast("int") - r, F.col(c).cast("int") + r)))
    d = sum(((F.col(f"p{c}") - F.col(c)) * (F.col(f"p{c}") - F.col(c)) for c in "zyx"), F.lit(0))
    return rows.where(d <= F.col("radius") * F.col("radius")).groupBy(*[F.col(f"p{c}").alias(c) for c in "zyx"]).agg(F.max("label").alias("label"))


def grid_neighbours(voxels: DataFrame, connectivity: int = 26) -> DataFrame:
    """``z, y, x, neighbours`` among the given voxels (6 or 26 around each, itself not counted)."""
    steps = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) != (0, 0, 0) and (connectivity == 26 or abs(a) + abs(b) + abs(c) == 1)]
    moves = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a, b, c in steps])
    near = voxels.select("z", "y", "x", F.explode(moves).alias("m")).select("z", "y", "x", (F.col("z") + F.col("m.a")).alias("vz"), (F.col("y") + F.col("m.b")).alias("vy"), (F.col("x") + F.col("m.c")).alias("vx"))
    other = voxels.select(F.col("z").alias("wz"), F.col("y").alias("wy"), F.col("x").alias("wx"))
    met = near.join(other, (F.col("vz") == F.col("wz")) & (F.col("vy") == F.col("wy")) & (F.col("vx") == F.col("wx")), "left")
    return met.groupBy("z", "y", "x").agg(F.count("wz").alias("neighbours"))


def skeleton_points(voxels: DataFrame) -> DataFrame:
    """One row: voxels, endpoints (one neighbour) and branch points (more than two)."""
    return grid_neighbours(voxels).agg(F.count("*").alias("voxels"), F.count_if(F.col("neighbours") == 1).alias("endpoints"), F.count_if(F.col("neighbours") > 2).alias("branch_points"))


def voxel_edges(voxels: DataFrame, shape: tuple[int, int, int], connectivity: int = 26) -> DataFrame:
    """``u, v`` between packed ids ``(z * ny + y) * nx + x`` of neighbouring voxels, each voxel also with itself."""
    nz, ny, nx = shape
    pack = lambda z, y, x: ((F.col(z).cast("long") * ny + F.col(y)) * nx + F.col(x))
    half = [(a, b, c) for a in (0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) > (0, 0, 0) and (connectivity == 26 or abs(a) + abs(b) + abs(c) == 1)]
    moves = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a, b, c in [(0, 0, 0), *half]])
    near = voxels.select("z", "y", "x", F.explode(moves).alias("m")).select(
        pack("z", "y", "x").alias("u"), (F.col("z") + F.col("m.a")).alias("vz"), (F.col("y") + F.col("m.b")).alias("vy"), (F.col("x") + F.col("m.c")).alias("vx")
    )
    other = voxels.select(F.col("z").alias("wz"), F.col("y").alias("wy"), F.col("x").alias("wx"))
    met = near.join(other, (F.col("vz") == F.col("wz")) & (F.col("vy") == F.col("wy")) & (F.col("vx") == F.col("wx")))
    return met.select("u", pack("wz", "wy", "wx").alias("v"))


def sizes_within(labels: DataFrame, least: int, most: int, label: str = "component") -> DataFrame:
    return labels.groupBy(label).agg(F.count("*").alias("size")).where(F.col("size").between(least, most))


def centroids(voxels: DataFrame, label: str = "component", factor: float = 1.0, offset: float = 0.0) -> DataFrame:
    """Mean place of each label's voxels, scaled and shifted."""
    return voxels.groupBy(label).agg(*[(F.avg(F.col(c).cast("double")) * factor + offset).alias(c) for c in "zyx"], F.count("*").alias("size"))
