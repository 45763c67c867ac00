"""Column expressions on points and vectors given as three columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]


def vec(prefix: str, suffixes: str = "xyz") -> Vector:
    return tuple(F.col(f"{prefix}{c}") for c in suffixes)


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def minus(a: Vector, b: Vector) -> Vector:
    return tuple(x - y for x, y in zip(a, b))


def scaled(a: Vector, k: Column) -> Vector:
    return tuple(x * k for x in a)


def cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def axis(at: int) -> Vector:
    return tuple(F.lit(1.0 if k == at else 0.0) for k in range(3))


def pick(where: Column, a: Vector, b: Vector) -> Vector:
    return tuple(F.when(where, x).otherwise(y) for x, y in zip(a, b))


def _named(names: str, v: Vector) -> dict[str, Column]:
    return {f"{names}{c}": x for c, x in zip("xyz", v)}


def with_stable_frame(df: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Adds the frame ``xx..xz, yx..yz, zx..zz`` of each segment: z along it, x from the world axis least along z (the first of equals).

    Null for a segment of length 0. Built in steps, so that what is used often
    is computed once and not written out again in every expression.
    """
    out = df.withColumns(_named("__d", minus(vec(b), vec(a))))
    out = out.withColumn("__n", F.nullif(norm(vec("__d")), F.lit(0.0)))
    out = out.withColumns({f"z{c}": F.col(f"__d{c}") / F.col("__n") for c in "xyz"})
    x, y, z = (F.abs(F.col(f"z{c}")) for c in "xyz")
    out = out.withColumn("__k", F.when((x <= y) & (x <= z), 0).when(y <= z, 1).otherwise(2))
    ref = tuple(F.when(F.col("__k") == k, 1.0).otherwise(0.0) for k in range(3))
    out = out.withColumns(_named("__r", ref)).withColumn("__t", dot(vec("__r"), vec("z")))
    out = out.withColumns(_named("__q", minus(vec("__r"), scaled(vec("z"), F.col("__t"))))).withColumn("__m", F.nullif(norm(vec("__q")), F.lit(0.0)))
    out = out.withColumns({f"x{c}": F.col(f"__q{c}") / F.col("__m") for c in "xyz"})
    return out.withColumns(_named("y", cross(vec("z"), vec("x")))).drop(*[f"__{n}{c}" for n in "drq" for c in "xyz"], "__n", "__k", "__t", "__m")


def with_basis(df: DataFrame, a: str = "a", b: str = "b", cut: float = 0.8) -> DataFrame:
    """Adds two unit vectors ``e1x..e1z, e2x..e2z`` across each segment, in steps.

    They start from the x axis, or from the y axis where the direction's x part
    reaches ``cut``; null for a segment of length 0.
    """
    out = df.withColumns(_named("__d", minus(vec(b), vec(a))))
    out = out.withColumn("__n", F.nullif(norm(vec("__d")), F.lit(0.0))).withColumns({f"__u{c}": F.col(f"__d{c}") / F.col("__n") for c in "xyz"})
    steep = F.abs(F.col("__ux")) >= cut
    out = out.withColumns(_named("__r", pick(steep, axis(1), axis(0))))
    out = out.withColumns(_named("__q", cross(vec("__u"), vec("__r")))).withColumn("__m", F.nullif(norm(vec("__q")), F.lit(0.0)))
    out = out.withColumns({f"e1{c}": F.col(f"__q{c}") / F.col("__m") for c in "xyz"})
    return out.withColumns(_named("e2", cross(vec("__u"), vec("e1")))).drop(*[f"__{n}{c}" for n in "durq" for c in "xyz"], "__n", "__m")


def moved(p: Vector, scale: float, rotation, shift) -> Vector:
    """``scale * rotation @ p + shift`` with literal parameters."""
    return tuple(F.lit(float(scale)) * sum((F.lit(float(rotation[i][k])) * p[k] for k in range(3)), F.lit(0.0)) + F.lit(float(shift[i])) for i in range(3))
