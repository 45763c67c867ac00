"""Nearest neighbours and range tests in space by grid cells, exact and without cross joins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strutwise.operators.ranking import numbered
from strutwise.sources.storage import stored

_AROUND = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]


def _cells(points: DataFrame, size: float, around: bool) -> DataFrame:
    at = lambda c, k: f"cast(floor({c} / {float(size)!r}D) as bigint) + {k}L"
    moves = _AROUND if around else [(0, 0, 0)]
    cells = ", ".join(f"named_struct('cx', {at('x', a)}, 'cy', {at('y', b)}, 'cz', {at('z', c)})" for a, b, c in moves)
    return points.withColumn("cell", F.explode(F.expr(f"array({cells})"))).select(*points.columns, "cell.*")


def _square(a: str, b: str):
    return sum(((F.col(f"{a}{c}") - F.col(f"{b}{c}")) * (F.col(f"{a}{c}") - F.col(f"{b}{c}")) for c in "xyz"), F.lit(0.0))


#: Places whose cells (27 each) may be broadcast; more are shuffled.
PLACES = 20_000
#: Spots, counted over all of more than ``PLACES``, that share a spot's cell at most; and cells along the box at most, as a power of 2.
CROWD, FINEST = 8, 30
#: Pairs of a source that still looks and a spot, all of which are compared at last; and a cell that holds every place but for its sign.
PAIRS, WHOLE = 1 << 20, 1e300


def _cell_size(spots: DataFrame) -> float | None:
    """The side of a cell that holds two spots on average, of the box around all; None without spots.

    Where many spots crowd in a part of the box, cells are made smaller, so that
    what a source meets does not grow with their number.
    """
    low_high = [f(c) for c in "xyz" for f in (F.min, F.max)]
    n, *ends = spots.agg(F.count("*"), *low_high).first()
    if not n:
        return None
    spans = [b - a for a, b in zip(ends[::2], ends[1::2]) if b > a]
    if not spans:
        return 1.0
    size = math.prod(s * (2 / n) ** (1 / len(spans)) for s in spans) ** (1 / len(spans))
    while n > PLACES and size > max(spans) / (1 << FINEST):
        own = _cells(spots.select("x", "y", "z"), size, False).groupBy("cx", "cy", "cz").agg(F.count("*").cast("double").alias("n"))
        if own.agg(F.sum(F.col("n") * F.col("n"))).first()[0] <= CROWD * n:
            break
        size /= 3
    return size


_KNOWN = " and ".join(f"coalesce(abs({c}) < double('infinity'), false)" for c in "xyz")


def spots_of(targets: DataFrame) -> tuple[DataFrame, float | None]:
    """Distinct finite places of targets with the least id of each (a stored table), and a cell size for them; None without any."""
    spots = stored(targets.where(_KNOWN).groupBy("x", "y", "z").agg(F.min("id").alias("target")), "spots")
    return spots, _cell_size(spots)


def nearest_spots(left: DataFrame, spots: DataFrame, cell: float, keys: list[str]) -> DataFrame:
    """``keys, x, y, z, target, distance, tx, ty, tz`` for sources ``keys, x, y, z`` (finite, keys unique), as :func:`nearest` finds them.

    Spots are spread over the cells around them as long as they are no more than
    the sources that still look, then the sources; the last few meet all spots.
    More than ``PLACES`` spots are never broadcast: Spark would go by their size
    before they are spread.
    """
    left, done, many, looking = left.where(_KNOWN).select(*keys, "x", "y", "z"), None, spots.count(), None
    while True:
        spread = looking is None or many <= looking
        near = _cells(spots, cell, spread).select("target", *[F.col(c).alias(f"t{c}") for c in "xyz"], "cx", "cy", "cz")
        met = _cells(left, cell, not spread).join(near if many <= PLACES else near.hint("merge"), ["cx", "cy", "cz"], "left")
        best = F.min(F.when(F.col("target").isNotNull(), F.struct(F.sqrt(_square("", "t")).alias("distance"), "target", "tx", "ty", "tz"))).alias("b")
        round_ = stored(met.groupBy(*keys, "x", "y", "z").agg(best), "nearest")
        sure = F.coalesce(F.col("b.distance") <= cell, F.lit(False))
        found = round_.where(sure).select(*keys, "x", "y", "z", "b.target", "b.distance", "b.tx", "b.ty", "b.tz")
        done = found if done is None else done.unionByName(found)
        left = round_.where(~sure).select(*keys, "x", "y", "z")
        looking = left.count()
        if not looking:
            return done
        cell = WHOLE if looking * many <= PAIRS else cell * 3


def nearest(sources: DataFrame, targets: DataFrame, cell: float | None = None) -> DataFrame:
    """``id, target, distance``: the nearest target of each source, the least id among equals.

    Sources look into the 27 cells around their own; a match no farther than
    the cell size (from extent and number of the targets, if not given) is the
    nearest there is. Sources without one look again with three times the size,
    so each round joins fewer rows. Targets that share one place are joined
    once, as their least id. Places that aren't finite take no part. Without
    targets the result is empty.
    """
    spots, size = spots_of(targets)
    if size is None:
        return sources.select("id", F.lit(None).cast("long").alias("target"), F.lit(None).cast("double").alias("distance")).limit(0)
    return nearest_spots(sources, spots, cell or size, ["id"]).select("id", "target", "distance")


def _reach(targets: DataFrame, radius: float) -> DataFrame:
    """Distinct places with all cells of the radius' size that they may be reached from."""
    places = stored(targets.select("x", "y", "z").distinct(), "places")
    reach = _cells(places, radius, True).select(*[F.col(c).alias(f"t{c}") for c in "xyz"], "cx", "cy", "cz")
    return F.broadcast(reach) if places.count() <= PLACES else reach


def within(samples: DataFrame, targets: DataFrame, radius: float) -> DataFrame:
    """The samples that have a target within the radius (a semi join on cells of that size)."""
    reach = _reach(targets, radius)
    own = _cells(samples, radius, False)
    same = [own[c] == reach[c] for c in ("cx", "cy", "cz")]
    d = sum(((own[c] - reach[f"t{c}"]) * (own[c] - reach[f"t{c}"]) for c in "xyz"), F.lit(0.0))
    return own.join(reach, [*same, d <= radius * radius], "left_semi").drop("cx", "cy", "cz")


def empty_tubes(placed: DataFrame, targets: DataFrame, radius: float, samples: int = 9, core: tuple[float, float] = (0.4, 0.6)) -> DataFrame:
    """``id`` of struts none of whose core samples has a target within the radius."""
    low, high = core
    t = F.lit(low) + F.lit(high - low) * F.col("k") / F.lit(float(samples - 1))
    points = placed.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))).select(
        "id", *[(F.col(f"a{c}") + t * (F.col(f"b{c}") - F.col(f"a{c}"))).alias(c) for c in "xyz"]
    )
    own, reach = _cells(points, radius, False), _reach(targets, radius)
    d = sum(((own[c] - reach[f"t{c}"]) * (own[c] - reach[f"t{c}"]) for c in "xyz"), F.lit(0.0))
    met = own.join(reach, [*[own[c] == reach[c] for c in ("cx", "cy", "cz")], d <= radius * radius], "left")
    return met.groupBy("id").agg(F.count("tx").alias("hits")).where("hits = 0").select("id")


def trimmed(distances: DataFrame, share: float, least: int = 4) -> DataFrame:
    """The ceil(n * share) smallest distances (``least`` at least), the least id first among equals."""
    placed, n = numbered(distances, ["distance", "id"], "__place")
    keep = max(min(least, n), -(-int(round(n * share * 1e9)) // 10**9))
    return placed.where(F.col("__place") < keep).drop("__place")


def moment_sums(pairs: DataFrame, *keys: str) -> DataFrame:
    """One row (for each key) of sums from which a similarity transform follows: n, means, products, squares.

    ``pairs``: ``px, py, pz`` (source) and ``qx, qy, qz`` (target).
    """
    one = lambda c: F.sum(F.col(c)).alias(f"s_{c}")
    both = [F.sum(F.col(f"q{a}") * F.col(f"p{b}")).alias(f"s_{a}{b}") for a in "xyz" for b in "xyz"]
    squares = F.sum(sum((F.col(f"p{c}") * F.col(f"p{c}") for c in "xyz"), F.lit(0.0))).alias("s_pp")
    return pairs.groupBy(*keys).agg(F.count("*").alias("n"), *[one(f"{s}{c}") for s in "pq" for c in "xyz"], *both, squares)


#: Picks after which the running distances are written down.
PICKS = 16


def farthest_picks(points: DataFrame, count: int) -> list[tuple[int, float]]:
    """(id, distance) of spread-out picks: first the point nearest the mean, then ever the one farthest from all picked.

    Every point (``id, x, y, z``) is a candidate in every round; the least id
    of equals is picked, and none twice. A round is one pass that keeps one row;
    distances to earlier picks are written down every ``PICKS`` rounds. The
    distance of the first is that to the mean. Fewer points give fewer picks.
    """
    rows = stored(points.where(_KNOWN).select("id", "x", "y", "z", F.lit(float("inf")).alias("gap")), "points")
    mean = rows.agg(*[F.avg(c) for c in "xyz"]).first()
    if mean[0] is None:
        return []
    far = lambda p: F.sqrt(sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip("xyz", p)), F.lit(0.0)))
    best = lambda table, score: table.select("id", "x", "y", "z", score.alias("d")).orderBy(F.desc("d"), "id").first()
    first = best(rows, -far(mean))
    picks, new = [(first.id, -first.d)], [first]
    while len(picks) < count:
        gap = F.least("gap", *[far((p.x, p.y, p.z)) for p in new])
        if len(new) >= PICKS:
            rows, new = stored(rows.withColumn("gap", gap), "points"), []
            gap = F.col("gap")
        found = best(rows.where(~F.col("id").isin([i for i, _ in picks])), gap)
        if found is None:
            break
        picks.append((found.id, found.d))
        new.append(found)
    return picks
