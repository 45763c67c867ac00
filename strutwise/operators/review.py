"""Smaller operators: endpoint widening, evidence, verification, exports, remaps, searches."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strutwise.operators.neighbours import nearest_spots, spots_of
from strutwise.operators.selection import linear_quantiles
from strutwise.sources.storage import stored


#: Entries of a document that travel as one text.
ENTRIES = 64


def topology_json(junctions: DataFrame, struts: DataFrame, cells: DataFrame) -> DataFrame:
    """One row ``topology_sha256, junctions, struts, cells`` of one lattice document.

    SHA-256 of compact JSON with sorted junction ids, ``[id, lower end, higher
    end]`` of struts and ``[id, sorted members]`` of unit cells; places don't
    count. Entries are sorted by ranges and put together side by side; a digest
    runs over all of them in turn, so one task streams the pieces past it and
    holds a batch of them at a time.
    """
    zero, member = F.lit(0).cast("long"), F.array_join(F.sort_array("struts").cast("array<string>"), ",")
    low, high, k = F.least("junction0", "junction1").cast("long"), F.greatest("junction0", "junction1").cast("long"), F.col("id").cast("long")
    entry = lambda df, part, u, v, text: df.select(F.lit(part).alias("part"), k.alias("id"), u.alias("u"), v.alias("v"), text.alias("entry"))
    rows = entry(junctions, 0, zero, zero, k.cast("string"))
    rows = rows.unionByName(entry(struts, 1, low, high, F.concat(F.lit("["), k, F.lit(","), low, F.lit(","), high, F.lit("]"))))
    rows = rows.unionByName(entry(cells, 2, zero, zero, F.concat(F.lit("["), k, F.lit(",["), member, F.lit("]]"))))

    def pieces(frames):
        for f in frames:
            out = []
            for part, own in f.groupby("part"):
                for at in range(0, len(own), ENTRIES):
                    some = own.iloc[at : at + ENTRIES]
                    known = some["entry"].dropna()
                    out.append((part, int(some["at"].iloc[0]), len(some), ",".join(known) if len(known) else None))
            yield pd.DataFrame(out, columns=["part", "at", "n", "piece"])

    def digest(frames):
        names, counts, sha, now = ('{"junction_ids":[', '],"struts":[', '],"unit_cells":['), [0, 0, 0], hashlib.sha256(), -1
        bare = True
        for f in frames:
            for part, n, piece in zip(f["part"], f["n"], f["piece"]):
                while now < part:
                    now, bare = now + 1, True
                    sha.update(names[now].encode())
                if part >= 0:
                    counts[part] += int(n)
                    if piece is not None:
                        sha.update((piece if bare else "," + piece).encode())
                        bare = False
        sha.update(("".join(names[now + 1 :]) + "]}").encode())
        yield pd.DataFrame([(sha.hexdigest(), *counts)], columns=["topology_sha256", "junctions", "struts", "cells"])

    order, form = ["part", "id", "u", "v", "entry"], "part int, at long, n long, piece string"
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    told = stored(placed.select("part", "at", "entry").mapInPandas(pieces, form), "topology")
    # an entry of no part, so that the document of three empty tables has a row too
    told = told.unionByName(told.sparkSession.range(1).select(F.lit(-1).alias("part"), F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("piece")))
    # one task takes the ranges one after the other, each sorted by itself
    return told.repartitionByRange("at").sortWithinPartitions("at").coalesce(1).mapInPandas(digest, "topology_sha256 string, junctions long, struts long, cells long")


def widened(rows: DataFrame, key: str, side: str, values: Sequence[str]) -> DataFrame:
    """Two rows per key (sides A and B) as one with ``<value>_a, <value>_b`` and ``complete``: one row of each side, no other."""
    s = F.col(side)
    cols = [F.max(F.when(s == n, F.col(v))).alias(f"{v}_{n.lower()}") for v in values for n in "AB"]
    whole = (F.count("*") == 2) & (F.count_if(s == "A") == 1) & (F.count_if(s == "B") == 1)
    return rows.groupBy(key).agg(*cols, whole.alias("complete"))


def evidence_problems(required: DataFrame, given: DataFrame, key: str = "id") -> DataFrame:
    """``key, problem`` for evidence that is missing, not asked for, or given twice."""
    need, have = required.select(key).distinct(), given.groupBy(key).agg(F.count("*").alias("n"))
    both = need.withColumn("r", F.lit(1)).join(have, key, "full_outer")
    what = F.when(F.col("n").isNull(), "missing").when(F.col("r").isNull(), "not_required").when(F.col("n") > 1, "repeated")
    return both.select(key, what.alias("problem")).where("problem is not null")


def class_differences(given: DataFrame, recomputed: DataFrame, key: str = "id") -> DataFrame:
    """``key, given, recomputed`` where two classifications differ or one lacks the strut."""
    a = given.select(key, F.col("class").alias("given"))
    b = recomputed.select(key, F.col("class").alias("recomputed"))
    return a.join(b, key, "full_outer").where(~F.col("given").eqNullSafe(F.col("recomputed")))


def yen(hist: DataFrame) -> DataFrame:
    """Yen threshold: the first bin with the largest correlation criterion; no row if no bin has any."""
    # 65,536 rows at most, so one task orders them
    p = hist.where("c > 0").withColumn("p", F.col("c") / F.sum("c").over(Window.partitionBy()))
    up = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    on = Window.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    sums = p.select("bin", F.sum("p").over(up).alias("a"), F.sum(F.col("p") * F.col("p")).over(up).alias("b"), F.sum(F.col("p") * F.col("p")).over(on).alias("d"))
    score = F.round(F.log(F.pow(F.col("a") * (1 - F.col("a")), F.lit(2.0)) / (F.col("b") * F.col("d"))), 9)
    return sums.where("d > 0 and a < 1").select("bin", score.alias("s")).agg(F.max_by("bin", F.struct("s", -F.col("bin"))).alias("threshold")).where("threshold is not null")


def contrast(rows: DataFrame, value: str, low: float = 0.01, high: float = 0.997) -> DataFrame:
    """Adds ``shade``: 0 to 255 between two quantiles, cut off beyond them; 0 where they are equal."""
    found = linear_quantiles(rows.select(F.col(value).alias("__value")), "__value", [low, high], [])
    ends = rows.sparkSession.range(1).join(found, how="left").select(F.get("at", F.lit(0)).alias("__low"), F.get("at", F.lit(1)).alias("__high"))
    share = (F.col(value) - F.col("__low")) / F.nullif(F.col("__high") - F.col("__low"), F.lit(0.0))
    shade = F.coalesce(F.floor(F.round(255 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)), 6)), F.lit(0)).cast("int")
    return rows.join(F.broadcast(ends)).withColumn("shade", shade).drop("__low", "__high")  # one row of ends


def component_summary(labels: DataFrame, small: int, label: str = "component") -> DataFrame:
    """One row: components, share of voxels in the largest, share in components below ``small`` voxels."""
    sizes = labels.groupBy(label).agg(F.count("*").alias("n"))
    total = F.nullif(F.sum("n").cast("double"), F.lit(0.0))
    return sizes.agg(F.count("*").alias("components"), (F.max("n") / total).alias("largest_share"), (F.sum(F.when(F.col("n") < small, F.col("n")).otherwise(0)) / total).alias("small_share"))


def node_errors(found: DataFrame, truth: DataFrame) -> DataFrame:
    """One row of distances between nodes of equal id: mean, median, p95, p99, largest, and mean signed error by axis."""
    t = truth.select("id", *[F.col(c).alias(f"t{c}") for c in "xyz"])
    diff = found.join(t, "id").select(*[(F.col(c) - F.col(f"t{c}")).alias(f"d{c}") for c in "xyz"])
    size = diff.withColumn("e", F.sqrt(sum((F.col(f"d{c}") * F.col(f"d{c}") for c in "xyz"), F.lit(0.0))))
    size = stored(size, "errors")
    at = linear_quantiles(size, "e", [0.5, 0.95, 0.99], []).select("at")
    sums = size.agg(F.count("*").alias("n"), F.avg("e").alias("mean"), F.max("e").alias("largest"), *[F.avg(f"d{c}").alias(f"bias_{c}") for c in "xyz"])
    return sums.join(at, how="left").select("n", "mean", *[F.get("at", F.lit(k)).alias(n) for k, n in enumerate(("median", "p95", "p99"))], "largest", *[f"bias_{c}" for c in "xyz"])  # one row each


def scale_search(sources: DataFrame, targets: DataFrame, scales: Sequence[float], cell: float | None = None) -> DataFrame:
    """``scale, n, mean, largest`` of nearest distances for each trial scale, with ``best`` on the least mean (the least scale of equals).

    Sources at one place look once, for all of them. Cells are sized by the
    targets' number unless given: in cells of a fixed size every source would
    meet a share of all targets.
    """
    trial = F.explode(F.array(*[F.lit(float(s)) for s in scales]))
    moved = sources.select(*"xyz", trial.alias("scale")).select("scale", *[(F.col(c) * F.col("scale")).alias(c) for c in "xyz"])
    places = moved.groupBy("scale", *"xyz").agg(F.count("*").alias("times"))
    spots, size = spots_of(targets)
    if size is None:
        found = places.select("scale", "times", F.lit(0.0).alias("distance")).limit(0)
    else:
        found = nearest_spots(places, spots, cell or size, ["scale", "times"])
    sums = found.groupBy("scale").agg(F.sum("times").alias("n"), (F.sum(F.col("distance") * F.col("times")) / F.sum("times")).alias("mean"), F.max("distance").alias("largest"))
    best = sums.agg(F.min(F.struct(F.round("mean", 9).alias("m"), "scale")).alias("b")).select("b.scale")
    return sums.join(best.withColumn("best", F.lit(True)), "scale", "left").withColumn("best", F.coalesce("best", F.lit(False)))


def turned_ids(left: DataFrame, right: DataFrame, matrix: Sequence[Sequence[int]], digits: int = 6) -> DataFrame:
    """``id, match`` of struts that lie on each other after the left ones are turned about the centre of their box.

    Struts (``ax..bz``) are keyed by their two rounded ends in either order. A
    place that several struts share matches all of them; callers that need a
    bijection compare counts. Rows meet by one number, a hash of both ends,
    which sorts fast; the ends decide.
    """
    span = left.agg(*[f(F.least(f"a{c}", f"b{c}") if n == "l" else F.greatest(f"a{c}", f"b{c}")).alias(f"{n}{c}") for c in "xyz" for n, f in (("l", F.min), ("h", F.max))])
    rows = left.join(F.broadcast(span))  # one row
    mid = {c: (F.col(f"l{c}") + F.col(f"h{c}")) / 2 for c in "xyz"}

    def turned(e: str) -> Column:
        d = [F.col(f"{e}{c}") - mid[c] for c in "xyz"]
        return F.struct(*[(F.round(sum((F.lit(float(matrix[i][k])) * d[k] for k in range(3)), F.lit(0.0)) + mid[c], digits) + 0.0).alias(c) for i, c in enumerate("xyz")])

    plain = lambda e: F.struct(*[(F.round(F.col(f"{e}{c}"), digits) + 0.0).alias(c) for c in "xyz"])

    def keyed(df: DataFrame, p: Column, q: Column, name: str) -> DataFrame:
        both = df.select(F.col("id").alias(name), p.alias("p"), q.alias("q")).select(name, F.least("p", "q").alias(f"{name}_low"), F.greatest("p", "q").alias(f"{name}_high"))
        return both.withColumn(f"{name}_key", F.xxhash64(f"{name}_low", f"{name}_high"))

    a, b = keyed(rows, turned("a"), turned("b"), "id"), keyed(right, plain("a"), plain("b"), "match")
    # as ranges: equal ends would become keys that rows are sorted by as well
    same = [F.col(f"id_{e}").between(F.col(f"match_{e}"), F.col(f"match_{e}")) for e in ("low", "high")]
    return a.join(b, [F.col("id_key") == F.col("match_key"), *same]).select("id", "match")


def near_positions(wanted: DataFrame, records: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """``id, n, value``: mean value of the records at each wanted place within a tolerance on every axis.

    Places go to cells of twice the tolerance, records to their own and the
    cells around, so each close pair meets once. Rows that share one place are
    joined once, as their count and sum.
    """
    size = 2 * tolerance
    at = lambda c: F.floor(F.col(c) / size).cast("long")
    near = wanted.select(*"xyz").distinct().select(*"xyz", *[at(c).alias(f"k{c}") for c in "xyz"])
    around = records.groupBy(*[F.col(c).alias(f"r{c}") for c in "xyz"]).agg(F.count("*").alias("n"), F.count("value").alias("m"), F.sum("value").alias("s"))
    for c in "xyz":
        around = around.withColumn(f"k{c}", F.explode(F.sequence(F.floor((F.col(f"r{c}") - tolerance) / size).cast("long"), F.floor((F.col(f"r{c}") + tolerance) / size).cast("long"))))
    close = F.lit(True)
    for c in "xyz":
        close = close & (F.abs(F.col(c) - F.col(f"r{c}")) <= tolerance)
    sums = lambda rows, *by: rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in "nms"])
    spots = sums(near.join(around, [f"k{c}" for c in "xyz"]).where(close), *"xyz")
    found = sums(wanted.select("id", *"xyz").join(spots, [*"xyz"]), "id")
    return found.select("id", "n", (F.col("s") / F.nullif(F.col("m").cast("double"), F.lit(0.0))).alias("value"))


def spaced_slices(counts: list[tuple[int, int]], forced: Sequence[int], wanted: int, spacing: int) -> list[int]:
    """Slices to show: the forced ones, then the fullest at least ``spacing`` apart, then the fullest left.

    ``counts`` are (slice, count) of one volume, a short list on the driver.
    """
    have = {z for z, _ in counts}
    picked = [z for z in dict.fromkeys(forced) if z in have][:wanted]
    ranked = [z for z, n in sorted(counts, key=lambda c: (-c[1], c[0])) if n > 0]
    for z in ranked:
        if len(picked) < wanted and z not in picked and all(abs(z - q) >= spacing for q in picked):
            picked.append(z)
    for z in ranked:
        if len(picked) < wanted and z not in picked:
            picked.append(z)
    return sorted(picked)


def spacing(rows: DataFrame) -> DataFrame:
    """Voxel spacing in millimetres from several metadata sources, the first that has one, and where it came from.

    ``rows``: ``ome, imagej, tag`` (double, null where absent) and ``unit``
    (mm, inch, cm) of the tag.
    """
    factor = F.when(F.col("unit") == "inch", 25.4).when(F.col("unit") == "cm", 10.0).otherwise(1.0)
    tag = F.col("tag") * factor
    return rows.withColumn("spacing", F.coalesce("ome", "imagej", tag)).withColumn("spacing_source", F.when(F.col("ome").isNotNull(), "ome").when(F.col("imagej").isNotNull(), "imagej").when(F.col("tag").isNotNull(), "tag").otherwise("unknown"))


def crop_edges(placed: DataFrame, axis: str, at: float, tolerance: float = 1e-9) -> DataFrame:
    """Struts with an end on or beyond a crop plane."""
    return placed.where((F.col(f"a{axis}") >= at - tolerance) | (F.col(f"b{axis}") >= at - tolerance))


def difference(ids: DataFrame, kept: DataFrame, key: str = "strut_id") -> DataFrame:
    """The distinct ids of the first table that the second lacks; a null id is in neither."""
    return ids.select(key).where(F.col(key).isNotNull()).distinct().join(kept.select(key).distinct(), key, "left_anti")


def viewer_rows(geometry: DataFrame, features: DataFrame, kinds: tuple[str, ...] = ("missing", "broken"), key: str = "strut_id") -> DataFrame:
    """Geometry rows of the struts that features call one of the kinds, with ``class`` and ``minimum_foreground_fraction``."""
    told = features.where(F.col("class").isin(*kinds)).select(key, "class", F.col("minimum").alias("minimum_foreground_fraction"))
    return geometry.join(told, key)


def label_leaks(inputs: DataFrame, labels: DataFrame, stages: DataFrame) -> DataFrame:
    """Inputs (``stage, path, sha256, role``) that a stage may not read, and why.

    ``labels`` has the ``sha256`` and ``kind`` of label files; ``stages`` the
    ``stage, kind`` pairs that are not allowed. An input counts as a kind by
    its content, whatever its path or role is, and by a role of that name.
    """
    by_hash = inputs.join(labels.select("sha256", "kind").distinct(), "sha256").withColumn("reason", F.lit("content"))
    by_role = inputs.withColumn("kind", F.col("role")).withColumn("reason", F.lit("role"))
    found = by_hash.select(*inputs.columns, "kind", "reason").unionByName(by_role.select(*inputs.columns, "kind", "reason"))
    barred = found.join(stages.select("stage", "kind").distinct(), ["stage", "kind"], "left_semi")
    return barred.groupBy(*inputs.columns, "kind").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def stale_inputs(inputs: DataFrame, produced: DataFrame) -> DataFrame:
    """Inputs whose content or role differs from what was produced at that path: ``path, stale, other_role``."""
    made = produced.select("path", F.col("sha256").alias("__hash"), F.col("role").alias("__role"))
    met = inputs.join(made, "path").select("path", (~F.col("sha256").eqNullSafe(F.col("__hash"))).alias("stale"), (~F.col("role").eqNullSafe(F.col("__role"))).alias("other_role"))
    return met.where("stale or other_role")
