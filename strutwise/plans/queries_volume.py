"""Volume queries: histograms, thresholds, masks, windows, neighbours on the grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from strutwise.operators import histogram as H
from strutwise.operators import labelling as B
from strutwise.operators import sampling as P
from strutwise.plans import views as V
from strutwise.plans.catalog import ORACLE_SQL, query
from strutwise.plans.views import SHAPE, with_views
from strutwise.sources.volumes import blocks_of, mask

R = lambda x, name: f"round({x}, 6) + 0.0 AS {name}"

_OTSU = (
    with_views("v_intensity", "v_hist")
    + """, run AS (SELECT bin, c, sum(c) OVER w AS w0, sum(c*bin::BIGINT) OVER w AS s0, sum(c) OVER () AS n, sum(c*bin::BIGINT) OVER () AS s
    FROM v_hist WINDOW w AS (ORDER BY bin ROWS UNBOUNDED PRECEDING)),
score AS (SELECT *, CASE WHEN n > w0 THEN w0::DOUBLE*(n-w0)::DOUBLE*power(s0::DOUBLE/w0-(s-s0)::DOUBLE/(n-w0), 2) ELSE 0 END AS between_ FROM run),
otsu AS (SELECT bin AS threshold, between_/(n::DOUBLE*(SELECT sum(c::DOUBLE*power(bin-(s::DOUBLE/n), 2)) FROM run)) AS separability FROM score ORDER BY between_ DESC, bin LIMIT 1)
"""
)


@query("hist_native", with_views("v_intensity", "v_hist") + "SELECT bin, c FROM v_hist")
def hist_native(spark, d):
    return H.exact_histogram(V.intensities(spark, d))


@query("hist_affine", """WITH s AS (SELECT min(l_extendedprice)::DOUBLE AS lo, max(l_extendedprice)::DOUBLE AS hi FROM lineitem)
SELECT least(65535, greatest(0, round_even((l_extendedprice::DOUBLE-lo)*(65535/(hi-lo)), 0)))::INT AS bin, count(*)::BIGINT AS c FROM lineitem, s GROUP BY 1""")
def hist_affine(spark, d):
    return H.affine_histogram(V.table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("value")))


@query("volume_stats", f"""SELECT {R('min(l_extendedprice)::DOUBLE', 'minimum')}, {R('max(l_extendedprice)::DOUBLE', 'maximum')}, {R('avg(l_extendedprice::DOUBLE)', 'mean')},
count(l_extendedprice)::BIGINT AS finite_count, (count(*)-count(l_extendedprice))::BIGINT AS nonfinite_count FROM lineitem""")
def volume_stats(spark, d):
    return H.volume_stats(V.table(spark, d, "lineitem"), "l_extendedprice")


@query("otsu_threshold", _OTSU + f"SELECT threshold::INT AS threshold, {R('separability', 'separability')} FROM otsu")
def otsu_threshold(spark, d):
    return H.otsu(H.exact_histogram(V.intensities(spark, d)))


@query("otsu_diagnostics", _OTSU + f""", m AS (SELECT threshold, separability, sum(c)::DOUBLE AS n,
  sum(c) FILTER (bin<threshold)::DOUBLE AS w0, sum(c*bin::BIGINT) FILTER (bin<threshold)::DOUBLE AS s0, sum(c::DOUBLE*bin*bin) FILTER (bin<threshold) AS q0,
  sum(c) FILTER (bin>=threshold)::DOUBLE AS w1, sum(c*bin::BIGINT) FILTER (bin>=threshold)::DOUBLE AS s1, sum(c::DOUBLE*bin*bin) FILTER (bin>=threshold) AS q1
  FROM v_hist, otsu GROUP BY ALL),
x AS (SELECT *, s0/w0 AS m0, s1/w1 AS m1, q0/w0-(s0/w0)*(s0/w0) AS v0, q1/w1-(s1/w1)*(s1/w1) AS v1 FROM m),
y AS (SELECT *, abs(m1-m0)/sqrt(greatest((v0+v1)/2, 1e-12)) AS sep FROM x)
SELECT threshold::INT AS threshold, {R('separability', 'separability')}, {R('w1/n', 'foreground_fraction')}, {R('m0', 'background_mean')}, {R('m1', 'foreground_mean')},
  round(v0, 2) + 0.0 AS background_variance, round(v1, 2) + 0.0 AS foreground_variance, {R('sep', 'class_separation')},
  w1/n BETWEEN 0.01 AND 0.35 AS fraction_ok, separability >= 0.45 AS separability_ok, sep >= 0.75 AS separation_ok FROM y""")
def otsu_diagnostics(spark, d):
    hist = H.exact_histogram(V.intensities(spark, d))
    out = H.diagnostics(hist, H.otsu(hist))
    return out.withColumns({c: F.round(c, 2) for c in ("background_variance", "foreground_variance")})


_TAPS = "(SELECT o, exp(-0.5*power(o/2.0::DOUBLE, 2)) AS w FROM (SELECT unnest(generate_series(-8, 8)) AS o))"


@query("intensity_modes", "WITH RECURSIVE " + with_views("v_intensity", "v_hist").removeprefix("WITH ") + f""", g AS (SELECT unnest(generate_series(0, 1023)) AS k),
q AS (SELECT k, coalesce(sum(c), 0)::DOUBLE AS c FROM g LEFT JOIN v_hist ON bin//64=k GROUP BY k),
s AS (SELECT a.k, round(sum(w*q.c)/(SELECT sum(w) FROM {_TAPS}), 9) AS v FROM g a, {_TAPS} t JOIN q ON q.k = CASE WHEN a.k+o<0 THEN -(a.k+o)-1 WHEN a.k+o>1023 THEN 2047-(a.k+o) ELSE a.k+o END GROUP BY a.k),
u AS (SELECT k, v, v IS DISTINCT FROM lag(v) OVER (ORDER BY k) AS opens FROM s), w AS (SELECT k, v, sum(opens::INT) OVER (ORDER BY k) AS run FROM u),
x AS (SELECT run, (min(k)+max(k))//2 AS k, any_value(v) AS v FROM w GROUP BY run), y AS (SELECT *, lag(v) OVER (ORDER BY run) AS l, lead(v) OVER (ORDER BY run) AS r FROM x),
p AS (SELECT k, v, row_number() OVER (ORDER BY v DESC, k DESC) AS i FROM y WHERE v>l AND v>r),
kept AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS ks UNION ALL SELECT p.i, CASE WHEN len(list_filter(ks, lambda z: abs(z-p.k)<8))=0 THEN list_append(ks, p.k) ELSE ks END FROM kept JOIN p ON p.i=kept.i+1),
t AS (SELECT p.k, p.v FROM p WHERE list_contains((SELECT ks FROM kept ORDER BY i DESC LIMIT 1), p.k)),
b AS (SELECT t.k, t.v, coalesce(max(s.k) FILTER (s.k<t.k AND s.v>t.v), -1) AS lo, coalesce(min(s.k) FILTER (s.k>t.k AND s.v>t.v), 1024) AS hi FROM t, s GROUP BY ALL),
m AS (SELECT b.k, b.v, b.v-greatest(min(s.v) FILTER (s.k>lo AND s.k<=b.k), min(s.v) FILTER (s.k>=b.k AND s.k<hi)) AS prominence FROM b, s GROUP BY b.k, b.v)
SELECT (k+0.5)*64 AS mode, {R('v', 'v')}, {R('prominence', 'prominence')} FROM m WHERE prominence >= greatest(1, 0.003*(SELECT max(v) FROM s))""")
def intensity_modes(spark, d):
    return H.intensity_modes(H.exact_histogram(V.intensities(spark, d)))


@query("threshold_replay", f"""SELECT threshold, separability, modes, fraction_ok, separability_ok, separation_ok, modes>=2 AS modes_ok,
CASE WHEN fraction_ok AND separability_ok AND separation_ok AND modes>=2 THEN 'pass' ELSE 'manual_review' END AS gate
FROM ({ORACLE_SQL["otsu_diagnostics"]}), (SELECT count(*)::BIGINT AS modes FROM ({ORACLE_SQL["intensity_modes"]}))""")
def threshold_replay(spark, d):
    return H.replay(H.exact_histogram(V.intensities(spark, d)))


@query("triangle_threshold", with_views("v_intensity", "v_hist") + """, e AS (SELECT min(bin) AS low, max(bin) AS high, max(c) AS top FROM v_hist),
p AS (SELECT *, (SELECT bin FROM v_hist ORDER BY c DESC, bin LIMIT 1) AS peak FROM e),
f AS (SELECT *, peak-low > high-peak AS l, CASE WHEN peak-low > high-peak THEN low ELSE high END AS far FROM p),
s AS (SELECT bin, peak, top::DOUBLE*abs(bin-far)-c::DOUBLE*abs(peak-far) AS d FROM v_hist, f WHERE CASE WHEN l THEN bin<=peak ELSE bin>=peak END)
SELECT bin::INT AS threshold FROM s ORDER BY d DESC, abs(bin-peak) LIMIT 1""")
def triangle_threshold(spark, d):
    return H.triangle(H.exact_histogram(V.intensities(spark, d)))


@query("threshold_sweep", _OTSU + f""", cand AS (SELECT DISTINCT threshold, least(65535, greatest(0, round_even(threshold*(1.0::DOUBLE+o/100.0::DOUBLE), 0)))::INT AS candidate
  FROM otsu, (VALUES (-20),(-10),(0),(10),(20)) t(o))
SELECT candidate, coalesce(sum(c) FILTER (bin>=candidate), 0)::BIGINT AS foreground, {R('coalesce(sum(c) FILTER (bin>=candidate), 0)/(sum(c) FILTER (bin>=threshold))::DOUBLE-1', 'growth')}
FROM v_hist, cand GROUP BY candidate""")
def threshold_sweep(spark, d):
    hist = H.exact_histogram(V.intensities(spark, d))
    return H.threshold_sweep(hist, H.otsu(hist), [-20, -10, 0, 10, 20])


_FG = "value >= (SELECT quantile_disc(value, 0.9) FROM v_voxel)"


def _cut(vox):
    """The 90 % discrete quantile of voxel values, one row."""
    return vox.agg(F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY value)").alias("cut"))


def _mask(spark, d):
    vox = V.voxels(spark, d)
    return vox.join(F.broadcast(_cut(vox))).select("z", "y", "x", "value", (F.col("value") >= F.col("cut")).alias("fg"))


@query("mask_compare", with_views("v_voxel") + f""", m AS (SELECT {_FG} AS o, (x+y+z)%3=0 AS e FROM v_voxel)
SELECT count_if(o)::BIGINT AS foreground, count_if(e)::BIGINT AS expected, count_if(e<>o)::BIGINT AS mismatched, count_if(o AND NOT e)::BIGINT AS false_positives,
count_if(e AND NOT o)::BIGINT AS false_negatives, count_if(e<>o)=0 AS exact_match FROM m""")
def mask_compare(spark, d):
    return H.mask_comparison(_mask(spark, d), (F.col("x") + F.col("y") + F.col("z")) % 3 == 0, F.col("fg"))


@query("masked_mean", with_views("v_voxel") + f"SELECT count(*)::BIGINT AS voxels, {R('avg(value::DOUBLE)', 'mean')}, 'computed' AS status FROM v_voxel WHERE {_FG}")
def masked_mean(spark, d):
    return H.masked_mean(_mask(spark, d), F.col("fg"))


@query("slice_window", with_views("v_voxel") + "SELECT z, count(*)::BIGINT AS voxels, sum(value)::BIGINT AS total FROM v_voxel WHERE z BETWEEN 1 AND 5 GROUP BY z")
def slice_window(spark, d):
    return P.without_edge_slices(V.voxels(spark, d), SHAPE[0], 1).groupBy("z").agg(F.count("*").alias("voxels"), F.sum("value").alias("total"))


@query("downsample", with_views("v_voxel") + "SELECT z, y, x, value FROM v_voxel WHERE z%2=0 AND y%2=0 AND x%2=0")
def downsample(spark, d):
    return P.strided(V.voxels(spark, d), 2)


@query("positions_in_volume", with_views("v_junction") + "SELECT id, (x>=2 AND x<17 AND y>=2 AND y<17 AND z>=2 AND z<17) AS inside FROM v_junction")
def positions_in_volume(spark, d):
    return V.junctions(spark, d).select("id", P.inside((F.col("x"), F.col("y"), F.col("z")), (19, 19, 19), 2).alias("inside"))


@query("nearest_voxel", with_views("v_points", "v_voxel") + """SELECT p.id, round_even(p.z*20+3, 0)::INT AS zi, round_even(p.y*40+16, 0)::INT AS yi, round_even(p.x*40+16, 0)::INT AS xi, v.value
FROM v_points p JOIN v_voxel v ON v.z=round_even(p.z*20+3, 0)::INT AND v.y=round_even(p.y*40+16, 0)::INT AND v.x=round_even(p.x*40+16, 0)::INT""")
def nearest_voxel(spark, d):
    p = V.points(spark, d).select("id", (F.col("z") * 20 + 3).alias("z"), (F.col("y") * 40 + 16).alias("y"), (F.col("x") * 40 + 16).alias("x"))
    vox = V.voxels(spark, d)
    at = P.voxel_index(p).select("id", "zi", "yi", "xi")
    return at.join(vox, (at.zi == vox.z) & (at.yi == vox.y) & (at.xi == vox.x)).select("id", "zi", "yi", "xi", "value")


@query("patch_fraction", with_views("v_voxel") + f""", m AS (SELECT z, y, x, {_FG} AS fg FROM v_voxel),
n AS (SELECT (y*32+x)::BIGINT AS id, 3 AS z, y, x FROM (SELECT DISTINCT y, x FROM v_voxel WHERE y%8=3 AND x%8=5))
SELECT n.id, count(m.z)::BIGINT AS voxels, count_if(coalesce(fg, false))::BIGINT AS foreground, {R('coalesce(count_if(fg)/nullif(count(m.z), 0)::DOUBLE, 0)', 'fraction')}
FROM n LEFT JOIN m ON abs(m.z-n.z)<=2 AND abs(m.y-n.y)<=2 AND abs(m.x-n.x)<=2 GROUP BY n.id""")
def patch_fraction(spark, d):
    vox = _mask(spark, d)
    nodes = vox.where("y % 8 = 3 and x % 8 = 5").select((F.col("y") * 32 + F.col("x")).cast("long").alias("id"), F.lit(3.0).alias("z"), F.col("y").cast("double").alias("y"), F.col("x").cast("double").alias("x")).distinct()
    return P.patch_means(nodes, vox, 2)


@query("stamp_raster", """WITH m AS (SELECT DISTINCT (s_suppkey%23)::INT AS z, (s_suppkey%29)::INT AS y, (s_suppkey%31)::INT AS x, (s_suppkey%3+1)::DOUBLE AS radius, (s_suppkey%4)::INT AS label FROM supplier),
o AS (SELECT unnest(generate_series(-3, 3)) AS k)
SELECT (z+a.k)::INT AS z, (y+b.k)::INT AS y, (x+c.k)::INT AS x, max(label)::INT AS label FROM m, o a, o b, o c WHERE a.k*a.k+b.k*b.k+c.k*c.k <= radius*radius GROUP BY ALL""")
def stamp_raster(spark, d):
    k = F.col("s_suppkey")
    marks = V.table(spark, d, "supplier").select(*[(k % n).cast("int").alias(c) for n, c in ((23, "z"), (29, "y"), (31, "x"))], (k % 3 + 1).cast("double").alias("radius"), (k % 4).cast("int").alias("label")).distinct()
    return P.stamped(marks)


_WHOLE = f"(SELECT z, y, x FROM v_voxel WHERE {_FG})"


def _whole(spark, d):
    return _mask(spark, d).where("fg").select("z", "y", "x")


@query("skeleton_degree", with_views("v_voxel") + f""", t AS {_WHOLE},
n AS (SELECT a.z, a.y, a.x, count(b.z) AS k FROM t a LEFT JOIN t b ON abs(a.z-b.z)<=1 AND abs(a.y-b.y)<=1 AND abs(a.x-b.x)<=1 AND NOT (a.z=b.z AND a.y=b.y AND a.x=b.x) GROUP BY ALL)
SELECT count(*)::BIGINT AS voxels, count_if(k=1)::BIGINT AS endpoints, count_if(k>2)::BIGINT AS branch_points FROM n""")
def skeleton_degree(spark, d):
    return B.skeleton_points(B.cell_parts(_whole(spark, d), SHAPE, 4), 4)


@query("thinned_mask")
def thinned_mask(spark, d):
    """The mask's skeleton, cell by cell: no SQL can state it, so a test compares it with the kernel on the whole array."""
    return B.part_cells(B.thinned_parts(B.cell_parts(_whole(spark, d), SHAPE, 8), 8), "u1").select("z", "y", "x")


_LABELS = (
    "WITH RECURSIVE " + f"v_voxel AS ({V.SQL['v_voxel']})" + f""", t AS (SELECT z, y, x, ((z::BIGINT*32+y)*32+x) AS id FROM {_WHOLE}),
e AS (SELECT a.id AS u, b.id AS v FROM t a JOIN t b ON abs(a.z-b.z)<=1 AND abs(a.y-b.y)<=1 AND abs(a.x-b.x)<=1),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v=e.u),
lab AS (SELECT u AS node, min(v) AS component FROM r GROUP BY u)
"""
)


@query("components_26", _LABELS + "SELECT node, component FROM lab")
def components_26(spark, d):
    return B.component_cells(_labels(spark, d), SHAPE)


def _labels(spark, d):
    """Components of the mask in parts of 4 cells, so that most of them go on from part to part."""
    return B.labelled(B.cell_parts(_whole(spark, d), SHAPE, 4), SHAPE)


@query("component_filter", _LABELS + "SELECT component, count(*)::BIGINT AS size FROM lab GROUP BY component HAVING count(*) BETWEEN 2 AND 99")
def component_filter(spark, d):
    return B.component_sums(_labels(spark, d)).where(F.col("size").between(2, 99)).select("component", "size")


@query("label_centroids", _LABELS + f"""SELECT component, {R('avg(t.z::DOUBLE)*2+1', 'z')}, {R('avg(t.y::DOUBLE)*2+1', 'y')}, {R('avg(t.x::DOUBLE)*2+1', 'x')}, count(*)::BIGINT AS size
FROM lab JOIN t ON lab.node=t.id GROUP BY component""")
def label_centroids(spark, d):
    sums = B.component_sums(_labels(spark, d))
    return sums.select("component", *[(F.col(c) / F.col("size") * 2 + 1).alias(c) for c in "zyx"], "size")


_TRUE = with_views("v_voxel") + f""", t AS {_WHOLE},
g AS (SELECT z::INT AS z, y::INT AS y, x::INT AS x FROM (SELECT unnest(generate_series(0, {SHAPE[0] - 1})) AS z), (SELECT unnest(generate_series(0, {SHAPE[1] - 1})) AS y), (SELECT unnest(generate_series(0, {SHAPE[2] - 1})) AS x)),
f AS (SELECT * FROM g ANTI JOIN t USING (z, y, x))
"""


@query("distance_transform", _TRUE + "SELECT t.z, t.y, t.x, min((t.z-f.z)*(t.z-f.z)+(t.y-f.y)*(t.y-f.y)+(t.x-f.x)*(t.x-f.x))::BIGINT AS value FROM t, f GROUP BY ALL")
def distance_transform(spark, d):
    return B.part_cells(B.squared_distances(B.cell_parts(_whole(spark, d), SHAPE, 4), SHAPE, 4))


@query("background_distance", _TRUE + """SELECT value, count(*)::BIGINT AS cells FROM (SELECT min((t.z-f.z)*(t.z-f.z)+(t.y-f.y)*(t.y-f.y)+(t.x-f.x)*(t.x-f.x))::BIGINT AS value FROM f, t GROUP BY f.z, f.y, f.x) GROUP BY value""")
def background_distance(spark, d):
    full = blocks_of(_whole(spark, d).withColumn("value", F.lit(1)), SHAPE, "u1", 3)
    empty = B.mask_parts(mask(full, 1, below=True), 1, size=8)
    return B.part_cells(B.squared_distances(empty, SHAPE, 8)).groupBy("value").agg(F.count("*").alias("cells"))


@query("central_window", with_views("v_voxel") + "SELECT z, sum(value)::BIGINT AS total FROM v_voxel WHERE z%2=0 AND z/2.0 >= 1 AND z/2.0 < 3 GROUP BY z")
def central_window(spark, d):
    first, stop = P.central_slices(SHAPE[0], 0.15, 2)
    return P.strided(V.voxels(spark, d).withColumn("y", F.lit(0)).withColumn("x", F.lit(0)), 2).where(F.col("z").between(first * 2, (stop - 1) * 2)).groupBy("z").agg(F.sum("value").alias("total"))
