"""Graph, geometry and evaluation queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from strutwise.functions import vectors as X
from strutwise.operators import alignment as A
from strutwise.operators import classify as C
from strutwise.operators import corridors as K
from strutwise.operators import evaluate as E
from strutwise.operators import lattice as L
from strutwise.operators import neighbours as N
from strutwise.operators import sampling as P
from strutwise.operators import spatial as S
from strutwise.plans import analyses as Y
from strutwise.plans import views as V
from strutwise.plans.catalog import query
from strutwise.plans.views import with_views
from strutwise.sources.volumes import blocks_of

R = lambda x, name: f"round({x}, 6) + 0.0 AS {name}"
_PLACED = ("v_strut", "v_junction", "v_placed")
_KINDS = ["missing", "broken", "thin", "present"]


def _placed(spark, d):
    return L.with_endpoints(V.struts(spark, d), V.junctions(spark, d))


def _long(spark, d):
    """Struts that have a length: asked of the ends, since a filter on what follows from them is pushed down as one expression without shared parts."""
    return _placed(spark, d).where("ax <> bx or ay <> by or az <> bz")


@query("edge_endpoints", with_views(*_PLACED) + "SELECT id, junction0, junction1, ax, ay, az, bx, by_ AS by, bz FROM v_placed")
def edge_endpoints(spark, d):
    return _placed(spark, d)


@query("cell_membership", """WITH c AS (SELECT l_orderkey::BIGINT AS cell_id, l_linenumber::BIGINT*100+l_suppkey%100 AS strut_id FROM lineitem)
SELECT cell_id, (row_number() OVER (PARTITION BY cell_id ORDER BY strut_id)-1)::INT AS place, strut_id::BIGINT AS strut_id FROM c""")
def cell_membership(spark, d):
    li = V.table(spark, d, "lineitem")
    cells = li.groupBy(F.col("l_orderkey").cast("long").alias("id")).agg(F.collect_list((F.col("l_linenumber").cast("long") * 100 + F.col("l_suppkey") % 100).cast("long")).alias("struts"))
    return L.membership(cells)


@query("ref_integrity", with_views("v_strut", "v_junction") + """, j AS (SELECT id FROM v_junction WHERE id%7<>0)
SELECT s.id AS strut_id, e AS junction FROM (SELECT id, unnest([junction0, junction1]) AS e FROM v_strut) s WHERE e NOT IN (SELECT id FROM j)""")
def ref_integrity(spark, d):
    return L.unknown_references(V.struts(spark, d), V.junctions(spark, d).where("id % 7 <> 0"))


@query("duplicate_positions", with_views("v_junction") + "SELECT x, y, z, count(*)::BIGINT AS n FROM v_junction GROUP BY x, y, z HAVING count(*)>1")
def duplicate_positions(spark, d):
    return L.duplicates(V.junctions(spark, d), "x", "y", "z")


@query("graph_problems", with_views("v_strut") + """SELECT 0::BIGINT AS repeated_struts, 0::BIGINT AS repeated_junctions,
(SELECT count(*) FROM (SELECT 1 FROM v_strut GROUP BY least(junction0, junction1), greatest(junction0, junction1) HAVING count(*)>1))::BIGINT AS repeated_pairs,
count_if(junction0=junction1)::BIGINT AS self_loops, 0::BIGINT AS unknown_ends FROM v_strut""")
def graph_problems(spark, d):
    return L.problems(V.struts(spark, d), V.junctions(spark, d))


@query("coverage_check", """WITH e AS (SELECT o_orderkey::BIGINT AS id FROM orders), g AS (SELECT DISTINCT l_orderkey::BIGINT AS id FROM lineitem WHERE l_linenumber>=2)
SELECT (SELECT count(*) FROM e WHERE id NOT IN (SELECT id FROM g))::BIGINT AS missing, (SELECT count(*) FROM g WHERE id NOT IN (SELECT id FROM e))::BIGINT AS extra,
(SELECT array_to_string(list(id ORDER BY id), ',') FROM (SELECT id FROM e WHERE id NOT IN (SELECT id FROM g) ORDER BY id LIMIT 5)) AS first_missing,
coalesce((SELECT array_to_string(list(id ORDER BY id), ',') FROM (SELECT id FROM g WHERE id NOT IN (SELECT id FROM e) ORDER BY id LIMIT 5)), '') AS first_extra,
false AS equal""")
def coverage_check(spark, d):
    e = V.table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("id"))
    g = V.table(spark, d, "lineitem").where("l_linenumber >= 2").select(F.col("l_orderkey").cast("long").alias("id"))
    out = L.coverage(e, g)
    return out.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("first_missing", "first_extra")})


@query("topology_compare", with_views("v_strut") + """, c AS (SELECT id, junction0, CASE WHEN id%13=0 THEN junction1+1 ELSE junction1 END AS junction1 FROM v_strut WHERE id%11<>0)
SELECT (SELECT count(*) FROM v_strut WHERE id%11=0)::BIGINT AS only_nominal, 0::BIGINT AS only_candidate, (SELECT count(*) FROM c WHERE id%13=0)::BIGINT AS changed_ends, false AS equal""")
def topology_compare(spark, d):
    s = V.struts(spark, d)
    return L.topology_differences(s, s.where("id % 11 <> 0").withColumn("junction1", F.col("junction1") + F.when(F.col("id") % 13 == 0, 1).otherwise(0)))


@query("physical_nodes", with_views("v_junction") + "SELECT x, y, z, min(id)::BIGINT AS node, count(*)::BIGINT AS records FROM v_junction GROUP BY x, y, z")
def physical_nodes(spark, d):
    return L.physical_nodes(V.junctions(spark, d))


@query("graph_stats", with_views("v_strut", "v_junction") + """SELECT (SELECT count(*) FROM v_junction)::BIGINT AS junctions, min(j.id)::BIGINT AS junction_low, max(j.id)::BIGINT AS junction_high, count(DISTINCT j.id)::BIGINT AS junction_ids,
(SELECT count(*) FROM v_strut)::BIGINT AS struts, (SELECT min(id) FROM v_strut)::BIGINT AS strut_low, (SELECT max(id) FROM v_strut)::BIGINT AS strut_high, max(j.id)-min(j.id)+1=count(DISTINCT j.id) AS contiguous FROM v_junction j""")
def graph_stats(spark, d):
    return L.graph_stats(V.junctions(spark, d), V.struts(spark, d))


@query("node_degree", with_views("v_strut", "v_class") + """SELECT junction, count(*)::BIGINT AS degree, count_if(class='missing')::BIGINT AS special
FROM (SELECT unnest([junction0, junction1]) AS junction, class FROM v_strut JOIN v_class USING (id)) GROUP BY junction""")
def node_degree(spark, d):
    return L.degrees(V.struts(spark, d).join(V.classes(spark, d).select("id", "class"), "id"), F.col("class") == "missing")


@query("incident_directions", with_views(*_PLACED) + f""", l AS (SELECT *, sqrt((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)+(bz-az)*(bz-az)) AS len FROM v_placed)
SELECT junction0 AS junction, id AS strut_id, {R('(bx-ax)/len', 'ux')}, {R('(by_-ay)/len', 'uy')}, {R('(bz-az)/len', 'uz')} FROM l WHERE len>0
UNION ALL SELECT junction1, id, {R('(ax-bx)/len', 'ux')}, {R('(ay-by_)/len', 'uy')}, {R('(az-bz)/len', 'uz')} FROM l WHERE len>0""")
def incident_directions(spark, d):
    return L.incident_directions(_placed(spark, d))


_FRAME = with_views(*_PLACED) + """, u AS (SELECT id, (bx-ax)/len AS zx, (by_-ay)/len AS zy, (bz-az)/len AS zz FROM (SELECT *, nullif(sqrt((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)+(bz-az)*(bz-az)), 0) AS len FROM v_placed)),
"""


@query("strut_frame", _FRAME + f"""r AS (SELECT *, CASE WHEN abs(zx)<=abs(zy) AND abs(zx)<=abs(zz) THEN 1.0::DOUBLE ELSE 0 END AS rx,
 CASE WHEN abs(zx)<=abs(zy) AND abs(zx)<=abs(zz) THEN 0.0::DOUBLE WHEN abs(zy)<=abs(zz) THEN 1 ELSE 0 END AS ry,
 CASE WHEN abs(zx)<=abs(zy) AND abs(zx)<=abs(zz) THEN 0.0::DOUBLE WHEN abs(zy)<=abs(zz) THEN 0 ELSE 1 END AS rz FROM u WHERE zx IS NOT NULL),
p AS (SELECT *, rx*zx+ry*zy+rz*zz AS dt FROM r), q AS (SELECT *, rx-dt*zx AS qx, ry-dt*zy AS qy, rz-dt*zz AS qz FROM p),
n AS (SELECT *, sqrt(qx*qx+qy*qy+qz*qz) AS qn FROM q), x AS (SELECT *, qx/qn AS xx, qy/qn AS xy, qz/qn AS xz FROM n)
SELECT id, {R('xx', 'xx')}, {R('xy', 'xy')}, {R('xz', 'xz')}, {R('zy*xz-zz*xy', 'yx')}, {R('zz*xx-zx*xz', 'yy')}, {R('zx*xy-zy*xx', 'yz')}, {R('zx', 'zx')}, {R('zy', 'zy')}, {R('zz', 'zz')} FROM x""")
def strut_frame(spark, d):
    return X.with_stable_frame(_long(spark, d)).select("id", *[f"{n}{c}" for n in "xyz" for c in "xyz"])


@query("perp_basis", _FRAME + f"""c AS (SELECT *, CASE WHEN abs(zx)>=0.8 THEN -zz ELSE 0.0::DOUBLE END AS ex, CASE WHEN abs(zx)>=0.8 THEN 0.0::DOUBLE ELSE zz END AS ey,
 CASE WHEN abs(zx)>=0.8 THEN zx ELSE -zy END AS ez FROM u WHERE zx IS NOT NULL), n AS (SELECT *, sqrt(ex*ex+ey*ey+ez*ez) AS en FROM c),
e AS (SELECT *, ex/en AS fx, ey/en AS fy, ez/en AS fz FROM n)
SELECT id, {R('fx', 'e1x')}, {R('fy', 'e1y')}, {R('fz', 'e1z')}, {R('zy*fz-zz*fy', 'e2x')}, {R('zz*fx-zx*fz', 'e2y')}, {R('zx*fy-zy*fx', 'e2z')} FROM e""")
def perp_basis(spark, d):
    return X.with_basis(_long(spark, d)).select("id", *[f"e{n}{c}" for n in "12" for c in "xyz"])


# corridors around all struts that have a length, in the 19**3 grid of junction places
_CORRIDOR = _FRAME + """k AS (SELECT p.*, u.zx, u.zy, u.zz FROM v_placed p JOIN u USING (id) WHERE u.zx IS NOT NULL),
c AS (SELECT *, CASE WHEN abs(zx)>=0.8 THEN -zz ELSE 0.0::DOUBLE END AS ex, CASE WHEN abs(zx)>=0.8 THEN 0.0::DOUBLE ELSE zz END AS ey, CASE WHEN abs(zx)>=0.8 THEN zx ELSE -zy END AS ez FROM k),
e AS (SELECT *, ex/sqrt(ex*ex+ey*ey+ez*ez) AS fx, ey/sqrt(ex*ex+ey*ey+ez*ez) AS fy, ez/sqrt(ex*ex+ey*ey+ez*ez) AS fz FROM c),
o AS (SELECT 0 AS ring, 0 AS k, 0.0::DOUBLE AS ru, 0.0::DOUBLE AS rv UNION ALL
  SELECT r, a, least(r::DOUBLE, 1.5)*cos(2*pi()*a/6.0::DOUBLE), least(r::DOUBLE, 1.5)*sin(2*pi()*a/6.0::DOUBLE) FROM (SELECT unnest([1,2]) AS r), (SELECT unnest(generate_series(0,5)) AS a)),
s AS (SELECT unnest(generate_series(0,8)) AS step),
pts AS (SELECT id, step::INT AS step, (-0.2::DOUBLE+1.4::DOUBLE*step/8.0::DOUBLE) AS t, ring::INT AS ring, o.k::INT AS k,
  ax+(-0.2::DOUBLE+1.4::DOUBLE*step/8.0::DOUBLE)*(bx-ax)+ru*fx+rv*(zy*fz-zz*fy) AS x, ay+(-0.2::DOUBLE+1.4::DOUBLE*step/8.0::DOUBLE)*(by_-ay)+ru*fy+rv*(zz*fx-zx*fz) AS y,
  az+(-0.2::DOUBLE+1.4::DOUBLE*step/8.0::DOUBLE)*(bz-az)+ru*fz+rv*(zx*fy-zy*fx) AS z FROM e, o, s)
"""
_SAMPLES = _CORRIDOR + """, w AS (SELECT *, round_even(round(x, 6), 0)::INT AS xi, round_even(round(y, 6), 0)::INT AS yi, round_even(round(z, 6), 0)::INT AS zi FROM pts),
smp AS (SELECT *, xi BETWEEN 0 AND 18 AND yi BETWEEN 0 AND 18 AND zi BETWEEN 0 AND 18 AS valid, (xi*7+yi*5+zi*3)%4=0 AS fg FROM w)
"""


def _corridor(spark, d):
    return P.corridor(_long(spark, d), 1.5, 6, 9)


def _corridors(spark, d):
    """The counts of all corridors in the grid as a volume."""
    cells = _grid19(spark).select("z", "y", "x", F.col("fg").cast("int").alias("value"))
    return K.corridors(_placed(spark, d), blocks_of(cells, (19, 19, 19), "u1", 19), (19, 19, 19), 1, 1.5, 6, 9)


def _grid19(spark):
    """A volume that junctions and corridors lie in, as rows."""
    grid = spark.range(19 * 19 * 19).select((F.col("id") % 19).cast("int").alias("x"), (F.floor(F.col("id") / 19) % 19).cast("int").alias("y"), F.floor(F.col("id") / 361).cast("int").alias("z"))
    return grid.withColumn("fg", (F.col("x") * 7 + F.col("y") * 5 + F.col("z") * 3) % 4 == 0)


# every coordinate takes part: the extent of each ring of each corridor, and of its ends along the axis
@query("corridor_coords", _CORRIDOR + f"SELECT id, ring, count(*)::BIGINT AS samples, {R('min(t)', 'low_t')}, {R('max(t)', 'high_t')}, "
       + ", ".join(f"{R(f'min({c})', 'low_' + c)}, {R(f'max({c})', 'high_' + c)}, {R(f'sum({c}*(1+k))', 'sum_' + c)}" for c in "xyz") + " FROM pts GROUP BY id, ring")
def corridor_coords(spark, d):
    return K.extents(_long(spark, d), 1.5, 6, 9)


@query("corridor_sample", _SAMPLES + f"""SELECT id, count(*)::BIGINT AS samples, count_if(valid)::BIGINT AS valid, count_if(valid AND fg)::BIGINT AS foreground, bool_and(valid) AS contained,
{R('coalesce(count_if(valid AND fg)/nullif(count_if(valid), 0)::DOUBLE, 0)', 'fraction')} FROM smp GROUP BY id""")
def corridor_sample(spark, d):
    return _corridors(spark, d).select("id", "samples", "valid", "foreground", "contained", "fraction")


@query("radial_probability", _SAMPLES + f"SELECT ring, count_if(valid)::BIGINT AS valid, count_if(valid AND fg)::BIGINT AS foreground, {R('count_if(valid AND fg)/nullif(count_if(valid), 0)::DOUBLE', 'probability')} FROM smp GROUP BY ring")
def radial_probability(spark, d):
    return K.ring_profile(_corridors(spark, d))


_MEASURES = _SAMPLES + """, occ AS (SELECT id, bool_and(valid) AS contained, coalesce(count_if(valid AND fg)/nullif(count_if(valid), 0)::DOUBLE, 0) AS fraction FROM smp GROUP BY id),
ring AS (SELECT coalesce(max(ring), 0) AS radius FROM (SELECT ring, count_if(valid AND fg)/nullif(count_if(valid), 0)::DOUBLE AS p FROM smp GROUP BY ring) WHERE p >= 0.5),
mid AS (SELECT id, fraction, (ax+bx)/2 AS mx, (ay+by_)/2 AS my, (az+bz)/2 AS mz FROM v_placed JOIN occ USING (id)),
nt AS (SELECT fraction, ntile(5) OVER (ORDER BY mx, id) AS px, ntile(5) OVER (ORDER BY my, id) AS py, ntile(5) OVER (ORDER BY mz, id) AS pz FROM mid),
md AS (SELECT 'x' AS a, quantile_cont(fraction, 0.5) AS m FROM nt GROUP BY px UNION ALL SELECT 'y', quantile_cont(fraction, 0.5) FROM nt GROUP BY py UNION ALL SELECT 'z', quantile_cont(fraction, 0.5) FROM nt GROUP BY pz),
sp AS (SELECT max(d) AS spread FROM (SELECT max(m)-min(m) AS d FROM md GROUP BY a)),
gr AS (SELECT x, y, z, (x*7+y*5+z*3)%4=0 AS fg FROM (SELECT unnest(generate_series(0, 18)) AS x), (SELECT unnest(generate_series(0, 18)) AS y), (SELECT unnest(generate_series(0, 18)) AS z)),
pa AS (SELECT j.id, coalesce(count_if(fg)/nullif(count(gr.x), 0)::DOUBLE, 0) AS fraction FROM v_junction j LEFT JOIN gr ON abs(gr.x-j.x)<=1 AND abs(gr.y-j.y)<=1 AND abs(gr.z-j.z)<=1 GROUP BY j.id),
ms AS (SELECT (SELECT avg(fraction) FROM pa) AS junction_mean, (SELECT quantile_cont(fraction, 0.5) FROM occ) AS corridor_median, (SELECT avg(contained::INT::DOUBLE) FROM occ) AS contained, radius, spread,
  (SELECT count_if(NOT (x>=0 AND x<19 AND y>=0 AND y<19 AND z>=0 AND z<19)) FROM v_junction) AS outside FROM ring, sp)
"""


@query("registration_gates", _MEASURES + f"""SELECT kind, gate, {R('value', 'value')}, coalesce(passed, false) AS passed FROM (
  SELECT 'image' AS kind, 'junctions_filled' AS gate, junction_mean AS value, junction_mean>=0.2 AS passed FROM ms UNION ALL SELECT 'image', 'corridors_filled', corridor_median, corridor_median>=0.08 FROM ms
  UNION ALL SELECT 'image', 'even_in_space', spread, spread<=0.25 FROM ms UNION ALL SELECT 'image', 'nodes_inside', outside::DOUBLE, outside=0 FROM ms UNION ALL SELECT 'region', 'corridors_inside', contained, contained>=0.99 FROM ms
  UNION ALL SELECT 'metrology', 'radius_measured', radius::DOUBLE, radius>0 FROM ms UNION ALL SELECT 'metrology', 'uncertainty_known', 0.5, true UNION ALL SELECT 'metrology', 'uncertainty_small', 0.5/nullif(radius, 0)::DOUBLE, 0.5/nullif(radius, 0)::DOUBLE<=1 FROM ms)""")
def registration_gates(spark, d):
    grid = _grid19(spark)
    j = V.junctions(spark, d)
    placed = _placed(spark, d)
    patches = P.patch_means(j, grid, 1)
    measures = Y.quality_measures(_corridors(spark, d), patches, placed, j, (19, 19, 19))
    return Y.quality_gates(measures, 0.5, policy=Y.QualityPolicy(least_junction=0.2))


# struts in the voxel view, whose cells of at least the mean are material; corridors of rings 0 to 2, five places along
_SUPPORT = _CORRIDOR.replace("least(r::DOUBLE, 1.5)", "r::DOUBLE").replace("generate_series(0,8)", "generate_series(0,4)").replace("(-0.2::DOUBLE+1.4::DOUBLE*step/8.0::DOUBLE)", "(0.15::DOUBLE+0.7::DOUBLE*step/4.0::DOUBLE)") + f""", cells AS ({V.SQL["v_voxel"]}),
gr AS (SELECT z, y, x, value*(SELECT count(*) FROM cells) >= (SELECT sum(value) FROM cells) AS fg FROM cells),
w AS (SELECT id, step, ring, round_even(round(x, 6), 0)::INT AS xi, round_even(round(y, 6), 0)::INT AS yi, round_even(round(z, 6), 0)::INT AS zi FROM pts),
smp AS (SELECT w.id, step, ring, coalesce(fg, false) AS fg FROM w LEFT JOIN gr ON gr.x=xi AND gr.y=yi AND gr.z=zi),
ax AS (SELECT id, step, bool_or(fg) AS seen, count_if(fg) AS hits, count(*) AS n FROM smp GROUP BY id, step),
runs AS (SELECT id, step, seen, step-row_number() OVER (PARTITION BY id, seen ORDER BY step) AS run FROM ax),
gap AS (SELECT id, max(n) AS gap FROM (SELECT id, run, count(*) AS n FROM runs WHERE NOT seen GROUP BY id, run) GROUP BY id),
occ AS (SELECT id, sum(hits)/sum(n)::DOUBLE AS share, coalesce(any_value(gap), 0)::BIGINT AS gap FROM ax LEFT JOIN gap USING (id) GROUP BY id),
mid AS (SELECT id, share, (ax+bx)/2 AS mx, (ay+by_)/2 AS my, (az+bz)/2 AS mz FROM v_placed JOIN occ USING (id)),
nt AS (SELECT share, ntile(5) OVER (ORDER BY mx, id) AS px, ntile(5) OVER (ORDER BY my, id) AS py, ntile(5) OVER (ORDER BY mz, id) AS pz FROM mid),
sp AS (SELECT """ + ", ".join(f"(SELECT max(m)-min(m) FROM (SELECT quantile_cont(share, 0.5) AS m FROM nt GROUP BY p{c})) AS spread_{c}" for c in "xyz") + """),
pa AS (SELECT j.id, coalesce(count_if(gr.fg), 0) AS hits, (SELECT count(*) FROM (SELECT unnest(generate_series(0, 6)) AS z), (SELECT unnest(generate_series(0, 31)) AS y), (SELECT unnest(generate_series(0, 31)) AS x)
  WHERE abs(z-any_value(j.z))<=1 AND abs(y-any_value(j.y))<=1 AND abs(x-any_value(j.x))<=1) AS n
  FROM v_junction j LEFT JOIN gr ON abs(gr.x-j.x)<=1 AND abs(gr.y-j.y)<=1 AND abs(gr.z-j.z)<=1 GROUP BY j.id),
ds AS (SELECT j.id, min(sqrt((j.x-p.x)*(j.x-p.x)+(j.y-p.y)*(j.y-p.y)+(j.z-p.z)*(j.z-p.z))) AS distance FROM v_junction j, (SELECT DISTINCT x, y, z FROM v_junction WHERE id<1000000000) p WHERE j.id>=1000000000 GROUP BY j.id)
"""


def _solid(spark, d):
    vox = V.voxels(spark, d)
    mean = vox.agg(F.sum("value").alias("total"), F.count("*").alias("n"))
    return vox.join(F.broadcast(mean)).select("z", "y", "x", (F.col("value") * F.col("n") >= F.col("total")).alias("fg"))  # one row


def _supports(spark, d):
    cells = _solid(spark, d).select("z", "y", "x", F.col("fg").cast("int").alias("value"))
    return K.corridors(_placed(spark, d), blocks_of(cells, V.SHAPE, "u1", 7), V.SHAPE, 1, 2, 6, 5, -0.15)


@query("axial_support", _SUPPORT + f"SELECT id, gap AS longest_gap, {R('share', 'share')} FROM occ")
def axial_support(spark, d):
    return _supports(spark, d).select("id", F.col("longest_gap").cast("long").alias("longest_gap"), (F.col("foreground") / F.col("samples")).alias("share"))


@query("image_support", _SUPPORT + f""", pf AS (SELECT hits, coalesce(hits/nullif(n, 0)::DOUBLE, 0) AS fraction FROM pa), cut AS (SELECT quantile_cont(share, 0.75) AS c FROM occ),
rp AS (SELECT ring FROM smp GROUP BY ring HAVING count_if(fg)/count(*)::DOUBLE >= 0.5)
SELECT (SELECT count(*) FROM pf)::BIGINT AS junctions, (SELECT {R('avg(fraction)', 'a')} FROM pf) AS junction_mean, (SELECT {R('avg((hits>0)::INT::DOUBLE)', 'a')} FROM pf) AS junction_any,
  (SELECT {R('quantile_cont(fraction, 0.5)', 'a')} FROM pf) AS junction_median, (SELECT count(*) FROM ds)::BIGINT AS candidates, (SELECT {R('quantile_cont(distance, 0.5)', 'a')} FROM ds) AS distance_median,
  (SELECT {R('quantile_cont(distance, 0.95)', 'a')} FROM ds) AS distance_p95, (SELECT count(*) FROM occ)::BIGINT AS struts, {", ".join(f"(SELECT {R(f'quantile_cont(share, 0.{k})', 'a')} FROM occ) AS corridor_p{k}0" for k in (1, 5, 9))},
  (SELECT {R('c', 'a')} FROM cut) AS confident_share, (SELECT count_if(share>=c) FROM occ, cut)::BIGINT AS confident, (SELECT {R('avg((gap=5)::INT::DOUBLE)', 'a')} FROM occ) AS unsupported,
  (SELECT coalesce(max(ring), 0) FROM rp)::INT AS radius, {R('spread_x', 'spread_x')}, {R('spread_y', 'spread_y')}, {R('spread_z', 'spread_z')} FROM sp""")
def image_support(spark, d):
    policy = Y.SupportPolicy(1, 2, 6, 5, confident=0.75)
    every = spark.range(V.SHAPE[0] * V.SHAPE[1] * V.SHAPE[2]).select(F.floor(F.col("id") / 1024).cast("int").alias("z"), F.floor(F.col("id") % 1024 / 32).cast("int").alias("y"), (F.col("id") % 32).cast("int").alias("x"))
    whole = every.join(_solid(spark, d), ["z", "y", "x"], "left").withColumn("fg", F.coalesce("fg", F.lit(False)))
    j = V.junctions(spark, d)
    far = N.nearest(j.where(F.col("id") >= V.SUPPLIERS), j.where(F.col("id") < V.SUPPLIERS))
    return Y.image_support(_supports(spark, d), _placed(spark, d), P.patch_means(j, whole, 1), far, policy)


@query("spatial_bias", with_views("v_points") + f""", t AS (SELECT *, ntile(5) OVER (ORDER BY x, id) AS part FROM v_points)
SELECT part::INT AS part, count(*)::BIGINT AS n, {R('quantile_cont(y, 0.5)', 'median')} FROM t GROUP BY part""")
def spatial_bias(spark, d):
    return S.equal_count_bias(V.points(spark, d), "x", "y", "id")


@query("bounds", with_views("v_points") + "SELECT " + ", ".join(f"{R(f'min({c})', 'low_' + c)}, {R(f'max({c})', 'high_' + c)}, {R(f'max({c})-min({c})', 'span_' + c)}" for c in "xyz") + " FROM v_points")
def bounds(spark, d):
    return S.bounds(V.points(spark, d))


@query("axis_thirds", with_views("v_junction") + "".join([
    ", e AS (SELECT min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM v_junction) ",
    " UNION ALL ".join(f"SELECT '{c}' AS axis, CASE WHEN h{c}=l{c} THEN 1 ELSE least(2, greatest(0, floor(3*({c}-l{c})/(h{c}-l{c}))))::INT END::INT AS third, count(*)::BIGINT AS n FROM v_junction, e GROUP BY 1, 2" for c in "xyz"),
]))
def axis_thirds(spark, d):
    return S.thirds(V.junctions(spark, d))


_ROT = ((0.0, -1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0))


@query("similarity_apply", with_views("v_points") + f"SELECT id, {R('12.5::DOUBLE*(-y)+4', 'x')}, {R('12.5::DOUBLE*x+5', 'y')}, {R('12.5::DOUBLE*z+6', 'z')} FROM v_points")
def similarity_apply(spark, d):
    out = X.moved((F.col("x"), F.col("y"), F.col("z")), 12.5, _ROT, (4, 5, 6))
    return V.points(spark, d).select("id", *[v.alias(c) for v, c in zip(out, "xyz")])


@query("umeyama_moments", with_views("v_points") + ", p AS (SELECT id, x AS px, y AS py, z AS pz, 2*x-y+1 AS qx, 2*y+z AS qy, 2*z-x AS qz FROM v_points) SELECT count(*)::BIGINT AS n, "
       + ", ".join(R(f"sum({s}{c})", f"s_{s}{c}") for s in "pq" for c in "xyz") + ", " + ", ".join(R(f"sum(q{a}*p{b})", f"s_{a}{b}") for a in "xyz" for b in "xyz") + f", {R('sum(px*px+py*py+pz*pz)', 's_pp')} FROM p")
def umeyama_moments(spark, d):
    p = V.points(spark, d)
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return N.moment_sums(p.select(x.alias("px"), y.alias("py"), z.alias("pz"), (2 * x - y + 1).alias("qx"), (2 * y + z).alias("qy"), (2 * z - x).alias("qz")))


_NN = with_views("v_points") + """, d AS (SELECT a.id, b.id AS target, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)) AS distance FROM v_points a, v_points b WHERE a.id%2=0 AND b.id%2=1),
nn AS (SELECT id, target, distance FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, target)=1)
"""


def _nearest(spark, d):
    return N.nearest(V.points(spark, d, 0), V.points(spark, d, 1))


@query("nearest_neighbor", _NN + f"SELECT id, target, {R('distance', 'distance')} FROM nn")
def nearest_neighbor(spark, d):
    return _nearest(spark, d)


@query("trimmed_nn", _NN + f"SELECT id, target, {R('distance', 'distance')} FROM nn ORDER BY distance, id LIMIT (SELECT ceil(count(*)*0.7)::BIGINT FROM nn)")
def trimmed_nn(spark, d):
    return N.trimmed(_nearest(spark, d), 0.7)


# two starts of a fit: as it is, and turned a little, grown and moved
_STARTS = {0: (1.0, np.eye(3), np.zeros(3)), 1: (1.1, np.array([[0.8, -0.6, 0.0], [0.6, 0.8, 0.0], [0.0, 0.0, 1.0]]), np.array([0.05, -0.02, 0.01]))}


def _sql_place(k: int) -> str:
    s, r, t = _STARTS[k]
    return ", ".join("+".join([*(f"({float(s * r[a][b])!r}::DOUBLE)*{c}" for b, c in enumerate("xyz")), f"({float(t[a])!r}::DOUBLE)"]) + f" AS m{n}" for a, n in enumerate("xyz"))


@query("fit_round", with_views("v_points") + f""", m AS ({" UNION ALL ".join(f"SELECT {k} AS start, id, x AS px, y AS py, z AS pz, {_sql_place(k)} FROM v_points WHERE id%2=0" for k in _STARTS)}),
d AS (SELECT start, m.id, px, py, pz, b.x AS qx, b.y AS qy, b.z AS qz, sqrt((mx-b.x)*(mx-b.x)+(my-b.y)*(my-b.y)+(mz-b.z)*(mz-b.z)) AS distance FROM m, v_points b WHERE b.id%2=1
  QUALIFY row_number() OVER (PARTITION BY start, m.id ORDER BY distance, b.id)=1),
k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY start ORDER BY distance, id) <= ceil(0.7*count(*) OVER (PARTITION BY start)-1e-9))
SELECT start::INT AS start, count(*)::BIGINT AS n, {R('avg(distance)', 'mean')}, {R('max(distance)', 'cut')}, {R('sum(qx*py)', 's_xy')}, {R('sum(qz*pz)', 's_zz')}, {R('sum(px)', 's_px')}, {R('sum(qy)', 's_qy')},
  {R('sum(px*px+py*py+pz*pz)', 's_pp')} FROM k GROUP BY start""")
def fit_round(spark, d):
    points = V.points(spark, d, 0)
    spots, cell = N.spots_of(V.points(spark, d, 1))
    size = -(-points.count() * 7 // 10)
    return A.round_sums(points, spots, cell, _STARTS, size).select("start", "n", "mean", "cut", "s_xy", "s_zz", "s_px", "s_qy", "s_pp")


@query("holdout_split", with_views("v_points") + """SELECT id, row_number() OVER (ORDER BY ('0x' || substr(md5('5:' || id), 1, 15))::BIGINT) <= greatest(1, round_even(count(*) OVER () * 0.2::DOUBLE, 0)) AS held FROM v_points""")
def holdout_split(spark, d):
    return A.held_out(V.points(spark, d), 0.2, 5).select("id", "held")


@query("farthest_picks", "WITH RECURSIVE " + with_views("v_points").removeprefix("WITH ") + f""", c AS (SELECT avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM v_points),
r AS (SELECT 1 AS k, id, x, y, z, -sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy)+(z-cz)*(z-cz)) AS gap FROM v_points, c
  UNION ALL SELECT k+1, id, x, y, z, CASE WHEN id=pid THEN -1 ELSE least(CASE WHEN k=1 THEN 1e300 ELSE gap END, sqrt((x-px)*(x-px)+(y-py)*(y-py)+(z-pz)*(z-pz))) END
  FROM (SELECT *, first_value(id) OVER w AS pid, first_value(x) OVER w AS px, first_value(y) OVER w AS py, first_value(z) OVER w AS pz FROM r WINDOW w AS (ORDER BY gap DESC, id)) WHERE k < 20)
SELECT k::INT AS pick, id, {R('abs(gap)', 'distance')} FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY gap DESC, id)=1""")
def farthest_picks(spark, d):
    found = N.farthest_picks(V.points(spark, d), 20)
    return spark.createDataFrame([(k + 1, i, float(x)) for k, (i, x) in enumerate(found)], "pick int, id long, distance double")


@query("tube_emptiness", with_views(*_PLACED) + """, s AS (SELECT p.id, ax+(0.4::DOUBLE+0.2::DOUBLE*k/8)*(bx-ax) AS x, ay+(0.4::DOUBLE+0.2::DOUBLE*k/8)*(by_-ay) AS y, az+(0.4::DOUBLE+0.2::DOUBLE*k/8)*(bz-az) AS z
  FROM v_placed p, (SELECT unnest(generate_series(0, 8)) AS k)),
o AS (SELECT unnest([-1, 0, 1]) AS o), t AS (SELECT DISTINCT x, y, z FROM v_junction),
c AS (SELECT t.*, floor(x/0.5)::BIGINT+a.o AS cx, floor(y/0.5)::BIGINT+b.o AS cy, floor(z/0.5)::BIGINT+c.o AS cz FROM t, o a, o b, o c)
SELECT id FROM v_placed WHERE id NOT IN (SELECT s.id FROM s JOIN c ON floor(s.x/0.5)::BIGINT=cx AND floor(s.y/0.5)::BIGINT=cy AND floor(s.z/0.5)::BIGINT=cz
  AND (s.x-c.x)*(s.x-c.x)+(s.y-c.y)*(s.y-c.y)+(s.z-c.z)*(s.z-c.z) <= 0.25::DOUBLE)""")
def tube_emptiness(spark, d):
    return N.empty_tubes(_placed(spark, d), V.junctions(spark, d), 0.5)


# labels go from struts to junctions and back, 40 times: farther than any two struts of these tables are apart
_CLUSTERS = "WITH RECURSIVE " + f"v_strut AS ({V.SQL['v_strut']}), v_class AS ({V.SQL['v_class']})" + """,
f AS (SELECT s.* FROM v_strut s JOIN v_class c USING (id) WHERE c.class<>'present'),
e AS (SELECT id, junction0 AS j FROM f UNION SELECT id, junction1 FROM f),
r AS (SELECT id, id AS cluster, 0 AS turn FROM f UNION ALL
  SELECT e.id, min(l.cluster), any_value(l.turn)+1 FROM e JOIN (SELECT e.j, min(r.cluster) AS cluster, any_value(r.turn) AS turn FROM r JOIN e ON e.id=r.id GROUP BY e.j) l ON e.j=l.j WHERE l.turn<40 GROUP BY e.id),
c AS (SELECT id AS strut_id, cluster FROM r WHERE turn=40)
"""


@query("defect_clusters", _CLUSTERS + "SELECT strut_id, cluster FROM c")
def defect_clusters(spark, d):
    return L.shared_junction_clusters(V.struts(spark, d).join(V.classes(spark, d).where("class <> 'present'").select("id"), "id", "left_semi"))


@query("cluster_sizes", _CLUSTERS + "SELECT cluster, count(*)::BIGINT AS size FROM c GROUP BY cluster")
def cluster_sizes(spark, d):
    return L.cluster_sizes(defect_clusters(spark, d))


@query("class_fractions", with_views("v_class") + f"SELECT k AS class, count(c.id)::BIGINT AS n, {R('count(c.id)/(SELECT count(*) FROM v_class)::DOUBLE', 'fraction')} FROM (SELECT unnest(['missing','broken','thin','present','deferred']) AS k) LEFT JOIN v_class c ON c.class=k GROUP BY k")
def class_fractions(spark, d):
    return S.class_fractions(V.classes(spark, d), [*_KINDS, "deferred"])


@query("median_by_class", with_views("v_class") + f"SELECT class, {R('quantile_cont(quantity, 0.5)', 'median_quantity')}, {R('quantile_cont(price, 0.5)', 'median_price')} FROM v_class GROUP BY class")
def median_by_class(spark, d):
    return S.medians(V.classes(spark, d), "class", ["quantity", "price"])


@query("quantile_summary", with_views("v_class") + "SELECT class, count(price)::BIGINT AS n, " + ", ".join(R(f"quantile_cont(price, {q})", f"p{round(q * 100)}") for q in (0.1, 0.5, 0.9, 0.95, 0.99)) + " FROM v_class GROUP BY class")
def quantile_summary(spark, d):
    return S.quantiles(V.classes(spark, d), "price", (0.1, 0.5, 0.9, 0.95, 0.99), "class")


_PRED = ", p AS (SELECT id, class AS actual, CASE WHEN id%17=0 THEN 'present' WHEN id%19=0 THEN 'broken' ELSE class END AS predicted FROM v_class) "


def _pairs(spark, d):
    return V.classes(spark, d).select("id", F.col("class").alias("actual"), F.when(F.col("id") % 17 == 0, "present").when(F.col("id") % 19 == 0, "broken").otherwise(F.col("class")).alias("predicted"))


@query("confusion_matrix", with_views("v_class") + _PRED + """, k AS (SELECT unnest(['missing','broken','thin','present']) AS c)
SELECT a.c AS actual, b.c AS predicted, count(p.id)::BIGINT AS n FROM k a CROSS JOIN k b LEFT JOIN p ON p.actual=a.c AND p.predicted=b.c GROUP BY a.c, b.c""")
def confusion_matrix(spark, d):
    return E.confusion(_pairs(spark, d), _KINDS)


def _wilson_sql(k: str, n: str, side: str) -> str:
    z = f"{E.Z}::DOUBLE"
    sign, cap = ("-", "greatest(0.0::DOUBLE,") if side == "low" else ("+", "least(1.0::DOUBLE,")
    p = f"({k}/{n}::DOUBLE)"
    return f"{cap} ({p}+{z}*{z}/(2*{n}) {sign} {z}*sqrt({p}*(1-{p})/{n}+{z}*{z}/(4*{n}*{n}::DOUBLE)))/(1+{z}*{z}/{n}))"


@query("detection_recall", with_views("v_class") + _PRED + f""", s AS (SELECT count(*)::BIGINT AS sealed, count_if(predicted='missing')::BIGINT AS strict_hits, count_if(predicted IN ('missing','broken'))::BIGINT AS lenient_hits FROM p WHERE actual='missing')
SELECT *, 0::BIGINT AS unpredicted, {R('strict_hits/sealed::DOUBLE', 'strict_recall')}, {R(_wilson_sql('strict_hits', 'sealed', 'low'), 'strict_low')}, {R(_wilson_sql('strict_hits', 'sealed', 'high'), 'strict_high')},
{R('lenient_hits/sealed::DOUBLE', 'lenient_recall')}, {R(_wilson_sql('lenient_hits', 'sealed', 'low'), 'lenient_low')}, {R(_wilson_sql('lenient_hits', 'sealed', 'high'), 'lenient_high')} FROM s""")
def detection_recall(spark, d):
    p = _pairs(spark, d)
    return E.detection(p.where("actual = 'missing'").select(F.col("id").alias("strut_id")), p.select(F.col("id").alias("strut_id"), F.col("predicted").alias("class")))


@query("wilson", f"""WITH g AS (SELECT quality::INT AS quality, count(*)::BIGINT AS n, sum(toxic)::BIGINT AS k FROM labels WHERE quality IS NOT NULL GROUP BY 1)
SELECT quality, n, k, {R(_wilson_sql('k', 'n', 'low'), 'low')}, {R(_wilson_sql('k', 'n', 'high'), 'high')} FROM g""")
def wilson(spark, d):
    g = V.table(spark, d, "labels").where("quality is not null").groupBy(F.col("quality").cast("int").alias("quality")).agg(F.count("*").alias("n"), F.sum("toxic").cast("long").alias("k"))
    low, high = E.wilson(F.col("k"), F.col("n"))
    return g.withColumn("low", low).withColumn("high", high)


@query("edge_quality", with_views("v_strut", "v_junction") + """, n AS (SELECT id, CASE WHEN id%29=0 THEN 4 WHEN id%23=0 THEN 3 WHEN id%5=0 THEN 2 ELSE 1 END AS r, id%29<>0 AND id%23<>0 AS accepted, (x=0 OR x=18) AS boundary FROM v_junction)
SELECT s.id, ['primary','stable_coarse','fallback','ambiguous'][greatest(a.r, b.r)] AS match_class, NOT a.boundary AND NOT b.boundary AND a.r<4 AND b.r<4 AS usable_for_roi,
a.accepted AND b.accepted AND NOT a.boundary AND NOT b.boundary AS usable_for_metrology FROM v_strut s JOIN n a ON s.junction0=a.id JOIN n b ON s.junction1=b.id""")
def edge_quality(spark, d):
    i = F.col("id")
    nodes = V.junctions(spark, d).select(
        "id", F.when(i % 29 == 0, "ambiguous").when(i % 23 == 0, "fallback").when(i % 5 == 0, "stable_coarse").otherwise("primary").alias("match_class"),
        ((i % 29 != 0) & (i % 23 != 0)).alias("accepted"), ((F.col("x") == 0) | (F.col("x") == 18)).alias("boundary"))
    return C.edge_quality(V.struts(spark, d), nodes)


@query("gate_reduction", """WITH g AS (SELECT l_suppkey::BIGINT AS supplier, bool_and(l_quantity<=50) AS quantity, bool_and(l_discount<0.1) AS discount, bool_and(l_tax<0.09) AS tax FROM lineitem GROUP BY 1)
SELECT supplier, CASE WHEN NOT discount THEN 'halt' WHEN NOT (quantity AND tax) THEN 'manual_review' ELSE 'pass' END AS gate,
array_to_string(list_filter([CASE WHEN NOT discount THEN 'discount' END, CASE WHEN NOT quantity THEN 'quantity' END, CASE WHEN NOT tax THEN 'tax' END], lambda x: x IS NOT NULL), ',') AS failed FROM g""")
def gate_reduction(spark, d):
    li = V.table(spark, d, "lineitem").withColumn("supplier", F.col("l_suppkey").cast("long"))
    return S.gate(li, {"quantity": F.col("l_quantity") <= 50, "discount": F.col("l_discount") < 0.1, "tax": F.col("l_tax") < 0.09}, ["discount"], "supplier")


@query("strut_report", with_views(*_PLACED, "v_class") + f"SELECT p.id, c.class, {R('c.price', 'price')}, p.ax, p.ay, p.az, p.bx, p.by_ AS by, p.bz FROM v_placed p JOIN v_class c USING (id) WHERE c.class='missing' AND c.price>5000")
def strut_report(spark, d):
    return _placed(spark, d).join(V.classes(spark, d).where("class = 'missing' and price > 5000"), "id").select("id", "class", "price", "ax", "ay", "az", "bx", "by", "bz")
