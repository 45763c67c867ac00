"""Queries of the review operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strutwise.operators import histogram as H
from strutwise.operators import neighbours as N
from strutwise.operators import review as R
from strutwise.plans import analyses as A
from strutwise.plans import views as V
from strutwise.plans.queries_graph import _NN, _nearest, _placed
from strutwise.plans.queries_volume import _LABELS, components_26
from strutwise.plans.catalog import query
from strutwise.plans.views import with_views

D = lambda x, name: f"round({x}, 6) + 0.0 AS {name}"


def _cells(spark, d):
    li = V.table(spark, d, "lineitem")
    return li.groupBy(F.col("l_orderkey").cast("long").alias("id")).agg(F.collect_list((F.col("l_partkey") * F.lit(V.STRIDE) + F.col("l_suppkey")).cast("long")).alias("struts"))


@query("topology_hash", with_views("v_strut", "v_junction") + f""", c AS (SELECT l_orderkey::BIGINT AS id, list_sort(list((l_partkey*{V.STRIDE}+l_suppkey)::BIGINT)) AS m FROM lineitem GROUP BY 1)
SELECT sha256('{{"junction_ids":['||(SELECT string_agg(id::VARCHAR, ',' ORDER BY id) FROM v_junction)||'],"struts":['||
(SELECT string_agg('['||id||','||least(junction0, junction1)||','||greatest(junction0, junction1)||']', ',' ORDER BY id) FROM v_strut)||'],"unit_cells":['||
(SELECT string_agg('['||id||',['||array_to_string(m, ',')||']]', ',' ORDER BY id) FROM c)||']}}') AS topology_sha256,
(SELECT count(*) FROM v_junction)::BIGINT AS junctions, (SELECT count(*) FROM v_strut)::BIGINT AS struts, (SELECT count(*) FROM c)::BIGINT AS cells""")
def topology_hash(spark, d):
    return R.topology_json(V.junctions(spark, d), V.struts(spark, d), _cells(spark, d))


@query("endpoint_widening", f"""WITH e AS (SELECT l_orderkey::BIGINT AS strut_id, CASE WHEN l_linenumber%2=1 THEN 'A' ELSE 'B' END AS side, l_quantity::DOUBLE AS q, l_tax::DOUBLE AS t FROM lineitem WHERE l_linenumber<=2)
SELECT strut_id, {D("max(q) FILTER (side='A')", 'q_a')}, {D("max(q) FILTER (side='B')", 'q_b')}, {D("max(t) FILTER (side='A')", 't_a')}, {D("max(t) FILTER (side='B')", 't_b')}, true AS complete
FROM e GROUP BY strut_id HAVING count(*)=2 AND count_if(side='A')=1""")
def endpoint_widening(spark, d):
    rows = V.table(spark, d, "lineitem").where("l_linenumber <= 2").select(
        F.col("l_orderkey").cast("long").alias("strut_id"), F.when(F.col("l_linenumber") % 2 == 1, "A").otherwise("B").alias("side"), F.col("l_quantity").cast("double").alias("q"), F.col("l_tax").cast("double").alias("t"))
    return R.widened(rows, "strut_id", "side", ["q", "t"]).where("complete")


@query("evidence_check", with_views("v_class") + """, g AS (SELECT id, 1 AS k FROM v_class WHERE id%5<>0 AND class IN ('missing','broken') OR id%501=0 UNION ALL SELECT id, 2 FROM v_class WHERE id%7=0 AND id%5<>0 AND class='missing'),
n AS (SELECT id, count(*) AS n FROM g GROUP BY id)
SELECT coalesce(r.id, n.id) AS id, CASE WHEN n.n IS NULL THEN 'missing' WHEN r.id IS NULL THEN 'not_required' ELSE 'repeated' END AS problem
FROM (SELECT id FROM v_class WHERE class IN ('missing','broken')) r FULL JOIN n ON r.id=n.id WHERE n.n IS NULL OR r.id IS NULL OR n.n>1""")
def evidence_check(spark, d):
    c = V.classes(spark, d)
    bad = F.col("class").isin("missing", "broken")
    given = c.where((F.col("id") % 5 != 0) & bad | (F.col("id") % 501 == 0)).select("id").unionAll(c.where((F.col("id") % 7 == 0) & (F.col("id") % 5 != 0) & (F.col("class") == "missing")).select("id"))
    return R.evidence_problems(c.where(bad), given)


@query("verify_classes", with_views("v_class") + """SELECT id, class AS given, CASE WHEN id%41=0 THEN NULL WHEN id%37=0 THEN 'thin' ELSE class END AS recomputed FROM v_class
WHERE id%41=0 OR id%37=0 AND class<>'thin'""".replace("NULL", "'none'"))
def verify_classes(spark, d):
    c = V.classes(spark, d)
    other = c.where("id % 41 <> 0").withColumn("class", F.when(F.col("id") % 37 == 0, "thin").otherwise(F.col("class")))
    return R.class_differences(c, other).select("id", "given", F.coalesce("recomputed", F.lit("none")).alias("recomputed"))


@query("yen_threshold", with_views("v_voxel") + """, h AS (SELECT value AS bin, count(*) AS c FROM v_voxel GROUP BY 1), p AS (SELECT bin, c/(sum(c) OVER ())::DOUBLE AS p FROM h),
s AS (SELECT bin, sum(p) OVER u AS a, sum(p*p) OVER u AS b, sum(p*p) OVER o AS d FROM p WINDOW u AS (ORDER BY bin ROWS UNBOUNDED PRECEDING), o AS (ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT bin::INT AS threshold FROM s WHERE d>0 AND a<1 ORDER BY round(ln(power(a*(1-a), 2)/(b*d)), 9) DESC, bin LIMIT 1""")
def yen_threshold(spark, d):
    return R.yen(H.exact_histogram(V.voxels(spark, d)))


@query("contrast_stretch", with_views("v_voxel") + """, e AS (SELECT quantile_cont(value::DOUBLE, 0.01) AS lo, quantile_cont(value::DOUBLE, 0.997) AS hi FROM v_voxel)
SELECT shade, count(*)::BIGINT AS n FROM (SELECT coalesce(floor(round(255*least(1, greatest(0, (value-lo)/nullif(hi-lo, 0))), 6)), 0)::INT AS shade FROM v_voxel, e) GROUP BY shade""")
def contrast_stretch(spark, d):
    return R.contrast(V.voxels(spark, d), "value").groupBy("shade").agg(F.count("*").alias("n"))


@query("component_summary", _LABELS + f""", z AS (SELECT component, count(*) AS n FROM lab GROUP BY component)
SELECT count(*)::BIGINT AS components, {D('max(n)/sum(n)::DOUBLE', 'largest_share')}, {D('coalesce(sum(n) FILTER (n<27), 0)/sum(n)::DOUBLE', 'small_share')} FROM z""")
def component_summary(spark, d):
    return R.component_summary(components_26(spark, d), 27)


@query("node_errors", with_views("v_points") + f""", e AS (SELECT x*0.01+0.001 AS dx, -y*0.01 AS dy, 0.002::DOUBLE AS dz FROM v_points), s AS (SELECT *, sqrt(dx*dx+dy*dy+dz*dz) AS e FROM e)
SELECT count(*)::BIGINT AS n, {D('avg(e)', 'mean')}, {D('quantile_cont(e, 0.5)', 'median')}, {D('quantile_cont(e, 0.95)', 'p95')}, {D('quantile_cont(e, 0.99)', 'p99')}, {D('max(e)', 'largest')},
{D('avg(dx)', 'bias_x')}, {D('avg(dy)', 'bias_y')}, {D('avg(dz)', 'bias_z')} FROM s""")
def node_errors(spark, d):
    p = V.points(spark, d)
    moved = p.select("id", (F.col("x") * 1.01 + 0.001).alias("x"), (F.col("y") * 0.99).alias("y"), (F.col("z") + 0.002).alias("z"))
    return R.node_errors(moved, p)


@query("scale_search", with_views("v_points") + f""", t AS (SELECT unnest([0.8, 1.0, 1.2])::DOUBLE AS scale), dd AS (SELECT scale, a.id, min(sqrt(power(a.x*scale-b.x, 2)+power(a.y*scale-b.y, 2)+power(a.z*scale-b.z, 2))) AS distance
  FROM v_points a, v_points b, t WHERE a.id%2=0 AND b.id%2=1 GROUP BY scale, a.id), s AS (SELECT scale, count(*)::BIGINT AS n, avg(distance) AS mean, max(distance) AS largest FROM dd GROUP BY scale)
SELECT scale, n, {D('mean', 'mean')}, {D('largest', 'largest')}, scale=(SELECT scale FROM s ORDER BY round(mean, 9), scale LIMIT 1) AS best FROM s""")
def scale_search(spark, d):
    return R.scale_search(V.points(spark, d, 0), V.points(spark, d, 1), [0.8, 1.0, 1.2])


@query("symmetry_remap", with_views("v_strut", "v_junction", "v_placed") + """,
b AS (SELECT (min(least(ax, bx))+max(greatest(ax, bx)))/2 AS mx, (min(least(ay, by_))+max(greatest(ay, by_)))/2 AS my FROM v_placed),
l AS (SELECT id, [mx-(ay-my), my+(ax-mx), az] AS p, [mx-(by_-my), my+(bx-mx), bz] AS q FROM v_placed, b), r AS (SELECT id, [ax, ay, az] AS p, [bx, by_, bz] AS q FROM v_placed)
SELECT l.id, r.id AS match FROM l JOIN r ON least(l.p, l.q)=least(r.p, r.q) AND greatest(l.p, l.q)=greatest(r.p, r.q)""")
def symmetry_remap(spark, d):
    s = _placed(spark, d)
    return R.turned_ids(s, s, ((0, -1, 0), (1, 0, 0), (0, 0, 1)))


@query("position_match", with_views("v_junction") + f"""SELECT w.id, count(*)::BIGINT AS n, {D('avg(j.id%97::DOUBLE)', 'value')}
FROM v_junction w JOIN v_junction j ON round(w.x*1e6)=round(j.x*1e6) AND abs(w.x-j.x)<=1e-8 AND abs(w.y-j.y)<=1e-8 AND abs(w.z-j.z)<=1e-8 GROUP BY w.id""")
def position_match(spark, d):
    j = V.junctions(spark, d)
    return R.near_positions(j, j.select("x", "y", "z", (F.col("id") % 97).cast("double").alias("value")))


@query("crop_edges", with_views("v_strut", "v_junction", "v_placed") + "SELECT id FROM v_placed WHERE ay>=18 OR by_>=18")
def crop_edges(spark, d):
    return R.crop_edges(_placed(spark, d), "y", 18.0).select("id")


@query("missing_geometry", _NN + f""", n AS (SELECT id, distance FROM nn WHERE id%10<>0), s AS (SELECT count(*)::BIGINT AS struts, count_if(coalesce(n.distance>0.06, true))::BIGINT AS ms FROM nn LEFT JOIN n USING (id)),
k AS (SELECT count(*)::BIGINT AS nodes, count_if(nn.distance>0.06)::BIGINT AS mn FROM nn)
SELECT struts, ms AS missing_struts, nodes, mn AS missing_nodes, {D('100*ms/struts::DOUBLE', 'percent_struts')}, {D('100*mn/nodes::DOUBLE', 'percent_nodes')} FROM s, k""")
def missing_geometry(spark, d):
    gaps = _nearest(spark, d).withColumn("distance", F.col("distance"))
    return A.missing_geometry(gaps, gaps, gaps.where("id % 10 <> 0"), gaps, 0.06)


@query("external_cases", f"""WITH c AS (SELECT l_suppkey AS scan, l_linenumber AS geometry, bool_and(l_quantity<=49) AS passed FROM lineitem GROUP BY 1, 2)
SELECT count(DISTINCT scan)::BIGINT AS scans, count(DISTINCT geometry)::BIGINT AS geometries, {D('avg(passed::INT::DOUBLE)', 'share')}, count(DISTINCT scan)>=3 AND count(DISTINCT geometry)>=2 AND avg(passed::INT::DOUBLE)>=0.9 AS sufficient FROM c""")
def external_cases(spark, d):
    li = V.table(spark, d, "lineitem")
    return A.external_cases(li.groupBy(F.col("l_suppkey").alias("scan"), F.col("l_linenumber").alias("geometry")).agg(F.bool_and(F.col("l_quantity") <= 49).alias("passed")))


@query("within_radius", with_views("v_points") + "SELECT DISTINCT a.id::VARCHAR AS sample FROM v_points a, v_points b WHERE a.id%2=0 AND b.id%2=1 AND power(a.x-b.x, 2)+power(a.y-b.y, 2)+power(a.z-b.z, 2)<=0.0016::DOUBLE")
def within_radius(spark, d):
    s = V.points(spark, d, 0).select(F.col("id").cast("string").alias("sample"), "x", "y", "z")
    return N.within(s, V.points(spark, d, 1), 0.04).select("sample")


@query("voxel_spacing", f"""WITH m AS (SELECT p_partkey::BIGINT AS id, CASE WHEN p_partkey%5=0 THEN 0.5::DOUBLE END AS ome, CASE WHEN p_partkey%3=0 THEN 0.25::DOUBLE END AS imagej, CASE WHEN p_partkey%2=0 THEN 0.1::DOUBLE END AS tag,
CASE p_partkey%3 WHEN 0 THEN 'mm' WHEN 1 THEN 'inch' ELSE 'cm' END AS unit FROM part)
SELECT id, {D("coalesce(ome, imagej, tag*CASE unit WHEN 'inch' THEN 25.4 WHEN 'cm' THEN 10 ELSE 1 END, -1)", 'spacing')}, CASE WHEN ome IS NOT NULL THEN 'ome' WHEN imagej IS NOT NULL THEN 'imagej' WHEN tag IS NOT NULL THEN 'tag' ELSE 'unknown' END AS spacing_source FROM m""")
def voxel_spacing(spark, d):
    k = F.col("p_partkey")
    rows = V.table(spark, d, "part").select(
        k.cast("long").alias("id"), F.when(k % 5 == 0, 0.5).alias("ome"), F.when(k % 3 == 0, 0.25).alias("imagej"), F.when(k % 2 == 0, 0.1).alias("tag"), F.when(k % 3 == 0, "mm").when(k % 3 == 1, "inch").otherwise("cm").alias("unit"))
    return R.spacing(rows).select("id", F.coalesce("spacing", F.lit(-1.0)).alias("spacing"), "spacing_source")
