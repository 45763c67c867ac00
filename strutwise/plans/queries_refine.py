"""Queries over refined fits and cleaned masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from strutwise.operators import localize as Z
from strutwise.operators import refine as W
from strutwise.plans import views as V
from strutwise.plans.catalog import query
from strutwise.plans.views import SHAPE, with_views
from strutwise.sources.volumes import blocks_of

R = lambda x, name: f"round({x}, 6) + 0.0 AS {name}"
_GRID = f"""g AS (SELECT z::INT AS z, y::INT AS y, x::INT AS x FROM (SELECT unnest(generate_series(0, {SHAPE[0] - 1})) AS z), (SELECT unnest(generate_series(0, {SHAPE[1] - 1})) AS y),
  (SELECT unnest(generate_series(0, {SHAPE[2] - 1})) AS x)), v AS (SELECT z, y, x, coalesce(value, 0) AS value FROM g LEFT JOIN v_voxel USING (z, y, x))"""
_POLICY = W.RefinePolicy(patch=3, search=3.0, weigh=2.5, threshold=8)


def _nodes(spark, d):
    """A place for each part and supplier, inside the voxel view."""
    at = lambda key, shift: [
        (F.col(key) + F.lit(shift)).cast("long").alias("id"), (F.col(key) % 32).cast("double").alias("x"), (F.floor(F.col(key) / F.lit(32.0)).cast("long") % 32 + 0.25).alias("y"), (F.col(key) % 7 - 0.125).alias("z")]
    part, supplier = V.table(spark, d, "part").select(*at("p_partkey", 0)), V.table(spark, d, "supplier").select(*at("s_suppkey", V.SUPPLIERS))
    return part.unionByName(supplier)


_NODES = f"""n AS (SELECT p_partkey::BIGINT AS id, (p_partkey%32)::DOUBLE AS x, floor(p_partkey/32.0)::BIGINT%32+0.25::DOUBLE AS y, p_partkey%7-0.125::DOUBLE AS z FROM part
  UNION ALL SELECT (s_suppkey+{V.SUPPLIERS})::BIGINT, (s_suppkey%32)::DOUBLE, floor(s_suppkey/32.0)::BIGINT%32+0.25::DOUBLE, s_suppkey%7-0.125::DOUBLE FROM supplier)"""


@query("refined_nodes", with_views("v_voxel") + f""", {_GRID}, {_NODES},
c AS (SELECT n.id, n.x AS px, n.y AS py, n.z AS pz, v.z, v.y, v.x, v.value>=8 AS fg FROM n JOIN v ON abs(v.z-round_even(n.z, 0))<=3 AND abs(v.y-round_even(n.y, 0))<=3 AND abs(v.x-round_even(n.x, 0))<=3),
b AS (SELECT a.id, a.z, a.y, a.x, min((a.z-o.z)*(a.z-o.z)+(a.y-o.y)*(a.y-o.y)+(a.x-o.x)*(a.x-o.x)) AS d FROM c a JOIN c o ON o.id=a.id AND a.fg AND NOT o.fg GROUP BY ALL),
e AS (SELECT c.*, CASE WHEN NOT fg THEN 0 ELSE sqrt(d::DOUBLE) END AS depth, (c.z-pz)*(c.z-pz)+(c.y-py)*(c.y-py)+(c.x-px)*(c.x-px) <= 9 AS near FROM c LEFT JOIN b USING (id, z, y, x)),
t AS (SELECT id, z AS tz, y AS ty, x AS tx, CASE WHEN near THEN depth ELSE -1 END AS radius FROM e QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN near THEN coalesce(depth, 1e300) ELSE -1 END DESC, z, y, x)=1),
w AS (SELECT e.*, radius, CASE WHEN near AND (z-tz)*(z-tz)+(y-ty)*(y-ty)+(x-tx)*(x-tx) <= 6.25 THEN power(greatest(depth-(radius-1), 0), 2) ELSE 0 END AS w FROM e JOIN t USING (id)),
s AS (SELECT id, max(radius) AS radius, any_value(px) AS px, any_value(py) AS py, any_value(pz) AS pz, sum(w*x)/nullif(sum(w), 0) AS lx, sum(w*y)/nullif(sum(w), 0) AS ly, sum(w*z)/nullif(sum(w), 0) AS lz FROM w GROUP BY id)
SELECT id, {R('lx', 'lx')}, {R('ly', 'ly')}, {R('lz', 'lz')}, {R('radius', 'radius')}, {R('sqrt((lx-px)*(lx-px)+(ly-py)*(ly-py)+(lz-pz)*(lz-pz))', 'shift')} FROM s""")
def refined_nodes(spark, d):
    return W.peaks_near(_nodes(spark, d), blocks_of(V.voxels(spark, d), SHAPE, "u4", 3), _POLICY)


@query("localized_nodes")
def localized_nodes(spark, d):
    """Where mean shift moves each node; no SQL can state its rounds, so a test compares it with the kernel on the whole array."""
    policy = Z.LocalizePolicy(patch=3, search=3.0, threshold=8)
    found = Z.localized(_nodes(spark, d), blocks_of(V.voxels(spark, d), SHAPE, "u4", 3), SHAPE, policy=policy)
    return found.withColumn("reasons", F.array_join("reasons", ","))


_PAIRS = "p AS (SELECT id, x AS px, y AS py, z AS pz, 2*x-y+1+label*0.01::DOUBLE AS qx, 2*y+z-label*0.02::DOUBLE AS qy, 2*z-x+x*y AS qz FROM v_points)"
_DET = "(sxx*(syy*szz-syz*syz)-sxy*(sxy*szz-syz*sxz)+sxz*(sxy*syz-syy*sxz))"


def _solved(a: str) -> str:
    """Cramer's rule for the row of the map that makes target axis ``a``."""
    tx, ty, tz = (f"t{a}{b}" for b in "xyz")
    return (
        f"({tx}*(syy*szz-syz*syz)-sxy*({ty}*szz-syz*{tz})+sxz*({ty}*syz-syy*{tz}))/{_DET} AS mx, "
        f"(sxx*({ty}*szz-{tz}*syz)-{tx}*(sxy*szz-syz*sxz)+sxz*(sxy*{tz}-{ty}*sxz))/{_DET} AS my, "
        f"(sxx*(syy*{tz}-syz*{ty})-sxy*(sxy*{tz}-{ty}*sxz)+{tx}*(sxy*syz-syy*sxz))/{_DET} AS mz, m{a} AS q"
    )


_AFFINE = with_views("v_points") + f""", {_PAIRS}, m AS (SELECT avg(px) AS cx, avg(py) AS cy, avg(pz) AS cz, avg(qx) AS mx, avg(qy) AS my, avg(qz) AS mz FROM p),
s AS (SELECT any_value(cx) AS cx, any_value(cy) AS cy, any_value(cz) AS cz, any_value(mx) AS mx, any_value(my) AS my, any_value(mz) AS mz,
  {", ".join(f"sum((p{a}-c{a})*(p{b}-c{b})) AS s{a}{b}" for a in "xyz" for b in "xyz" if a <= b)}, {", ".join(f"sum((q{a}-m{a})*(p{b}-c{b})) AS t{a}{b}" for a in "xyz" for b in "xyz")} FROM p, m),
f AS ({" UNION ALL ".join(f"SELECT '{a}' AS axis, cx, cy, cz, {_solved(a)} FROM s" for a in "xyz")}), fit AS (SELECT axis, mx, my, mz, q-mx*cx-my*cy-mz*cz AS shift FROM f)
"""


def _pairs(spark, d):
    x, y, z, label = (F.col(c) for c in ("x", "y", "z", "label"))
    return V.points(spark, d).select(
        "id", x.alias("px"), y.alias("py"), z.alias("pz"), (2 * x - y + 1 + label * F.lit(0.01)).alias("qx"), (2 * y + z - label * F.lit(0.02)).alias("qy"), (2 * z - x + x * y).alias("qz")
    )


@query("affine_fit", _AFFINE + f"SELECT axis, {R('mx', 'mx')}, {R('my', 'my')}, {R('mz', 'mz')}, {R('shift', 'shift')} FROM fit")
def affine_fit(spark, d):
    return W.affine(_pairs(spark, d))


@query("affine_residuals", _AFFINE + f"""SELECT id, {R('sqrt(power(x.mx*px+x.my*py+x.mz*pz+x.shift-qx, 2)+power(y.mx*px+y.my*py+y.mz*pz+y.shift-qy, 2)+power(z.mx*px+z.my*py+z.mz*pz+z.shift-qz, 2))', 'residual')}
FROM p, fit x, fit y, fit z WHERE x.axis='x' AND y.axis='y' AND z.axis='z'""")
def affine_residuals(spark, d):
    pairs = _pairs(spark, d)
    return W.affine_residuals(pairs, W.affine(pairs)).select("id", "residual")


def _lines(spark, d):
    """A segment for each supplier, inside the voxel view."""
    s = F.col("s_suppkey")
    at = lambda k, n, name: ((s * k) % n).cast("double").alias(name)
    return V.table(spark, d, "supplier").select(at(1, 32, "ax"), at(7, 32, "ay"), at(1, 7, "az"), at(5, 32, "bx"), at(3, 32, "by"), at(2, 7, "bz"))


_LINES = """l AS (SELECT (s_suppkey%32)::DOUBLE AS ax, (s_suppkey*7%32)::DOUBLE AS ay, (s_suppkey%7)::DOUBLE AS az, (s_suppkey*5%32)::DOUBLE AS bx, (s_suppkey*3%32)::DOUBLE AS by_, (s_suppkey*2%7)::DOUBLE AS bz FROM supplier),
k AS (SELECT DISTINCT round_even(az+k/19.0::DOUBLE*(bz-az), 0)::INT AS z, round_even(ay+k/19.0::DOUBLE*(by_-ay), 0)::INT AS y, round_even(ax+k/19.0::DOUBLE*(bx-ax), 0)::INT AS x FROM l, (SELECT unnest(generate_series(0, 19)) AS k)),
o AS (SELECT unnest([-1, 0, 1]) AS o), n AS (SELECT DISTINCT z+a.o AS z, y+b.o AS y, x+c.o AS x FROM k, o a, o b, o c),
t AS (SELECT z, y, x, (z*32+y)*32+x AS id FROM v_voxel JOIN n USING (z, y, x) WHERE value >= (SELECT quantile_disc(value, 0.6) FROM v_voxel)),
e AS (SELECT a.id AS u, b.id AS v FROM t a JOIN t b ON abs(a.z-b.z)<=1 AND abs(a.y-b.y)<=1 AND abs(a.x-b.x)<=1),
r AS (SELECT id AS u, id AS v FROM t UNION SELECT e.v, r.v FROM r JOIN e ON r.u=e.u WHERE r.v < e.v), lab AS (SELECT u AS id, min(v) AS part FROM r GROUP BY u)
"""


@query("cleaned_mask", "WITH RECURSIVE " + f"v_voxel AS ({V.SQL['v_voxel']}), " + _LINES + """SELECT z, y, x FROM t JOIN lab USING (id)
WHERE part = (SELECT part FROM lab GROUP BY part ORDER BY count(*) DESC, part LIMIT 1)""")
def cleaned_mask(spark, d):
    vox = V.voxels(spark, d)
    cut = vox.agg(F.expr("percentile_disc(0.6) WITHIN GROUP (ORDER BY value)").alias("cut"))
    cells = vox.join(F.broadcast(cut)).where("value >= cut").select("z", "y", "x")  # one row
    return W.cleaned(cells, _lines(spark, d), SHAPE, reach=1, samples=20, size=4)
