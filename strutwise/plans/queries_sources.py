"""Sources and sinks over whole tables: what was written in a format is read back; and analyses on volumes as block tables."""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import functions as F

from strutwise.operators import classify as C
from strutwise.operators import evaluate as E
from strutwise.operators import registration as G
from strutwise.operators import review as R
from strutwise.operators import strut_metrics as M
from strutwise.operators.ranking import numbered
from strutwise.plans import views as V
from strutwise.plans.catalog import query
from strutwise.plans.views import SHAPE, with_views
from strutwise.sources import documents as D
from strutwise.sources import meshes, volumes
from strutwise.sources.storage import new_folder, put


def rounded(value: str, name: str) -> str:
    return f"round({value}, 6)+0.0::DOUBLE AS {name}"


# --- volumes: the voxel view as one file of fixed shape ------------------------

_GRID = with_views("v_voxel") + f""", g AS (SELECT z::INT AS z, y::INT AS y, x::INT AS x FROM (SELECT unnest(generate_series(0, {SHAPE[0] - 1})) AS z), (SELECT unnest(generate_series(0, {SHAPE[1] - 1})) AS y),
  (SELECT unnest(generate_series(0, {SHAPE[2] - 1})) AS x)), v AS (SELECT z, y, x, coalesce(value, 0) AS value FROM g LEFT JOIN v_voxel USING (z, y, x))
"""


def _dense(spark, d) -> np.ndarray:
    """The voxel view as an array of its fixed shape (7,168 cells)."""
    out = np.zeros(SHAPE, dtype=">u2")
    for r in V.voxels(spark, d).collect():
        out[r.z, r.y, r.x] = r.value
    return out


def _blocks(spark, d, depth: int = 2, dtype: str = "u2"):
    """The voxel view as a block table that Spark builds slab by slab."""
    return volumes.blocks_of(V.voxels(spark, d), SHAPE, dtype, depth)


def _npy(a: np.ndarray) -> bytes:
    handle = io.BytesIO()
    np.save(handle, a)
    return handle.getvalue()


def _volume(spark, d, slab_cells: int = 2 * SHAPE[1] * SHAPE[2]):
    return volumes.read_volume(spark, put(spark, "volume.npy", _npy(_dense(spark, d))), slab_cells)


@query("volume_file", _GRID + "SELECT z, y, x, value::DOUBLE AS value FROM v")
def volume_file(spark, d):
    return volumes.voxels(_volume(spark, d))


@query("volume_header", f"SELECT {SHAPE[0]} AS nz, {SHAPE[1]} AS ny, {SHAPE[2]} AS nx, 'u2' AS dtype, 'big' AS byte_order, {SHAPE[0] * SHAPE[1] * SHAPE[2]}::BIGINT AS cells")
def volume_header(spark, d):
    head = volumes.read_headers(spark, put(spark, "volume.npy", _npy(_dense(spark, d))))
    return head.select(*[F.get("shape", k).alias(c) for k, c in enumerate(("nz", "ny", "nx"))], "dtype", "byte_order", "cells")


@query("volume_inspection", _GRID + f"SELECT min(value)::DOUBLE AS minimum, max(value)::DOUBLE AS maximum, {rounded('avg(value::DOUBLE)', 'mean')}, count(*)::BIGINT AS finite_count, 0::BIGINT AS nonfinite_count FROM v")
def volume_inspection(spark, d):
    path = put(spark, "volume.npy", _npy(_dense(spark, d).astype("<f4")))
    return volumes.inspect(spark, [path]).select("minimum", "maximum", "mean", "finite_count", "nonfinite_count")


@query("volume_histogram", _GRID + "SELECT value::INT AS bin, count(*)::BIGINT AS c FROM v GROUP BY value")
def volume_histogram(spark, d):
    return volumes.histogram(_blocks(spark, d))


@query("mask_blocks", _GRID + "SELECT z, y, x, (value>=5)::INT::DOUBLE AS value FROM v")
def mask_blocks(spark, d):
    return volumes.voxels(volumes.mask(_blocks(spark, d, 3), 5))


@query("slice_sample", _GRID + "SELECT z, sum(value)::DOUBLE AS total FROM v WHERE z%3=0 GROUP BY z")
def slice_sample(spark, d):
    path = put(spark, "volume.npy", _npy(_dense(spark, d)))
    return volumes.voxels(volumes.read_volume(spark, path, every=3)).groupBy("z").agg(F.sum("value").alias("total"))


# a strut along each column of x at every fourth y of every third slice, in the file's own mask
_RODS = [(z * 100 + y, float(2), float(y), float(z), float(SHAPE[2] - 3), float(y), float(z)) for z in range(2, SHAPE[0] - 2, 2) for y in range(4, SHAPE[1] - 4, 4)]


@query("rod_metrics", _GRID + f""", k AS (SELECT z*100+y AS id, z, y FROM g WHERE x=0 AND z IN (2, 4) AND y BETWEEN 4 AND {SHAPE[1] - 5} AND y%4=0),
s AS (SELECT k.id, v.x-2 AS w, count_if(v.value>=10) AS hits, count(*) AS seen FROM k JOIN v ON (v.z-k.z)*(v.z-k.z)+(v.y-k.y)*(v.y-k.y)<=1 WHERE v.x BETWEEN 2 AND {SHAPE[2] - 3} GROUP BY ALL),
n AS (SELECT *, hits/seen::DOUBLE AS fg, {SHAPE[2] - 5}::DOUBLE AS length FROM s),
i AS (SELECT id, w, fg>=0.1 AS ok, w-row_number() OVER (PARTITION BY id, fg>=0.1 ORDER BY w) AS run, fg FROM n WHERE w BETWEEN 0.2*length-1e-9 AND 0.8*length+1e-9),
r AS (SELECT id, max(c) AS gap FROM (SELECT id, count(*) AS c FROM i WHERE NOT ok GROUP BY id, run) GROUP BY id)
SELECT n.id::BIGINT AS id, max(length) AS length, {rounded('avg(n.fg)', 'design')}, coalesce(max(r.gap), 0)::BIGINT AS gap,
  {rounded('(SELECT min(fg) FROM i WHERE i.id=n.id)', 'least')}, {rounded('(SELECT max(fg) FROM i WHERE i.id=n.id)', 'most')}, {rounded('(SELECT quantile_cont(fg, 0.5) FROM i WHERE i.id=n.id)', 'middle')}
FROM n LEFT JOIN r USING (id) GROUP BY n.id""")
def rod_metrics(spark, d):
    rods = spark.createDataFrame(_RODS, "id long, ax double, ay double, az double, bx double, by double, bz double")
    policy = M.CorridorPolicy(threshold=10, pad=0.05)
    rows = M.strut_metrics(rods, _blocks(spark, d), SHAPE, 1.0, policy)
    return rows.select("id", "length", F.col("corridor_foreground_fraction").alias("design"), F.col("maximum_axial_gap_samples").alias("gap"), F.col("interior_minimum").alias("least"),
                       F.col("interior_maximum").alias("most"), F.col("interior_median").alias("middle"))


# a strut along x for each distinct pair of places that parts and suppliers give; cells of its corridor: the axis and the four beside it
_KEYS = "SELECT p_partkey AS k FROM part UNION ALL SELECT s_suppkey FROM supplier"
_METRICS = _GRID.replace("WITH ", "WITH RECURSIVE ", 1) + f""", k AS (SELECT DISTINCT ((k%3+2)*100+k%24+4)::BIGINT AS id, (k%3+2)::INT AS z, (k%24+4)::INT AS y FROM ({_KEYS})),
d AS (SELECT * FROM (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) d(dz, dy)),
c AS (SELECT k.id, v.x-2 AS w, dz, dy, v.value >= (SELECT avg(value) FROM v_voxel) AS fg, (v.x-1)*9+(dz+1)*3+dy+1 AS node FROM k, d JOIN v ON v.z=k.z+dz AND v.y=k.y+dy WHERE v.x BETWEEN 1 AND 30),
s AS (SELECT id, w, count_if(fg) AS hits, count_if(fg)/5.0::DOUBLE AS fg, sum(CASE WHEN fg THEN dy END)/nullif(count_if(fg), 0)::DOUBLE AS cx, sum(CASE WHEN fg THEN dz END)/nullif(count_if(fg), 0)::DOUBLE AS cy FROM c GROUP BY ALL),
t AS (SELECT * FROM c WHERE fg), e AS (SELECT a.id, a.node AS u, b.node AS v FROM t a JOIN t b ON a.id=b.id AND abs(a.w-b.w)<=1 AND abs(a.dz-b.dz)<=1 AND abs(a.dy-b.dy)<=1),
r AS (SELECT id, node AS u, node AS v FROM t UNION SELECT e.id, e.v, r.v FROM r JOIN e ON e.id=r.id AND e.u=r.u WHERE r.v<e.v),
l AS (SELECT t.id, t.w, min(r.v) AS part FROM t JOIN r ON r.id=t.id AND r.u=t.node GROUP BY t.id, t.w, t.node),
q AS (SELECT id, part, count(*) AS size, bool_or(w<=2) AS e0, bool_or(w>=25) AS e1, bool_or(w IN (5, 6)) AS c0, bool_or(w IN (21, 22)) AS c1 FROM l GROUP BY ALL),
p AS (SELECT id, coalesce(sum(size) FILTER (e0 AND e1), 0) AS joined, coalesce(sum(size) FILTER (e0 AND c0), 0) AS near0, coalesce(sum(size) FILTER (e1 AND c1), 0) AS near1 FROM q GROUP BY id),
tm AS (SELECT * FROM t WHERE w BETWEEN 0 AND 27 AND power(least(w, 27-w), 2)+dz*dz+dy*dy > 9),
em AS (SELECT a.id, a.node AS u, b.node AS v FROM tm a JOIN tm b ON a.id=b.id AND abs(a.w-b.w)<=1 AND abs(a.dz-b.dz)<=1 AND abs(a.dy-b.dy)<=1),
rm AS (SELECT id, node AS u, node AS v FROM tm UNION SELECT em.id, em.v, rm.v FROM rm JOIN em ON em.id=rm.id AND em.u=rm.u WHERE rm.v<em.v),
lm AS (SELECT tm.id, tm.w, min(rm.v) AS part FROM tm JOIN rm ON rm.id=tm.id AND rm.u=tm.node GROUP BY tm.id, tm.w, tm.node),
qm AS (SELECT id, part, count(*) AS size, bool_or(w IN (5, 6)) AND bool_or(w IN (21, 22)) AS both_ FROM lm GROUP BY ALL),
pm AS (SELECT id, count(*) AS parts, max(size)/sum(size)::DOUBLE AS share, coalesce(sum(size) FILTER (both_), 0) AS collars FROM qm GROUP BY id),
i AS (SELECT *, w-6 AS j, fg<0.1 AS bare FROM s WHERE w BETWEEN 6 AND 21), ir AS (SELECT id, bare, j-row_number() OVER (PARTITION BY id, bare ORDER BY j) AS run FROM i),
gap AS (SELECT id, max(n) AS gap FROM (SELECT id, run, count(*) AS n FROM ir WHERE bare GROUP BY ALL) GROUP BY id),
h AS (SELECT *, max(CASE WHEN cx IS NOT NULL THEN j END) OVER (PARTITION BY id ORDER BY j ROWS UNBOUNDED PRECEDING) AS lo, min(CASE WHEN cx IS NOT NULL THEN j END) OVER (PARTITION BY id ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi FROM i),
b0 AS (SELECT h.id, h.j, coalesce(h.cx, CASE WHEN h.lo IS NULL THEN b.cx WHEN h.hi IS NULL THEN a.cx ELSE a.cx+(b.cx-a.cx)*(h.j-h.lo)/(h.hi-h.lo)::DOUBLE END) AS cx,
  coalesce(h.cy, CASE WHEN h.lo IS NULL THEN b.cy WHEN h.hi IS NULL THEN a.cy ELSE a.cy+(b.cy-a.cy)*(h.j-h.lo)/(h.hi-h.lo)::DOUBLE END) AS cy FROM h LEFT JOIN i a ON a.id=h.id AND a.j=h.lo LEFT JOIN i b ON b.id=h.id AND b.j=h.hi),
b1 AS (SELECT id, j, CASE WHEN j IN (0, 15) THEN cx ELSE (lag(cx) OVER o+2*cx+lead(cx) OVER o)/4 END AS cx, CASE WHEN j IN (0, 15) THEN cy ELSE (lag(cy) OVER o+2*cy+lead(cy) OVER o)/4 END AS cy FROM b0 WINDOW o AS (PARTITION BY id ORDER BY j)),
b2 AS (SELECT id, j, CASE WHEN j IN (0, 15) THEN cx ELSE (lag(cx) OVER o+2*cx+lead(cx) OVER o)/4 END AS cx, CASE WHEN j IN (0, 15) THEN cy ELSE (lag(cy) OVER o+2*cy+lead(cy) OVER o)/4 END AS cy FROM b1 WINDOW o AS (PARTITION BY id ORDER BY j)),
b3 AS (SELECT *, first_value(cx) OVER o AS ax, last_value(cx) OVER o AS bx, first_value(cy) OVER o AS ay, last_value(cy) OVER o AS by_ FROM b2 WINDOW o AS (PARTITION BY id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
bend AS (SELECT id, sqrt(avg(power(cx-ax-(bx-ax)*j/15.0::DOUBLE, 2)+power(cy-ay-(by_-ay)*j/15.0::DOUBLE, 2))) AS rms FROM b3 GROUP BY id),
thick AS (SELECT id, quantile_cont(CASE WHEN hits=5 THEN sqrt(2::DOUBLE) ELSE 1 END, 0.5) AS radius, count(*) AS known FROM i WHERE hits>0 GROUP BY id),
f AS (SELECT id, avg(fg) FILTER (w BETWEEN 0 AND 27) AS corridor_foreground_fraction, min(fg) FILTER (w BETWEEN 6 AND 21) AS interior_minimum, quantile_cont(fg, 0.5) FILTER (w BETWEEN 6 AND 21) AS interior_median,
  max(fg) FILTER (w BETWEEN 6 AND 21) AS interior_maximum, avg(fg) FILTER (w BETWEEN 0 AND 2) AS endpoint0_support_fraction, avg(fg) FILTER (w BETWEEN 25 AND 27) AS endpoint1_support_fraction,
  avg(fg) FILTER (w IN (5, 6)) AS collar0_fraction, avg(fg) FILTER (w IN (21, 22)) AS collar1_fraction, string_agg(hits::VARCHAR, ',' ORDER BY w) AS hits, sum(w/27.0::DOUBLE) AS axial_sum FROM s GROUP BY id)
"""
_SHARES = (
    "corridor_foreground_fraction", "interior_minimum", "interior_median", "interior_maximum", "endpoint0_support_fraction", "endpoint1_support_fraction", "collar0_fraction", "collar1_fraction", "axial_sum",
)


@query("strut_metric_columns", _METRICS + f"""SELECT f.id, 27.0::DOUBLE AS length, {", ".join(rounded(c, c) for c in _SHARES)}, hits, coalesce(gap, 0)::BIGINT AS maximum_axial_gap_samples, {rounded('coalesce(gap, 0)/16.0::DOUBLE', 'gap_fraction')},
  coalesce(parts, 0)::BIGINT AS interior_component_count, {rounded('coalesce(share, 0)', 'largest_component_fraction')}, coalesce(joined, 0)>0 AS connected, coalesce(joined, 0)::BIGINT AS connected_voxels,
  coalesce(near0, 0)>0 AS endpoint0_connected, coalesce(near0, 0)::BIGINT AS endpoint0_voxels, coalesce(near1, 0)>0 AS endpoint1_connected, coalesce(near1, 0)::BIGINT AS endpoint1_voxels,
  coalesce(collars, 0)>0 AS collar_connected, coalesce(collars, 0)::BIGINT AS collar_voxels, coalesce(near0, 0)>0 AND coalesce(near1, 0)>0 AS both_endpoint_segments_observed,
  {rounded('coalesce(radius, 0)', 'radius_voxels')}, {rounded('CASE WHEN coalesce(known, 0)<5 THEN 0 ELSE rms END', 'curvature_rms')}, {rounded('CASE WHEN z=3 THEN 1 ELSE 6/7.0::DOUBLE END', 'valid_fraction')}, z=3 AS roi_valid
FROM f JOIN k USING (id) LEFT JOIN gap USING (id) LEFT JOIN p USING (id) LEFT JOIN pm USING (id) LEFT JOIN bend USING (id) LEFT JOIN thick USING (id)""")
def strut_metric_columns(spark, d):
    key = V.table(spark, d, "part").select(F.col("p_partkey").alias("k")).unionByName(V.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k")))
    places = key.select((F.col("k") % 3 + 2).cast("double").alias("z"), (F.col("k") % 24 + 4).cast("double").alias("y")).distinct()
    rods = places.select((F.col("z") * 100 + F.col("y")).cast("long").alias("id"), F.lit(2.0).alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az"), F.lit(29.0).alias("bx"), F.col("y").alias("by"), F.col("z").alias("bz"))
    cut = V.voxels(spark, d).agg(F.avg("value")).first()[0]
    rows = M.strut_metrics(rods, _blocks(spark, d), SHAPE, 1.0, M.CorridorPolicy(threshold=cut, pad=1 / 27))
    hits = F.array_join(F.transform("foreground_fraction", lambda x: F.round(x * 5).cast("int")), ",")
    return rows.withColumn("hits", hits).withColumn("axial_sum", F.aggregate("axial_t", F.lit(0.0), lambda s, x: s + x)).drop("axial_t", "foreground_fraction")


@query("node_detection", "WITH RECURSIVE " + _GRID.removeprefix("WITH ") + f""", t AS (SELECT z, y, x, (z*{SHAPE[1]}+y)*{SHAPE[2]}+x AS id FROM v WHERE value>=14),
e AS (SELECT a.id AS u, b.id AS w FROM t a JOIN t b ON abs(a.z-b.z)+abs(a.y-b.y)+abs(a.x-b.x)<=1),
r AS (SELECT u, w FROM e UNION SELECT r.u, e.w FROM r JOIN e ON r.w=e.u), lab AS (SELECT u AS id, min(w) AS part FROM r GROUP BY u)
SELECT {rounded('avg(z::DOUBLE)', 'z')}, {rounded('avg(y::DOUBLE)', 'y')}, {rounded('avg(x::DOUBLE)', 'x')}, count(*)::BIGINT AS size FROM t JOIN lab USING (id) GROUP BY part HAVING count(*) BETWEEN 2 AND 999""")
def node_detection(spark, d):
    found = G.detected(_blocks(spark, d), SHAPE, 14, step=1, margin=0.0, least_distance=1.0, size=4)
    return found.select("z", "y", "x", "size")


# --- lattice, metrics, profile, label and id documents ---------------------------


def _lattice(spark, d):
    """The lattice as JSON documents, one for each supplier's struts; a document holds one supplier's lattice."""
    s, j = V.struts(spark, d), V.junctions(spark, d)
    at = j.select("id", F.array("x", "y", "z").alias("position"))
    cells = s.groupBy("junction1").agg(
        F.sort_array(F.collect_list(F.struct("id", "junction0", "junction1"))).alias("struts"), F.sort_array(F.collect_list("id")).alias("members")
    )
    docs = cells.join(at.withColumnRenamed("id", "junction1"), "junction1", "left").select(
        F.array(F.struct(F.col("junction1").alias("id"), "position")).alias("junctions"), "struts", F.array(F.struct(F.col("junction1").alias("id"), F.col("members").alias("struts"))).alias("unit_cells")
    )
    folder = new_folder(spark, "lattice")
    docs.write.json(folder)
    return folder


def _read_lattice(spark, d):
    # a document a line
    docs = spark.read.schema(D.LATTICE).json(_lattice(spark, d))
    return D.lattice_tables(docs)


@query("lattice_file", with_views("v_strut") + "SELECT id, junction0, junction1, -1::BIGINT AS unit_cell_edge_idx FROM v_strut")
def lattice_file(spark, d):
    return _read_lattice(spark, d)[1].select("id", "junction0", "junction1", "unit_cell_edge_idx")


@query("lattice_junctions", with_views("v_strut", "v_junction") + "SELECT DISTINCT s.junction1 AS id, j.x, j.y, j.z FROM v_strut s LEFT JOIN v_junction j ON s.junction1=j.id")
def lattice_junctions(spark, d):
    return _read_lattice(spark, d)[0].select("id", "x", "y", "z")


@query("lattice_members", with_views("v_strut") + "SELECT junction1 AS cell_id, id AS strut_id, (row_number() OVER (PARTITION BY junction1 ORDER BY id)-1)::INT AS place FROM v_strut")
def lattice_members(spark, d):
    j, s, c = _read_lattice(spark, d)
    folder = new_folder(spark, "lattice-tables")
    D.write_lattice(j, s, c, folder)
    return spark.read.parquet(f"{folder}/cell_strut")


@query("metrics_file", with_views("v_class") + "SELECT id AS strut_id, CASE WHEN class='missing' THEN NULL ELSE price END AS length_voxels, most::BIGINT AS interior_component_count, discount>=0.1 AS roi_valid FROM v_class")
def metrics_file(spark, d):
    rows = V.classes(spark, d).select(
        F.col("id").alias("strut_id"), F.when(F.col("class") != "missing", F.col("price")).alias("length_voxels"), F.col("most").cast("long").alias("interior_component_count"), (F.col("discount") >= 0.1).alias("roi_valid")
    )
    folder = new_folder(spark, "metrics")
    D.write_csv(rows, folder, rows.columns)
    return D.read_metrics(spark, folder, set(rows.columns))


@query("profile_file", with_views("v_profile") + f"SELECT strut_id, i::INT AS i, {rounded('fg', 'fg')} FROM v_profile")
def profile_file(spark, d):
    p = V.profiles(spark, d)
    docs = p.select(F.lit(True).alias("measurement_only"), F.array(F.struct("strut_id", F.transform("fg", lambda x: x * 0).alias("axial_t"), F.col("fg").alias("foreground_fraction"))).alias("profiles"))
    folder = new_folder(spark, "profiles")
    docs.write.json(folder)
    return D.read_profiles(spark, folder, lines=True).select("strut_id", F.posexplode("fg").alias("i", "fg"))


@query("id_list", "SELECT DISTINCT l_suppkey::BIGINT AS strut_id FROM lineitem WHERE l_quantity>49")
def id_list(spark, d):
    folder = new_folder(spark, "ids")
    V.table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("strut_id"), "l_returnflag").write.option("header", True).csv(folder)
    return D.read_ids(spark, folder)


@query("intentional_crop", "SELECT DISTINCT l_suppkey::BIGINT AS strut_id FROM lineitem WHERE l_quantity>49 AND l_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_discount>=0.1 AND l_tax<=0)")
def intentional_crop(spark, d):
    some = V.table(spark, d, "lineitem").where("l_discount >= 0.1 and l_tax <= 0").select(F.col("l_suppkey").cast("long").alias("strut_id"))
    return R.difference(id_list(spark, d), some)


@query("sealed_labels", with_views("v_class") + "SELECT id AS strut_id, class FROM v_class WHERE class<>'present'")
def sealed_labels(spark, d):
    rows = V.classes(spark, d).where("class <> 'present'")
    # all four layouts: lists of ids for missing struts, by the rest of their id, and labelled structs for the others
    layout = F.when(F.col("class") != "missing", 3).otherwise(F.pmod("id", F.lit(4)))
    docs = rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"), layout.alias("layout")).agg(F.collect_list("id").alias("ids"), F.collect_list(F.struct(F.col("id").alias("strut_id"), "class")).alias("labels"))
    lists = ("strut_ids", "missing_strut_ids", "sealed_strut_ids")
    folder = new_folder(spark, "labels")
    docs.select(*[F.when(F.col("layout") == k, F.col("ids")).alias(c) for k, c in enumerate(lists)], F.when(F.col("layout") == 3, F.col("labels")).alias("labels")).write.json(folder)
    schema = ", ".join(f"{c} array<bigint>" for c in lists) + ", labels array<struct<strut_id:bigint,class:string>>"
    return E.label_layouts(spark.read.schema(schema).json(folder)).select("strut_id", "class")


@query("endpoint_rows", with_views("v_class") + f"SELECT id AS strut_id, e AS endpoint, {rounded('quantity', 'seen')} FROM v_class, (SELECT unnest(['A', 'B']) AS e)")
def endpoint_rows(spark, d):
    rows = V.classes(spark, d).select(F.col("id").alias("strut_id"), F.explode(F.array(F.lit("A"), F.lit("B"))).alias("endpoint"), F.col("quantity").alias("seen"))
    folder = new_folder(spark, "endpoints")
    rows.write.option("header", True).csv(folder)
    return D.read_endpoints(spark, folder).select("strut_id", "endpoint", F.col("seen").cast("double").alias("seen"))


@query("mesh_centroids", with_views("v_junction") + f"""SELECT id, {rounded('((x+(x+1)+x)/3)::FLOAT::DOUBLE', 'x')}, {rounded('((y+y+(y+1))/3)::FLOAT::DOUBLE', 'y')}, {rounded('z', 'z')}
FROM (SELECT row_number() OVER (ORDER BY id)-1 AS id, x, y, z FROM v_junction)""")
def mesh_centroids(spark, d):
    """A triangle at each junction, in order of id, as one mesh file: as many faces as the lattice has nodes."""
    rows, many = numbered(V.junctions(spark, d), ["id"], "face")
    path = put(spark, "mesh.stl", meshes.stl_chunks(_triangles(rows.drop("id")), many))
    return meshes.centroids(meshes.read_stl(spark, path, 1000)).select(F.col("face").alias("id"), *[F.col(c).cast("double").alias(c) for c in "xyz"])


def _triangles(rows):
    """A triangle at each place ``x, y, z``; other columns stay."""
    corner = lambda k: [(F.col(c) + F.lit(float((k == 1 and c == "x") + (k == 2 and c == "y")))).alias(f"{c}{k}") for c in "xyz"]
    return rows.select(*[c for c in rows.columns if c not in ("x", "y", "z")], *[x for k in range(3) for x in corner(k)])


@query("mesh_text", with_views("v_junction") + f"SELECT {rounded('((x+(x+1)+x)/3)::FLOAT::DOUBLE', 'x')}, {rounded('((y+y+(y+1))/3)::FLOAT::DOUBLE', 'y')}, {rounded('z', 'z')}, count(*)::BIGINT AS faces FROM v_junction GROUP BY ALL")
def mesh_text(spark, d):
    """The same triangles as text meshes that Spark writes and reads."""
    folder = new_folder(spark, "mesh-text")
    meshes.text_facets(_triangles(V.junctions(spark, d))).write.text(folder)
    found = meshes.centroids(meshes.read_text_stl(spark, folder))
    return found.groupBy(*[F.col(c).cast("double").alias(c) for c in "xyz"]).agg(F.count("*").alias("faces"))


# --- rules and access -------------------------------------------------------------


@query("deferred_findings", with_views("v_strut") + "SELECT id AS strut_id, k AS kind, 'deferred' AS disposition, k || '_specialist_not_implemented' AS reason, false AS evidence_required FROM v_strut, (SELECT unnest(['thin', 'bent']) AS k)")
def deferred_findings(spark, d):
    rows = C.deferred_findings(V.struts(spark, d).select(F.col("id").alias("strut_id")))
    return rows.select("strut_id", "kind", "disposition", F.get("reasons", F.lit(0)).alias("reason"), "evidence_required")


@query("merged_findings", with_views("v_class") + """SELECT id AS strut_id, CASE class WHEN 'missing' THEN 'missing' WHEN 'broken' THEN 'broken' ELSE 'deferred' END AS class, class IN ('missing', 'broken') AS evidence_required FROM v_class""")
def merged_findings(spark, d):
    c = V.classes(spark, d).select(F.col("id").alias("strut_id"), "class")
    told = [C.finding(k, F.when(F.col("class") == k, "positive").otherwise("negative"), F.array(F.col("class")), F.lit(False)) for k in ("missing", "broken")]
    every = C.findings_of(c, [*told, C.deferred_finding("thin"), C.deferred_finding("bent")])
    return C.merge(C.findings_wide(every)).select("strut_id", "class", "evidence_required")


@query("viewer_rows", with_views("v_strut", "v_junction", "v_placed", "v_class") + f"SELECT p.id AS strut_id, c.class, p.ax, p.bx, {rounded('c.quantity', 'minimum_foreground_fraction')} FROM v_placed p JOIN v_class c USING (id) WHERE c.class IN ('missing', 'broken')")
def viewer_rows(spark, d):
    from strutwise.plans.queries_graph import _placed

    told = V.classes(spark, d).select(F.col("id").alias("strut_id"), "class", F.col("quantity").alias("minimum"))
    return R.viewer_rows(_placed(spark, d).select(F.col("id").alias("strut_id"), "ax", "bx"), told)


_ACCESS = """WITH i AS (SELECT (o_orderkey%5)::INT AS stage, 'f' || o_orderkey AS path, sha256((o_orderkey%97)::VARCHAR) AS sha256, CASE WHEN o_orderkey%11=0 THEN 'sealed_labels' ELSE 'volume' END AS role FROM orders),
l AS (SELECT DISTINCT sha256((c_custkey%7)::VARCHAR) AS sha256, CASE WHEN c_custkey%7<3 THEN 'sealed_labels' ELSE 'defect_labels' END AS kind FROM customer), b AS (SELECT 1 AS stage, 'sealed_labels' AS kind UNION ALL SELECT 2, 'defect_labels')
"""


@query("label_leaks", _ACCESS + """, f AS (SELECT i.*, l.kind, 'content' AS reason FROM i JOIN l USING (sha256) UNION ALL SELECT i.*, role, 'role' FROM i)
SELECT stage, path, kind, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons FROM f JOIN b USING (stage, kind) GROUP BY stage, path, kind""")
def label_leaks(spark, d):
    o, c = V.table(spark, d, "orders"), V.table(spark, d, "customer")
    sha = lambda v: F.sha2(v.cast("string"), 256)
    k = F.col("o_orderkey")
    inputs = o.select((k % 5).cast("int").alias("stage"), F.concat(F.lit("f"), k).alias("path"), sha(k % 97).alias("sha256"), F.when(k % 11 == 0, "sealed_labels").otherwise("volume").alias("role"))
    labels = c.select(sha(F.col("c_custkey") % 7).alias("sha256"), F.when(F.col("c_custkey") % 7 < 3, "sealed_labels").otherwise("defect_labels").alias("kind"))
    barred = spark.createDataFrame([(1, "sealed_labels"), (2, "defect_labels")], "stage int, kind string")
    return R.label_leaks(inputs, labels, barred).select("stage", "path", "kind", F.array_join("reasons", ",").alias("reasons"))


@query("stale_inputs", "SELECT 'f' || o_orderkey AS path, o_orderkey%3=0 AS stale, o_orderkey%4=0 AS other_role FROM orders WHERE o_orderkey%2=0 AND (o_orderkey%3=0 OR o_orderkey%4=0)")
def stale_inputs(spark, d):
    k = F.col("o_orderkey")
    o = V.table(spark, d, "orders").withColumn("path", F.concat(F.lit("f"), k))
    inputs = o.select("path", F.sha2(k.cast("string"), 256).alias("sha256"), F.lit("volume").alias("role"))
    made = o.where(k % 2 == 0).select("path", F.sha2(F.when(k % 3 == 0, k + 1).otherwise(k).cast("string"), 256).alias("sha256"), F.when(k % 4 == 0, "mask").otherwise("volume").alias("role"))
    return R.stale_inputs(inputs, made)


@query("utc_text", r"""SELECT event_id, regexp_replace(regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '0+$', ''), '\.$', '') || 'Z' AS shown, epoch_us(ts)::BIGINT AS micros FROM events""")
def utc_text(spark, d):
    e = V.table(spark, d, "events").select("event_id", D.utc_text(F.col("ts").cast("timestamp")).alias("shown"))
    return e.withColumn("micros", F.unix_micros(D.utc_time(F.col("shown"))))


@query("strict_values", "SELECT event_id, user_id::BIGINT AS number, value>50 AS flag FROM events")
def strict_values(spark, d):
    e = V.table(spark, d, "events").select("event_id", F.concat(F.lit(" +"), F.col("user_id")).alias("number"), F.upper((F.col("value") > 50).cast("string")).alias("flag"))
    return e.select("event_id", D.strict_integer(F.col("number")).alias("number"), D.strict_flag(F.col("flag")).alias("flag"))
