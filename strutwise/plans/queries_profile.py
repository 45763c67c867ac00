"""Profile queries: runs, smoothing, features, rules and their merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from strutwise.functions import sequences as Q
from strutwise.operators import classify as C
from strutwise.plans import views as V
from strutwise.plans.catalog import query
from strutwise.plans.views import with_views

R = lambda x, name: f"round({x}, 6) + 0.0 AS {name}"


def _runs_sql(flag: str, name: str) -> str:
    return with_views("v_profile") + f""", f AS (SELECT strut_id, i, {flag} AS hit FROM v_profile), g AS (SELECT *, i - row_number() OVER (PARTITION BY strut_id, hit ORDER BY i) AS island FROM f),
r AS (SELECT strut_id, hit, island, count(*) AS n FROM g GROUP BY ALL)
SELECT strut_id, coalesce(max(n) FILTER (hit), 0)::INT AS {name} FROM r GROUP BY strut_id"""


@query("longest_gap_run", _runs_sql("fg < 0.3", "gap"))
def longest_gap_run(spark, d):
    return V.profiles(spark, d).select("strut_id", Q.longest_gap(F.transform("fg", lambda x: x >= 0.3)).alias("gap"))


@query("deficit_run", _runs_sql("fg < 0.5", "run"))
def deficit_run(spark, d):
    return V.profiles(spark, d).select("strut_id", Q.longest_run(F.transform("fg", lambda x: x < 0.5)).alias("run"))


@query("moving_avg3", with_views("v_profile") + f""", m AS (SELECT strut_id, avg(fg) OVER w AS a, count(*) OVER w AS k FROM v_profile WINDOW w AS (PARTITION BY strut_id ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
SELECT strut_id, count(*)::INT AS windows, {R('min(a)', 'least')}, {R('max(a)', 'most')} FROM m WHERE k=3 GROUP BY strut_id""")
def moving_avg3(spark, d):
    m = V.profiles(spark, d).select("strut_id", Q.moving_average(F.col("fg")).alias("m"))
    return m.select("strut_id", F.size("m").alias("windows"), F.array_min("m").alias("least"), F.array_max("m").alias("most"))


_S1 = "SELECT strut_id, i, CASE WHEN lag({c}) OVER w IS NULL OR lead({c}) OVER w IS NULL THEN {c} ELSE (lag({c}) OVER w+2*{c}+lead({c}) OVER w)/4 END AS {o} FROM {t} WINDOW w AS (PARTITION BY strut_id ORDER BY i)"


@query("smooth121", with_views("v_profile") + f", a AS ({_S1.format(c='fg', o='s', t='v_profile')}), b AS ({_S1.format(c='s', o='t', t='a')}) SELECT strut_id, i::INT AS i, round(t, 10) + 0.0 AS value FROM b", digits=10)
def smooth121(spark, d):
    return V.profiles(spark, d).select("strut_id", F.posexplode(Q.smoothed(F.col("fg"), 2)).alias("i", "value"))


_HOLES = """, h AS (SELECT strut_id, i, n, CASE WHEN fg>=0.2 THEN fg END AS v FROM v_profile),
k AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY strut_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS lo,
  min(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY strut_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi FROM h),
g AS (SELECT k.strut_id, k.i, k.n, coalesce(k.v, CASE WHEN lo IS NULL THEN b.v WHEN hi IS NULL THEN a.v ELSE a.v+(b.v-a.v)*(k.i-lo)/(hi-lo)::DOUBLE END) AS v
  FROM k LEFT JOIN h a ON a.strut_id=k.strut_id AND a.i=lo LEFT JOIN h b ON b.strut_id=k.strut_id AND b.i=hi)
"""


@query("gap_interp", with_views("v_profile") + _HOLES + f"SELECT strut_id, i::INT AS i, {R('v', 'value')} FROM g")
def gap_interp(spark, d):
    holes = F.transform("fg", lambda x: F.when(x >= 0.2, x))
    return Q.filled_rows(V.profiles(spark, d).select("strut_id", holes.alias("holes")), "strut_id", "holes")


@query("chord_rms", with_views("v_profile") + f""", e AS (SELECT strut_id, i, n, fg, first_value(fg) OVER w AS a, last_value(fg) OVER w AS b FROM v_profile WINDOW w AS (PARTITION BY strut_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT strut_id, {R('sqrt(avg(power(fg-(a+(b-a)*i/(n-1)::DOUBLE), 2)))', 'rms')} FROM e GROUP BY strut_id""")
def chord_rms(spark, d):
    return V.profiles(spark, d).select("strut_id", Q.chord_rms(F.col("fg")).alias("rms"))


@query("end_means", with_views("v_profile") + f"SELECT strut_id, {R('avg(fg) FILTER (i<3)', 'head')}, {R('avg(fg) FILTER (i>=n-3)', 'tail')} FROM v_profile GROUP BY strut_id")
def end_means(spark, d):
    return V.profiles(spark, d).select("strut_id", Q.head_mean(F.col("fg")).alias("head"), Q.tail_mean(F.col("fg")).alias("tail"))


@query("short_profiles", with_views("v_day") + f""", m AS (SELECT *, avg(fg) OVER w AS a, count(*) OVER w AS k, first_value(fg) OVER e AS p, last_value(fg) OVER e AS q FROM v_day
  WINDOW w AS (PARTITION BY strut_id ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), e AS (PARTITION BY strut_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT strut_id, max(n)::INT AS n, count(*) FILTER (k=3)::INT AS windows, {R('min(a) FILTER (k=3)', 'least')}, {R('max(a) FILTER (k=3)', 'most')},
  {R('CASE WHEN max(n)<5 THEN 0 ELSE sqrt(avg(power(fg-(p+(q-p)*i/nullif(n-1, 0)::DOUBLE), 2))) END', 'rms')},
  {R('avg(fg) FILTER (i<least(3, greatest(1, n//2)))', 'head')}, {R('avg(fg) FILTER (i>=n-least(3, greatest(1, n//2)))', 'tail')},
  {R('avg((fg>=0.3)::INT::DOUBLE) FILTER (i<greatest(1, n//3))', 'left_share')}, {R('avg((fg>=0.3)::INT::DOUBLE) FILTER (i>=n-greatest(1, n//3))', 'right_share')} FROM m GROUP BY strut_id""")
def short_profiles(spark, d):
    rows = V.daily_profiles(spark, d).withColumn("m", Q.moving_average(F.col("fg")))
    left, right = Q.third_shares(F.transform("fg", lambda x: x >= 0.3))
    return rows.select(
        "strut_id", F.col("n").cast("int").alias("n"), F.size("m").alias("windows"), F.array_min("m").alias("least"), F.array_max("m").alias("most"), Q.chord_rms(F.col("fg")).alias("rms"),
        Q.head_mean(F.col("fg")).alias("head"), Q.tail_mean(F.col("fg")).alias("tail"), left.alias("left_share"), right.alias("right_share"))


_FEATURES = with_views("v_profile") + """, sp AS (SELECT strut_id, n, i, fg, row_number() OVER (PARTITION BY strut_id ORDER BY i)-1 AS k, count(*) OVER (PARTITION BY strut_id) AS m FROM v_profile WHERE 10*i>=2*(n-1) AND 10*i<=8*(n-1)),
rf AS (SELECT strut_id, quantile_cont(fg, 0.9) AS reference FROM sp GROUP BY strut_id),
fl AS (SELECT sp.*, reference, fg<0.5::DOUBLE*reference AS deficient, fg>=0.05 AS present, avg(fg) OVER w AS sm, count(*) OVER w AS sk FROM sp JOIN rf USING (strut_id) WINDOW w AS (PARTITION BY sp.strut_id ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
rd AS (SELECT strut_id, max(c) FILTER (deficient) AS run FROM (SELECT strut_id, deficient, g, count(*) AS c FROM (SELECT *, k-row_number() OVER (PARTITION BY strut_id, deficient ORDER BY k) AS g FROM fl) GROUP BY ALL) GROUP BY 1),
ra AS (SELECT strut_id, max(c) FILTER (NOT present) AS run FROM (SELECT strut_id, present, g, count(*) AS c FROM (SELECT *, k-row_number() OVER (PARTITION BY strut_id, present ORDER BY k) AS g FROM fl) GROUP BY ALL) GROUP BY 1),
ft AS (SELECT strut_id, any_value(reference) AS reference, 0.5::DOUBLE*any_value(reference) AS cutoff, count(*)::INT AS samples, avg(present::INT::DOUBLE) AS present_fraction,
  avg(deficient::INT::DOUBLE) AS deficit_fraction, CASE WHEN any_value(reference)>0 THEN avg(least(1, greatest(0, 1-fg/nullif(reference, 0)))) ELSE 1 END AS material_loss, min(fg) AS minimum,
  CASE WHEN any_value(reference)>0 THEN min(fg)/nullif(any_value(reference), 0) END AS relative_minimum, min(sm) FILTER (sk=3) AS smoothed_minimum,
  avg(present::INT::DOUBLE) FILTER (k<greatest(1, m//3)) AS left_present, avg(present::INT::DOUBLE) FILTER (k>=m-greatest(1, m//3)) AS right_present FROM fl GROUP BY strut_id),
fx AS (SELECT ft.*, coalesce(rd.run, 0)::INT AS deficit_run, coalesce(ra.run, 0)::INT AS longest_absent FROM ft JOIN rd USING (strut_id) JOIN ra USING (strut_id)),
ev AS (SELECT *, strut_id%3=0 AS connected, strut_id%7<>0 AS both_observed, 0.01::DOUBLE*(strut_id%30) AS collar_a, 0.2::DOUBLE AS collar_b, (strut_id%11)*100 AS voxels_a, 1000 AS voxels_b FROM fx),
ms AS (SELECT *, NOT connected AND present_fraction<=0.10 AS is_missing, (deficit_fraction>=0.15 OR deficit_run>=3) AS deficit, both_observed AND least(collar_a, collar_b)>=0.05 AND least(voxels_a, voxels_b)>=500 AS evidence FROM ev),
rl AS (SELECT *, CASE WHEN is_missing THEN 'positive' ELSE 'negative' END AS missing, CASE WHEN is_missing THEN 'negative' WHEN deficit AND evidence THEN 'positive' WHEN NOT connected THEN 'review' ELSE 'negative' END AS broken,
  CASE WHEN is_missing THEN 'missing' WHEN deficit AND evidence AND connected THEN 'connected_bite' WHEN deficit AND evidence THEN 'disconnected_fragment' WHEN NOT connected THEN 'unresolved_disconnection' ELSE 'no_deficit' END AS broken_reason FROM ms)
"""


def features(spark, d):
    rows = V.profiles(spark, d)
    n = F.col("n")
    indexed = F.transform("fg", lambda x, i: F.struct(i.alias("i"), x.alias("fg")))
    central = F.filter(indexed, lambda p: (10 * p["i"] >= 2 * (n - 1)) & (10 * p["i"] <= 8 * (n - 1)))
    return C.profile_features(rows, central=central).drop("fg", "n")


def evidence(spark, d):
    s = F.col("strut_id")
    return features(spark, d).select(
        "*", (s % 3 == 0).alias("connected"), (s % 7 != 0).alias("both_observed"), (F.lit(0.01) * (s % 30)).alias("collar_a"), F.lit(0.2).alias("collar_b"),
        ((s % 11) * 100).alias("voxels_a"), F.lit(1000).alias("voxels_b"))


def ruled(spark, d):
    kind, reason = C.broken_rule()
    return evidence(spark, d).withColumn("missing", C.missing_rule()).withColumn("broken_reason", reason).withColumn("broken", kind)


_COLS = ["reference", "cutoff", "present_fraction", "deficit_fraction", "material_loss", "minimum", "relative_minimum", "smoothed_minimum", "left_present", "right_present"]


@query("profile_features", _FEATURES + "SELECT strut_id, samples, longest_absent, deficit_run, " + ", ".join(R(c, c) for c in _COLS) + " FROM fx")
def profile_features(spark, d):
    return features(spark, d)


@query("missing_rule", _FEATURES + "SELECT strut_id, missing FROM rl")
def missing_rule(spark, d):
    return ruled(spark, d).select("strut_id", "missing")


@query("broken_rule", _FEATURES + "SELECT strut_id, broken, broken_reason FROM rl")
def broken_rule(spark, d):
    return ruled(spark, d).select("strut_id", "broken", "broken_reason")


@query("classify_merge", _FEATURES + """, mg AS (SELECT *, CASE WHEN strut_id%13=0 THEN 'positive' ELSE 'negative' END AS thin, CASE WHEN strut_id%5=0 THEN 'deferred' WHEN strut_id%17=0 THEN 'positive' ELSE 'negative' END AS bent FROM rl),
k AS (SELECT *, CASE WHEN missing='positive' THEN 'missing' WHEN broken='positive' THEN 'broken' WHEN thin='positive' THEN 'thin' WHEN broken='review' OR bent='deferred' THEN 'deferred' ELSE 'present' END AS class FROM mg)
SELECT strut_id, class, CASE WHEN class='deferred' AND broken='review' THEN 'specialist_review_required' WHEN class='deferred' THEN 'specialist_implementation_deferred' WHEN class='present' THEN 'all_negative' ELSE class||'_positive' END AS reason,
CASE WHEN bent='deferred' THEN 'unknown' WHEN bent='positive' THEN 'true' ELSE 'false' END AS is_bent, class IN ('missing','broken','thin') OR bent='positive' OR broken='review' AS evidence_required FROM k""")
def classify_merge(spark, d):
    s = F.col("strut_id")
    rows = ruled(spark, d).withColumn("thin", F.when(s % 13 == 0, "positive").otherwise("negative")).withColumn("bent", F.when(s % 5 == 0, "deferred").when(s % 17 == 0, "positive").otherwise("negative"))
    return C.merge(rows).select("strut_id", "class", "reason", F.coalesce(F.col("is_bent").cast("string"), F.lit("unknown")).alias("is_bent"), "evidence_required")


@query("classify_legacy", with_views("v_class") + """, m AS (SELECT id, quantity/50 AS occupancy, discount*10 AS gap, (id%100)/100.0::DOUBLE AS component, most/50 AS radius, (id%13)::DOUBLE AS curvature FROM v_class)
SELECT id, CASE WHEN occupancy<=0.8 AND gap>=0.1 THEN 'missing' WHEN gap>=0.9 OR component<=0.05 THEN 'broken' WHEN radius<=0.1 THEN 'thin' ELSE 'present' END AS class, curvature>=10 AS bent FROM m""")
def classify_legacy(spark, d):
    rows = V.classes(spark, d).select("id", (F.col("quantity") / 50).alias("occupancy"), (F.col("discount") * 10).alias("gap"), ((F.col("id") % 100) / 100.0).alias("component"), (F.col("most") / 50).alias("radius"), (F.col("id") % 13).cast("double").alias("curvature"))
    kind, bent = C.legacy_class()
    return rows.select("id", kind.alias("class"), bent.alias("bent"))


_REMAP = with_views("v_strut", "v_junction", "v_placed", "v_class") + """, r AS (SELECT p.id, CASE WHEN p.id%31=0 THEN 'deferred' ELSE c.class END AS class, p.id%2=0 AS connected, ay=18 OR by_=18 AS plane FROM v_placed p JOIN v_class c USING (id)),
w AS (SELECT *, CASE WHEN class='deferred' THEN 'deferred_to_present' WHEN class IN ('missing','broken') AND plane THEN 'exclude_crop_plane' WHEN class='broken' AND connected THEN 'connected_broken_to_present' END AS why FROM r)
"""


def _remapped(spark, d):
    from strutwise.plans.queries_graph import _placed

    rows = _placed(spark, d).join(V.classes(spark, d).select("id", "class"), "id").withColumn("class", F.when(F.col("id") % 31 == 0, "deferred").otherwise(F.col("class")))
    rows = rows.withColumn("connected", F.col("id") % 2 == 0).withColumn("reasons", F.array(F.col("class")))
    return C.report_remap(rows, C.touches_plane(F.col("ay"), F.col("by"), 18.0))


@query("report_remap", _REMAP + "SELECT id, class AS original_class, CASE WHEN why IS NULL THEN class ELSE 'present' END AS class, CASE WHEN why IS NULL THEN class ELSE class||'|'||why END AS reasons FROM w")
def report_remap(spark, d):
    return _remapped(spark, d).select("id", "original_class", "class", F.concat_ws("|", "reasons").alias("reasons"))


@query("remap_counts", _REMAP + "SELECT class AS original_class, CASE WHEN why IS NULL THEN class ELSE 'present' END AS class, count(*)::BIGINT AS n FROM w GROUP BY 1, 2")
def remap_counts(spark, d):
    return _remapped(spark, d).groupBy("original_class", "class").agg(F.count("*").alias("n"))


@query("validation_export", _REMAP + f""", x AS (SELECT w.*, c.quantity, c.price, p.ax, p.ay, p.az, p.bx, p.by_, p.bz FROM w JOIN v_placed p USING (id) JOIN v_class c USING (id))
SELECT id, class, connected, plane, {R('quantity', 'quantity')}, {R('price', 'price')}, ax, ay, az, bx, by_ AS by, bz FROM x WHERE class='missing' AND plane OR class='broken' AND plane AND NOT connected""")
def validation_export(spark, d):
    rows = _remapped(spark, d).withColumn("plane", C.touches_plane(F.col("ay"), F.col("by"), 18.0)).drop("class")
    rows = rows.join(V.classes(spark, d).select("id", "quantity", "price"), "id").withColumnRenamed("original_class", "class")
    kept = rows.where((F.col("class") == "missing") & F.col("plane") | (F.col("class") == "broken") & F.col("plane") & ~F.col("connected"))
    return kept.select("id", "class", "connected", "plane", "quantity", "price", "ax", "ay", "az", "bx", "by", "bz")


@query("unconnected_split", _FEATURES + "SELECT strut_id, CASE WHEN present_fraction<=0.10 THEN 'missing' WHEN both_observed AND voxels_a>0 THEN 'broken' ELSE 'review' END AS label FROM ev WHERE NOT connected")
def unconnected_split(spark, d):
    rows = evidence(spark, d).where("not connected")
    return rows.select("strut_id", C.split_without_connection(F.col("present_fraction"), F.col("both_observed"), F.col("voxels_a") > 0).alias("label"))


@query("material_loss", _FEATURES + """SELECT strut_id, CASE WHEN strut_id%10=0 THEN 'intentional_edge_crop' WHEN NOT connected AND present_fraction<=0.10 THEN 'missing' WHEN NOT connected AND deficit_fraction>=0.15 THEN 'broken'
WHEN NOT connected THEN 'not_connected_review' WHEN deficit_fraction>=0.15 THEN 'connected_loss' ELSE 'present' END AS label FROM ev""")
def material_loss(spark, d):
    rows = evidence(spark, d)
    return rows.select("strut_id", C.material_loss_label(F.col("strut_id") % 10 == 0, F.col("connected"), F.col("present_fraction"), F.col("deficit_fraction")).alias("label"))


@query("specialist_counts", _FEATURES + """SELECT kind, count(*)::BIGINT AS total, count_if(v='positive')::BIGINT AS positive, count_if(v='negative')::BIGINT AS negative, count_if(v='review')::BIGINT AS review
FROM (SELECT 'missing' AS kind, missing AS v FROM rl UNION ALL SELECT 'broken', broken FROM rl) GROUP BY kind""")
def specialist_counts(spark, d):
    long = ruled(spark, d).select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("v")) for k in ("missing", "broken")])).alias("s")).select("s.*")
    return long.groupBy("kind").agg(F.count("*").alias("total"), *[F.count_if(F.col("v") == k).alias(k) for k in ("positive", "negative", "review")])
