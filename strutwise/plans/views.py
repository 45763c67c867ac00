"""Lattice-shaped views of the test tables, for Spark and, as SQL text, for the oracle.

No scan or lattice file comes with the tables, so voxels, profiles, struts,
junctions, classes and points are derived from them by fixed arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHAPE = (7, 32, 32)
#: Supplier junctions are numbered from here.
SUPPLIERS = 1_000_000_000
STRIDE = 10_000_000
#: Rows of a table that one task groups.
ROWS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_strut(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Items with their strut's ``id``, by it over as many tasks as the table's rows ask for.

    Most struts have one item, so combining before the shuffle would hold
    nearly every row of a file's part; what a task holds does not grow with the
    table this way, and what goes on by ``id`` isn't shuffled again.
    """
    li = table(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-li.count() // ROWS))
    key = (F.col("l_partkey") * F.lit(STRIDE) + F.col("l_suppkey")).cast("long").alias("id")
    return li.select(key, "l_partkey", "l_suppkey", *columns).repartition(tasks, "id")


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy((F.col("l_linenumber") - 1).cast("int").alias("z"), (F.col("l_suppkey") % 32).cast("int").alias("y"), (F.col("l_partkey") % 32).cast("int").alias("x")).agg(F.count("*").alias("value"))


def intensities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.least(F.floor(F.col("l_extendedprice") / 2).cast("int"), F.lit(65535)).alias("value"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user: ``strut_id, n, fg`` in event order."""
    ev = table(spark, sf_dir, "events")
    by_user = ev.groupBy(F.col("user_id").cast("long").alias("strut_id")).agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", F.least(F.col("value") / 50.0, F.lit(1.0)).alias("fg")))).alias("rows"), F.count("*").alias("n")
    )
    return by_user.select("strut_id", "n", F.transform("rows", lambda r: r["fg"]).alias("fg"))


def daily_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and day, most of them very short: ``strut_id, n, fg`` in event order."""
    ev = table(spark, sf_dir, "events").withColumn("strut_id", (F.col("user_id") * 100_000 + F.unix_date(F.to_date("ts"))).cast("long"))
    by_day = ev.groupBy("strut_id").agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", F.least(F.col("value") / 50.0, F.lit(1.0)).alias("fg")))).alias("rows"), F.count("*").alias("n")
    )
    return by_day.select("strut_id", "n", F.transform("rows", lambda r: r["fg"]).alias("fg"))


def struts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_strut(spark, sf_dir).select(
        "id", F.col("l_partkey").cast("long").alias("junction0"), (F.col("l_suppkey") + F.lit(SUPPLIERS)).cast("long").alias("junction1")
    ).distinct()


def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda k, by: (F.floor(F.col(k) / F.lit(float(by))).cast("long") % 19).cast("double")
    one = lambda name, key, shift: table(spark, sf_dir, name).select(
        (F.col(key) + F.lit(shift)).cast("long").alias("id"), (F.col(key) % 19).cast("double").alias("x"), at(key, 19).alias("y"), at(key, 361).alias("z"))
    return one("part", "p_partkey", 0).unionByName(one("supplier", "s_suppkey", SUPPLIERS))


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _by_strut(spark, sf_dir, "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    sums = li.groupBy("id", "l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("q"), F.max("l_discount").alias("d"), F.min("l_tax").alias("t"), F.max("l_quantity").alias("m"), F.sum("l_extendedprice").alias("price")
    )
    kind = F.when(F.col("q") <= 3, "missing").when((F.col("d") >= 0.1) & (F.col("t") <= 0.0), "broken").when(F.col("m") <= 8, "thin").otherwise("present")
    return sums.select("id", kind.alias("class"), F.col("q").cast("double").alias("quantity"), F.col("d").cast("double").alias("discount"), F.col("m").cast("double").alias("most"), F.round(F.col("price").cast("double"), 2).alias("price"))


def points(spark: SparkSession, sf_dir: str, odd: int | None = None) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), *[F.col("embedding")[k].cast("double").alias(c) for k, c in enumerate("xyz")], F.col("label").cast("int").alias("label"))
    return e if odd is None else e.where(F.col("id") % 2 == odd)


def numbered_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long form of ``profiles``: ``strut_id, i (from 0), n, fg``."""
    return profiles(spark, sf_dir).select("strut_id", "n", F.posexplode("fg").alias("i", "fg"))


SQL = {
    "v_voxel": "SELECT (l_linenumber-1)::INT AS z, (l_suppkey%32)::INT AS y, (l_partkey%32)::INT AS x, count(*)::BIGINT AS value FROM lineitem GROUP BY ALL",
    "v_intensity": "SELECT least(floor(l_extendedprice/2)::INT, 65535) AS value FROM lineitem",
    "v_profile": """SELECT strut_id, n, i, fg FROM (
        SELECT user_id::BIGINT AS strut_id, count(*) OVER (PARTITION BY user_id) AS n,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, least(value/50.0::DOUBLE, 1.0::DOUBLE) AS fg FROM events)""",
    "v_day": """SELECT strut_id, count(*) OVER w AS n, row_number() OVER (PARTITION BY strut_id ORDER BY ts, event_id) - 1 AS i, fg FROM (
        SELECT (user_id*100000+(ts::DATE-DATE '1970-01-01'))::BIGINT AS strut_id, ts, event_id, least(value/50.0::DOUBLE, 1.0::DOUBLE) AS fg FROM events) WINDOW w AS (PARTITION BY strut_id)""",
    "v_strut": f"SELECT DISTINCT (l_partkey*{STRIDE}+l_suppkey)::BIGINT AS id, l_partkey::BIGINT AS junction0, (l_suppkey+{SUPPLIERS})::BIGINT AS junction1 FROM lineitem",
    "v_junction": f"""SELECT p_partkey::BIGINT AS id, (p_partkey%19)::DOUBLE AS x, (floor(p_partkey/19.0)::BIGINT%19)::DOUBLE AS y, (floor(p_partkey/361.0)::BIGINT%19)::DOUBLE AS z FROM part
        UNION ALL SELECT (s_suppkey+{SUPPLIERS})::BIGINT, (s_suppkey%19)::DOUBLE, (floor(s_suppkey/19.0)::BIGINT%19)::DOUBLE, (floor(s_suppkey/361.0)::BIGINT%19)::DOUBLE FROM supplier""",
    "v_class": f"""SELECT (l_partkey*{STRIDE}+l_suppkey)::BIGINT AS id,
        CASE WHEN sum(l_quantity)<=3 THEN 'missing' WHEN max(l_discount)>=0.1 AND min(l_tax)<=0.0 THEN 'broken' WHEN max(l_quantity)<=8 THEN 'thin' ELSE 'present' END AS class,
        sum(l_quantity)::DOUBLE AS quantity, max(l_discount)::DOUBLE AS discount, max(l_quantity)::DOUBLE AS most, round(sum(l_extendedprice)::DOUBLE, 2) AS price FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "v_points": "SELECT vec_id::BIGINT AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, label::INT AS label FROM embeddings",
    "v_hist": "SELECT value::INT AS bin, count(*)::BIGINT AS c FROM v_intensity GROUP BY 1",
    "v_placed": """SELECT s.*, a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS by_, b.z AS bz FROM v_strut s
        JOIN v_junction a ON s.junction0=a.id JOIN v_junction b ON s.junction1=b.id""",
}


def with_views(*names: str) -> str:
    """A WITH clause of the named views, in the order given."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n"
