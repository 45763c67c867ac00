"""Lattice JSON, metrics CSV, profile, label and id documents, and small report files."""

from __future__ import annotations

import hashlib
import io
import json
import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strutwise.operators import lattice as L

LATTICE = (
    "junctions array<struct<id:bigint,position:array<double>,indices:array<double>>>, "
    "struts array<struct<id:bigint,junction0:bigint,junction1:bigint,unit_cell_edge_idx:bigint,thickness:double>>, "
    "unit_cells array<struct<id:bigint,struts:array<bigint>,indices:array<double>>>"
)

# Columns of the per-strut metrics file, in order: fixed names and kinds.
METRIC_COLUMNS = (
    "strut_id", "junction0_id", "junction1_id", "length_voxels", "corridor_radius_voxels", "cuboid_half_width_voxels", "axial_padding_fraction_total",
    "corridor_foreground_fraction", "minimum_foreground_fraction", "median_foreground_fraction", "maximum_foreground_fraction",
    "maximum_axial_gap_samples", "maximum_axial_gap_fraction", "endpoint0_support_fraction", "endpoint1_support_fraction",
    "a_collar_foreground_fraction", "b_collar_foreground_fraction", "interior_component_count", "largest_component_fraction",
    "same_material_component_connects_a_to_b", "same_component_connects_collar_a_to_b", "shared_component_voxel_count_in_corridor",
    "endpoint0_to_collar_component_voxel_count_in_corridor", "endpoint1_to_collar_component_voxel_count_in_corridor", "both_endpoint_segments_observed",
    "junction_masked_collar_shared_component_voxel_count_in_corridor", "edt_radius_median_voxels", "centerline_curvature_rms_voxels", "roi_in_bounds_fraction", "roi_valid",
)
METRIC_LONGS = (
    "strut_id", "junction0_id", "junction1_id", "maximum_axial_gap_samples", "interior_component_count", "shared_component_voxel_count_in_corridor",
    "endpoint0_to_collar_component_voxel_count_in_corridor", "endpoint1_to_collar_component_voxel_count_in_corridor", "junction_masked_collar_shared_component_voxel_count_in_corridor",
)
METRIC_FLAGS = ("same_material_component_connects_a_to_b", "same_component_connects_collar_a_to_b", "both_endpoint_segments_observed", "roi_valid")


def read_lattice(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(junctions, struts, unit cells) of a lattice document; keys beyond the known ones are left out."""
    return lattice_tables(spark.read.schema(LATTICE).option("multiLine", True).option("mode", "FAILFAST").json(path))


def lattice_tables(doc: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same of documents that are rows already (schema ``LATTICE``)."""
    j = doc.select(F.explode("junctions").alias("r")).select(
        "r.id", *[F.get("r.position", k).alias(c) for k, c in enumerate("xyz")], *[F.get("r.indices", k).alias(f"i{c}") for k, c in enumerate("xyz")]
    )
    s = doc.select(F.explode("struts").alias("r")).select("r.id", "r.junction0", "r.junction1", F.coalesce("r.unit_cell_edge_idx", F.lit(-1)).alias("unit_cell_edge_idx"), "r.thickness")
    c = doc.select(F.explode("unit_cells").alias("r")).select("r.id", *[F.get("r.indices", k).alias(f"i{x}") for k, x in enumerate("xyz")], "r.struts")
    return j, s, c


def checked_lattice(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``read_lattice``; repeated ids or pairs, loops and unknown ends raise an error that counts them."""
    j, s, c = read_lattice(spark, path)
    found = L.problems(s, j).first().asDict()
    members = c.select(F.explode("struts").alias("id")).join(s, "id", "left_anti").count()
    if any(found.values()) or members:
        raise ValueError(f"the lattice is not sound: {found | {'unknown_members': members}}")
    return j, s, c


def moved_lattice(doc: DataFrame, positions: DataFrame) -> DataFrame:
    """A lattice document (schema ``LATTICE``) with new ``x, y, z`` by junction id; junctions without keep theirs."""
    rows = doc.withColumn("__doc", F.monotonically_increasing_id())
    new = rows.select("__doc", F.posexplode("junctions").alias("at", "j")).join(positions.select("id", F.array("x", "y", "z").alias("p")), F.col("j.id") == F.col("id"), "left")
    put = new.select("__doc", "at", F.col("j").withField("position", F.coalesce("p", "j.position")).alias("j"))
    back = put.groupBy("__doc").agg(F.sort_array(F.collect_list(F.struct("at", "j"))).alias("js")).select("__doc", F.transform("js", lambda x: x["j"]).alias("junctions"))
    return rows.drop("junctions").join(back, "__doc").select(*doc.columns)


def metrics_schema(header: list[str]) -> T.StructType:
    kind = lambda n: T.LongType() if n in METRIC_LONGS else T.BooleanType() if n in METRIC_FLAGS else T.DoubleType()
    return T.StructType([T.StructField(n, kind(n)) for n in header])


def read_metrics(spark: SparkSession, path: str, expected: set[str] | None = None) -> DataFrame:
    """Per-strut metrics from CSV; blank is null; the header must be the expected set of names, in any order."""
    header = [c.strip() for c in spark.read.text(path).first()[0].split(",")]
    if len(set(header)) != len(header) or (expected is not None and set(header) != expected):
        raise ValueError(f"unexpected columns: {sorted(set(header) ^ (expected or set(header)))}")
    return spark.read.schema(metrics_schema(header)).option("header", True).option("enforceSchema", False).option("nullValue", "").option("mode", "FAILFAST").csv(path)


def csv_number(value: Column) -> Column:
    """Twelve significant digits; blank for null and non-finite values."""
    v = value.cast("double")
    digits = F.lit(11) - F.floor(F.log10(F.abs(v))).cast("int")
    short = F.when(v == 0, v).otherwise(F.round(v * F.pow(F.lit(10.0), digits)) / F.pow(F.lit(10.0), digits))
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), "").otherwise(F.regexp_replace(short.cast("string"), r"\.0$", ""))


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Exactly these columns in this order; true and false in small letters, numbers by ``csv_number``."""
    extra = set(df.columns) ^ set(columns)
    if extra:
        raise ValueError(f"columns don't match: {sorted(extra)}")
    kinds = dict(df.dtypes)
    shown = [csv_number(F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    df.select(*shown).write.option("header", True).option("emptyValue", "").mode("errorifexists").csv(path)


def read_profiles(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``strut_id, t, fg`` from profile documents (with ``lines`` one a line); ids must be unique and the documents mark measurements only."""
    schema = "measurement_only boolean, profiles array<struct<strut_id:bigint,axial_t:array<double>,foreground_fraction:array<double>>>"
    doc = spark.read.schema(schema).option("multiLine", not lines).json(path)
    if doc.where("not coalesce(measurement_only, false)").limit(1).count():
        raise ValueError("a profile document does not say that it holds measurements only")
    rows = doc.select(F.explode("profiles").alias("p")).select("p.strut_id", F.col("p.axial_t").alias("t"), F.col("p.foreground_fraction").alias("fg"))
    if L.duplicates(rows, "strut_id").limit(1).count():
        raise ValueError("a strut has two profiles")
    return rows


def canonical(value) -> str:
    """JSON with sorted keys, no spaces and no NaN; text outside ASCII as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def digest(value) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def write_report(path: str, value, overwrite: bool = False) -> bool:
    """Writes a small JSON report on the driver in one step; says whether the file changed.

    The same content again changes nothing; other content raises an error
    unless it may be overwritten.
    """
    return write_text(path, json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n", overwrite)


def write_text(path: str, body: str, overwrite: bool = False) -> bool:
    """Writes a small UTF-8 text as ``write_report`` does."""
    return write_bytes(path, body.encode("utf-8"), overwrite)


def write_bytes(path: str, body: bytes, overwrite: bool = False) -> bool:
    if os.path.exists(path):
        with open(path, "rb") as f:
            if f.read() == body:
                return False
        if not overwrite:
            raise FileExistsError(f"{path} holds something else")
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=folder)
    with os.fdopen(handle, "wb") as f:
        f.write(body)
        f.flush()
        os.fsync(f.fileno())
    os.replace(name, path)
    return True


def write_histogram(folder: str, hist: DataFrame, report: dict, bins: int = 65_536) -> bool:
    """``histogram.npy`` (counts of all bins) and ``report.json`` of a threshold, both or neither; says whether either changed."""
    counts = np.zeros(bins, dtype=np.int64)
    for r in hist.collect():  # a row for each bin at most
        counts[r.bin] = r.c
    handle = io.BytesIO()
    np.save(handle, counts)
    first, second = os.path.join(folder, "histogram.npy"), os.path.join(folder, "report.json")
    fresh = not os.path.exists(first)
    changed = write_bytes(first, handle.getvalue())
    try:
        return write_report(second, report) or changed
    except BaseException:
        if fresh:
            os.unlink(first)
        raise


def read_object(spark: SparkSession, path: str) -> dict:
    """A small JSON document, which must be an object at the top."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    value = json.loads(rows[0].value) if len(rows) == 1 else None
    if not isinstance(value, dict):
        raise ValueError(f"{path} is not one JSON object")
    return value


def strict_integer(text: Column) -> Column:
    """A whole number written as digits with or without a sign; blank is null, anything else an error."""
    t = F.trim(text)
    return F.when(t.isNull() | (t == ""), None).when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long")).otherwise(F.raise_error(F.concat(F.lit("not a whole number: "), t)).cast("long"))


def strict_flag(text: Column) -> Column:
    """``true`` or ``false`` in any case; blank is null, anything else an error."""
    t = F.lower(F.trim(text))
    return F.when(t.isNull() | (t == ""), None).when(t == "true", True).when(t == "false", False).otherwise(F.raise_error(F.concat(F.lit("not a flag: "), t)).cast("boolean"))


def utc_text(at: Column) -> Column:
    """A time as ISO 8601 text in UTC with up to six digits of a second and ``Z``."""
    shown = F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(F.regexp_replace(shown, "0+$", ""), r"\.$", ""), F.lit("Z"))


def utc_time(text: Column) -> Column:
    """The time that ``utc_text`` writes; null for text of another form, more than six digits of a second among it."""
    ok = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$")
    return F.when(ok, F.try_to_timestamp(text))


def read_ids(spark: SparkSession, path: str | list[str], column: str = "strut_id") -> DataFrame:
    """The distinct ids of a column of CSV files with headers."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(strict_integer(F.col(column)).alias(column)).where(F.col(column).isNotNull()).distinct()


def read_endpoints(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of CSV files by ``strut_id`` (long) and ``endpoint`` (A or B); a pair twice raises an error."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.withColumn("strut_id", strict_integer(F.col("strut_id")))
    if rows.where(~F.coalesce(F.col("endpoint").isin("A", "B"), F.lit(False))).limit(1).count():
        raise ValueError("an endpoint is neither A nor B")
    if rows.groupBy("strut_id", "endpoint").count().where("count > 1").limit(1).count():
        raise ValueError("an endpoint of a strut has two rows")
    return rows


def read_compact_profiles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``strut_id, length, fg`` from NPZ files of arrays ``strut_id, length_voxels, axial_disk_foreground_fraction``.

    Values that aren't finite are dropped; a strut in two rows raises an error.
    """

    def run(frames):
        for f in frames:
            for content in f["content"]:
                with np.load(io.BytesIO(bytes(content))) as z:
                    ids, lengths, fg = z["strut_id"], z["length_voxels"], z["axial_disk_foreground_fraction"]
                    if not len(ids) == len(lengths) == len(fg):
                        raise ValueError("arrays of a profile file differ in length")
                    yield pd.DataFrame({"strut_id": ids.astype(np.int64), "length": lengths.astype(float), "fg": [np.asarray(x, float)[np.isfinite(np.asarray(x, float))].tolist() for x in fg]})

    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "strut_id long, length double, fg array<double>")
    if L.duplicates(rows, "strut_id").limit(1).count():
        raise ValueError("a strut has two profiles")
    return rows


def write_lattice(junctions: DataFrame, struts: DataFrame, cells: DataFrame, folder: str) -> dict:
    """A lattice as Parquet tables ``junction, strut, cell, cell_strut`` with each one's rows; tables that exist raise an error.

    ``strut`` has the lower and the higher end beside the ends as given;
    ``cell_strut`` lists members by place.
    """
    tables = {
        "junction": junctions, "strut": struts.withColumns({"low_end": F.least("junction0", "junction1"), "high_end": F.greatest("junction0", "junction1")}),
        "cell": cells.drop("struts"), "cell_strut": L.membership(cells),
    }
    for name, rows in tables.items():
        rows.write.mode("errorifexists").parquet(f"{folder}/{name}")
    return {name: rows.sparkSession.read.parquet(f"{folder}/{name}").count() for name, rows in tables.items()}


def envelope(status: str, gate: str, summary: str, result=None, artifacts=(), hashes=None, warnings=(), error=None) -> dict:
    """The one shape in which every tool answers."""
    if status not in ("ok", "error") or gate not in ("pass", "halt", "manual_review"):
        raise ValueError("unknown status or gate")
    return {"status": status, "gate": gate, "summary": summary, "result": result, "artifacts": list(artifacts), "hashes": dict(hashes or {}), "warnings": list(warnings), "error": error}


def answered(f, *args, **kwargs) -> dict:
    """``f``'s envelope, or one that carries its exception."""
    try:
        return f(*args, **kwargs)
    except Exception as e:  # the caller gets the reason, whatever it is
        return envelope("error", "halt", f"{type(e).__name__}: {e}", error={"type": type(e).__name__, "message": str(e)})


def publish_bundle(folder: str, files: dict[str, str]) -> bool:
    """Writes a folder of small text files in one step; says whether anything changed.

    The files are staged beside the folder, which then appears by one rename.
    A folder that holds exactly these files already is left alone; one that
    holds anything else raises an error.
    """
    if os.path.isdir(folder):
        have = {}
        for name in os.listdir(folder):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                have[name] = f.read()
        if have == files:
            return False
        raise FileExistsError(f"{folder} holds something else")
    parent = os.path.dirname(os.path.abspath(folder))
    os.makedirs(parent, exist_ok=True)
    stage = tempfile.mkdtemp(dir=parent)
    for name, body in files.items():
        with open(os.path.join(stage, name), "w", encoding="utf-8", newline="\n") as f:
            f.write(body)
            f.flush()
            os.fsync(f.fileno())
    os.rename(stage, folder)
    return True
