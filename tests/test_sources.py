"""Readers and writers on small files made here."""

import hashlib
import json
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from strutwise.operators import histogram as H
from strutwise.sources import documents as D
from strutwise.sources import meshes as M
from strutwise.sources import volumes as V
from strutwise.streaming import counts as C


def save(path, a):
    np.save(path, a)
    return str(path)


def test_volume_axes_and_types(spark, tmp_path):
    a = np.zeros((3, 4, 5), dtype=np.uint16)
    a[2, 1, 4] = 65_000
    for k, x in enumerate((a, a.astype(">u2"), np.asfortranarray(a))):
        blocks = V.read_volume(spark, save(tmp_path / f"v{k}.npy", x), slab_cells=20)
        assert blocks.count() == 3
        assert V.voxels(blocks).where("value > 0").collect() == [(2, 1, 4, 65_000.0)]
        assert {tuple(r) for r in V.histogram(blocks).collect()} == {(0, 59), (65_000, 1)}
    head = V.read_headers(spark, str(tmp_path / "v1.npy")).first()
    assert (head.shape, head.dtype, head.byte_order, head.cells) == ([3, 4, 5], "u2", "big", 60)
    part, first = V.gathered(blocks, 1, 3)
    assert first == 1 and (part == a[1:]).all()


@pytest.mark.parametrize("every", [1, 3])
def test_fortran_volumes_by_columns(spark, tmp_path, every):
    a = np.random.default_rng(0).integers(0, 9, (7, 4, 11)).astype(">u2")
    paths = [save(tmp_path / "f.npy", np.asfortranarray(a)), save(tmp_path / "c.npy", a)]
    for slab in (30, 100, 10_000):
        one, two = (sorted((r.z0, r.nz, r.dtype, bytes(r.data)) for r in V.read_volume(spark, p, slab, every).collect()) for p in paths)
        assert one == two and len(one) > 0
    both = V.read_volume(spark, paths, 100, every)
    assert both.groupBy("path").agg(F.sum("nz").alias("n")).select("n").distinct().count() == 1


def tiff(a, order="<", big=False, strips=2, description=b"", resolution=None, unit=None, one_page=False):
    """An uncompressed TIFF of the slices of ``a``, written by the format's rules."""
    a = a.astype(a.dtype.newbyteorder(order))
    width, head = ("Q", 16) if big else ("I", 8)
    body, ifds = b"", []
    data = [x.tobytes() for x in a]
    for k, raw in enumerate(data if not one_page else [b"".join(data)]):
        rows = a.shape[1] if one_page else -(-a.shape[1] // strips)
        size = rows * a.shape[2] * a.dtype.itemsize
        parts = [raw[i : i + size] for i in range(0, len(data[0]), size)] if not one_page else [raw]
        offsets = []
        for part in parts:
            offsets.append(head + len(body))
            body += part
        tags = [(256, "I", (a.shape[2],)), (257, "I", (a.shape[1],)), (258, "H", (a.dtype.itemsize * 8,)), (259, "H", (1,)), (273, width, offsets), (277, "H", (1,)), (278, "I", (rows,)),
                (279, width, [len(p) for p in parts]), (339, "H", ({"u": 1, "i": 2, "f": 3}[a.dtype.kind],))]
        if description:
            tags.append((270, "s", description))
        if resolution:
            tags += [(282, "II", resolution), (283, "II", resolution), (296, "H", (unit,))]
        ifds.append(sorted(tags))
    out, codes = body, {"H": 3, "I": 4, "Q": 16, "s": 2, "II": 5}
    places, blobs = [], []
    at = head + len(body)
    for tags in ifds:
        entry = 20 if big else 12
        size = (8 if big else 2) + entry * len(tags) + (8 if big else 4)
        extra, rows, start = b"", b"", at + size
        for tag, kind, value in tags:
            raw = value if kind == "s" else struct.pack(order + kind * (1 if kind == "II" else len(value)), *value)
            room = 8 if big else 4
            n = len(value) if kind == "s" else 1 if kind == "II" else len(value)
            if len(raw) > room:
                extra, raw = extra + raw, struct.pack(order + width, start + len(extra))
            rows += struct.pack(order + "HH" + width, tag, codes[kind], n) + raw.ljust(room, b"\0")
        places.append(at)
        blobs.append((rows, len(tags), extra))
        at = start + len(extra)
    for (rows, n, extra), after in zip(blobs, [*places[1:], 0]):
        out += struct.pack(order + ("Q" if big else "H"), n) + rows + struct.pack(order + width, after) + extra
    first = (b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, places[0]) if big else struct.pack(order + "HI", 42, places[0]))
    return first + out


@pytest.mark.parametrize("kind", ["u1", "u2", "i2", "f4"])
@pytest.mark.parametrize("order,big,strips", [("<", False, 1), (">", False, 3), ("<", True, 2), (">", True, 1)])
def test_tiff_stacks(spark, tmp_path, kind, order, big, strips):
    a = (np.arange(5 * 6 * 7).reshape(5, 6, 7) % 120).astype(kind)
    (tmp_path / "v.tif").write_bytes(tiff(a, order, big, strips))
    blocks = V.read_volume(spark, str(tmp_path / "v.tif"), slab_cells=90)
    part, _ = V.gathered(blocks, 0, 5)
    assert (part == a).all() and part.dtype.newbyteorder("=") == a.dtype and blocks.count() == 3
    head = V.read_headers(spark, str(tmp_path / "v.tif")).first()
    assert (head.shape, head.dtype, head.cells) == ([5, 6, 7], kind, 210)
    some = V.read_volume(spark, str(tmp_path / "v.tif"), every=2)
    assert {r.z0 for r in some.collect()} == {0, 2, 4} and (V.gathered(some.where("z0 = 4"), 4, 5)[0] == a[4:]).all()


def test_tiff_of_one_page_with_images_behind_it(spark, tmp_path):
    a = np.arange(4 * 3 * 2).reshape(4, 3, 2).astype("u2")
    (tmp_path / "v.tif").write_bytes(tiff(a, description=b"ImageJ=1.53\nimages=4\nslices=4\nunit=mm\nspacing=0.5\n", one_page=True))
    assert (V.gathered(V.read_volume(spark, str(tmp_path / "v.tif")), 0, 4)[0] == a).all()


def test_compressed_tiff_is_refused(spark, tmp_path):
    raw = bytearray(tiff(np.zeros((1, 2, 2), "u1"), strips=1))
    at = raw.find(struct.pack("<HHI", 259, 3, 1))
    raw[at + 8] = 8
    (tmp_path / "v.tif").write_bytes(raw)
    with pytest.raises(Exception, match="compressed"):
        V.read_volume(spark, str(tmp_path / "v.tif")).count()


def test_spacing(spark, tmp_path):
    a = np.zeros((2, 2, 2), "u2")
    ome = b'<?xml version="1.0"?><OME xmlns="http://o"><Image><Pixels PhysicalSizeX="0.5" PhysicalSizeXUnit="um" PhysicalSizeZ="2" PhysicalSizeY="x"/></Image></OME>'
    files = {
        "ome.tif": tiff(a, description=ome, resolution=(100, 1), unit=3), "ij.tif": tiff(a, description=b"ImageJ=1\nspacing=0.25\nunit=mm\n"),
        "inch.tif": tiff(a, resolution=(254, 1), unit=2), "none.tif": tiff(a, resolution=(3, 1), unit=1), "bad.tif": tiff(a, description=b"<broken"),
    }
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    np.save(tmp_path / "v.npy", a)
    got = {(r.path.rsplit("/", 1)[1], r.axis): (r.value, r.unit, r.source) for r in V.read_spacing(spark, [str(tmp_path / n) for n in [*files, "v.npy"]]).collect()}
    unknown = (None, "unknown", "unknown")
    assert [got["ome.tif", c] for c in "xyz"] == [(0.5, "um", "ome_xml"), (0.1, "mm", "tiff_tag"), (2.0, "unknown", "ome_xml")]
    assert [got["ij.tif", c] for c in "xyz"] == [unknown, unknown, (0.25, "mm", "imagej_metadata")]
    assert got["inch.tif", "y"][1:] == ("mm", "tiff_tag") and abs(got["inch.tif", "y"][0] - 0.1) < 1e-12 and {got[n, c] for n in ("none.tif", "bad.tif", "v.npy") for c in "xyz"} == {unknown}


def test_mask_file(spark, tmp_path):
    a = np.random.default_rng(0).integers(0, 100, (6, 5, 4)).astype("u2")
    blocks = V.mask(V.read_volume(spark, save(tmp_path / "v.npy", a), slab_cells=40), 50)
    path = str(tmp_path / "mask.npy")
    assert V.write_npy(blocks, path) and not V.write_npy(blocks, path)
    assert (np.load(path) == (a >= 50)).all() and np.load(path).dtype == np.uint8
    with pytest.raises(FileExistsError):
        V.write_npy(V.mask(V.read_volume(spark, str(tmp_path / "v.npy")), 20), path)
    with pytest.raises(ValueError):
        V.write_npy(blocks.where("z0 > 0"), str(tmp_path / "part.npy"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["mask.npy", "v.npy"]


def test_small_documents(spark, tmp_path):
    path = str(tmp_path / "r.json")
    assert D.write_report(path, {"b": "é", "a": 1}) and not D.write_report(path, {"a": 1, "b": "é"})
    assert "é" in open(path, encoding="utf-8").read() and D.read_object(spark, path) == {"a": 1, "b": "é"}
    assert D.digest({"é": 1}) == hashlib.sha256('{"é":1}'.encode()).hexdigest()
    with pytest.raises(FileExistsError):
        D.write_text(path, "other")
    D.write_text(path, "[1]", overwrite=True)
    with pytest.raises(ValueError):
        D.read_object(spark, path)
    hist = spark.createDataFrame([(3, 5), (9, 1)], "bin int, c long")
    folder = str(tmp_path / "otsu")
    assert D.write_histogram(folder, hist, {"t": 3}, 16) and not D.write_histogram(folder, hist, {"t": 3}, 16)
    assert np.load(f"{folder}/histogram.npy").tolist() == [0, 0, 0, 5, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0]
    with pytest.raises(FileExistsError):
        D.write_histogram(folder, hist, {"t": 4}, 16)


def test_id_lists_endpoints_and_profiles(spark, tmp_path):
    (tmp_path / "a.csv").write_text("strut_id,x\n1,a\n 2 ,b\n2,c\n,d\n")
    assert sorted(r[0] for r in D.read_ids(spark, str(tmp_path / "a.csv")).collect()) == [1, 2]
    (tmp_path / "b.csv").write_text("strut_id\n1.5\n")
    with pytest.raises(Exception, match="not a whole number"):
        D.read_ids(spark, str(tmp_path / "b.csv")).collect()
    (tmp_path / "e1.csv").write_text("strut_id,endpoint,v\n1,A,5\n1,B,6\n")
    (tmp_path / "e2.csv").write_text("strut_id,endpoint,v\n1,A,7\n")
    assert D.read_endpoints(spark, str(tmp_path / "e1.csv")).count() == 2
    with pytest.raises(ValueError):
        D.read_endpoints(spark, [str(tmp_path / "e1.csv"), str(tmp_path / "e2.csv")])
    for k, ids in enumerate(([4, 5], [6])):
        np.savez(tmp_path / f"p{k}.npz", strut_id=ids, length_voxels=[10.0] * len(ids), axial_disk_foreground_fraction=np.array([[0.5, np.nan, 1.0]] * len(ids)))
    got = D.read_compact_profiles(spark, str(tmp_path / "p*.npz")).orderBy("strut_id").collect()
    assert [(r.strut_id, r.length, r.fg) for r in got] == [(i, 10.0, [0.5, 1.0]) for i in (4, 5, 6)]
    np.savez(tmp_path / "p2.npz", strut_id=[6], length_voxels=[1.0], axial_disk_foreground_fraction=[[1.0]])
    with pytest.raises(ValueError):
        D.read_compact_profiles(spark, str(tmp_path / "p*.npz"))


def test_conversions(spark):
    texts = [" 7 ", "-3", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(D.strict_integer(F.col("t"))).collect()] == [7, -3, None, None]
    assert [r[0] for r in spark.createDataFrame([("TRUE",), ("false ",), ("",)], "t string").select(D.strict_flag(F.col("t"))).collect()] == [True, False, None]
    for bad, f in (("7.0", D.strict_integer), ("yes", D.strict_flag)):
        with pytest.raises(Exception, match="not a"):
            spark.createDataFrame([(bad,)], "t string").select(f(F.col("t"))).collect()
    times = ["2024-02-29T23:59:59.123456Z", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.5Z", "2024-01-01T00:00:00.1234567Z", "2024-01-01T00:00:00", "2024-13-01T00:00:00Z", None]
    got = spark.createDataFrame([(t,) for t in times], "t string").select(D.utc_text(D.utc_time(F.col("t")))).collect()
    assert [r[0] for r in got] == [*times[:3], None, None, None, None]


def test_lattice_tables(spark, tmp_path):
    j = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 1.0, 0.0, 0.0)], "id long, x double, y double, z double")
    s = spark.createDataFrame([(9, 2, 1)], "id long, junction0 long, junction1 long")
    c = spark.createDataFrame([(5, [9])], "id long, struts array<bigint>")
    assert D.write_lattice(j, s, c, str(tmp_path / "l")) == {"junction": 2, "strut": 1, "cell": 1, "cell_strut": 1}
    assert spark.read.parquet(str(tmp_path / "l/strut")).first().low_end == 1
    with pytest.raises(Exception):
        D.write_lattice(j, s, c, str(tmp_path / "l"))


def test_only_real_volumes(spark, tmp_path):
    with pytest.raises(ValueError):
        V.npy_header(b"nope" * 10)
    with pytest.raises(ValueError):
        V.npy_header(open(save(tmp_path / "c.npy", np.zeros((2, 2, 2), complex)), "rb").read())
    with pytest.raises(Exception, match="axes"):
        V.read_volume(spark, save(tmp_path / "flat.npy", np.zeros((2, 2)))).count()


def test_two_levels(spark, tmp_path):
    a = np.array([10, 10, 20, 20, 20], dtype=">u2").reshape(1, 1, 5)
    hist = V.histogram(V.read_volume(spark, save(tmp_path / "v.npy", a)))
    t = H.otsu(hist)
    assert t.first() == (10, 1.0)
    d = H.diagnostics(hist, t).first()
    assert d.foreground_fraction == 1.0 and d.background_mean is None and not d.separation_ok


def test_float_volume_and_mask(spark, tmp_path):
    rng = np.random.default_rng(0)
    a = np.concatenate([rng.uniform(1, 2, 4000), rng.uniform(8, 9, 4000)]).astype(np.float32).reshape(20, 20, 20)
    blocks = V.read_volume(spark, save(tmp_path / "v.npy", a))
    hist = H.affine_histogram(V.voxels(blocks))
    assert hist.agg(F.sum("c")).first()[0] == 8000
    level = H.otsu(hist).first().threshold
    cut = float(a.min()) + level * (float(a.max()) - float(a.min())) / 65_535
    made = V.voxels(V.mask(blocks, cut))
    got = H.mask_comparison(made, F.col("value") > 0, F.col("value") == 1).first()
    assert got.exact_match and abs(got.foreground - 4000) <= 1
    stats = H.volume_stats(spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,), (3.0,)], "value double")).first()
    assert tuple(stats) == (1.0, 3.0, 2.0, 2, 3)
    with pytest.raises(ValueError):
        H.affine_histogram(spark.createDataFrame([(1.0,), (1.0,)], "value double"))


def test_one_level_and_none(spark):
    one = spark.createDataFrame([(7, 5)], "bin int, c long")
    assert H.otsu(one).first() == (7, 0.0) and H.triangle(one).first()[0] == 7
    assert H.otsu(one.limit(0)).count() == 0 == H.triangle(one.limit(0)).count()


def test_stl(spark, tmp_path):
    faces = np.zeros(3, dtype=M.TRIANGLE)
    faces["corners"] = np.arange(27).reshape(3, 3, 3)
    body = b" " * 80 + np.uint32(3).tobytes() + faces.tobytes()
    (tmp_path / "a.stl").write_bytes(body)
    t = M.read_stl(spark, str(tmp_path / "a.stl"))
    assert [tuple(r)[1:] for r in M.centroids(t).orderBy("face").collect()] == [(0, 3.0, 4.0, 5.0), (1, 12.0, 13.0, 14.0), (2, 21.0, 22.0, 23.0)]
    s = M.summary(t).first()
    assert (s.faces, s.vertices, s.low_x, s.high_z) == (3, 9, 0.0, 26.0)
    with pytest.raises(ValueError):
        M.decode(body[:-1])
    with pytest.raises(ValueError):
        M.decode(b"solid")


LATTICE = {
    "junctions": [{"id": 30, "position": [3.0, 0, 0]}, {"id": 10, "position": [1.0, 0, 0], "indices": [0, 0, 0]}],
    "struts": [{"id": 99, "junction0": 30, "junction1": 10}], "unit_cells": [{"id": 7, "struts": [99]}], "note": "kept out",
}


def test_lattice(spark, tmp_path):
    path = tmp_path / "l.json"
    path.write_text(json.dumps(LATTICE, indent=1))
    j, s, c = D.checked_lattice(spark, str(path))
    assert s.first().asDict() == {"id": 99, "junction0": 30, "junction1": 10, "unit_cell_edge_idx": -1, "thickness": None}
    assert sorted((r.id, r.x) for r in j.collect()) == [(10, 1.0), (30, 3.0)] and c.first().struts == [99]
    doc = spark.read.schema(D.LATTICE).option("multiLine", True).json(str(path))
    out = D.moved_lattice(doc, spark.createDataFrame([(30, 9.0, 8.0, 7.0)], "id long, x double, y double, z double")).first()
    assert [(r.id, r.position) for r in out.junctions] == [(30, [9.0, 8.0, 7.0]), (10, [1.0, 0.0, 0.0])] and out.unit_cells[0].id == 7
    for change in ({"struts": [{"id": 1, "junction0": 10, "junction1": 10}]}, {"struts": [{"id": 1, "junction0": 10, "junction1": 11}]}, {"unit_cells": [{"id": 7, "struts": [5]}]}):
        path.write_text(json.dumps(LATTICE | change))
        with pytest.raises(ValueError, match="not sound"):
            D.checked_lattice(spark, str(path))


def test_metrics_csv(spark, tmp_path):
    rows = [(1, True, 0.1 + 0.2, None), (2, False, float("nan"), 1e-20), (3, None, 123456789.123456789, -0.0)]
    df = spark.createDataFrame(rows, "strut_id long, roi_valid boolean, a double, b double")
    D.write_csv(df, str(tmp_path / "m"), ["strut_id", "roi_valid", "a", "b"])
    text = spark.read.text(str(tmp_path / "m")).where("value like '1,%' or value like '3,%'").orderBy("value").collect()
    assert text[0][0] == "1,true,0.3," and text[1][0].startswith("3,,1.23456789123E8,")
    back = {r.strut_id: r for r in D.read_metrics(spark, str(tmp_path / "m"), {"strut_id", "roi_valid", "a", "b"}).collect()}
    assert back[1].a == 0.3 and back[1].b is None and back[2].a is None and back[2].roi_valid is False and back[3].roi_valid is None
    with pytest.raises(ValueError):
        D.read_metrics(spark, str(tmp_path / "m"), {"strut_id"})
    with pytest.raises(ValueError):
        D.write_csv(df, str(tmp_path / "x"), ["strut_id"])


def test_profiles(spark, tmp_path):
    doc = {"measurement_only": True, "profiles": [{"strut_id": 1, "axial_t": [0.0, 1.0], "foreground_fraction": [0.5, 0.25]}]}
    path = tmp_path / "p.json"
    path.write_text(json.dumps(doc))
    assert D.read_profiles(spark, str(path)).collect() == [(1, [0.0, 1.0], [0.5, 0.25])]
    for bad in (doc | {"measurement_only": False}, doc | {"profiles": doc["profiles"] * 2}):
        path.write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            D.read_profiles(spark, str(path))


def test_reports(tmp_path):
    path = str(tmp_path / "deep" / "r.json")
    assert D.write_report(path, {"b": 1, "a": [1.5]}) and not D.write_report(path, {"a": [1.5], "b": 1})
    with pytest.raises(FileExistsError):
        D.write_report(path, {"a": 2})
    assert D.write_report(path, {"a": 2}, overwrite=True)
    with pytest.raises(ValueError):
        D.write_report(path, {"a": math.nan}, overwrite=True)
    assert D.canonical({"b": 1, "a": "é"}) == '{"a":"é","b":1}' and len(D.digest({})) == 64
    assert D.answered(lambda: 1 / 0)["gate"] == "halt" and D.answered(lambda: D.envelope("ok", "pass", "fine"))["error"] is None


def test_streams_agree_with_batch(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 7).cast("int").alias("value"))
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("value int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for start, batch in ((C.running_histogram, H.exact_histogram), (C.running_stats, H.volume_stats)):
        q = start(stream, start.__name__, str(tmp_path / start.__name__))
        q.processAllAvailable()
        q.stop()
        assert sorted(map(tuple, spark.table(start.__name__).collect())) == sorted(map(tuple, batch(rows).collect()))


def test_windows_of_classes(spark, tmp_path):
    rows = spark.range(60).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.when(F.col("id") % 2 == 0, "missing").otherwise("present").alias("class"))
    rows.write.parquet(str(tmp_path / "in"))
    counts = C.class_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = counts.writeStream.outputMode("complete").format("memory").queryName("classes").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("classes").agg(F.sum("n"), F.count("*")).first() == (60, 24)


def test_inspection_in_order(spark, tmp_path):
    import hashlib

    a = save(tmp_path / "b.npy", np.array([[[1.0, np.nan], [3.0, np.inf]]]))
    b = save(tmp_path / "a.npy", np.arange(24, dtype=np.int16).reshape(2, 3, 4))
    got = V.inspect(spark, [a, b]).collect()
    assert [(r.place, r.path) for r in got] == [(0, a), (1, b)]
    assert (got[0].minimum, got[0].maximum, got[0].mean, got[0].finite_count, got[0].nonfinite_count) == (1.0, 3.0, 2.0, 2, 2)
    assert (got[1].mean, got[1].shape, got[1].sha256) == (11.5, [2, 3, 4], hashlib.sha256(open(b, "rb").read()).hexdigest())
    assert "mean" not in V.inspect(spark, [a], statistics=False).columns
    assert "sha256" not in V.inspect(spark, [a], statistics=False, hashes=False).columns


def test_digests_in_pieces(spark, tmp_path):
    import hashlib

    bodies = {"none": b"", "one": b"x", "many": bytes(range(256)) * 41}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    got = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in V.digests(spark, str(tmp_path), step=100).collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items() if b}


def test_manifest(spark, tmp_path):
    import hashlib

    (tmp_path / "in").mkdir()
    a = save(tmp_path / "in" / "b.npy", np.zeros((2, 3, 4), dtype=">i2"))
    b = save(tmp_path / "a.npy", np.zeros((1, 1, 5), dtype=np.uint8))
    root = str(tmp_path)
    got = V.manifest(spark, [a, b], root, "committed").collect()
    assert [r.place for r in got] == [0, 1]
    assert got[0].ct_volume.asDict() == {"path": "in/b.npy", "sha256": hashlib.sha256(open(a, "rb").read()).hexdigest(), "role": "ct_volume", "retention": "committed"}
    first, second = got[0].ct_metadata, got[1].ct_metadata
    assert (first.format, first.shape, first.dtype, first.byte_order) == ("npy", [2, 3, 4], "int16", "big")
    assert (second.shape, second.dtype, second.byte_order) == ([1, 1, 5], "uint8", "not_applicable")
    assert {k: tuple(v) for k, v in first.voxel_spacing.items()} == {c: (None, "unknown", "unknown") for c in "xyz"}
    assert V.manifest(spark, [b], root, hashes=False).first().ct_volume.sha256 is None
    for paths, kept in (([str(tmp_path / ".." / "a.npy")], "external"), (["/elsewhere/a.npy"], "external"), ([a + ".txt"], "external"), ([a], "lost")):
        with pytest.raises(ValueError):
            V.manifest(spark, paths, root, kept)


def test_bundles(tmp_path):
    folder = str(tmp_path / "x" / "bundle")
    assert D.publish_bundle(folder, {"a.csv": "1\n", "b.json": "{}"}) and not D.publish_bundle(folder, {"b.json": "{}", "a.csv": "1\n"})
    with pytest.raises(FileExistsError):
        D.publish_bundle(folder, {"a.csv": "2\n"})


def test_stored_tables_are_replaced(spark):
    from strutwise.sources import storage as S

    since = S.written()
    one = S.stored(spark.range(5), "one")
    two = S.alone(one.where("id > 2"), "two", since)
    assert S.written() == since + 1 and two.count() == 2
    with pytest.raises(Exception):
        one.count()
    S.discard(two)
    assert S.written() == since


def test_stl_by_ranges(spark, tmp_path):
    rng = np.random.default_rng(2)
    faces = np.zeros(25, M.TRIANGLE)
    faces["corners"] = rng.normal(size=(25, 3, 3))
    (tmp_path / "a.stl").write_bytes(b"\0" * 80 + np.uint32(25).tobytes() + faces.tobytes())
    got = sorted(tuple(r)[1:] for r in M.read_stl(spark, str(tmp_path / "a.stl"), 4).collect())
    assert got == [(k, *map(float, f.ravel())) for k, f in enumerate(faces["corners"])]
    triangles = M.read_stl(spark, str(tmp_path / "a.stl"), 7)
    assert b"".join(M.stl_chunks(triangles, 25))[84:] == faces.tobytes()


def test_text_stl(spark, tmp_path):
    text = """solid part
facet normal 0 0 1
 outer loop
  vertex 0 0.5 -1e2
  VERTEX 1. .25 3
  vertex +2 2 2
 endloop
endfacet
facet normal 0 0 1\n outer loop\n vertex 0 0 0\n vertex 1 0 0\n vertex 0 1 0\n endloop\nendfacet
endsolid part
"""
    (tmp_path / "a.stl").write_text(text)
    got = sorted(tuple(r)[1:] for r in M.read_text_stl(spark, str(tmp_path / "a.stl")).collect())
    assert got == [(0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0), (0.0, 0.5, -100.0, 1.0, 0.25, 3.0, 2.0, 2.0, 2.0)]
    s = M.summary(M.read_text_stl(spark, str(tmp_path / "a.stl"))).first()
    assert (s.faces, s.low_z, s.high_x) == (2, -100.0, 2.0)
    for bad in ("facet normal 0 0 1 vertex 0 0 0 vertex 1 0 0 endfacet", "facet normal 0 0 1 vertex 0 0 zero vertex 1 0 0 vertex 1 1 1 endfacet"):
        (tmp_path / "b.stl").write_text(bad)
        with pytest.raises(Exception, match="three vertices"):
            M.read_text_stl(spark, str(tmp_path / "b.stl")).collect()
