"""Uncompressed TIFF and BigTIFF: where the pages of a stack lie, and the voxel spacing that their metadata tells."""

from __future__ import annotations

import re
import struct
from xml.etree import ElementTree

import numpy as np

MAGIC = (b"II*\0", b"MM\0*", b"II+\0", b"MM\0+")
# Tag numbers and value types of the format: fixed values.
WIDTH, LENGTH, BITS, COMPRESSION, DESCRIPTION, OFFSETS, SAMPLES, COUNTS, X_RESOLUTION, Y_RESOLUTION, UNIT, TILE, FORMAT = 256, 257, 258, 259, 270, 273, 277, 279, 282, 283, 296, 322, 339
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "s", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_KINDS = {1: "u", 2: "i", 3: "f"}


def pages(f, most: int | None = None) -> list[dict]:
    """The tags of each page (``most`` at most) of an open file, values as tuples; ``order`` is the byte order."""
    f.seek(0)
    head = f.read(16)
    order = "<" if head[:2] == b"II" else ">"
    big = struct.unpack(order + "H", head[2:4])[0] == 43
    at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
    entry, width, out, seen = (20, "Q", [], set()) if big else (12, "I", [], set())
    while at and at not in seen and (most is None or len(out) < most):
        seen.add(at)
        f.seek(at)
        count = struct.unpack(order + ("Q" if big else "H"), f.read(8 if big else 2))[0]
        body = f.read(count * entry + (8 if big else 4))
        tags: dict = {"order": order}
        for k in range(count):
            tag, kind, n = struct.unpack_from(order + "HH" + width, body, k * entry)
            code = _TYPES.get(kind)
            if code is None:
                continue
            size = n if code == "s" else n * struct.calcsize("=" + code)
            raw = body[k * entry + (12 if big else 8) : (k + 1) * entry]
            if size > len(raw):
                f.seek(struct.unpack(order + width, raw)[0])
                raw = f.read(size)
            tags[tag] = raw[:n] if code == "s" else struct.unpack(order + code * n, raw[:size])
        out.append(tags)
        at = struct.unpack(order + width, body[count * entry :])[0]
    return out


def _type(page: dict) -> np.dtype:
    bits, kind = page.get(BITS, (1,)), page.get(FORMAT, (1,))
    if page.get(COMPRESSION, (1,))[0] != 1:
        raise ValueError("compressed pages are not read")
    if TILE in page or page.get(SAMPLES, (1,))[0] != 1 or bits[0] not in (8, 16, 32, 64) or kind[0] not in _KINDS:
        raise ValueError("pages must be strips of one sample of 8 to 64 bits")
    return np.dtype(f"{page['order']}{_KINDS[kind[0]]}{bits[0] // 8}")


def stacked(found: list[dict]) -> tuple[tuple[int, ...], np.dtype, list[list[tuple[int, int]]]]:
    """Shape, type and the (offset, bytes) of each slice of a stack of equal pages.

    A description that counts more images than there are pages says that they
    follow the first one without pages of their own.
    """
    kinds = {(p[WIDTH][0], p[LENGTH][0], _type(p)) for p in found}
    if len(kinds) != 1:
        raise ValueError("the pages differ in size or type")
    (width, length, dtype), = kinds
    slices = [list(zip(p[OFFSETS], p.get(COUNTS, (width * length * dtype.itemsize,)))) for p in found]
    more = re.search(rb"^images=(\d+)", found[0].get(DESCRIPTION, b""), re.M)
    if len(found) == 1 and found[0].get(DESCRIPTION, b"").startswith(b"ImageJ=") and more and int(more[1]) > 1:
        size = width * length * dtype.itemsize
        slices = [[(slices[0][0][0] + k * size, size)] for k in range(int(more[1]))]
    return (len(slices), length, width), dtype, slices


def _number(text) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def spacing(page: dict) -> dict[str, tuple[float, str, str]]:
    """``axis: (value, unit, source)`` for each axis that the first page's metadata knows."""
    text = page.get(DESCRIPTION, b"").rstrip(b"\0").decode("utf-8", "replace")
    out: dict[str, tuple[float, str, str]] = {}
    if text.lstrip().startswith("<"):
        try:
            node = next((e for e in ElementTree.fromstring(text).iter() if e.tag.endswith("Pixels")), None)
        except ElementTree.ParseError:
            node = None
        for axis in "xyz":
            value = None if node is None else _number(node.get(f"PhysicalSize{axis.upper()}"))
            if value is not None:
                out[axis] = (value, node.get(f"PhysicalSize{axis.upper()}Unit", "unknown"), "ome_xml")
    elif text.startswith("ImageJ="):
        said = dict(line.split("=", 1) for line in text.splitlines() if "=" in line)
        value = _number(said.get("spacing"))
        if value is not None:
            out["z"] = (value, said.get("unit", "unknown"), "imagej_metadata")
    scale = {2: 25.4, 3: 10.0}.get(page.get(UNIT, (0,))[0])  # inch and centimetre in millimetres
    for axis, tag in (("x", X_RESOLUTION), ("y", Y_RESOLUTION)):
        if axis not in out and scale and tag in page and len(page[tag]) == 2 and min(page[tag]) > 0:
            out[axis] = (scale * page[tag][1] / page[tag][0], "mm", "tiff_tag")
    return out
