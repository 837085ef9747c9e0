"""Polygon layers as WKB in Parquet, with a bounding box a feature (as in GeoParquet's covering).

Layer file columns: ``id BIGINT, name STRING, geometry BINARY, bbox STRUCT<xmin, ymin, xmax, ymax>``.
The box columns are plain numbers, so a reader that wants a window of the layer filters on them
and Parquet's statistics skip the row groups outside; :func:`write_wkb` sorts features along a
space-filling curve, which makes the groups' boxes small.

Geometries are decoded per Arrow batch with numpy: ring lengths are walked, coordinates are taken
as whole blocks. Both byte orders, Polygon and MultiPolygon, with or without Z and M (which are dropped, as is an
SRID); anything else raises.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the format: geometry types, and the flags of the extended form.
POLYGON, MULTIPOLYGON = 3, 6
_Z, _M, _SRID = 0x80000000, 0x40000000, 0x20000000
#: Bits a side of the curve that orders features.
_CURVE_BITS = 16


def decode(data: bytes) -> list[list[np.ndarray]]:
    """Polygons of a geometry, each a list of rings (n x 2 arrays)."""
    polygons, end = _geometry(data, 0)
    if end != len(data):
        raise ValueError(f"{len(data) - end} bytes after the geometry")
    return polygons


def _geometry(data: bytes, at: int) -> tuple[list[list[np.ndarray]], int]:
    order = "<" if data[at] else ">"
    kind, = struct.unpack_from(order + "I", data, at + 1)
    at += 9 if kind & _SRID else 5
    # the extended form has flags, the ISO form adds 1000 for Z, 2000 for M
    plain = kind & ~(_Z | _M | _SRID)
    width = 2 + bool(kind & _Z) + bool(kind & _M) + (0, 1, 1, 2)[min(plain // 1000, 3)]
    n, = struct.unpack_from(order + "I", data, at)
    at += 4
    if plain % 1000 == MULTIPOLYGON:
        out = []
        for _ in range(n):
            part, at = _geometry(data, at)
            out += part
        return out, at
    if plain % 1000 != POLYGON:
        raise ValueError(f"geometry type {plain} is not a polygon")
    rings = []
    for _ in range(n):
        points, = struct.unpack_from(order + "I", data, at)
        block = np.frombuffer(data, order + "f8", points * width, at + 4).reshape(points, width)
        rings.append(block[:, :2])
        at += 4 + 8 * points * width
    return [rings], at


def encode(polygons: list[list[np.ndarray]], little: bool = True) -> bytes:
    """WKB of one polygon, or of several as a MultiPolygon."""
    order = "<" if little else ">"
    head = lambda kind, n: struct.pack(order + "BII", little, kind, n)
    parts = [head(POLYGON, len(rings)) + b"".join(
        struct.pack(order + "I", len(r)) + np.asarray(r, order + "f8").tobytes() for r in rings) for rings in polygons]
    return parts[0] if len(parts) == 1 else head(MULTIPOLYGON, len(parts)) + b"".join(parts)


_RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def _rings_array(geometries: list[bytes | None]) -> pa.Array:
    """Rings of every geometry (parts flattened), built from one flat block of coordinates."""
    rings = [None if g is None else [r for p in decode(g) for r in p] for g in geometries]
    flat = [r for own in rings if own for r in own]
    xy = np.concatenate([np.zeros((0, 2)), *flat]).astype("f8")
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, k])) for k in (0, 1)], ["x", "y"])
    inner = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, flat)]), pa.int32()), points)
    ends = np.cumsum([0, *(len(own or ()) for own in rings)])
    missing = [own is None for own in rings]
    offsets = pa.array([None if gone else int(e) for gone, e in zip([*missing, False], ends)], pa.int32())
    return pa.ListArray.from_arrays(offsets, inner)


def with_rings(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``df`` with ``rings`` decoded from a WKB column, which goes."""
    kept = [c for c in df.columns if c != geometry]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rings = _rings_array(batch.column(geometry).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], rings], [*kept, "rings"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != geometry)
    return df.mapInArrow(run, fields + ", rings array<array<struct<x:double,y:double>>>")


def _curve(x: Column, y: Column) -> Column:
    """Place on the Z-order curve of two columns in 0 .. 1."""
    spread = lambda v: F.aggregate(
        F.sequence(F.lit(0), F.lit(_CURVE_BITS - 1)), F.lit(0).cast("bigint"),
        lambda acc, k: acc + F.call_function("shiftleft", F.call_function("shiftright", v, k).bitwiseAND(F.lit(1)).cast("bigint"), 2 * k))
    cut = lambda c: F.least(F.floor(c * (1 << _CURVE_BITS)), F.lit((1 << _CURVE_BITS) - 1)).cast("int")
    return spread(cut(x)) + 2 * spread(cut(y))


def write_wkb(parts_layer: DataFrame, path: str, little: bool = True, files: int = 1, **options) -> None:
    """Write ``id, name, parts ARRAY<ARRAY<ARRAY<STRUCT<x,y>>>>`` as a WKB layer, neighbours close together.
    ``options`` go to the Parquet writer (``parquet.block.size`` sets the row groups)."""
    schema = "id bigint, name string, geometry binary, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            made, boxes = [], []
            for parts in batch.column("parts").to_pylist():
                polygons = [[np.array([(p["x"], p["y"]) for p in ring]) for ring in rings] for rings in parts or ()]
                made.append(encode(polygons, little) if polygons else None)
                xy = np.concatenate([r for rings in polygons for r in rings]) if polygons else None
                boxes.append(None if xy is None else dict(zip(
                    ("xmin", "ymin", "xmax", "ymax"), map(float, [*xy.min(0), *xy.max(0)]))))
            box = pa.struct([(k, pa.float64()) for k in ("xmin", "ymin", "xmax", "ymax")])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("name"), pa.array(made, pa.binary()),
                                              pa.array(boxes, box)], ["id", "name", "geometry", "bbox"])

    coded = parts_layer.select("id", "name", "parts").mapInArrow(run, schema)
    whole = coded.agg(*[f(f"bbox.{c}").alias(c) for c, f in (("xmin", F.min), ("ymin", F.min), ("xmax", F.max), ("ymax", F.max))]).first()
    if whole["xmin"] is None:
        coded.write.options(**options).parquet(path)
        return
    middle = lambda lo, hi: F.try_divide(
        (F.col(f"bbox.{lo}") + F.col(f"bbox.{hi}")) / 2 - whole[lo], F.lit(float(whole[hi] - whole[lo])))
    at = _curve(*[F.coalesce(middle(*pair), F.lit(0.0)) for pair in (("xmin", "xmax"), ("ymin", "ymax"))])
    (coded.withColumn("at", at).repartitionByRange(files, "at", "id").sortWithinPartitions("at", "id").drop("at")
     .write.options(**options).parquet(path))


def read_wkb(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """``id, name, rings`` of a WKB layer; with ``box`` (xmin, ymin, xmax, ymax) the features whose bounding box
    meets it. The filter is on plain columns and goes down to Parquet, before anything is decoded."""
    rows = spark.read.parquet(path)
    if box is not None:
        xmin, ymin, xmax, ymax = box
        rows = rows.filter((F.col("bbox.xmin") <= xmax) & (F.col("bbox.xmax") >= xmin)
                           & (F.col("bbox.ymin") <= ymax) & (F.col("bbox.ymax") >= ymin))
    return with_rings(rows.select(F.col("id").cast("bigint").alias("id"), "name", "geometry"))
