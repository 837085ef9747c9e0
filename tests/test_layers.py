"""Layer files: order of features, WKB."""

import json
import os
import struct
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabstat.operators.geo import NeighborhoodIndex
from cabstat.session import scratch_path
from cabstat.sources import polygons as PG
from cabstat.sources import wkb
from cabstat.sources.tables import table


def feature(name, x0, y0, x1, y1, own=None, points=1):
    xs = np.linspace(x0, x1, points + 1)
    ring = [[x, y0] for x in xs] + [[x, y1] for x in xs[::-1]] + [[x0, y0]]
    return {"type": "Feature", **({} if own is None else {"id": own}), "properties": {"NAME": name},
            "geometry": {"type": "Polygon", "coordinates": [ring]}}


def folder(files, collection):
    d = tempfile.mkdtemp(prefix="layer-")
    for name, features in files.items():
        with open(os.path.join(d, name), "w") as fh:
            if collection:
                json.dump({"type": "FeatureCollection", "features": features}, fh)
            else:
                fh.writelines(json.dumps(f) + "\n" for f in features)
    return d


@pytest.mark.parametrize("fmt", ["geojson", "geojsonseq"])
def test_first_feature_in_file_order_wins(spark, fmt):
    """The second file is larger, so Spark reads it first; both files' features contain the point."""
    d = folder({"part-0.json": [feature("far", 50, 50, 51, 51), feature("first", 0, 0, 2, 2, own=7)],
                "part-1.json": [feature("second", 0, 0, 3, 3, own=0, points=4000), feature("third", 0, 0, 4, 4, own=7)]},
               fmt == "geojson")
    layer = PG.read_layer(spark, d, fmt)
    assert [r["name"] for r in layer.orderBy("id").collect()] == ["far", "first", "second", "third"]
    assert layer.select("id").distinct().count() == 4
    pts = spark.createDataFrame([(1.0, 1.0), (2.5, 2.5), (3.5, 3.5)], "x DOUBLE, y DOUBLE")
    tagged = NeighborhoodIndex.build(layer).tag(pts, "x", "y", "n")
    assert {r["x"]: r["n"] for r in tagged.collect()} == {1.0: "first", 2.5: "second", 3.5: "third"}
    with pytest.raises(ValueError, match="used twice"):
        PG.read_layer(spark, d, fmt, order="id")


def test_own_ids_order_features(spark):
    d = folder({"a.json": [feature("late", 0, 0, 2, 2, own=5)], "b.json": [feature("early", 0, 0, 2, 2, own=1)]}, False)
    assert [r["id"] for r in PG.read_layer(spark, d, "geojsonseq", order="id").orderBy("id").collect()] == [1, 5]
    assert PG.read_layer(spark, d, "geojsonseq").orderBy("id").first()["name"] == "late"


def test_pieces_of_one_file_keep_their_order(spark):
    d = folder({"all.json": [feature(f"f{k}", k, 0, k + 1, 1) for k in range(3000)]}, False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        layer = PG.read_layer(spark, d, "geojsonseq")
        assert layer.rdd.getNumPartitions() > 3
        assert [r["name"] for r in layer.orderBy("id").collect()] == [f"f{k}" for k in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# ------------------------------------------------------------------ WKB

def test_wkb_forms():
    ring, hole = np.array([(0, 0), (4, 0), (4, 4), (0, 0)], float), np.array([(1, 1), (2, 1), (2, 2), (1, 1)], float)
    for little in (True, False):
        for polygons in ([[ring, hole]], [[ring], [hole, ring]]):
            got = wkb.decode(wkb.encode(polygons, little))
            assert [[r.tolist() for r in p] for p in got] == [[r.tolist() for r in p] for p in polygons]
    points = [(0.0, 0.0, 9.0), (4.0, 0.0, 9.0), (4.0, 4.0, 9.0)]
    body = struct.pack("<I", 1) + struct.pack("<I", 3) + b"".join(struct.pack("<3d", *p) for p in points)
    for head in (struct.pack("<BI", 1, 1003), struct.pack("<BI", 1, 3 | 0x80000000),
                 struct.pack("<BII", 1, 3 | 0x80000000 | 0x20000000, 4326)):
        assert wkb.decode(head + body)[0][0].tolist() == [[0, 0], [4, 0], [4, 4]]
    with pytest.raises(ValueError, match="not a polygon"):
        wkb.decode(struct.pack("<BI", 1, 1) + struct.pack("<2d", 1, 2) + b"\0" * 8)
    with pytest.raises(ValueError, match="bytes after"):
        wkb.decode(wkb.encode([[ring]]) + b"x")


def rows_of(layer):
    return {r["id"]: (r["name"], r["rings"]) for r in layer.collect()}


def test_wkb_layer_equals_the_layer(spark, sf_small):
    nation = table(spark, sf_small, "nation")
    parts = PG.nation_layer_parts(nation)
    for little in (True, False):
        path = scratch_path(spark, "wkb")
        wkb.write_wkb(parts, path, little, files=3)
        assert rows_of(wkb.read_wkb(spark, path)) == rows_of(PG.nation_layer(nation))
        assert rows_of(PG.read_layer(spark, path, "wkb")) == rows_of(PG.nation_layer(nation))
    odd = spark.createDataFrame([(1, "none", None), (2, None, [])], parts.schema)
    path = scratch_path(spark, "wkb")
    wkb.write_wkb(odd, path)
    assert {i: r for i, (_, r) in rows_of(wkb.read_wkb(spark, path)).items()} == {1: None, 2: None}
    wkb.write_wkb(parts.limit(0), scratch_path(spark, "wkb"))


def test_a_window_skips_row_groups(spark):
    cells = spark.range(20_000).select(F.col("id"), F.lit("c").alias("name"), (F.col("id") % 200).cast("double").alias("a"),
                                       F.floor(F.col("id") / 200).cast("double").alias("b"))
    at = lambda dx, dy: F.struct((F.col("a") + dx).alias("x"), (F.col("b") + dy).alias("y"))
    parts = cells.select("id", "name", F.array(F.array(F.array(at(0, 0), at(1, 0), at(1, 1), at(0, 0)))).alias("parts"))
    path = scratch_path(spark, "wkb-groups")
    wkb.write_wkb(parts, path, files=2, **{"parquet.block.size": 64 << 10, "parquet.page.size": 8 << 10,
                                           "parquet.block.size.row.check.min": 100, "parquet.page.size.row.check.min": 100})
    window = (10.5, 10.5, 14.5, 12.5)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = wkb.read_wkb(spark, path, window)
        assert sorted(r["id"] for r in found.collect()) == sorted(b * 200 + a for a in range(10, 15) for b in range(10, 13))
        plan = found._jdf.queryExecution().executedPlan()
        scan = plan.collectLeaves().head()
        assert scan.metrics().apply("numOutputRows").value() < 20_000 / 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
