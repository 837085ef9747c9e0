"""Point in polygon: boundary cases, first-match order, join paths, property test."""

import json
import os
import tempfile

import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from cabstat.operators.geo import NeighborhoodIndex, UNKNOWN
from cabstat.operators.geo_udf import register_neighborhood_finder
from cabstat.schemas import POLYGON_SCHEMA
from cabstat.sources.polygons import read_layer


def square(x0, y0, x1, y1):
    return [{"x": float(x), "y": float(y)} for x, y in [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]


def layer(spark):
    rows = [
        (1, "outer", [square(0, 0, 10, 10), square(4, 4, 6, 6)]),          # with a hole
        (2, "multi", [square(20, 0, 22, 2), square(30, 0, 32, 2)]),        # two parts
        (3, "L", [[{"x": float(x), "y": float(y)} for x, y in
                   [(40, 0), (46, 0), (46, 2), (42, 2), (42, 6), (40, 6), (40, 0)]]]),
        (4, "overlap_a", [square(50, 0, 60, 10)]),
        (5, "overlap_b", [square(55, 0, 65, 10)]),
    ]
    return spark.createDataFrame(rows, POLYGON_SCHEMA)


CASES = [
    (1.0, 1.0, "outer"), (5.0, 5.0, UNKNOWN),            # in the hole
    (4.0, 5.0, UNKNOWN), (0.0, 5.0, UNKNOWN),            # on hole edge, on outer edge
    (10.0, 10.0, UNKNOWN), (4.0, 4.0, UNKNOWN),          # vertices
    (31.0, 1.0, "multi"), (21.0, 1.0, "multi"), (25.0, 1.0, UNKNOWN),
    (41.0, 5.0, "L"), (44.0, 4.0, UNKNOWN), (42.0, 4.0, UNKNOWN), (44.0, 1.0, "L"),
    (57.0, 5.0, "overlap_a"), (62.0, 5.0, "overlap_b"),  # first by id where both contain
    (-1.0, -1.0, UNKNOWN), (100.0, 100.0, UNKNOWN),
    (None, 1.0, None), (1.0, None, None),
    (float("nan"), 1.0, UNKNOWN), (float("inf"), 1.0, UNKNOWN), (1.0, float("-inf"), UNKNOWN),
]


def points(spark, cases):
    return spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(cases)], "i INT, lon DOUBLE, lat DOUBLE")


def check(df, cases):
    got = {r["i"]: r["n"] for r in df.collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_cases_broadcast_shuffle_salted(spark):
    lay = layer(spark)
    for kw in ({}, {"max_broadcast_bytes": 0}, {"max_broadcast_bytes": 0, "salt_buckets": 3}):
        idx = NeighborhoodIndex.build(lay, cell=2.0, **kw)
        if not idx.broadcastable:   # a layer too large to broadcast: Spark must not either
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            out = idx.tag(points(spark, CASES), "lon", "lat", "n")
            check(out, CASES)
            assert out.count() == len(CASES)
            assert set(out.columns) == {"i", "lon", "lat", "n"}
            plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert ("BroadcastHashJoin" in plan) == idx.broadcastable
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert NeighborhoodIndex.build(lay, cell=2.0).broadcastable
    assert not NeighborhoodIndex.build(lay, cell=2.0, max_broadcast_bytes=0).broadcastable


def test_default_cell_and_udf_agree(spark):
    lay = layer(spark)
    idx = NeighborhoodIndex.build(lay)
    check(idx.tag(points(spark, CASES), "lon", "lat", "n"), CASES)
    register_neighborhood_finder(spark, lay, "nf_test")
    points(spark, CASES).createOrReplaceTempView("pts_test")
    check(spark.sql("SELECT i, nf_test(lon, lat) AS n FROM pts_test"), CASES)   # null and NaN included
    # a layer above the broadcast bound, and one cut over several levels, answer under the same name
    for index in (NeighborhoodIndex.build(lay, max_broadcast_bytes=0), NeighborhoodIndex.build(lay, cell=16.0, split_edges=3)):
        finder = register_neighborhood_finder(spark, lay, "nf_test", index)
        out = spark.sql("SELECT i, nf_test(lon, lat) AS n, nf_test(lat, lon) AS turned FROM pts_test")
        check(out, CASES)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        check(points(spark, CASES).select("i", finder("lon", "lat").alias("n")), CASES)


def levels(idx):
    return {r["level"]: r["n"] for r in idx.tiles.groupBy("level").agg(F.count("*").alias("n")).collect()}


def test_levels_agree_with_one_level(spark):
    lay = layer(spark)
    for split_edges, kw in ((2, {}), (8, {"max_broadcast_bytes": 0})):
        idx = NeighborhoodIndex.build(lay, cell=32.0, split_edges=split_edges, **kw)
        assert len(idx.splits) >= 2 and idx.splits_broadcastable == idx.broadcastable
        out = idx.tag(points(spark, CASES), "lon", "lat", "n")
        check(out, CASES)
        assert set(out.columns) == {"i", "lon", "lat", "n"}
        # what splitting does not thin out is not split for ever
        assert sum(levels(idx).values()) < 2000


def test_one_huge_and_many_tiny_polygons(spark):
    """Cells stay small in content and few in number, whatever the sizes and the order of the features."""
    n = 100
    tiny = spark.range(n * n).select(
        F.col("id"), (F.col("id") % n).cast("double").alias("a"), F.floor(F.col("id") / n).cast("double").alias("b"))
    at = lambda dx, dy: F.struct((F.col("a") / 64 + dx).alias("x"), (F.col("b") / 64 + dy).alias("y"))
    tiny = tiny.select((F.col("id") + 1).alias("id"), F.concat(F.lit("t"), F.col("id")).alias("name"), F.array(F.array(
        at(0, 0), at(1 / 128, 0), at(1 / 128, 1 / 128), at(0, 1 / 128))).alias("rings"))
    for first in (0, n * n + 1):     # the huge polygon before all others, or after them
        huge = spark.createDataFrame([(first, "huge", [square(-1000, -1000, 1000, 1000)])], POLYGON_SCHEMA)
        idx = NeighborhoodIndex.build(huge.unionByName(tiny))
        held = idx.tiles.agg(F.max(F.aggregate("cands", F.lit(0), lambda s, c: s + F.size(c["edges"]))).alias("edges"),
                             F.max(F.size("cands")).alias("cands"), F.count("*").alias("n")).first()
        assert held["edges"] <= 128 and held["cands"] <= 64 and held["n"] < 30_000
        assert (len(idx.splits) > 5) == (first > 0)      # where the huge one answers first, nothing is split
        pts = spark.range(4000).select(F.col("id"), ((F.col("id") % 200) / 128 + 1 / 256).alias("x"),
                                       (F.floor(F.col("id") / 20) / 128 + 1 / 256).alias("y"))
        want = F.when((F.floor(F.col("x") * 128) % 2 == 0) & (F.floor(F.col("y") * 128) % 2 == 0), F.concat(
            F.lit("t"), (F.floor(F.col("x") * 64) + n * F.floor(F.col("y") * 64)).cast("string"))).otherwise(F.lit("huge"))
        want = F.when(F.col("y") * 64 >= n, F.lit("huge")).otherwise(want) if first else F.lit("huge")
        assert idx.tag(pts, "x", "y", "n").filter(F.col("n") != want).count() == 0


def test_broadcast_plan_has_no_point_shuffle(spark):
    idx = NeighborhoodIndex.build(layer(spark), cell=2.0)
    plan = idx.tag(points(spark, CASES), "lon", "lat", "n")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "RoundRobin" not in plan


def test_hot_cell_and_nulls_are_spread_in_the_shuffle_join(spark):
    """90 % of the points in one cell (all equal) and many nulls: no task gets a large share."""
    idx = NeighborhoodIndex.build(layer(spark), cell=2.0, max_broadcast_bytes=0)
    pts = spark.range(20_000).select(
        F.col("id").alias("i"), F.when(F.col("id") % 10 != 0, F.lit(1.0)).alias("lon"), F.lit(1.0).alias("lat"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        tagged = idx.tag(pts.drop("i"), "lon", "lat", "n").withColumn("task", F.spark_partition_id())
        counts = tagged.groupBy("task", F.col("lon").isNull().alias("missing")).count().collect()
        hot = [r["count"] for r in counts if not r["missing"]]
        missing = [r["count"] for r in counts if r["missing"]]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(hot) == 18_000 and max(hot) <= 18_000 / 4
    assert sum(missing) == 2_000 and max(missing) <= 2_000 / 16


def even_odd(px, py, rings):
    inside = False
    for ring in rings:
        n = len(ring)
        for k in range(n):
            (x1, y1), (x2, y2) = ring[k], ring[(k + 1) % n]
            d = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
            if d == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return False
            if (y1 > py) != (y2 > py) and ((y2 > y1 and d > 0) or (y2 < y1 and d < 0)):
                inside = not inside
    return inside


coord = st.one_of(st.integers(min_value=0, max_value=16).map(lambda v: v / 2),     # dyadic: exact edges
                  st.integers(min_value=0, max_value=80).map(lambda v: v / 10))   # not representable
poly = st.lists(st.tuples(coord, coord), min_size=3, max_size=7)


@settings(max_examples=8, deadline=None)
@given(polys=st.lists(poly, min_size=1, max_size=3),
       pts=st.lists(st.tuples(coord, coord), min_size=1, max_size=40),
       cell=st.sampled_from([0.5, 1.0, 4.0]), split=st.sampled_from([3, 1000]))
def test_property_matches_scalar_even_odd(spark, polys, pts, cell, split):
    rows = [(i + 1, f"p{i + 1}", [[{"x": x, "y": y} for x, y in ring]]) for i, ring in enumerate(polys)]
    lay = spark.createDataFrame(rows, POLYGON_SCHEMA)
    idx = NeighborhoodIndex.build(lay, cell=cell, materialize=False, split_edges=split, max_level=3)
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "i INT, lon DOUBLE, lat DOUBLE")
    got = {r["i"]: r["n"] for r in idx.tag(df, "lon", "lat", "n").collect()}
    for i, (x, y) in enumerate(pts):
        want = next((f"p{j + 1}" for j, ring in enumerate(polys) if even_odd(x, y, [ring])), UNKNOWN)
        assert got[i] == want, (x, y, polys)


def test_geojson_feature_collection(spark):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"NAME": "A", "BoroCode": 1, "Shape_Area": 16.5, "tags": None},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]}},
        {"type": "Feature", "properties": {"NAME": "B"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[10, 0], [12, 0], [12, 2], [10, 0]]],
                                                              [[[20, 0], [22, 0], [22, 2], [20, 0]]]]}}]}
    d = tempfile.mkdtemp(prefix="geojson-")
    with open(os.path.join(d, "layer.geojson"), "w") as fh:
        json.dump(fc, fh, indent=2)
    lay = read_layer(spark, d, "geojson")
    rows = {r["name"]: r for r in lay.collect()}
    assert rows["A"]["id"] == 0 and rows["B"]["id"] == 1
    assert len(rows["A"]["rings"]) == 1 and len(rows["B"]["rings"]) == 2
    idx = NeighborhoodIndex.build(lay, materialize=False)
    pts = spark.createDataFrame([(0, 1.0, 1.0), (1, 21.5, 0.5), (2, 5.0, 5.0)], "i INT, lon DOUBLE, lat DOUBLE")
    got = {r["i"]: r["n"] for r in idx.tag(pts, "lon", "lat", "n").collect()}
    assert got == {0: "A", 1: "B", 2: UNKNOWN}


def test_nation_layer_query_matches_oracle_rule(spark, sf_small):
    from cabstat.plans.catalog import QUERIES
    got = QUERIES["point_in_polygon"](spark, sf_small)
    assert got.count() == spark.read.parquet(f"{sf_small}/events.parquet").count()
    names = {r[0] for r in got.select("pickup_neighborhood").distinct().collect()}
    assert UNKNOWN in names and None in names and any(n and n.startswith("NATION_") for n in names)


def test_choose_cell_bounds():
    from cabstat.operators.geo import choose_cell
    assert choose_cell(60 / 64, 12 / 64) == 2.0 ** -5              # ~4 cells across a median polygon
    assert 360.0 / 128 <= choose_cell(360.0, 1e-6) <= 360.0 / 64    # never many more than 64 across
    assert choose_cell(0.0, None) == 1.0
