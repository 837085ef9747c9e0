"""Polygon layer I/O and the SQL-callable neighbourhood function."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.geo import NeighborhoodIndex
from ..operators.geo_udf import register_neighborhood_finder
from ..session import ensure_utc, scratch_path
from ..sources import feeds as FD
from ..sources import polygons as PG
from ..sources import wkb as WKB
from ..sources.feeds import trip_facts
from ..sources.tables import table
from .catalog import register
from .oracle_sql import base_cte

_N_RINGS = [len([r for poly in s for r in poly]) for s in PG.SHAPES]
_N_VERTS = [sum(len(r) for poly in s for r in poly) for s in PG.SHAPES]
_BOX = [(min(a for poly in s for r in poly for a, _ in r), max(a for poly in s for r in poly for a, _ in r),
         min(b for poly in s for r in poly for _, b in r), max(b for poly in s for r in poly for _, b in r))
        for s in PG.SHAPES]


def _pick(values) -> str:
    return "CASE n_nationkey % 5 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_X = f"({PG.BLOCK_OFFSET} + {PG.BLOCK} * (n_nationkey % 5))"
_Y = f"({PG.BLOCK_OFFSET} + {PG.BLOCK} * (n_nationkey // 5))"


@register("polygon_layer", base_cte() + f"""
, pickups AS (SELECT pickupNeighborhood AS name, count(*) AS n_pickups FROM f GROUP BY 1)
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, coalesce(p.n_pickups, 0) AS n_pickups,
  {_pick(_N_RINGS)} AS n_rings, {_pick(_N_VERTS)} AS n_vertices,
  -74.0 + ({_X} + {_pick([b[0] for b in _BOX])}) / 64 AS min_lon,
  -74.0 + ({_X} + {_pick([b[1] for b in _BOX])}) / 64 AS max_lon,
  40.0 + ({_Y} + {_pick([b[2] for b in _BOX])}) / 64 AS min_lat,
  40.0 + ({_Y} + {_pick([b[3] for b in _BOX])}) / 64 AS max_lat
FROM nation LEFT JOIN pickups p ON p.name = n_name""")
def q_polygon_layer(spark, sf_dir):
    """Nation-derived neighbourhoods written as GeoJSON features (Polygon and
    MultiPolygon), read back through the layer reader, summarised, with the
    number of event pickups each one contains (tagged with the read layer)."""
    ensure_utc(spark)
    path = scratch_path(spark, "layer")
    PG.write_geojsonseq(PG.nation_layer_parts(table(spark, sf_dir, "nation")), path)
    layer = PG.read_layer(spark, path, "geojsonseq")
    index = NeighborhoodIndex.build(layer)
    pts = trip_facts(table(spark, sf_dir, "events"))
    counts = (index.tag(pts, "pickupLon", "pickupLat", "name").groupBy("name")
              .agg(F.count(F.lit(1)).alias("n_pickups")))
    layer = layer.join(counts, "name", "left").withColumn(
        "n_pickups", F.coalesce(F.col("n_pickups"), F.lit(0)))
    pts = F.flatten("rings")
    return layer.select(
        "id", "name", "n_pickups", F.size("rings").alias("n_rings"), F.size(pts).alias("n_vertices"),
        F.array_min(F.transform(pts, lambda p: p["x"])).alias("min_lon"),
        F.array_max(F.transform(pts, lambda p: p["x"])).alias("max_lon"),
        F.array_min(F.transform(pts, lambda p: p["y"])).alias("min_lat"),
        F.array_max(F.transform(pts, lambda p: p["y"])).alias("max_lat"))


#: A row of blocks (one per region of five nations) as a feature that comes after all nations, with many vertices.
_ROW_NAME, _ROW_WIDTH = "Row ", PG.BLOCK * PG.BLOCKS_PER_ROW


def _row_features(nation):
    """``id, name, parts``: a rectangle over each row of blocks, its sides cut into 1/8 units."""
    r = F.floor(F.col("n_nationkey") / PG.BLOCKS_PER_ROW).cast("double")
    ox, oy = PG.LAYER_ORIGIN
    at = lambda a, b: F.struct((F.lit(ox) + (PG.BLOCK_OFFSET + a) * PG.LAYER_UNIT).alias("x"),
                               (F.lit(oy) + (PG.BLOCK_OFFSET + b) * PG.LAYER_UNIT).alias("y"))
    along = F.transform(F.sequence(F.lit(0), F.lit(8 * _ROW_WIDTH)), lambda k: k / 8)
    ring = F.concat(F.transform(along, lambda a: at(a, r * PG.BLOCK)),
                    F.transform(F.reverse(along), lambda a: at(a, (r + 1) * PG.BLOCK)))
    rows = nation.filter(F.col("n_nationkey") % PG.BLOCKS_PER_ROW == 0)      # one of each row
    return rows.select((F.lit(1000) + r).cast("bigint").alias("id"), F.concat(F.lit(_ROW_NAME), r.cast("int")).alias("name"),
                       F.array(F.array(ring)).alias("parts"))


@register("polygon_layer_files", base_cte() + f"""
, p AS (SELECT event_id, pickupNeighborhood AS n, event_id % {FD.GRID} - {PG.BLOCK_OFFSET} AS i,
               (event_id // {FD.GRID}) % {FD.GRID} - {PG.BLOCK_OFFSET} AS j FROM f)
SELECT event_id, CASE WHEN n IS NULL OR n <> 'Unknown' THEN n
  WHEN i > 0 AND i < {_ROW_WIDTH} AND j > 0 AND j % {PG.BLOCK} <> 0 AND j // {PG.BLOCK} IN (SELECT n_nationkey // {PG.BLOCKS_PER_ROW} FROM nation)
  THEN '{_ROW_NAME}' || CAST(j // {PG.BLOCK} AS INTEGER) ELSE n END AS neighborhood FROM p
""")
def q_polygon_layer_files(spark, sf_dir):
    """Pickups tagged with a layer of several files of unequal size in which later features cover
    earlier ones: the first in (file, place) order wins, however Spark packs the files."""
    ensure_utc(spark)
    nation, path = table(spark, sf_dir, "nation"), scratch_path(spark, "layer-files")
    features = PG.nation_layer_parts(nation).unionByName(_row_features(nation))
    PG.write_geojsonseq(features.repartitionByRange(6, "id").sortWithinPartitions("id"), path)
    index = NeighborhoodIndex.build(PG.read_layer(spark, path, "geojsonseq"))
    pts = trip_facts(table(spark, sf_dir, "events"))
    return index.tag(pts, "pickupLon", "pickupLat", "neighborhood").select(F.col("hackLicense").alias("event_id"), "neighborhood")


#: A window of the layer: blocks it touches are read, others are not.
_WINDOW = (-73.9, 40.1, -73.6, 40.45)


@register("polygon_layer_wkb", f"""
WITH b AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, {_pick(_N_RINGS)} AS n_rings, {_pick(_N_VERTS)} AS n_vertices,
  -74.0 + ({_X} + {_pick([b[0] for b in _BOX])}) / 64 AS min_lon,
  -74.0 + ({_X} + {_pick([b[1] for b in _BOX])}) / 64 AS max_lon,
  40.0 + ({_Y} + {_pick([b[2] for b in _BOX])}) / 64 AS min_lat,
  40.0 + ({_Y} + {_pick([b[3] for b in _BOX])}) / 64 AS max_lat FROM nation)
SELECT * FROM b WHERE min_lon <= {_WINDOW[2]} AND max_lon >= {_WINDOW[0]} AND min_lat <= {_WINDOW[3]} AND max_lat >= {_WINDOW[1]}
""")
def q_polygon_layer_wkb(spark, sf_dir):
    """The layer written as WKB with bounding boxes, and the features that meet a window read back
    and summarised."""
    path = scratch_path(spark, "layer-wkb")
    WKB.write_wkb(PG.nation_layer_parts(table(spark, sf_dir, "nation")), path, little=False, files=4)
    layer, pts = WKB.read_wkb(spark, path, _WINDOW), F.flatten("rings")
    return layer.select(
        "id", "name", F.size("rings").alias("n_rings"), F.size(pts).alias("n_vertices"),
        F.array_min(F.transform(pts, lambda p: p["x"])).alias("min_lon"),
        F.array_max(F.transform(pts, lambda p: p["x"])).alias("max_lon"),
        F.array_min(F.transform(pts, lambda p: p["y"])).alias("min_lat"),
        F.array_max(F.transform(pts, lambda p: p["y"])).alias("max_lat"))


@register("neighborhood_udf_sql", base_cte() + """
SELECT event_id, pickupNeighborhood AS pickup_neighborhood, dropoffNeighborhood AS dropoff_neighborhood FROM f
""")
def q_neighborhood_udf_sql(spark, sf_dir):
    """``SELECT neighborhoodFinder(lon, lat)`` from SQL over every event."""
    ensure_utc(spark)
    register_neighborhood_finder(spark, PG.nation_layer(table(spark, sf_dir, "nation")))
    view = f"points_{uuid.uuid4().hex[:8]}"
    trip_facts(table(spark, sf_dir, "events")).createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT hackLicense AS event_id,
               neighborhoodFinder(pickupLon, pickupLat) AS pickup_neighborhood,
               neighborhoodFinder(dropoffLon, dropoffLat) AS dropoff_neighborhood
        FROM {view}""")
