"""Polygon layers: GeoJSON / GeoJSON-lines / parquet readers, a GeoJSON-lines
writer, and the neighbourhood layer derived from ``nation``.

Layer schema: ``id BIGINT`` (feature order, first wins), ``name STRING`` (the
``NAME`` property), ``rings ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>`` (outer
rings, holes and parts alike; even-odd rule).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

_GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("coordinates", T.StringType()),   # raw JSON, parsed by type below
])
_FEATURE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", _GEOMETRY),
])
_COLLECTION = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])


def _rings_from_geometry(geometry: Column) -> Column:
    """Polygon: coordinates at depth 3; MultiPolygon: depth 4, flattened."""
    coords = geometry["coordinates"]
    poly = F.from_json(coords, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(coords, "array<array<array<array<double>>>>"))
    rings = F.when(geometry["type"] == "Polygon", poly).when(geometry["type"] == "MultiPolygon", multi)
    return F.transform(rings, lambda r: F.transform(
        r, lambda p: F.struct(F.try_element_at(p, F.lit(1)).alias("x"), F.try_element_at(p, F.lit(2)).alias("y"))))


def _in_file_order(rows: DataFrame) -> DataFrame:
    """Rows of files with ``id``: their order by file name, then place in the file, however Spark packs them.

    A task reads a piece of a file from its start, so the pieces in the order of (file, start) and
    the row numbers inside each give the order. There are as many pieces as tasks' splits.
    """
    placed = rows.select("*", F.col("_metadata.file_path").alias("file_"), F.col("_metadata.file_block_start").alias("at_"))
    pieces = placed.select("file_", "at_").distinct().select("file_", "at_", (
        F.row_number().over(Window.orderBy("file_", "at_")) - 1).alias("piece_"))
    here = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.withColumn("row_", here).join(F.broadcast(pieces), ["file_", "at_"])
    return numbered.withColumn("id", F.col("piece_").cast("bigint") * F.lit(1 << 33) + F.col("row_")).drop(
        "file_", "at_", "piece_", "row_")


def _own_ids(features: DataFrame) -> DataFrame:
    """Features with their own ``id``, all of which must be there and different."""
    doubles = features.groupBy("id").count().filter("id IS NULL OR count > 1").limit(5).collect()
    if doubles:
        raise ValueError(f"feature ids missing or used twice: {sorted(str(r['id']) for r in doubles)}")
    return features


def read_layer(spark: SparkSession, path: str, fmt: str = "geojson",
               name_property: str = "NAME", order: str = "position") -> DataFrame:
    """Read a polygon layer.

    ``geojson``: one FeatureCollection document per file (read whole, it is a
    single JSON value); ``geojsonseq``: one Feature per line, split freely;
    ``wkb``: see :mod:`cabstat.sources.wkb`; ``parquet``: already ``id, name, rings``.

    Where features overlap the first in the layer wins: ``order="position"`` takes files by name and
    features by their place in them, ``order="id"`` the features' own integer ids, which must differ.
    """
    if order not in ("position", "id"):
        raise ValueError(f"order is position or id, not {order!r}")
    if fmt == "parquet":
        return spark.read.parquet(path).select("id", "name", "rings")
    if fmt == "wkb":
        from .wkb import read_wkb
        return read_wkb(spark, path)
    if fmt == "geojson":
        doc = spark.read.schema(_COLLECTION).option("multiLine", True).json(path)
        if order == "position":
            doc = _in_file_order(doc)     # one row a file
        feats = doc.select(*(["id"] if order == "position" else []), F.posexplode("features").alias("pos", "f"))
        place = F.col("id") + F.col("pos") if order == "position" else F.col("f.id")
        feats = feats.select(place.cast("bigint").alias("id"), F.col("f.properties").alias("properties"),
                             F.col("f.geometry").alias("geometry"))
    elif fmt == "geojsonseq":
        feats = spark.read.schema(_FEATURE).json(path)
        if order == "position":
            feats = _in_file_order(feats.drop("id"))
    else:
        raise ValueError(f"unknown polygon layer format: {fmt}")
    if order == "id":
        feats = _own_ids(feats)
    return feats.select("id", F.col("properties")[name_property].alias("name"),
                        _rings_from_geometry(F.col("geometry")).alias("rings"))


def write_geojsonseq(parts_layer: DataFrame, path: str) -> None:
    """Write ``id, name, parts ARRAY<ARRAY<ARRAY<STRUCT<x,y>>>>`` as GeoJSON lines."""
    as_xy = lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    poly_coords = F.transform(F.try_element_at("parts", F.lit(1)), as_xy)
    multi_coords = F.transform("parts", lambda poly: F.transform(poly, as_xy))
    geometry = (F.when(F.size("parts") == 1, F.concat(
                    F.lit('{"type":"Polygon","coordinates":'), F.to_json(poly_coords), F.lit("}")))
                .otherwise(F.concat(
                    F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json(multi_coords), F.lit("}"))))
    line = F.concat(
        F.lit('{"type":"Feature","id":'), F.col("id").cast("string"),
        F.lit(',"properties":'), F.to_json(F.create_map(F.lit("NAME"), F.col("name"))),
        F.lit(',"geometry":'), geometry, F.lit("}"))
    parts_layer.select(line.alias("value")).write.mode("error").text(path)


# ---- fixed values of the derived neighbourhood layer --------------------------
# Units are 1/64 degree from (-74, 40). Nation k owns the 12 x 12 block whose
# lower-left corner is (2 + 12 * (k % 5), 2 + 12 * (k // 5)); its shape is
# chosen by k % 5. Each shape is a list of polygons, each a list of rings.
LAYER_UNIT = 1.0 / 64
LAYER_ORIGIN = (-74.0, 40.0)
BLOCK, BLOCK_OFFSET, BLOCKS_PER_ROW = 12, 2, 5
SHAPES = [
    # 0: square
    [[[(0, 0), (12, 0), (12, 12), (0, 12), (0, 0)]]],
    # 1: L shape (concave)
    [[[(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10), (0, 0)]]],
    # 2: square with a square hole
    [[[(1, 1), (11, 1), (11, 11), (1, 11), (1, 1)],
      [(4, 4), (8, 4), (8, 8), (4, 8), (4, 4)]]],
    # 3: two parts
    [[[(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)]],
     [[(7, 7), (12, 7), (12, 12), (7, 12), (7, 7)]]],
    # 4: right triangle (diagonal edge)
    [[[(0, 0), (12, 0), (0, 12), (0, 0)]]],
]
# -------------------------------------------------------------------------------


def _shapes_literal() -> Column:
    def pt(a, b):
        return F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b"))
    return F.array(*[
        F.array(*[F.array(*[F.array(*[pt(a, b) for a, b in ring]) for ring in poly]) for poly in shape])
        for shape in SHAPES])


def nation_layer_parts(nation: DataFrame) -> DataFrame:
    """``id, name, parts``: one neighbourhood per nation, by the rule above."""
    k = F.col("n_nationkey").cast("bigint")
    bx = F.lit(BLOCK_OFFSET) + F.lit(BLOCK) * (k % BLOCKS_PER_ROW)
    by = F.lit(BLOCK_OFFSET) + F.lit(BLOCK) * F.floor(k / BLOCKS_PER_ROW)
    shape = F.try_element_at(_shapes_literal(), (k % len(SHAPES) + 1).cast("int"))
    ox, oy = LAYER_ORIGIN

    def to_deg(p):
        return F.struct((F.lit(ox) + (bx + p["a"]) * LAYER_UNIT).alias("x"),
                        (F.lit(oy) + (by + p["b"]) * LAYER_UNIT).alias("y"))

    parts = F.transform(shape, lambda poly: F.transform(poly, lambda ring: F.transform(ring, to_deg)))
    return nation.select(k.alias("id"), F.col("n_name").alias("name"), parts.alias("parts"))


def nation_layer(nation: DataFrame) -> DataFrame:
    """``id, name, rings`` layer derived from ``nation``."""
    return nation_layer_parts(nation).select("id", "name", F.flatten("parts").alias("rings"))
