"""Point-in-polygon tagging as a broadcast (or shuffled) join with a quadtree of tiles.

The layer is cut into square cells. For every (cell, polygon) we keep

* nothing, if no edge touches the cell and the cell lies outside the polygon,
* ``inside = true`` and no edges, if no edge touches the cell and it lies inside,
* otherwise the edges that touch the closed cell, and ``flip``: whether the cell's lower right
  corner has an odd number of edges to its right.

A point p of the cell is inside if the ray from p towards +x crosses an odd number of edges. That
is the parity of the crossings up to the cell's right side, of those of that side between the corner
and p's height, and of ``flip``; the first two need only edges that touch the cell. The rules at
ends are half-open as if the corner's column lay just right of the side, and each edge's side of a
point comes from one and the same product everywhere, so the parts always fit together.

Of a cell's candidates those after the first that covers the whole cell can
never be the answer and go. A cell whose candidates still have more than
``split_edges`` edges is split into four, level by level, as long as that helps: the
fullest child holds a quarter less, or the children together hold hardly more (a cluster in a
corner). So a cell's work is small however unequal the polygons are, and the number of cells
is too: a huge polygon is a few large cells inside and small ones where other borders are, thousands
of tiny ones have cells of their size, and edges that run together or meet in one point are not cut
for ever.

Candidates are grouped to **one row per leaf cell** (sorted by feature id). A
point has exactly one leaf; its level is found by looking up, from the top, which
of its ancestor cells were split (keys only, no polygons). So the point
side joins at most one row and its row count never changes. A point is
in a polygon when the even-odd crossing count is odd and it lies on no edge
(containment excludes the boundary). The first containing feature wins; none
gives ``Unknown``; a null coordinate gives null and NaN gives ``Unknown``.
When a cell's first candidate covers the whole cell, its name is stored with
the cell (``head``) and points there need no geometric test at all.

All tests are exact comparisons of products and all cell sizes are a power of two apart,
so dyadic coordinates give exact answers on edges and vertices.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpoint_root

UNKNOWN = "Unknown"
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
#: Tasks that share a cell's points where tiles are joined by a shuffle.
DEFAULT_SALTS = 16
#: Rows without a coordinate are spread over so many keys that no tile has.
_NOWHERE, _NOWHERE_KEYS = -(1 << 60), 4096
#: Edges a cell may hold before it is split, and the levels below the first.
DEFAULT_SPLIT_EDGES, DEFAULT_MAX_LEVEL = 128, 16
#: Bytes of a split cell's keys in memory.
_SPLIT_BYTES = 64


def layer_edges(layer: DataFrame) -> DataFrame:
    """``id, name, edges ARRAY<STRUCT<x1,y1,x2,y2>>`` plus the bounding box.

    Every ring contributes the segments between consecutive vertices and the
    closing one, so open and closed rings both work; holes and parts are rings.
    """
    def ring_edges(r: Column) -> Column:
        nxt = F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(1))), F.slice(r, 1, 1))
        return F.zip_with(r, nxt, lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))

    edges = F.flatten(F.transform("rings", ring_edges))
    pts = F.flatten("rings")
    return layer.select(
        "id", "name", edges.alias("edges"),
        F.array_min(F.transform(pts, lambda p: p["x"])).alias("minx"),
        F.array_max(F.transform(pts, lambda p: p["x"])).alias("maxx"),
        F.array_min(F.transform(pts, lambda p: p["y"])).alias("miny"),
        F.array_max(F.transform(pts, lambda p: p["y"])).alias("maxy"),
    )


def _cell(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(cell))


def _orient(e: Column, px: Column, py: Column) -> Column:
    """Cross product (b - a) x (p - a) of edge ``e`` and point ``p``."""
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])


def _crosses(e: Column, px: Column, py: Column) -> Column:
    """Edge crossed by the ray from ``p`` towards +x (half-open in y)."""
    d = _orient(e, px, py)
    straddle = (e["y1"] > py) != (e["y2"] > py)
    return straddle & (((e["y2"] > e["y1"]) & (d > 0)) | ((e["y2"] < e["y1"]) & (d < 0)))


def _touches(e: Column, px: Column, py: Column) -> Column:
    """Point lies on the closed segment."""
    return ((_orient(e, px, py) == 0)
            & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
            & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))


def _below(e: Column, x: Column, y: Column) -> Column:
    """Where it passes the line just right of ``x``, the edge is at ``y`` or lower (half-open in x; an edge
    through (x, y) itself counts if it does not rise)."""
    d = _orient(e, x, y)
    spans = (e["x1"] > x) != (e["x2"] > x)
    return spans & F.when(e["x2"] > e["x1"], (d > 0) | ((d == 0) & (e["y2"] <= e["y1"]))).otherwise(
        (d < 0) | ((d == 0) & (e["y2"] >= e["y1"])))


def odd_right(edges: Column, flip: Column, right: Column, bottom: Column, px: Column, py: Column) -> Column:
    """Whether a point of a cell has an odd number of edges to its right; -1 if it lies on one. One pass over
    the edges that touch the cell, whose right side, bottom and ``flip`` are given."""
    def step(acc, e):
        turns = (_crosses(e, px, py) != _crosses(e, right, py)) != (_below(e, right, py) != _below(e, right, bottom))
        return F.when(acc < 0, acc).when(_touches(e, px, py), F.lit(-1)).when(turns, 1 - acc).otherwise(acc)

    return F.aggregate(edges, flip.cast("int"), step)


def _touch(e: Column, left: Column, right: Column, bottom: Column, top: Column) -> Column:
    """The edge has a point in the closed box: their extents meet and the corners are not all on one side."""
    corners = [_orient(e, x, y) for x in (left, right) for y in (bottom, top)]
    return ((F.least(e["x1"], e["x2"]) <= right) & (F.greatest(e["x1"], e["x2"]) >= left)
            & (F.least(e["y1"], e["y2"]) <= top) & (F.greatest(e["y1"], e["y2"]) >= bottom)
            & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0))


def choose_cell(layer_extent: float, median_polygon: float | None = None,
                per_polygon: int = 4, max_across: int = 64) -> float:
    """Size of the cells of the first level, a power of two (exact for dyadic coordinates).

    About ``per_polygon`` cells across a median polygon, but never more than ``max_across``
    cells across the whole layer: denser places are split further.
    """
    if not layer_extent or layer_extent <= 0 or math.isinf(layer_extent):
        return 1.0
    floor_cell = 2.0 ** math.floor(math.log2(layer_extent / max_across))
    if not median_polygon or median_polygon <= 0:
        return floor_cell
    return max(2.0 ** math.floor(math.log2(median_polygon / per_polygon)), floor_cell)


def _sides(cell: float) -> dict[str, Column]:
    """Sides of the cell (cx, cy); exact, as ``cell`` is a power of two."""
    x, y = F.col("cx").cast("double"), F.col("cy").cast("double")
    return {"left": x * cell, "right": (x + 1) * cell, "bottom": y * cell, "top": (y + 1) * cell}


def _classified(cells: DataFrame, cell: float) -> DataFrame:
    """Cut each candidate's edges down to those that touch its cell; candidates outside go, those that
    cover the cell are marked."""
    s = _sides(cell)
    near = F.filter("edges", lambda e: _touch(e, s["left"], s["right"], s["bottom"], s["top"]))
    out = cells.withColumn("edges", near).withColumn("inside", (F.size("edges") == 0) & F.col("flip"))
    return out.filter(F.col("inside") | (F.size("edges") > 0))


def first_candidates(layer: DataFrame, cell: float) -> DataFrame:
    """``cx, cy, id, name, flip, edges, inside`` of the first level's cells.

    Built in two explodes so a polygon's full edge list is never copied to
    every cell: first one row per (polygon, row band) keeping only the edges
    that meet the band, then one row per cell of the band.
    """
    e = layer_edges(layer)
    bottom, top = F.col("cy").cast("double") * cell, (F.col("cy").cast("double") + 1) * cell
    band = F.filter("edges", lambda s: (F.least(s["y1"], s["y2"]) <= top) & (F.greatest(s["y1"], s["y2"]) >= bottom))
    rows = (e.withColumn("cy", F.explode(F.sequence(_cell(F.col("miny"), cell), _cell(F.col("maxy"), cell))))
             .select("id", "name", "minx", "maxx", "cy", band.alias("edges")))
    cells = rows.withColumn("cx", F.explode(F.sequence(_cell(F.col("minx"), cell), _cell(F.col("maxx"), cell))))
    s = _sides(cell)
    flip = F.aggregate("edges", F.lit(False), lambda acc, g: acc != _crosses(g, s["right"], s["bottom"]))
    return _classified(cells.select("cx", "cy", "id", "name", flip.alias("flip"), "edges"), cell)


def child_candidates(split: DataFrame, cell: float) -> DataFrame:
    """Candidates of the four cells of size ``cell`` in each cell of ``split``, and the edges that
    this parent holds (``parent_held``). A polygon that covers the parent covers them all."""
    up = _sides(2 * cell)
    quarter = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (0, 1) for dy in (0, 1)]))
    cells = split.select("*", up["right"].alias("right"), up["bottom"].alias("bottom"), quarter.alias("q")).select(
        (F.col("cx") * 2 + F.col("q.dx")).alias("cx"), (F.col("cy") * 2 + F.col("q.dy")).alias("cy"), "id", "name", "flip",
        "edges", "inside", F.col("held").alias("parent_held"), "right", "bottom")
    s = _sides(cell)
    # the child's corner as a point of the parent; being on an edge does not matter to its parity
    corner = F.aggregate("edges", F.col("flip"), lambda acc, e: acc != (
        (_crosses(e, s["right"], s["bottom"]) != _crosses(e, F.col("right"), s["bottom"]))
        != (_below(e, F.col("right"), s["bottom"]) != _below(e, F.col("right"), F.col("bottom")))))
    return _classified(cells.withColumn("flip", corner).drop("right", "bottom", "inside"), cell)


def _weighed(cells: DataFrame) -> DataFrame:
    """Candidates that can be the answer in their cell, with the number of edges the cell then holds."""
    own = Window.partitionBy("cx", "cy")
    out = cells.withColumn("cover", F.min(F.when(F.col("inside"), F.col("id"))).over(own))
    out = out.filter("cover IS NULL OR id <= cover")
    return out.withColumn("held", F.sum(F.size("edges")).over(own)).drop("cover")


def _grouped(cells: DataFrame, level: int, cell: float) -> DataFrame:
    """``level, cx, cy, right, bottom, cands ARRAY<STRUCT<id, name, inside, flip, edges>>, head``, one row per cell; ``head``
    is the answer for every point of a cell that its first candidate covers (no geometric test needed)."""
    tiles = cells.groupBy("cx", "cy").agg(F.array_sort(F.collect_list(
        F.struct("id", "name", "inside", "flip", "edges"))).alias("cands"))
    first, s = F.try_element_at("cands", F.lit(1)), _sides(cell)
    return tiles.select(F.lit(level).alias("level"), "cx", "cy", s["right"].alias("right"), s["bottom"].alias("bottom"), "cands",
                        F.when(first["inside"], first["name"]).alias("head"))


def _worth_splitting(kids: DataFrame) -> DataFrame:
    """Keys (cx, cy) of parents that splitting helps."""
    parent = [F.floor(F.col(c) / 2).alias(c) for c in ("cx", "cy")]
    loads = kids.groupBy(*parent).agg(F.max("held").alias("fullest"), F.sum(F.size("edges")).alias("all_"),
                                      F.max("parent_held").alias("before"))
    return loads.filter((F.col("fullest") <= 0.75 * F.col("before")) | (F.col("all_") <= 1.25 * F.col("before"))).select("cx", "cy")


def build_tiles(layer: DataFrame, cell: float, split_edges: int = DEFAULT_SPLIT_EDGES,
                max_level: int = DEFAULT_MAX_LEVEL) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Leaf tiles of all levels, the keys (cx, cy) of the cells split at each level, and what was cached on the way.
    A level below the first starts from a checkpoint, as each is used several times by the next."""
    tiles, splits, cells = [], [], _weighed(first_candidates(layer, cell)).persist()
    cached = [cells]
    for level in range(max_level + 1):
        size = cell / 2 ** level
        heavy = cells.filter(F.col("held") > split_edges)
        if level < max_level and not heavy.isEmpty():
            checkpoint_root(layer.sparkSession)
            kids = _weighed(child_candidates(heavy, size / 2)).checkpoint()
            split = _worth_splitting(kids).checkpoint()
            if not split.isEmpty():
                tiles.append(_grouped(cells.join(split, ["cx", "cy"], "left_anti"), level, size))
                splits.append(split)
                above = split.select(F.col("cx").alias("ux"), F.col("cy").alias("uy"))
                cells = kids.join(above, (F.floor(F.col("cx") / 2) == F.col("ux")) & (F.floor(F.col("cy") / 2) == F.col("uy")), "left_semi")
                continue
        tiles.append(_grouped(cells, level, size))
        break
    return reduce(DataFrame.unionByName, tiles), splits, cached


def tile_bytes(tiles: DataFrame) -> int:
    """Estimated in-memory size of the tile table (computed by Spark)."""
    row = tiles.agg(F.sum(
        F.lit(48) + F.aggregate("cands", F.lit(0).cast("bigint"),
                                lambda acc, c: acc + 64 + F.length(c["name"]) + 32 * F.size(c["edges"]))
    ).alias("b")).first()
    return int(row["b"] or 0)


@dataclass
class NeighborhoodIndex:
    tiles: DataFrame
    cell: float
    broadcastable: bool
    size_bytes: int
    salt_buckets: int = DEFAULT_SALTS
    splits: list[DataFrame] = field(default_factory=list)    # by level: keys of the cells that were split
    splits_broadcastable: bool = True

    @staticmethod
    def build(layer: DataFrame, cell: float | None = None,
              max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
              salt_buckets: int = DEFAULT_SALTS, materialize: bool = True,
              split_edges: int = DEFAULT_SPLIT_EDGES, max_level: int = DEFAULT_MAX_LEVEL) -> "NeighborhoodIndex":
        """Cut the layer into tiles, materialise them (checkpoint: the static
        side of a streaming join is then not recomputed per micro-batch) and
        decide broadcast vs shuffle from their measured size."""
        if cell is None:
            ext = layer_edges(layer).agg(
                (F.max("maxx") - F.min("minx")).alias("w"), (F.max("maxy") - F.min("miny")).alias("h"),
                F.percentile_approx(F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")),
                                    0.5).alias("median"),
            ).first()
            cell = choose_cell(max(ext["w"] or 0.0, ext["h"] or 0.0), ext["median"])
        tiles, splits, cached = build_tiles(layer, cell, split_edges, max_level)
        if materialize:
            checkpoint_root(layer.sparkSession)

            def kept(df: DataFrame) -> DataFrame:
                # persisted first so the reliable checkpoint writes without recomputing
                df.persist()
                out = df.checkpoint(eager=True)
                df.unpersist()
                return out

            tiles = kept(tiles)
            for df in cached:
                df.unpersist()
        size = tile_bytes(tiles)
        split_bytes = _SPLIT_BYTES * sum(s.count() for s in splits)
        return NeighborhoodIndex(tiles, cell, size <= max_broadcast_bytes, size, salt_buckets, splits,
                                 split_bytes <= max_broadcast_bytes)

    def _level(self, pts: DataFrame, px: Column, py: Column, level: str) -> DataFrame:
        """Add the level of each point's leaf: how many of its ancestor cells, from the top, were split."""
        pts = pts.withColumn(level, F.lit(0))
        for k, split in enumerate(self.splits):
            size, x, y, hit = self.cell / 2 ** k, f"{level}x", f"{level}y", f"{level}hit"
            keys = split.select(F.col("cx").alias(x), F.col("cy").alias(y), F.lit(1).alias(hit))
            # a point that left the tree is looked up no more: its key is null
            here = F.col(level) == k
            pts = pts.withColumn(x, F.when(here, _cell(px, size))).withColumn(y, F.when(here, _cell(py, size)))
            pts = pts.join(F.broadcast(keys) if self.splits_broadcastable else keys, [x, y], "left")
            pts = pts.withColumn(level, F.col(level) + F.coalesce(hit, F.lit(0))).drop(x, y, hit)
        return pts

    def tag(self, df: DataFrame, lon: str, lat: str, out: str) -> DataFrame:
        """Add ``out``: first containing feature's name, ``Unknown`` or null."""
        cxn, cyn, cn, ln = f"__cx_{out}", f"__cy_{out}", f"__cands_{out}", f"__level_{out}"
        px, py = F.col(lon), F.col(lat)
        # a power of two times the coordinate is exact, so all levels cut at the same places
        pts, finer = (self._level(df, px, py, ln), F.call_function("shiftleft", F.lit(1), F.col(ln))) if self.splits else (df, F.lit(1))
        pts = pts.withColumn(cxn, _cell(px * finer, self.cell)).withColumn(cyn, _cell(py * finer, self.cell))
        hn = f"__head_{out}"
        right, bottom = f"__right_{out}", f"__bottom_{out}"
        tiles = self.tiles.select(F.col("level").alias(ln), F.col("cx").alias(cxn), F.col("cy").alias(cyn),
                                  F.col("cands").alias(cn), F.col("head").alias(hn),
                                  F.col("right").alias(right), F.col("bottom").alias(bottom))
        keys = [cxn, cyn]
        if self.splits:
            keys = [ln, *keys]
        else:
            tiles = tiles.drop(ln)
        if self.broadcastable:
            tiles = F.broadcast(tiles)
        else:
            # hot cells: spread the point side over salts, replicate tiles per salt.
            # The row's number separates equal rows; a stream has none, and its
            # messages differ. Neither is rand(): a deterministic shuffle key lets
            # a lost map task rerun alone instead of its whole stage.
            sn, rn = f"__salt_{out}", f"__row_{out}"
            own = F.xxhash64(*[F.col(c) for c in df.columns]) if df.isStreaming else F.monotonically_increasing_id()
            pts = pts.withColumn(rn, own)
            # rows without a coordinate match no tile and share no key
            pts = pts.withColumn(cxn, F.coalesce(F.when(F.col(cyn).isNotNull(), F.col(cxn)), F.lit(_NOWHERE)
                                                 + F.pmod(F.col(rn), F.lit(_NOWHERE_KEYS))))
            pts = pts.withColumn(cyn, F.coalesce(cyn, F.lit(_NOWHERE)))
            pts = pts.withColumn(sn, F.pmod(F.xxhash64(rn), F.lit(self.salt_buckets)).cast("int")).drop(rn)
            tiles = tiles.hint("merge")
            tiles = tiles.withColumn(sn, F.explode(F.sequence(F.lit(0), F.lit(self.salt_buckets - 1))))
            keys = keys + [sn]
        joined = pts.join(tiles, keys, "left")
        # first containing candidate (sorted by id); later ones are not tested
        first = F.aggregate(F.col(cn), F.lit(None).cast("string"), lambda acc, c: F.when(
            acc.isNotNull(), acc).when(c["inside"] | (
                odd_right(c["edges"], c["flip"], F.col(right), F.col(bottom), px, py) == 1), c["name"]))
        name = (F.when(px.isNull() | py.isNull(), F.lit(None).cast("string"))
                .when(F.isnan(px) | F.isnan(py), F.lit(UNKNOWN))      # NaN is in no polygon
                .otherwise(F.coalesce(F.col(hn), first, F.lit(UNKNOWN))))   # lazy: head first
        return joined.withColumn(out, name).drop(*keys, cn, hn, right, bottom)


def tag_neighborhoods(rides: DataFrame, index: NeighborhoodIndex, dropoff: bool = True) -> DataFrame:
    """Rides plus ``pickupNeighborhood`` (and ``dropoffNeighborhood``).

    Aggregates that group by pickup only pass ``dropoff=False``: Catalyst
    cannot drop an unused left join to the tile table by itself (it cannot
    prove the table is unique per cell), so the second tagging would run and
    be thrown away.
    """
    tagged = index.tag(rides, "pickupLon", "pickupLat", "pickupNeighborhood")
    if not dropoff:
        return tagged
    return index.tag(tagged, "dropoffLon", "dropoffLat", "dropoffNeighborhood")
