"""``neighborhoodFinder(lon, lat)`` as a SQL function, all in the JVM.

The column path is :class:`~cabstat.operators.geo.NeighborhoodIndex.tag`. For SQL users the same
lookup is composed of SQL functions over the same tables: scalar subqueries with equality on the
cell's keys, which Catalyst turns into left joins of the query with the tiles (and with the split
cells, level by level). A layer of any size works: Spark broadcasts or shuffles the tiles by their size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .geo import UNKNOWN, NeighborhoodIndex

_EDGE = "STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>"
_CANDS = f"ARRAY<STRUCT<id: BIGINT, name: STRING, inside: BOOLEAN, flip: BOOLEAN, edges: ARRAY<{_EDGE}>>>"
_TILE = f"STRUCT<head: STRING, right: DOUBLE, bottom: DOUBLE, cands: {_CANDS}>"

# As geo.odd_right and the fold over candidates in NeighborhoodIndex.tag.
def _turn(x: str, y: str) -> str:
    return f"((e.x2 - e.x1) * ({y} - e.y1) - ({x} - e.x1) * (e.y2 - e.y1))"


def _crosses(x: str, y: str) -> str:
    return (f"((e.y1 > {y}) != (e.y2 > {y}) AND ((e.y2 > e.y1 AND {_turn(x, y)} > 0) OR (e.y2 < e.y1 AND {_turn(x, y)} < 0)))")


def _below(x: str, y: str) -> str:
    d = _turn(x, y)
    return (f"((e.x1 > {x}) != (e.x2 > {x}) AND CASE WHEN e.x2 > e.x1 THEN {d} > 0 OR ({d} = 0 AND e.y2 <= e.y1) "
            f"ELSE {d} < 0 OR ({d} = 0 AND e.y2 >= e.y1) END)")


_TOUCHES = (f"({_turn('px', 'py')} = 0 AND px >= least(e.x1, e.x2) AND px <= greatest(e.x1, e.x2) "
            "AND py >= least(e.y1, e.y2) AND py <= greatest(e.y1, e.y2))")
_TURNS = (f"(({_crosses('px', 'py')} != {_crosses('t.right', 'py')}) "
          f"!= ({_below('t.right', 'py')} != {_below('t.right', 't.bottom')}))")
_INSIDE = (f"aggregate(c.edges, CAST(c.flip AS INT), (s, e) -> CASE WHEN s < 0 THEN s WHEN {_TOUCHES} THEN -1 "
           f"WHEN {_TURNS} THEN 1 - s ELSE s END) = 1")


def register_neighborhood_finder(spark: SparkSession, layer: DataFrame, name: str = "neighborhoodFinder",
                                 index: NeighborhoodIndex | None = None):
    """Register the function over ``layer`` (or an index built from it) for this session. Null gives null,
    NaN is in no polygon. Returns it for use on columns."""
    index = index or NeighborhoodIndex.build(layer)
    own = f"{name}_{uuid.uuid4().hex[:8]}"

    def define(part: str, args: str, returns: str, body: str) -> str:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {part}({args}) RETURNS {returns} RETURN {body}")
        return part

    index.tiles.createOrReplaceTempView(f"{own}_tiles")
    tile = define(f"{own}_tile", "at INT, x BIGINT, y BIGINT", _TILE,
                  f"(SELECT any_value(named_struct('head', head, 'right', right, 'bottom', bottom, 'cands', cands)) FROM {own}_tiles "
                  "WHERE level = at AND cx = x AND cy = y)")
    was_split = []
    for k, split in enumerate(index.splits):
        split.createOrReplaceTempView(f"{own}_split_{k}")
        found = define(f"{own}_was_split_{k}", "x BIGINT, y BIGINT", "BIGINT",
                       f"(SELECT count(*) FROM {own}_split_{k} WHERE cx = x AND cy = y)")
        size = f"{index.cell / 2 ** k!r}D"
        # a cell is split only below split cells, so the count is the leaf's level
        was_split.append(f"coalesce({found}(floor(px / {size}), floor(py / {size})), 0)")
    level = define(f"{own}_level", "px DOUBLE, py DOUBLE", "INT", f"CAST({' + '.join(was_split) or '0'} AS INT)")
    pick = define(f"{own}_pick", f"t {_TILE}, px DOUBLE, py DOUBLE", "STRING",
                  "coalesce(t.head, aggregate(t.cands, CAST(NULL AS STRING), (found, c) -> CASE WHEN found IS NOT NULL "
                  f"THEN found WHEN c.inside OR {_INSIDE} THEN c.name END), '{UNKNOWN}')")
    cell = f"{index.cell!r}D"
    at = define(f"{own}_at", "at INT, px DOUBLE, py DOUBLE", "STRING",
                f"{pick}({tile}(at, floor(px * shiftleft(1, at) / {cell}), floor(py * shiftleft(1, at) / {cell})), px, py)")
    define(name, "lon DOUBLE, lat DOUBLE", "STRING",
           f"CASE WHEN lon IS NULL OR lat IS NULL THEN NULL WHEN isnan(lon) OR isnan(lat) THEN '{UNKNOWN}' "
           f"ELSE {at}({level}(lon, lat), lon, lat) END")

    def finder(lon: Column | str, lat: Column | str) -> Column:
        return F.call_function(name, *[(F.col(c) if isinstance(c, str) else c).cast("double") for c in (lon, lat)])

    return finder
