"""DuckDB SQL that recomputes each registered query from the raw tables.

The oracle never decodes messages: it derives the expected result straight
from ``events`` / ``orders`` / ``nation`` with the feed rules written as
plain arithmetic, so it is independent of the Spark code path.
"""

from __future__ import annotations

from ..sources import feeds as FD
from ..sources import polygons as PG


def _inside_sql(i: str, j: str) -> str:
    """Name of the nation-layer polygon strictly containing lattice point (i, j)."""
    o, b = PG.BLOCK_OFFSET, PG.BLOCK
    c = f"CAST(floor(({i} - {o}) / {b}) AS BIGINT)"
    r = f"CAST(floor(({j} - {o}) / {b}) AS BIGINT)"
    a = f"({i} - {o} - {b} * {c})"
    bb = f"({j} - {o} - {b} * {r})"
    kinds = (
        f"(({c}) = 0 AND {a} > 0 AND {bb} > 0)",
        f"(({c}) = 1 AND (({a} > 0 AND {a} < 10 AND {bb} > 0 AND {bb} < 4) OR ({a} > 0 AND {a} < 4 AND {bb} > 0 AND {bb} < 10)))",
        f"(({c}) = 2 AND {a} > 1 AND {a} < 11 AND {bb} > 1 AND {bb} < 11 AND NOT ({a} >= 4 AND {a} <= 8 AND {bb} >= 4 AND {bb} <= 8))",
        f"(({c}) = 3 AND (({a} > 0 AND {a} < 5 AND {bb} > 0 AND {bb} < 5) OR ({a} > 7 AND {bb} > 7)))",
        f"(({c}) = 4 AND {a} > 0 AND {bb} > 0 AND {a} + {bb} < 12)",
    )
    cond = f"{i} >= {o} AND {j} >= {o} AND {c} <= 4 AND {r} <= 4 AND ({' OR '.join(kinds)})"
    return (f"CASE WHEN {cond} THEN (SELECT n_name FROM nation WHERE n_nationkey = {r} * 5 + {c}) "
            f"ELSE 'Unknown' END")


def nbhd_sql(which: str) -> str:
    g = FD.GRID
    if which == "pickup":
        i, j = f"(event_id % {g})", f"((event_id // {g}) % {g})"
        return f"CASE WHEN event_id % {FD.RIDE_NO_PICKUP_LON} = 0 THEN NULL ELSE {_inside_sql(i, j)} END"
    i, j = f"((event_id * 3 + 5) % {g})", f"(((event_id // {g}) * 5 + 11) % {g})"
    return _inside_sql(i, j)


def base_cte() -> str:
    """``f``: one row per event with every feed attribute and fault flag."""
    g = FD.GRID
    return f"""
WITH e0 AS (
  SELECT event_id, user_id, event_type, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(round(value * 100) AS BIGINT) AS fare_c,
         date_trunc('second', ts) AS pt
  FROM events),
f AS (
  SELECT *,
    user_id AS medallion, event_id AS hackLicense, event_type AS vendorId,
    k % 6 AS rateCode,
    CASE WHEN k % 10 = 0 THEN 'Y' ELSE 'N' END AS storeAndForwardFlag,
    k % 5 + 1 AS passengerCount,
    CAST(k * 10 AS DOUBLE) AS tripTimeInSeconds,
    k / 8 AS tripDistanceInMiles,
    date_trunc('second', ts + to_seconds(k * 10)) AS dropoff_pt,
    CASE WHEN event_id % {FD.RIDE_NO_PICKUP_LON} = 0 THEN NULL ELSE -74.0 + (event_id % {g}) / {g} END AS pickupLon,
    40.0 + ((event_id // {g}) % {g}) / {g} AS pickupLat,
    -74.0 + ((event_id * 3 + 5) % {g}) / {g} AS dropoffLon,
    40.0 + (((event_id // {g}) * 5 + 11) % {g}) / {g} AS dropoffLat,
    CASE WHEN k % 2 = 0 THEN 'CRD' ELSE 'CSH' END AS paymentType,
    fare_c / 100 AS fareAmount,
    ((fare_c * 2 + 5) // 10) / 100 AS tipAmount,
    CASE WHEN event_id % {FD.FARE_SHORT_ROW} = 0 THEN NULL
         ELSE (fare_c + {FD.SURCHARGE_CENTS + FD.MTA_TAX_CENTS} + (fare_c * 2 + 5) // 10) / 100 END AS totalAmount,
    (event_id % {FD.RIDE_NOT_JSON} = 0 OR event_id % {FD.RIDE_OTHER_SHAPE} = 0) AS ride_bad,
    (event_id % {FD.FARE_BAD_TIME} = 0 OR event_id % {FD.FARE_HEADER_ONLY} = 0
       OR event_id % {FD.FARE_BAD_AMOUNT} = 0) AS fare_bad,
    concat_ws('_', user_id, event_id, event_type) AS partitionKey,
    {nbhd_sql("pickup")} AS pickupNeighborhood,
    {nbhd_sql("dropoff")} AS dropoffNeighborhood
  FROM e0),
trips AS (SELECT * FROM f WHERE NOT ride_bad AND NOT fare_bad)
"""


def money_sum(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(38,6))) AS DOUBLE)"
