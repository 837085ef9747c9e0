"""Driver contract: entry smoke run and oracle agreement on sf0.001."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = ["neighborhood_stats", "neighborhood_stats_joined", "trip_join", "point_in_polygon", "classify_fare_errors",
        "decode_csv_header", "csv_bad_cell", "csv_corrupt_record", "parse_ride_line", "publish_ride_json",
        "tip_per_mile", "metric_tags", "mean_over_all_rows", "valid_rows", "struct_expand", "csv_typed_cells",
        "csv_mode_drop", "csv_header_check", "trip_archive_scan", "polygon_layer", "parse_fare_line",
        "publish_fare_csv", "classify_ride_errors", "malformed_counts",
        "polygon_layer_files", "polygon_layer_wkb", "csv_encoded_bodies", "configured_stats", "upsert_versions",
        "message_log_scan", "late_rows", "durable_counters"]


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["neighborhood", "window_end", "number_of_rides", "total_fare_amount",
                          "total_tip_amount", "average_fare_amount", "average_tip_amount"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    """All of the library's own queries; those of the optional subpackage say which."""
    assert set(E.QUERIES) == set(E.ORACLES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.12g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return float(v) if hasattr(v, "as_tuple") else v


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, sf_small, duck, name):
    df = E.queries()[name](spark, sf_small)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    so = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oo = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = Counter(tuple(norm(r[i]) for i in so) for r in df.collect())
    b = Counter(tuple(norm(r[i]) for i in oo) for r in cur.fetchall())
    assert a == b
