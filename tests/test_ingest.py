"""Archive lines, archive scan, publishing."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cabstat.operators import ingest as IG
from cabstat.sources.archive import archive_members, scan_archive

RIDE = "2013000717,2013000714,CMT,1,N,2013-01-01 00:04:27,2013-01-01 00:11:20,1,413,2.3,-73.97912,40.7623177,-73.95027,40.77126"
FARE = "2013000717,2013000714,CMT,2013-01-01 00:04:27,CRD,8.5,0.5,0.5,2.37,0,11.87"


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_ride_lines(spark):
    p = IG.parse_ride_lines(lines(spark, [RIDE, RIDE.replace("-73.97912", "abc"), RIDE.rsplit(",", 1)[0],
                                          RIDE.replace("2013000717", "x", 1), "   ", RIDE + ",extra"]))
    rows = p.collect()
    assert rows[0]["error"] is None and rows[0]["medallion"] == 2013000717 and rows[0]["passengerCount"] == 1
    assert rows[1]["error"] is None and rows[1]["pickupLon"] == 0.0           # coordinate defaults to 0
    assert rows[2]["error"] == "expected 14 tokens, found 13" and rows[2]["medallion"] is None
    assert rows[3]["error"] == "invalid medallion"
    assert rows[4]["error"] == "empty line"
    assert rows[5]["error"] == "expected 14 tokens, found 15"
    assert IG.rejected(p).count() == 4 and IG.accepted(p).count() == 2


def test_fare_lines_and_publish(spark):
    p = IG.parse_fare_lines(lines(spark, [FARE, FARE.replace("8.5", "abc"), FARE.rsplit(",", 1)[0]]))
    rows = p.collect()
    assert rows[0]["error"] is None and rows[1]["fareAmount"] == 0.0 and rows[2]["error"] is not None
    msg = IG.publish_fares(IG.accepted(p)).select("key", F.col("body").cast("string").alias("b")).collect()
    assert msg[0]["key"] == "2013000717_2013000714_CMT"
    assert msg[0]["b"] == IG.FARE_CSV_HEADER + "\r\n" + FARE
    rj = IG.publish_rides(IG.accepted(IG.parse_ride_lines(lines(spark, [RIDE])))).select(
        F.col("body").cast("string")).first()[0]
    assert '"pickupTime":"2013-01-01T00:04:27+00:00"' in rj and '"pickupLon":-73.97912' in rj


def write(path, name, text):
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)


def test_archive_order_and_errors(spark):
    d = tempfile.mkdtemp(prefix="archive-")
    write(d, "trip_data_10.csv", "h\n10a\n10b\n")
    write(d, "trip_data_2.csv", "h\n2a\n")
    write(d, "trip_fare_1.csv", "h\nfare\n")
    write(d, "notes.txt", "x\n")
    assert [n for n, _ in archive_members(spark, d, "trip_data")] == [2, 10]
    got = [(r["file_seq"], r["value"]) for r in scan_archive(spark, d, "trip_data", ordered=True).collect()]
    assert got == [(2, "2a"), (10, "10a"), (10, "10b")]     # every data line kept, headers dropped
    write(d, "trip_data_x.csv", "h\n")
    with pytest.raises(ValueError):
        archive_members(spark, d, "trip_data")
    with pytest.raises(ValueError):
        archive_members(spark, tempfile.mkdtemp(), "trip_data")


def test_headers_go_by_position(spark):
    """A data line equal to the header stays; members with equal suffixes have headers of their own; a part
    without a header loses nothing."""
    d = tempfile.mkdtemp(prefix="archive-")
    write(d, "trip_data_1.csv", "h\na\nh\n\nb\n")
    write(d, "old_trip_data_1.csv", "k\nh\n")
    os.mkdir(os.path.join(d, "trip_data_2.csv"))
    write(os.path.join(d, "trip_data_2.csv"), "part-0", "p\n2a\n")
    write(os.path.join(d, "trip_data_2.csv"), "part-1", "p\n2b\np\n")
    write(os.path.join(d, "trip_data_2.csv"), "part-2", "2c\n")
    write(d, "trip_data_3.csv", "h\n" + "".join(f"{k}\n" for k in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = scan_archive(spark, d, "trip_data").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {}
    for r in rows:
        got.setdefault(r["file_name"], []).append(r["value"])
    assert sorted(got["trip_data_1.csv"]) == ["", "a", "b", "h"] and got["old_trip_data_1.csv"] == ["h"]
    assert sorted(got["trip_data_2.csv"]) == ["2a", "2b", "2c", "p"]
    assert sorted(got["trip_data_3.csv"], key=int) == [str(k) for k in range(5000)]
