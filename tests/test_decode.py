"""Ride/fare decoding and classification, with the feed's own literals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabstat.functions import decode as D
from cabstat.operators.quality import (ERR_CSV, ERR_JSON, ERR_TIME, decode_fares, decode_rides,
                                       valid_fares, valid_rides)
from cabstat.schemas import FARE_SCHEMA

# One valid ride and one valid fare of the feeds' formats.
VALID_RIDE = ('{"rateCode":1,"storeAndForwardFlag":"N","dropoffTime":"2013-01-01T00:11:20+00:00",'
              '"passengerCount":1,"tripTimeInSeconds":413.0,"tripDistanceInMiles":2.3,"pickupLon":-73.97912,'
              '"pickupLat":40.7623177,"dropoffLon":-73.95027,"dropoffLat":40.77126,"medallion":2013000717,'
              '"hackLicense":2013000714,"vendorId":"CMT","pickupTime":"2013-01-01T00:04:27+00:00"}')
OTHER_SHAPE = '{"depot": {"bay": 4, "cabs": [{"plate": "K-17"}]}}'
FLAT_OTHER = '{"plate": "K-17", "fuel": "low", "shift": "night"}'
HEADER = "medallion, hack_license, vendor_id, pickup_datetime, payment_type, fare_amount, surcharge, mta_tax, tip_amount, tolls_amount, total_amount"
FARE_LINE = "2013000717,2013000714,CMT,2013-01-01 00:04:27,CRD,8.5,0.5,0.5,2.37,0,11.87"


def msgs(spark, bodies):
    return spark.createDataFrame([(None if b is None else bytearray(b.encode()), f"k{i}")
                                  for i, b in enumerate(bodies)], "body BINARY, partitionKey STRING")


def by_key(df, cols):
    return {r["partitionKey"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_ride_classification(spark):
    d = decode_rides(msgs(spark, [VALID_RIDE, OTHER_SHAPE, FLAT_OTHER, "meter offline", None, ""]))
    got = by_key(d, ["errorMessage"])
    assert got == {"k0": (None,), "k1": (ERR_JSON,), "k2": (ERR_JSON,), "k3": (ERR_JSON,),
                   "k4": (ERR_JSON,), "k5": (ERR_JSON,)}
    r = valid_rides(msgs(spark, [VALID_RIDE])).first()
    assert r["medallion"] == 2013000717 and r["vendorId"] == "CMT" and r["rateCode"] == 1
    assert r["pickupTime"] == dt.datetime(2013, 1, 1, 0, 4, 27)
    assert r["pickupLon"] == pytest.approx(-73.97912)
    assert r["messageData"] is None and r["errorMessage"] is None  # fields of the message itself


def test_fare_classification(spark):
    bodies = [
        HEADER + "\r\n" + FARE_LINE,                               # valid
        HEADER + "\r\n" + FARE_LINE.rsplit(",", 1)[0],             # 10 fields: kept, total null
        HEADER + "\r\n" + FARE_LINE.replace(",8.5,", ",abc,"),     # bad cell voids the row
        HEADER + "\r\n" + FARE_LINE.replace("2013-01-01 00:04:27", "bad"),
        FARE_LINE,                                                 # no header: no record left
        HEADER + "\r\n",                                           # header only
        None,
        HEADER + "\r\n" + FARE_LINE + "\r\n" + "1,2,X,2000-01-01 00:00:00,CSH,1,1,1,1,1,5",  # later record ignored
    ]
    d = decode_fares(msgs(spark, bodies))
    got = by_key(d, ["errorMessage"])
    assert got == {"k0": (None,), "k1": (None,), "k2": (ERR_TIME,), "k3": (ERR_TIME,), "k4": (ERR_TIME,),
                   "k5": (ERR_TIME,), "k6": (ERR_CSV,), "k7": (None,)}
    rows = {r["partitionKey"]: r for r in d.collect()}
    assert rows["k1"]["fare"]["totalAmount"] is None and rows["k1"]["fare"]["tipAmount"] == 2.37
    assert all(v is None for v in rows["k2"]["fare"].asDict().values())
    assert rows["k7"]["fare"]["medallion"] == 2013000717
    v = valid_fares(msgs(spark, bodies[:1])).first()
    assert v["totalAmount"] == 11.87 and v["pickupTime"] == dt.datetime(2013, 1, 1, 0, 4, 27)


def test_fare_time_equals_ride_time(spark):
    """``2013-01-01 00:04:27`` and ``2013-01-01T00:04:27+00:00`` are one instant."""
    r = valid_rides(msgs(spark, [VALID_RIDE])).select("pickupTime")
    f = valid_fares(msgs(spark, [HEADER + "\r\n" + FARE_LINE])).select("pickupTime")
    assert r.first()[0] == f.first()[0]
    assert r.join(f, "pickupTime").count() == 1


def test_header_and_values(spark):
    df = spark.createDataFrame([("a,b,c\n\r\nx1,y1,z1",), ("x1,y1,z1",)], "t string")
    out = df.select(D.decode_csv_with_header("t", FARE_SCHEMA.__class__([
        FARE_SCHEMA["vendorId"], FARE_SCHEMA["paymentType"], FARE_SCHEMA["pickupTimeString"]])).alias("r")).collect()
    assert tuple(out[0]["r"]) == ("x1", "y1", "z1")
    assert tuple(out[1]["r"]) == (None, None, None)


def test_failfast_raises_and_dropmalformed_rejected(spark):
    df = spark.createDataFrame([("1,abc",)], "t string")
    with pytest.raises(Exception):
        df.select(F.from_csv("t", "a INT, b DOUBLE", {"mode": "FAILFAST"})).collect()
    with pytest.raises(Exception):
        df.select(F.from_csv("t", "a INT, b DOUBLE", {"mode": "DROPMALFORMED"})).collect()


def test_header_check(spark):
    df = spark.createDataFrame([("A,b,c\r\n1,2,3",), ("a,x,c\n1",), ("a,b\n",), (None,), ('"a","b","c"\n',), ("a, b,c\n",)], "t string")
    got = [r[0] for r in df.select(D.header_mismatch("t", ["a", "b", "c"])).collect()]
    assert got == [None, "column 2: expected b but found x", "header has 2 columns, schema has 3", None, None,
                   "column 2: expected b but found  b"]
    with pytest.raises(Exception):
        df.select(D.strict_header("t", ["a", "b", "c"])).collect()
    strict_ok = spark.createDataFrame([("a,b,c\n1,2,3",)], "t string")
    assert strict_ok.select(D.strict_header("t", ["a", "b", "c"])).first()[0] is None


def test_first_record_with_quoted_newline(spark):
    df = spark.createDataFrame([('h\r\n1,"two\nlines",3\r\n9,9,9',)], "t string")
    r = df.select(D.decode_csv_with_header("t", FARE_SCHEMA.__class__([
        FARE_SCHEMA["vendorId"], FARE_SCHEMA["paymentType"], FARE_SCHEMA["pickupTimeString"]])).alias("r")).first()["r"]
    assert tuple(r) == ("1", "two\nlines", "3")


def test_encode_csv_options(spark):
    df = spark.createDataFrame([("a,b", None, 'q"q')], "x string, y string, z string")
    assert df.select(D.encode_csv(F.struct("x", "y", "z"), {"quoteAll": "true", "nullValue": "NA"})).first()[0] \
        == '"a,b","NA","q\\"q"'


def test_dialect_escaped_separator_and_time_zone(spark):
    df = spark.createDataFrame([("1\t2024-01-01 10:00:00",)], "t string")
    r = df.select(D.decode_csv("t", "a INT, ts TIMESTAMP", {"sep": "\\t", "timeZone": "America/New_York",
                                                            "timestampFormat": "yyyy-MM-dd HH:mm:ss"}).alias("r")).first()["r"]
    assert r["a"] == 1
    assert r["ts"] == dt.datetime(2024, 1, 1, 15, 0, 0)      # 10:00 in New York is 15:00 UTC


def test_schema_must_be_literal(spark):
    df = spark.createDataFrame([("1,2", "a INT, b INT")], "t string, s string")
    with pytest.raises(Exception):
        df.select(F.from_csv("t", F.col("s"))).collect()
    assert tuple(df.select(F.from_csv("t", F.lit("a INT, b INT")).alias("r")).first()["r"]) == (1, 2)


def test_file_reader_skips_comments_and_blank_lines(spark):
    import os
    import tempfile
    from cabstat.sources.csvfiles import read_csv
    d = tempfile.mkdtemp(prefix="csvc-")
    with open(os.path.join(d, "part.csv"), "w") as fh:
        fh.write("a,b\n# a comment\n1,x\n\n   \n2,y\n#another\n")
    rows = read_csv(spark, d, "a INT, b STRING", header=True, options={"comment": "#"}).collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, "y")]


def test_bad_cell_voids_the_row_and_clean_records_parse_once(spark):
    df = spark.createDataFrame([("1,2.5,c",), ("1,x1,c",), ("1",), ("1,2.5,c,d",), ("x",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(D.decode_csv("t", "a INT, b DOUBLE, c STRING", corrupt="bad")).collect()]
    assert [None if r is None else tuple(r) for r in got] == [
        (1, 2.5, "c", None), (None, None, None, "1,x1,c"), (1, None, None, "1"), (1, 2.5, "c", "1,2.5,c,d"),
        (None, None, None, "x"), None, (None, None, None, None)]

    def parses(ddl):
        plan = df.select(D.decode_csv("t", ddl).alias("r"))._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("from_csv")

    assert parses("a INT, b DOUBLE") == parses("a INT, b DOUBLE, c STRING, d INT, e INT, f INT")


def test_first_record_honours_the_quote_option(spark):
    df = spark.createDataFrame([("h\n\n'a\nb|c',1\n2,2",)], "t string")
    r = df.select(D.decode_csv_with_header("t", FARE_SCHEMA.__class__([FARE_SCHEMA["vendorId"], FARE_SCHEMA["paymentType"]]),
                                           {"quote": "'"}).alias("r")).first()["r"]
    assert tuple(r) == ("a\nb|c", "1")


def test_null_key_part_keeps_its_separator(spark):
    from cabstat.operators.ingest import partition_key
    df = spark.createDataFrame([(1, 2, None), (1, None, "V")], "m BIGINT, h BIGINT, v STRING")
    assert [r[0] for r in df.select(partition_key(F.col("m"), F.col("h"), F.col("v"))).collect()] == ["1_2_", "1__V"]


def test_lines_of_tabs_are_blank(spark):
    from cabstat.operators.ingest import parse_ride_lines
    from cabstat.sources.csvfiles import drop_comment_and_blank
    df = spark.createDataFrame([("\t",), (" \t ",), ("# c",), ("x",)], "value string")
    assert [r[0] for r in drop_comment_and_blank(df).collect()] == ["x"]
    assert [r["error"] for r in parse_ride_lines(df).collect()][:2] == ["empty line"] * 2


def test_dialect_limits_and_encodings(spark):
    line = spark.createDataFrame([("a,bb,ccccccccccc",)], "l STRING")
    for limit in ({"maxCharsPerColumn": "5"}, {"maxColumns": "2"}):
        with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
            line.select(D.decode_csv("l", "a STRING, b STRING, c STRING", limit)).collect()
    assert line.select(D.decode_csv("l", "a STRING, b STRING, c STRING", {"maxCharsPerColumn": "20"}).alias("r")).first()["r"]["c"] == "c" * 11
    for encoding in ("UTF-8", "ISO-8859-1", "UTF-16", "UTF-16LE", "UTF-32"):
        body = spark.createDataFrame([(bytearray("é,ü".encode(encoding)),)], "body BINARY")
        assert body.select(D.body_to_text("body", encoding)).first()[0] == "é,ü"
