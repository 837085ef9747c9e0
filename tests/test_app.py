"""The application entry point over file feeds and a GeoJSON layer."""

import datetime as dt
import json
import os
import tempfile

from cabstat.app import run
from cabstat.config import JobConfig
from cabstat.session import scratch_path
from cabstat.streaming.sinks import read_keyed_table
from test_streaming import append, fare, ride


def test_app_runs_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="layer-")
    with open(os.path.join(d, "nyc.geojson"), "w") as fh:
        json.dump({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"NAME": "Manhattan"},
             "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}}]}, fh)
    rides, fares = scratch_path(spark, "app-r"), scratch_path(spark, "app-f")
    t0 = dt.datetime(2024, 1, 1, 10)
    append(spark, rides, [ride(1, t0), ride(2, t0 + dt.timedelta(minutes=1), lon=5.0), ride(3, t0 + dt.timedelta(hours=2))])
    append(spark, fares, [fare(1, t0, 10.0), fare(2, t0 + dt.timedelta(minutes=1), 20.0),
                          fare(3, t0 + dt.timedelta(hours=2), 1.0)])
    sink = scratch_path(spark, "app-sink")
    cfg = JobConfig.from_args(["-n", d, "--ride-feed", rides, "--fare-feed", fares, "--sink-path", sink,
                               "--checkpoint-path", scratch_path(spark, "app-ck"), "--available-now",
                               "--state-partitions", "3"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        q = run(spark, cfg)
        q.awaitTermination(300)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ops = [op for p in q.recentProgress for op in json.loads(p.json)["stateOperators"]]
    assert ops and all(op["numShufflePartitions"] == 3 for op in ops)
    assert q.exception() is None
    got = {r["neighborhood"]: (r["number_of_rides"], r["total_fare_amount"])
           for r in read_keyed_table(spark, sink).collect()}
    assert got == {"Manhattan": (1, 10.0), "Unknown": (1, 20.0)}
