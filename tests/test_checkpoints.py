"""Checkpoint readers, durable counters, telemetry slices."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_streaming import CFG, append, fare, ride, small_index

from cabstat.operators.quality import decode_rides, valid_rides
from cabstat.schemas import MESSAGE_SCHEMA
from cabstat.session import scratch_path
from cabstat.streaming import job as J
from cabstat.streaming.checkpoints import batch_offsets, files_read, join_state_rows, late_rows, state_operators
from cabstat.streaming.counters import CounterSink, classified, read_counters
from cabstat.streaming.sources import file_feed
from cabstat.streaming.telemetry import MetricsListener, last_of_each_batch

T0 = dt.datetime(2024, 1, 1, 10)
at = lambda **k: T0 + dt.timedelta(**k)


def test_join_state_before_and_after_the_watermark(spark):
    rides, fares, ckpt = (scratch_path(spark, x) for x in ("js-r", "js-f", "js-ck"))
    append(spark, rides, [ride(k, at(minutes=k)) for k in range(6)] + [ride(9, at(hours=3))])
    append(spark, fares, [fare(k, at(minutes=k), 1.0) for k in range(4)] + [fare(9, at(hours=4), 1.0)])
    stats = J.stats_stream_by_row(file_feed(spark, rides), file_feed(spark, fares), small_index(spark), CFG)
    J.run_to_end(J.start(stats, "js", ckpt, path=scratch_path(spark, "js-out")))
    count = lambda batch, side: join_state_rows(spark, ckpt, batch, side).count()
    assert (count(0, "left"), count(0, "right")) == (7, 5)
    assert (count(1, "left"), count(1, "right")) == (1, 1)       # watermark 12:57, the slower feed's
    marks = {r["batch_id"]: r["watermark"] for r in batch_offsets(spark, ckpt).collect()}
    assert marks == {0: None, 1: at(hours=3, minutes=-3)}
    assert "symmetricHashJoin" in {r["operatorName"] for r in state_operators(spark, ckpt).collect()}
    agg = scratch_path(spark, "js-ck2")
    J.run_to_end(J.start(valid_rides(file_feed(spark, rides)).withWatermark("pickupTime", "1 minute").groupBy("pickupTime").count(),
                         "js2", agg, path=scratch_path(spark, "js-out")))
    with pytest.raises(ValueError, match="0 stream-stream joins"):
        join_state_rows(spark, agg, 0, "left")


def test_late_rows_are_those_the_state_operators_drop(spark):
    src, ckpt = scratch_path(spark, "lr-src"), scratch_path(spark, "lr-ck")
    dropped = 0
    for bodies in ([ride(1, T0), ride(2, at(hours=1))], [ride(3, at(minutes=57)), ride(4, at(minutes=57, seconds=1)), "no json"],
                   [ride(5, T0), ride(6, at(hours=2))], [ride(7, at(hours=1, minutes=30))]):
        append(spark, src, bodies)
        rides = valid_rides(file_feed(spark, src)).withWatermark("pickupTime", "3 minutes")
        q = J.start(rides.groupBy("medallion", "pickupTime").count(), f"lr_{ckpt[-8:]}", ckpt, path=scratch_path(spark, "lr-out"))
        J.run_to_end(q)
        dropped += sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in json.loads(p.json)["stateOperators"])
    rows = spark.read.schema(MESSAGE_SCHEMA).parquet(src).withColumn("file_path", F.col("_metadata.file_path"))
    decoded = decode_rides(rows).filter("errorMessage IS NULL").select("file_path", "ride.medallion", "ride.pickupTime")
    late = {r["medallion"]: r["late_watermark"] for r in late_rows(spark, ckpt, decoded, F.col("pickupTime")).collect()}
    assert late == {3: at(minutes=57), 5: at(minutes=57), 7: at(hours=2, minutes=-3)} and dropped == 3
    assert files_read(spark, ckpt).count() == len(spark.read.parquet(src).inputFiles())


def test_a_killed_and_replayed_batch_counts_once(spark):
    rides, fares, ckpt, path = (scratch_path(spark, x) for x in ("dc-r", "dc-f", "dc-ck", "dc"))
    append(spark, rides, [ride(1, T0), "not json"])
    append(spark, fares, [fare(1, T0, 1.0)])
    stream = lambda: classified(file_feed(spark, rides), file_feed(spark, fares))
    own = CounterSink(path)

    def killed(batch, batch_id):
        own(batch, batch_id)
        raise RuntimeError("killed after the record")

    with pytest.raises(Exception, match="killed"):
        J.run_to_end(J.start(stream(), "dc1", ckpt, sink=killed))
    totals = lambda: {r["feed"]: (r["n"], r["bad"]) for r in read_counters(spark, path).groupBy("feed").agg(
        F.sum("messages").alias("n"), F.sum("malformed").alias("bad")).collect()}
    J.run_to_end(J.start(stream(), "dc1", ckpt, sink=CounterSink(path)))
    assert totals() == {"rides": (2, 1), "fares": (1, 0)}
    append(spark, rides, ["{}"])
    J.run_to_end(J.start(stream(), "dc1", ckpt, sink=CounterSink(path)))
    assert totals() == {"rides": (3, 2), "fares": (1, 0)}
    assert read_counters(spark, path).select("query").distinct().count() == 1


def test_progress_rows_of_a_slice_are_one_file(spark):
    class Event:
        runId = "r"
        exception = None

        def __init__(self, n):
            self.progress = {"id": "q", "runId": "r", "batchId": n, "numInputRows": 10 + n, "stateOperators": [
                {"numRowsDroppedByWatermark": n, "numRowsTotal": 5}]}

    listener = MetricsListener(spark, scratch_path(spark, "slices"), slice_seconds=3600)
    for n in (0, 1, 2, 1):        # batch 1 ran twice
        listener.onQueryProgress(Event(n))
    assert not listener.drain("r", timeout=0.1)     # the query has not ended; its rows are written all the same
    listener.onQueryTerminated(Event(0))
    assert listener.drain("r")
    rows = listener.to_dataframe()
    assert rows.count() == 4 and len(rows.inputFiles()) == 1
    once = last_of_each_batch(rows)
    assert once.agg(F.sum("inputRows"), F.sum("lateRows"), F.max("stateRows")).first() == (33, 3, 5)
    listener.onQueryProgress(object())              # whatever goes wrong becomes a row
    listener.flush()
    assert listener.to_dataframe().filter("event = 'listener_error'").count() == 1
