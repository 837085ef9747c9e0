"""Streaming: stream = batch on closed windows, late rows, sinks, telemetry."""

import datetime as dt
import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from cabstat.config import JobConfig
from cabstat.operators.geo import NeighborhoodIndex
from cabstat.plans import batch_job as P
from cabstat.schemas import POLYGON_SCHEMA
from cabstat.session import scratch_path
from cabstat.streaming import job as J
from cabstat.streaming.sources import file_feed
from cabstat.streaming.telemetry import MetricsListener, parse_progress

CFG = JobConfig(neighborhood_layer="test")
HEADER = "medallion,hack_license,vendor_id,pickup_datetime,payment_type,fare_amount,surcharge,mta_tax,tip_amount,tolls_amount,total_amount"


def ride(m, t, lon=1.0, lat=1.0):
    return json.dumps({"medallion": m, "hackLicense": m, "vendorId": "V", "pickupTime": t.strftime("%Y-%m-%dT%H:%M:%S+00:00"),
                       "pickupLon": lon, "pickupLat": lat, "dropoffLon": lon, "dropoffLat": lat, "rateCode": 1})


def fare(m, t, amount):
    return HEADER + "\r\n" + f"{m},{m},V,{t:%Y-%m-%d %H:%M:%S},CRD,{amount},0.5,0.5,1.0,0,{amount + 2}"


def append(spark, path, bodies):
    spark.createDataFrame([(bytearray(b.encode()), None, None) for b in bodies],
                          "body BINARY, partitionKey STRING, enqueuedTime TIMESTAMP").write.mode("append").parquet(path)


def small_index(spark):
    sq = [{"x": float(x), "y": float(y)} for x, y in [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]
    return NeighborhoodIndex.build(spark.createDataFrame([(1, "Sq", [sq])], POLYGON_SCHEMA), cell=1.0)


def test_stream_equals_batch_on_closed_windows(spark, sf_small):
    rides, fares = P.feed_folders(spark, sf_small)
    idx = P.neighborhood_index(spark, sf_small)
    streamed = J.stats_stream(file_feed(spark, rides), file_feed(spark, fares), idx, CFG)
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    J.run_to_end(J.start(streamed, "t_stream_batch", ck, path=out))
    got = spark.read.parquet(out)
    batch = P.stats(spark, sf_small)
    wm = got.agg(F.max("window_end")).first()[0]
    assert wm is not None
    closed = batch.filter(F.col("window_end") <= F.lit(wm))
    a = sorted(map(tuple, got.collect()), key=repr)
    b = sorted(map(tuple, closed.collect()), key=repr)
    assert a == b and len(a) > 0
    assert batch.count() > len(a)        # the last open windows are never emitted


def test_late_rows_dropped_and_counted(spark):
    idx = small_index(spark)
    rides, fares = scratch_path(spark, "late-r"), scratch_path(spark, "late-f")
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    append(spark, rides, [ride(1, t0), ride(2, t0 + dt.timedelta(hours=2))])
    append(spark, fares, [fare(1, t0, 10.0), fare(2, t0 + dt.timedelta(hours=2), 20.0)])
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    stats = J.stats_stream(file_feed(spark, rides), file_feed(spark, fares), idx, CFG)
    q = J.start(stats, "late1", ck, path=out)
    J.run_to_end(q)
    # second run: an on-time pair for a new hour and a pair far behind the watermark
    append(spark, rides, [ride(3, t0 + dt.timedelta(hours=5)), ride(4, t0 + dt.timedelta(minutes=5))])
    append(spark, fares, [fare(3, t0 + dt.timedelta(hours=5), 30.0), fare(4, t0 + dt.timedelta(minutes=5), 40.0)])
    stats = J.stats_stream(file_feed(spark, rides), file_feed(spark, fares), idx, CFG)
    q = J.start(stats, "late2", ck, path=out)
    J.run_to_end(q)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  for op in json.loads(p.json).get("stateOperators", []))
    assert dropped >= 2
    rows = {r["window_end"]: r["number_of_rides"] for r in spark.read.parquet(out).collect()}
    assert rows == {t0 + dt.timedelta(hours=1): 1, t0 + dt.timedelta(hours=3): 1}   # hour 10 has only the on-time ride


def test_parse_progress_echoes_fields():
    progress = {"id": "q-1", "runId": "r-1", "name": "cab-progress", "batchId": 4,
                "durationMs": {"addBatch": 41, "walCommit": 7}, "numInputRows": 12,
                "inputRowsPerSecond": 6.5, "processedRowsPerSecond": 8.25,
                "sources": [{"description": "folder feed", "startOffset": "0", "endOffset": "3"}],
                "sink": {"description": "keyed table"},
                "observedMetrics": {"rides_ab12": {"malformed": 3, "messages": 10}}}
    row = parse_progress(progress)
    assert row["id"] == "q-1" and row["inputRows"] == 12 and row["sink"] == "keyed table"
    assert row["procRowsPerSecond"] == 8.25 and row["inputRowsPerSecond"] == 6.5
    assert row["durationms"] == {"addBatch": 41, "walCommit": 7}
    assert row["observed"] == {"rides.malformed": 3, "rides.messages": 10}
    assert row["DateValue"].endswith(" GMT")


def test_listener_rows_and_observed_malformed(spark):
    idx = small_index(spark)
    rides, fares = scratch_path(spark, "obs-r"), scratch_path(spark, "obs-f")
    t0 = dt.datetime(2024, 1, 1, 10)
    append(spark, rides, [ride(1, t0), "not json", ride(2, t0)])
    append(spark, fares, [fare(1, t0, 10.0), HEADER + "\r\n", fare(2, t0, 5.0)])
    listener = MetricsListener(spark, scratch_path(spark, "obs-rows"), {"app": "cabstat", "name": "ctx-name"})
    spark.streams.addListener(listener)
    try:
        stats = J.stats_stream(file_feed(spark, rides), file_feed(spark, fares), idx, CFG)
        q = J.start(stats, "obs", scratch_path(spark, "obs-ck"), path=scratch_path(spark, "obs-out"))
        J.run_to_end(q)
        listener.drain(q.runId)
    finally:
        spark.streams.removeListener(listener)
    rows = [r.asDict() for r in listener.to_dataframe().collect()]

    def total(key):
        return sum((r["observed"] or {}).get(key, 0) for r in rows)

    assert total("rides.malformed") == 1 and total("fares.malformed") == 1
    assert total("rides.messages") == 3
    tags = next(r for r in rows if r["event"] == "progress")["tags"]
    assert tags["app"] == "cabstat" and tags["name"] == "obs"      # the row's own value wins


def test_rows_are_readable_while_the_stream_runs(spark):
    src = scratch_path(spark, "live-src")
    append(spark, src, ["x", "y"])
    listener = MetricsListener(spark, scratch_path(spark, "live-rows"))
    spark.streams.addListener(listener)
    try:
        q = (file_feed(spark, src).writeStream.option("checkpointLocation", scratch_path(spark, "live-ck"))
             .trigger(processingTime="1 second").format("noop").start())
        seen = 0
        while not seen:
            assert q.isActive
            time.sleep(0.5)
            if os.path.isdir(listener.path):
                seen = listener.to_dataframe().filter("inputRows = 2").count()
        assert q.isActive
        q.stop()
        listener.drain(q.runId)
    finally:
        spark.streams.removeListener(listener)


def test_state_is_kept_by_aggregate_and_evicted(spark):
    """A hot key's state is one row a side, whatever its messages; the join keeps nothing behind the watermark."""
    idx = small_index(spark)
    rides, fares = scratch_path(spark, "agg-r"), scratch_path(spark, "agg-f")
    t0 = dt.datetime(2024, 1, 1, 10)
    append(spark, rides, [ride(1, t0)] * 400 + [ride(99, t0 + dt.timedelta(hours=3))])
    append(spark, fares, [fare(1, t0, 10.0)] * 300 + [fare(99, t0 + dt.timedelta(hours=3), 1.0)])
    states, counts = {}, {}
    for build in (J.stats_stream, J.stats_stream_by_row):
        out = scratch_path(spark, "agg-out")
        q = J.start(build(file_feed(spark, rides), file_feed(spark, fares), idx, CFG), f"agg_{build.__name__}",
                    scratch_path(spark, "agg-ck"), path=out)
        J.run_to_end(q)
        states[build.__name__] = [json.loads(p.json)["stateOperators"] for p in q.recentProgress]
        counts[build.__name__] = [(r["number_of_rides"], r["total_fare_amount"]) for r in spark.read.parquet(out).collect()]
    assert counts["stats_stream"] == counts["stats_stream_by_row"] == [(400 * 300, 400 * 300 * 10.0)]
    by_row = [op["numRowsTotal"] for op in states["stats_stream_by_row"][0] if op["operatorName"] == "symmetricHashJoin"]
    assert by_row == [702]
    first, last = states["stats_stream"][0], states["stats_stream"][-1]
    assert sorted(op["numRowsTotal"] for op in first) == [0, 0, 2, 2]      # two keys a side, no join rows yet
    assert all(op["numRowsTotal"] <= 1 for op in last)


def test_feed_files_come_in_event_time_order(spark, sf_small):
    """With a few files per trigger the watermark follows and no row is late."""
    from cabstat.sources.feeds import both_feeds
    from cabstat.sources.tables import table
    from cabstat.streaming import sources as S

    before, S.FEED_FILE_ROWS = S.FEED_FILE_ROWS, 100
    try:
        rides, fares = S.write_feeds(both_feeds(table(spark, sf_small, "events")), scratch_path(spark, "ordered"))
    finally:
        S.FEED_FILE_ROWS = before
    out = scratch_path(spark, "ordered-out")
    q = J.start(J.stats_stream(file_feed(spark, rides, 2), file_feed(spark, fares, 2), P.neighborhood_index(spark, sf_small), CFG),
                "ordered", scratch_path(spark, "ordered-ck"), path=out)
    J.run_to_end(q)
    assert sum(p.numInputRows > 0 for p in q.recentProgress) >= 4
    got, wm = spark.read.parquet(out), spark.read.parquet(out).agg(F.max("window_end")).first()[0]
    batch = P.stats(spark, sf_small).filter(F.col("window_end") <= F.lit(wm))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.collect()))


def test_a_backlog_is_taken_in_few_batches_however_many_files_it_has(spark, sf_small, monkeypatch):
    """The number of micro-batches does not follow that of the files; a core's share of one is bounded."""
    from cabstat.plans import stream_queries as T
    from cabstat.streaming import sources as S
    from cabstat.streaming.counters import classified

    monkeypatch.setattr(S, "FEED_FILE_ROWS", 10)
    monkeypatch.setattr(P, "_FEEDS", {})
    rides, _ = P.feed_folders(spark, sf_small)
    n = len([f for f in os.listdir(rides.removeprefix("file:")) if f.endswith(".parquet")])
    assert n >= 80
    most = S.files_per_trigger(spark, rides)
    assert S.LEAST_FILES < most <= -(-n // S.BACKLOG_BATCHES) + 1
    q = J.start(classified(*T._both(spark, sf_small)), "few", scratch_path(spark, "few-ck"), path=scratch_path(spark, "few-out"))
    J.run_to_end(q)
    taken = [p.numInputRows for p in q.recentProgress if p.numInputRows]
    assert 2 <= len(taken) <= S.BACKLOG_BATCHES + 2 and sum(taken) == 2000
    monkeypatch.setattr(S, "CORE_BYTES", 1)
    assert S.files_per_trigger(spark, rides) == S.LEAST_FILES


def test_termination_error_becomes_a_row(spark):
    listener = MetricsListener(spark, scratch_path(spark, "term-rows"))
    spark.streams.addListener(listener)
    try:
        src = scratch_path(spark, "term-src")
        append(spark, src, ["x"])

        def boom(df, batch_id):
            raise ValueError("sink down")

        q = (file_feed(spark, src).writeStream.option("checkpointLocation", scratch_path(spark, "term-ck"))
             .trigger(availableNow=True).foreachBatch(boom).start())
        try:
            q.awaitTermination()
        except Exception:
            pass
        listener.drain(q.runId)
    finally:
        spark.streams.removeListener(listener)
    term = listener.to_dataframe().filter("event = 'terminated'").collect()
    assert len(term) == 1 and "sink down" in term[0]["error"]


def test_skewed_key_in_stream(spark):
    """One key carries most messages on both feeds: duplicates multiply."""
    idx = small_index(spark)
    rides, fares = scratch_path(spark, "skew-r"), scratch_path(spark, "skew-f")
    t0 = dt.datetime(2024, 1, 1, 10)
    append(spark, rides, [ride(7, t0)] * 30 + [ride(8, t0 + dt.timedelta(minutes=1)), ride(9, t0 + dt.timedelta(hours=2))])
    append(spark, fares, [fare(7, t0, 1.0)] * 20 + [fare(8, t0 + dt.timedelta(minutes=1), 2.0),
                                                     fare(9, t0 + dt.timedelta(hours=2), 3.0)])
    stats = J.stats_stream(file_feed(spark, rides), file_feed(spark, fares), idx, CFG)
    out = scratch_path(spark, "skew-out")
    J.run_to_end(J.start(stats, "skew", scratch_path(spark, "skew-ck"), path=out))
    row = spark.read.parquet(out).first()
    assert row["number_of_rides"] == 30 * 20 + 1
    assert row["total_fare_amount"] == 30 * 20 * 1.0 + 2.0


def test_combined_watermark_is_the_minimum(spark):
    """Rides run hours ahead of fares: windows close only as far as the slower
    feed's watermark allows."""
    idx = small_index(spark)
    rides, fares = scratch_path(spark, "minwm-r"), scratch_path(spark, "minwm-f")
    t0 = dt.datetime(2024, 1, 1, 10)
    append(spark, rides, [ride(i, t0 + dt.timedelta(hours=i)) for i in range(6)])      # up to 15:00
    append(spark, fares, [fare(i, t0 + dt.timedelta(hours=i), 1.0) for i in range(3)])  # up to 12:00
    out = scratch_path(spark, "minwm-out")
    stats = J.stats_stream(file_feed(spark, rides), file_feed(spark, fares), idx, CFG)
    J.run_to_end(J.start(stats, "minwm", scratch_path(spark, "minwm-ck"), path=out))
    ends = sorted(r["window_end"] for r in spark.read.parquet(out).collect())
    # min(ride 14:57, fare 11:57) = 11:57: only [10:00, 11:00) has closed. A max
    # policy (14:57) would also emit the windows ending 12:00 and 13:00.
    assert ends == [t0 + dt.timedelta(hours=1)]
