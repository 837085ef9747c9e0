"""The streaming job: two feeds → decode/classify → tag → watermark → join
→ windowed aggregate → sink. Same DataFrame functions as the batch job."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import JobConfig
from ..operators.geo import NeighborhoodIndex, tag_neighborhoods
from ..operators.quality import valid_fares, valid_rides
from ..operators.trips import join_trips, neighborhood_stats, neighborhood_stats_preaggregated
from ..schemas import TRIP_KEYS


def watermarked_rides(ride_msgs: DataFrame, index: NeighborhoodIndex, watermark: str = "3 minutes",
                      observation: str = "rides", dropoff: bool = True) -> DataFrame:
    """Valid, tagged rides; the watermark is set after the filter so a
    malformed message never advances event time."""
    rides = tag_neighborhoods(valid_rides(ride_msgs, observation), index, dropoff)
    return rides.withWatermark("pickupTime", watermark)


def watermarked_fares(fare_msgs: DataFrame, watermark: str = "3 minutes",
                      observation: str = "fares") -> DataFrame:
    return valid_fares(fare_msgs, observation).withWatermark("pickupTime", watermark)


def trip_stream(ride_msgs: DataFrame, fare_msgs: DataFrame, index: NeighborhoodIndex,
                cfg: JobConfig) -> DataFrame:
    """Stream-stream inner join on the four keys. Event time is a key and both
    sides are watermarked, so join state is evicted by the watermark."""
    return join_trips(watermarked_rides(ride_msgs, index, cfg.ride_watermark_interval),
                      watermarked_fares(fare_msgs, cfg.fare_watermark_interval))


def stats_stream(ride_msgs: DataFrame, fare_msgs: DataFrame, index: NeighborhoodIndex,
                 cfg: JobConfig) -> DataFrame:
    """Per (window, neighbourhood) stats; in append mode a window is emitted
    once, when the combined (minimum) watermark passes its end.

    State is held by aggregate, not by row: each feed is aggregated by join key
    first (a ride group per neighbourhood), so a hot key is a few sums in one
    state row, however many messages it gets, and its n x m trips are never built.
    A key's group is final when the watermark passes its pickup time, which is
    part of the key; only then it is joined, both sides in the same batch, so
    the join holds next to no state."""
    rides = watermarked_rides(ride_msgs, index, cfg.ride_watermark_interval, dropoff=False)
    fares = watermarked_fares(fare_msgs, cfg.fare_watermark_interval)
    return neighborhood_stats_preaggregated(rides, fares, cfg.window_interval)


def stats_stream_by_row(ride_msgs: DataFrame, fare_msgs: DataFrame, index: NeighborhoodIndex,
                        cfg: JobConfig) -> DataFrame:
    """The same stats over the joined trips themselves: the join keeps both feeds' rows
    until the watermark passes them. Only the columns the aggregate needs enter the state."""
    rides = watermarked_rides(ride_msgs, index, cfg.ride_watermark_interval, dropoff=False)
    rides = rides.select(*TRIP_KEYS, "pickupNeighborhood")
    fares = watermarked_fares(fare_msgs, cfg.fare_watermark_interval).select(*TRIP_KEYS, "fareAmount", "tipAmount")
    return neighborhood_stats(rides.join(fares, TRIP_KEYS, "inner"), cfg.window_interval)


def start(df: DataFrame, name: str, checkpoint: str, sink=None, path: str | None = None,
          available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """Named append-mode query with an explicit checkpoint. ``sink`` is a
    ``foreachBatch`` callable (e.g. :class:`KeyedUpsertSink`); otherwise rows are
    appended to ``path`` in ``fmt``."""
    w = df.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    if sink is not None:
        return w.foreachBatch(sink).start()
    return (w.option("path", path) if path else w).format(fmt).start()


@contextmanager
def state_partitions(spark, n: int | None):
    """Shuffle (and so state-store) partitions for queries started and run to
    completion inside the block. A fresh checkpoint freezes the count at its
    first batch; the stream thread reads the session conf asynchronously, so
    the setting is held until the block ends, then restored."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    if n:
        spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query, however long it takes; re-raise its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
