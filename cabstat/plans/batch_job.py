"""The batch job: feeds → decode/classify → tag → join → aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.geo import NeighborhoodIndex, tag_neighborhoods
from ..operators.quality import valid_fares, valid_rides
from ..operators.trips import join_trips, neighborhood_stats_preaggregated
from ..schemas import MESSAGE_SCHEMA, TRIP_KEYS
from ..session import ensure_utc, scratch_path
from ..sources.feeds import both_feeds
from ..sources.polygons import nation_layer
from ..sources.tables import table
from ..streaming.sources import write_feeds_of

_INDEXES: dict[tuple[str, str], NeighborhoodIndex] = {}


def neighborhood_index(spark: SparkSession, sf_dir: str) -> NeighborhoodIndex:
    """Tile index of the nation-derived layer, built once per application and dir."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEXES:
        _INDEXES[key] = NeighborhoodIndex.build(nation_layer(table(spark, sf_dir, "nation")))
    return _INDEXES[key]


_FEEDS: dict[tuple[str, str], tuple[str, str]] = {}


def feed_folders(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Ride and fare message folders derived from ``events``: written once per
    application and directory, then only read."""
    ensure_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FEEDS:
        _FEEDS[key] = write_feeds_of(table(spark, sf_dir, "events"), scratch_path(spark, "feeds"), "ts", both_feeds)
    return _FEEDS[key]


def feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rides, fares = (spark.read.schema(MESSAGE_SCHEMA).parquet(p) for p in feed_folders(spark, sf_dir))
    return rides, fares


def enriched_rides(spark: SparkSession, sf_dir: str,
                   observation: Observation | str | None = None, dropoff: bool = True) -> DataFrame:
    rides_msg, _ = feeds(spark, sf_dir)
    return tag_neighborhoods(valid_rides(rides_msg, observation), neighborhood_index(spark, sf_dir), dropoff)


def fares(spark: SparkSession, sf_dir: str,
          observation: Observation | str | None = None) -> DataFrame:
    _, fares_msg = feeds(spark, sf_dir)
    return valid_fares(fares_msg, observation)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_trips(enriched_rides(spark, sf_dir), fares(spark, sf_dir))


def untagged_trips(spark: SparkSession, sf_dir: str, rides: DataFrame | None = None) -> DataFrame:
    """Joined trips with whatever columns ``rides`` has (default: no tags)."""
    if rides is None:
        rides = valid_rides(feeds(spark, sf_dir)[0])
    keep = [c for c in rides.columns if c not in ("errorMessage", "messageData")]
    return rides.select(*keep).join(fares(spark, sf_dir), TRIP_KEYS, "inner")


def stats(spark: SparkSession, sf_dir: str, window: str = "1 hour") -> DataFrame:
    return neighborhood_stats_preaggregated(enriched_rides(spark, sf_dir, dropoff=False),
                                            fares(spark, sf_dir), window)
