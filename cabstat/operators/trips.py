"""Trip join and per-(window, neighbourhood) aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import TRIP_COLUMNS, TRIP_KEYS

# Money and distance are summed as exact decimals: the result then does not
# depend on partitioning, task order or recomputation after a lost executor.
SUM_TYPE = "decimal(38,6)"


def _dec(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(SUM_TYPE)


def join_trips(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """Inner equi-join USING the four keys; keys appear once, null keys never
    match, duplicate keys multiply. Returns the 23 trip columns."""
    return rides.join(fares, TRIP_KEYS, "inner").select(*TRIP_COLUMNS)


def with_window(df: DataFrame, window: str = "1 hour", time_col: str = "pickupTime") -> DataFrame:
    """Tumbling, epoch-aligned ``[start, end)`` event-time window."""
    return df.withColumn("window", F.window(time_col, window))


def _stats_from(counts: Column, fare_sum: Column, tip_sum: Column) -> list[Column]:
    n = F.sum(counts)
    fare = F.sum(fare_sum).cast("double")
    tip = F.sum(tip_sum).cast("double")
    return [
        n.alias("number_of_rides"),
        fare.alias("total_fare_amount"),
        tip.alias("total_tip_amount"),
        (fare / n).alias("average_fare_amount"),   # over all rows, not avg()
        (tip / n).alias("average_tip_amount"),
    ]


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("pickupNeighborhood").alias("neighborhood"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "number_of_rides", "total_fare_amount", "total_tip_amount",
        "average_fare_amount", "average_tip_amount",
    )


def neighborhood_stats(trips: DataFrame, window: str = "1 hour") -> DataFrame:
    """Counts, sums and means per (window, pickup neighbourhood) over joined
    trips. Null neighbourhood is a group. Works on streaming trips (append
    mode emits a window once the watermark passes its end)."""
    g = with_window(trips, window).groupBy("window", "pickupNeighborhood")
    agg = g.agg(*_stats_from(F.lit(1).cast("bigint"), _dec("fareAmount"), _dec("tipAmount")))
    return _finish(agg)


def fare_key_aggregates(fares: DataFrame) -> DataFrame:
    """One row per join key: fare count, exact sums, count of priced totals."""
    return fares.groupBy(*TRIP_KEYS).agg(
        F.count(F.lit(1)).alias("f_n"),
        F.sum(_dec("fareAmount")).alias("f_fare"),
        F.sum(_dec("tipAmount")).alias("f_tip"),
        F.sum(_dec("totalAmount")).alias("f_total"),
        F.count("totalAmount").alias("f_total_n"))


def trip_aggregates(rides: DataFrame, fares: DataFrame, window: str = "1 hour") -> DataFrame:
    """Per (window, pickup neighbourhood) sums over the joined trips, computed
    without materialising the join and without a hot key in any task.

    Both sides are aggregated before the join: fares to one row per join key,
    rides to one row per (join key, pickup neighbourhood). Map-side partial
    aggregation collapses a key that holds any share of the rows before it is
    shuffled, so no task ever receives a hot key's rows, and the join sees at
    most a few rows per key. A ride group of ``r_n`` rides and a fare group of
    ``f_n`` fares stand for ``r_n * f_n`` joined trips, so sums scale by the
    other side's count (a ride's distance once per matching fare, a fare's
    amounts once per matching ride). The n x m expansion is never built.

    Columns: ``window, pickupNeighborhood, n, fare, tip, total, total_n, miles``
    (sums as exact decimals).
    """
    r = rides.groupBy(*TRIP_KEYS, "pickupNeighborhood").agg(
        F.count(F.lit(1)).alias("r_n"), F.sum(_dec("tripDistanceInMiles")).alias("r_miles"))
    j = r.join(fare_key_aggregates(fares), TRIP_KEYS, "inner")
    g = with_window(j, window).groupBy("window", "pickupNeighborhood")
    rn, fn = F.col("r_n"), F.col("f_n")
    return g.agg(
        F.sum(rn * fn).alias("n"), F.sum(F.col("f_fare") * rn).alias("fare"),
        F.sum(F.col("f_tip") * rn).alias("tip"), F.sum(F.col("f_total") * rn).alias("total"),
        F.sum(F.col("f_total_n") * rn).alias("total_n"), F.sum(F.col("r_miles") * fn).alias("miles"))


def neighborhood_stats_preaggregated(rides: DataFrame, fares: DataFrame,
                                     window: str = "1 hour") -> DataFrame:
    """Batch plan of :func:`neighborhood_stats` over ``join_trips(rides, fares)``
    (see :func:`trip_aggregates`)."""
    a = trip_aggregates(rides, fares, window)
    fare, tip = F.col("fare").cast("double"), F.col("tip").cast("double")
    return _finish(a.select(
        "window", "pickupNeighborhood", F.col("n").alias("number_of_rides"),
        fare.alias("total_fare_amount"), tip.alias("total_tip_amount"),
        (fare / F.col("n")).alias("average_fare_amount"), (tip / F.col("n")).alias("average_tip_amount")))


def _keyed(a: DataFrame) -> list:
    return [F.col("pickupNeighborhood").alias("neighborhood"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            F.col("n").alias("number_of_rides")]


def tip_per_mile(rides: DataFrame, fares: DataFrame, window: str = "1 hour") -> DataFrame:
    """Average tip per mile per (window, pickup neighbourhood):
    sum(tip) / sum(distance) over joined trips, null when the distance is zero."""
    a = trip_aggregates(rides, fares, window)
    tip, miles = F.col("tip").cast("double"), F.col("miles").cast("double")
    return a.select(*_keyed(a), tip.alias("total_tip_amount"), miles.alias("total_miles"),
                    F.try_divide(tip, F.when(miles != 0, miles)).alias("tip_per_mile"))


def mean_over_all_rows(rides: DataFrame, fares: DataFrame, window: str = "1 hour") -> DataFrame:
    """sum(total) / count(*) next to avg(total): a null amount still counts
    in the first denominator."""
    a = trip_aggregates(rides, fares, window)
    total = F.col("total").cast("double")
    return a.select(*_keyed(a), F.col("total_n").alias("priced_rides"),
                    (total / F.col("n")).alias("mean_total_all_rows"),
                    (total / F.col("total_n")).alias("mean_total_priced"))
