"""Join and aggregate semantics."""

import datetime as dt

from pyspark.sql import functions as F

from cabstat.operators import trips as TR

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def rides(spark, rows):
    return spark.createDataFrame(rows, "medallion BIGINT, hackLicense BIGINT, vendorId STRING, pickupTime TIMESTAMP, "
                                       "pickupNeighborhood STRING, tripDistanceInMiles DOUBLE")


def fares(spark, rows):
    df = spark.createDataFrame(rows, "medallion BIGINT, hackLicense BIGINT, vendorId STRING, pickupTime TIMESTAMP, "
                                     "fareAmount DOUBLE, tipAmount DOUBLE")
    return df.withColumn("totalAmount", F.col("fareAmount") + 1)


def sample(spark):
    t1 = T0 + dt.timedelta(minutes=59, seconds=59)
    t2 = T0 + dt.timedelta(hours=1)             # next window: [start, end)
    r = rides(spark, [
        (1, 1, "A", T0, "X", 1.0), (1, 1, "A", T0, "X", 2.0), (1, 1, "A", T0, "Y", 3.0),  # duplicate key
        (2, 2, "B", t1, "X", 0.0), (3, 3, "C", t2, None, 1.5),
        (None, 4, "D", T0, "X", 1.0),                                                     # null key
    ])
    f = fares(spark, [
        (1, 1, "A", T0, 10.0, 1.0), (1, 1, "A", T0, None, 2.0),
        (2, 2, "B", t1, 5.5, 0.55), (3, 3, "C", t2, 7.25, None),
        (None, 4, "D", T0, 99.0, 9.0),
    ])
    return r, f


def test_join_multiplies_and_skips_null_keys(spark):
    r, f = sample(spark)
    j = r.join(f, ["medallion", "hackLicense", "vendorId", "pickupTime"])
    assert j.count() == 3 * 2 + 1 + 1
    assert j.filter(F.col("medallion").isNull()).count() == 0
    assert len([c for c in j.columns if c == "medallion"]) == 1


def test_preaggregated_equals_join_then_aggregate(spark):
    r, f = sample(spark)
    plain = TR.neighborhood_stats(r.join(f, ["medallion", "hackLicense", "vendorId", "pickupTime"]))
    pre = TR.neighborhood_stats_preaggregated(r, f)
    a = sorted(map(tuple, plain.collect()), key=repr)
    b = sorted(map(tuple, pre.collect()), key=repr)
    assert a == b
    rows = {(x["neighborhood"], x["window_end"]): x for x in pre.collect()}
    x = rows[("X", T0 + dt.timedelta(hours=1))]
    # 2 X-rides with key 1 x 2 fares + 1 ride with key 2 = 5 joined rows
    assert x["number_of_rides"] == 5
    assert x["total_fare_amount"] == 2 * 10.0 + 5.5            # null fares skipped in the sum
    assert x["average_fare_amount"] == (2 * 10.0 + 5.5) / 5    # ... but counted in the mean
    assert x["total_tip_amount"] == 2 * 3.0 + 0.55
    nul = rows[(None, T0 + dt.timedelta(hours=2))]              # null neighbourhood is a group
    assert nul["number_of_rides"] == 1 and nul["total_tip_amount"] is None


def test_tip_per_mile_zero_distance_is_null(spark):
    r, f = sample(spark)
    t = TR.tip_per_mile(r, f)
    got = {(x["neighborhood"], x["window_end"]): x["tip_per_mile"] for x in t.collect()}
    assert got[("X", T0 + dt.timedelta(hours=1))] == (2 * 3.0 + 0.55) / (2 * (1.0 + 2.0) + 0.0)
    only_zero = TR.tip_per_mile(rides(spark, [(9, 9, "Z", T0, "Q", 0.0)]), fares(spark, [(9, 9, "Z", T0, 1.0, 1.0)]))
    assert only_zero.first()["tip_per_mile"] is None


def test_decimal_sums_are_order_independent(spark):
    vals = [0.1] * 10 + [0.2] * 10
    r = rides(spark, [(i, i, "V", T0, "N", 1.0) for i in range(len(vals))])
    f = fares(spark, [(i, i, "V", T0, v, v) for i, v in enumerate(vals)])
    s1 = TR.neighborhood_stats_preaggregated(r.repartition(7), f.repartition(3)).first()
    s2 = TR.neighborhood_stats_preaggregated(r.coalesce(1), f.coalesce(1)).first()
    assert s1["total_fare_amount"] == s2["total_fare_amount"] == 3.0


def test_mean_over_all_rows_matches_plain_join(spark):
    r, f = sample(spark)
    pre = {(x["neighborhood"], x["window_end"]): x for x in TR.mean_over_all_rows(r, f).collect()}
    x = pre[("X", T0 + dt.timedelta(hours=1))]
    # totals: key 1 fares (11.0, null) x 2 rides + key 2 fare 6.5 -> 5 rows, 3 priced
    assert x["number_of_rides"] == 5 and x["priced_rides"] == 3
    assert x["mean_total_all_rows"] == (2 * 11.0 + 6.5) / 5
    assert x["mean_total_priced"] == (2 * 11.0 + 6.5) / 3
