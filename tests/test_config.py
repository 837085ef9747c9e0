import pytest

from cabstat.config import JobConfig, validate_interval


def test_intervals(spark):
    assert validate_interval(spark, "interval 3 minutes") == "3 minutes"
    assert validate_interval(spark, "1 hour") == "1 hour"
    for bad in ["3 fortnights", "", "abc", "1 hour'; drop"]:
        with pytest.raises(ValueError):
            validate_interval(spark, bad)


def test_config(spark):
    c = JobConfig.from_args(["-n", "/layers/nyc.geojson", "--window-interval", "30 minutes"])
    assert c.window_interval == "30 minutes" and c.ride_watermark_interval == "3 minutes"
    assert c.ride_consumer_group == "$Default"
    assert c.validated(spark).window_interval == "30 minutes"
    with pytest.raises(ValueError):
        JobConfig(neighborhood_layer="x", window_interval="1 parsec").validated(spark)
    with pytest.raises(SystemExit):
        JobConfig.from_args([])



def test_consumer_groups():
    c = JobConfig.from_args(["-n", "/layers/nyc.geojson", "--taxi-ride-consumer-group", "ride-cg",
                             "--taxi-fare-consumer-group", "fare-cg", "--window-interval", "1 hour"])
    assert c.ride_consumer_group == "ride-cg" and c.fare_consumer_group == "fare-cg"
