"""Job parameters (polygon layer, consumer groups, window and watermarks)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


def validate_interval(spark: SparkSession, text: str) -> str:
    """Accept what Spark accepts as an interval literal, with or without the
    ``interval`` prefix; raise ``ValueError`` otherwise."""
    body = text.strip()
    if body.lower().startswith("interval"):
        body = body[len("interval"):].strip()
    if not body or "'" in body:
        raise ValueError(f"invalid interval: {text!r}")
    try:
        spark.sql(f"SELECT INTERVAL '{body}' AS i").schema  # analysis parses the literal
    except Exception as exc:  # ParseException / AnalysisException
        raise ValueError(f"invalid interval: {text!r}") from exc
    return body


@dataclass(frozen=True)
class JobConfig:
    """Parameters of the streaming job. ``validated`` checks the intervals the
    way Spark parses them; ``from_args`` reads the command line."""

    # Defaults are fixed values of the job: 1 hour windows, 3 minute watermarks.
    neighborhood_layer: str
    ride_consumer_group: str = "$Default"
    fare_consumer_group: str = "$Default"
    window_interval: str = "1 hour"
    ride_watermark_interval: str = "3 minutes"
    fare_watermark_interval: str = "3 minutes"
    sink_path: str | None = None
    ride_feed: str | None = None        # parquet message folder, log:<path>, or kafka://servers/topic
    fare_feed: str | None = None
    checkpoint_path: str | None = None  # default: under spark.checkpoint.dir
    layer_format: str = "geojson"
    available_now: bool = False
    state_partitions: int | None = None  # frozen into the checkpoint at the first run

    def validated(self, spark: SparkSession) -> "JobConfig":
        if not self.neighborhood_layer:
            raise ValueError("neighborhood_layer is required")
        return JobConfig(
            neighborhood_layer=self.neighborhood_layer,
            ride_consumer_group=self.ride_consumer_group,
            fare_consumer_group=self.fare_consumer_group,
            window_interval=validate_interval(spark, self.window_interval),
            ride_watermark_interval=validate_interval(spark, self.ride_watermark_interval),
            fare_watermark_interval=validate_interval(spark, self.fare_watermark_interval),
            sink_path=self.sink_path,
            ride_feed=self.ride_feed,
            fare_feed=self.fare_feed,
            checkpoint_path=self.checkpoint_path,
            layer_format=self.layer_format,
            available_now=self.available_now,
            state_partitions=self.state_partitions,
        )

    @staticmethod
    def from_args(argv: list[str]) -> "JobConfig":
        """``--neighborhood-file-url x --window-interval '30 minutes' ...``"""
        import argparse
        p = argparse.ArgumentParser(prog="cabstat")
        p.add_argument("--neighborhood-file-url", "-n", required=True, dest="neighborhood_layer")
        p.add_argument("--taxi-ride-consumer-group", default="$Default", dest="ride_consumer_group")
        p.add_argument("--taxi-fare-consumer-group", default="$Default", dest="fare_consumer_group")
        p.add_argument("--window-interval", default="1 hour")
        p.add_argument("--taxi-ride-watermark-interval", default="3 minutes", dest="ride_watermark_interval")
        p.add_argument("--taxi-fare-watermark-interval", default="3 minutes", dest="fare_watermark_interval")
        p.add_argument("--sink-path", default=None)
        p.add_argument("--ride-feed", default=None)
        p.add_argument("--fare-feed", default=None)
        p.add_argument("--checkpoint-path", default=None)
        p.add_argument("--layer-format", default="geojson", choices=["geojson", "geojsonseq", "parquet"])
        p.add_argument("--available-now", action="store_true")
        p.add_argument("--state-partitions", type=int, default=None)
        return JobConfig(**vars(p.parse_args(argv)))
