"""Metric context tags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def merge_tags(context: Column, metrics: Column) -> Column:
    """Context tags merged into a metric map; the metric's own keys win.

    Plain ``map_concat`` raises on duplicate keys, so context keys that the
    metric already has are dropped first.
    """
    kept = F.map_filter(context, lambda k, v: ~F.array_contains(F.map_keys(metrics), k))
    return F.map_concat(kept, metrics)
