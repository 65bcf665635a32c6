"""The track catalog and what is counted over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.functions.geo import whole_seconds_between


def track_catalog(tracks: DataFrame, *, merged: bool = False) -> DataFrame:
    """A row per file and track, or with ``merged`` per track: mmsi, start, end, positions, hours (of whole seconds)."""
    keys = ["track_id"] if merged else ["file_seq", "track_id"]
    spans = tracks.groupBy(*keys).agg(F.min("mmsi").alias("mmsi"), F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.count("*").alias("num_positions"))
    return spans.withColumn("duration_hours", whole_seconds_between(F.col("start_time"), F.col("end_time")) / 3600.0)


def catalog_stats(catalog: DataFrame) -> DataFrame:
    """One row over a catalog."""
    return catalog.agg(
        F.count("*").alias("total_tracks"),
        F.count_distinct("mmsi").alias("unique_mmsis"),
        F.avg("num_positions").alias("avg_positions_per_track"),
        F.avg("duration_hours").alias("avg_duration_hours"),
        F.min("num_positions").alias("min_positions"),
        F.max("num_positions").alias("max_positions"),
    )
