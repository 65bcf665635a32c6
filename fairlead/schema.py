"""Columns of position tables and of what is derived from them."""

from __future__ import annotations

from pyspark.sql import types as T

#: Canonical columns in output order, each with the header pattern (any case) that maps to it and its type. Fixed values.
CANONICAL = [
    ("timestamp", r"^#?\s*timestamp$", T.TimestampNTZType()),
    ("mmsi", r"^mmsi$", T.LongType()),
    ("lat", r"^lat(itude)?$", T.DoubleType()),
    ("lon", r"^lon(gitude)?$", T.DoubleType()),
    ("sog", r"^sog$", T.DoubleType()),
    ("cog", r"^cog$", T.DoubleType()),
    ("heading", r"^heading$", T.DoubleType()),
    ("ship_type", r"^ship.?type$", T.StringType()),
    ("imo", r"^imo$", T.StringType()),
    ("name", r"^name$", T.StringType()),
    ("callsign", r"^callsign$", T.StringType()),
]

#: Timestamp formats in the order they are tried, as Spark patterns that also take one-digit parts. Fixed values.
TIMESTAMP_FORMATS = ["d/M/y H:m:s", "y-M-d H:m:s", "d-M-y H:m:s", "y/M/d H:m:s"]

POSITIONS = T.StructType([T.StructField(name, kind) for name, _, kind in CANONICAL])

TRACKS = T.StructType([*POSITIONS.fields, T.StructField("cluster_assignment", T.StringType()), T.StructField("track_id", T.StringType()), T.StructField("dt_seconds", T.FloatType())])

#: One row per vessel that has surviving tracks: where the next file goes on.
STATE = T.StructType(
    [
        T.StructField("mmsi", T.LongType()),
        T.StructField("last_lat", T.DoubleType()),
        T.StructField("last_lon", T.DoubleType()),
        T.StructField("last_timestamp", T.TimestampNTZType()),
        T.StructField("current_segment", T.LongType()),
        T.StructField("cluster_assignment", T.StringType()),
    ]
)

#: One row per identifier that two vessels share: the centroids and where they were first found.
REGISTRY = T.StructType(
    [
        T.StructField("mmsi", T.LongType()),
        T.StructField("file_seq", T.LongType()),
        T.StructField("a_lat", T.DoubleType()),
        T.StructField("a_lon", T.DoubleType()),
        T.StructField("b_lat", T.DoubleType()),
        T.StructField("b_lon", T.DoubleType()),
        T.StructField("bounces", T.LongType()),
        T.StructField("detected_at", T.TimestampNTZType()),
    ]
)
