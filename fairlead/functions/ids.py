"""Track identifiers and date parts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def track_id(mmsi: Column, cluster: Column, segment: Column) -> Column:
    """``mmsi_segment``, or ``mmsi_cluster_segment`` if there is a cluster."""
    return F.concat_ws("_", mmsi.cast("string"), cluster, segment.cast("string"))


def segment_of(track: Column) -> Column:
    """The number after the last underscore; 0 if there is none."""
    return F.coalesce(F.try_to_number(F.element_at(F.split(track, "_"), -1), F.lit("999999999999999999")).cast("long"), F.lit(0).cast("long"))


def day_parts(ts: Column) -> dict[str, Column]:
    """year, month and day as zero-padded strings."""
    return {"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"), "day": F.date_format(ts, "dd")}
