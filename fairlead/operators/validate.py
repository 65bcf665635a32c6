"""Validation of positions: null and range filters, bounding box, speed, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_SOG = 102.3


def position_filter(df: DataFrame, bounds: dict | None, max_sog: float = MAX_SOG) -> Column:
    """What a single row must meet. All of it can be pushed into a Parquet scan. Rows without an identifier or a time can belong to no track and go too."""
    ok = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("mmsi").isNotNull() & F.col("timestamp").isNotNull()
    ok = ok & F.col("lat").between(-90.0, 90.0) & F.col("lon").between(-180.0, 180.0)
    if bounds:
        ok = ok & F.col("lat").between(bounds["lat_min"], bounds["lat_max"]) & F.col("lon").between(bounds["lon_min"], bounds["lon_max"])
    if "sog" in df.columns:
        ok = ok & (F.col("sog").isNull() | F.col("sog").between(0.0, max_sog))
    return ok


def keep_first(df: DataFrame, order: list[str]) -> DataFrame:
    """One row per file, vessel and time: the first by ``order``.

    A row goes if the one before it in the vessel's series has its time, so no window is needed beside those of the later steps: they all use this exchange by file and vessel, and its sort.
    """
    w = W.partitionBy("file_seq", "mmsi").orderBy("timestamp", *order)
    return df.withColumn("_before", F.lag("timestamp").over(w)).filter(F.col("_before").isNull() | (F.col("_before") != F.col("timestamp"))).drop("_before")


def validate_positions(df: DataFrame, bounds: dict | None, *, order: list[str], max_sog: float = MAX_SOG) -> DataFrame:
    """Rows that pass, without duplicates."""
    return keep_first(df.filter(position_filter(df, bounds, max_sog)), order)


def validation_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: original, validated, removed and the share removed in percent (0 of nothing)."""
    n = before.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(after.select(F.lit(0).alias("a"), F.lit(1).alias("b")))
    counted = n.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("original_count"), F.coalesce(F.sum("b"), F.lit(0)).alias("validated_count"))
    removed = F.col("original_count") - F.col("validated_count")
    percent = F.when(F.col("original_count") > 0, removed * 100.0 / F.col("original_count")).otherwise(0.0)
    return counted.select("original_count", "validated_count", removed.alias("removed_count"), percent.alias("removal_percentage"))
