"""The driver's ``events`` table seen as vessel positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ONE_FILE = "cast(0 as bigint)"
DAY_FILES = "cast(date_format(ts, 'yyyyMMdd') as bigint)"
HALF_MONTHS = "cast(case when day(ts) <= 15 then 0 else 1 end as bigint)"

LAT = "54e0 + 4.5e0 * ((event_id * 7919) % 1000) / 1e3"
LON = "7e0 + 9e0 * ((event_id * 104729) % 1000) / 1e3"
BOUNCE_LAT = f"case when user_id % 5 = 0 then (case when event_id % 2 = 0 then 55e0 else 57.5e0 end) + ((event_id * 7919) % 100) / 1e4 else {LAT} end"
BOUNCE_LON = f"case when user_id % 5 = 0 then (case when event_id % 2 = 0 then 10e0 else 12e0 end) + ((event_id * 104729) % 100) / 1e4 else {LON} end"


def positions(spark: SparkSession, sf_dir: str, *, file: str = ONE_FILE, bounce: bool = False, hourly: bool = False) -> DataFrame:
    """One position per event. ``bounce``: every fifth vessel jumps between two places; ``hourly``: times cut to the hour, which makes duplicates."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        "event_id",
        F.expr(f"{file} AS file_seq"),
        F.expr("user_id AS mmsi"),
        F.expr("cast(date_trunc('hour', ts) as timestamp_ntz) AS timestamp" if hourly else "ts AS timestamp"),
        F.expr(f"{BOUNCE_LAT if bounce else LAT} AS lat"),
        F.expr(f"{BOUNCE_LON if bounce else LON} AS lon"),
        F.expr("value AS sog"),
        F.expr("event_type AS ship_type"),
    )
