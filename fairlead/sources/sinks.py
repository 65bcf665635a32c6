"""Parquet sinks for tracks and catalog, runs whose files appear when they are whole, and an audit of file sizes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.config import Config
from fairlead.functions.ids import day_parts
from fairlead.sources import store

CATALOG = "track_catalog.parquet"
SMALL_MB, LARGE_MB, AUDITED = 10, 1000, 10
DAY = ["year", "month", "day"]


def _writer(df: DataFrame, out: SimpleNamespace | None, mode: str):
    out = out or Config().output
    return df.write.mode(mode).option("compression", out.compression).option("parquet.compression.codec.zstd.level", out.compression_level).option("parquet.block.row.count.limit", out.row_group_size)


def write_parquet(df: DataFrame, path: str, out: SimpleNamespace | None = None, mode: str = "overwrite") -> None:
    """Sorted by track and time within each file, where both exist."""
    if {"track_id", "timestamp"} <= set(df.columns):
        df = df.sortWithinPartitions("track_id", "timestamp")
    _writer(df, out, mode).parquet(path)


def _by_day(df: DataFrame) -> DataFrame:
    """Rows dealt by day and a hash of the track, so a day is written by several tasks and a track lies in one file."""
    df = df.withColumns(day_parts(F.col("timestamp")))
    spread = df.repartition(*DAY, F.pmod(F.xxhash64("track_id"), F.lit(16)))
    return spread.drop("file_seq").sortWithinPartitions(*DAY, "track_id", "timestamp")


def write_tracks(df: DataFrame, base: str, out: SimpleNamespace | None = None, *, mode: str = "overwrite", same_day: str = "merge") -> None:
    """``year=/month=/day=`` folders with zero-padded parts. ``overwrite`` replaces the days that ``df`` has and no others; ``append`` adds to them. With ``same_day="last_file"`` only the rows of a day's last file stay."""
    if same_day == "last_file":
        day = F.to_date("timestamp")
        last = df.groupBy(day.alias("_day")).agg(F.max("file_seq").alias("_last"))
        df = df.withColumn("_day", day).join(last, "_day").filter(F.col("file_seq") == F.col("_last")).drop("_last", "_day")
    _writer(_by_day(df), out, mode).partitionBy(*DAY).option("partitionOverwriteMode", "dynamic").parquet(base)


def _of_run(run: str) -> str:
    return f"run-{run}-"


def publish_tracks(df: DataFrame, base: str, run: str, out: SimpleNamespace | None = None) -> list[str]:
    """Writes tracks beside ``base``'s day folders and then moves each file to its own, named by the run, so that an unfinished run's files can be told and dropped. Returns the folders of the days."""
    spark, staged = df.sparkSession, f"{base}/_{_of_run(run)}staged"
    _writer(_by_day(df), out, "overwrite").partitionBy(*DAY).parquet(staged)
    found = [path[len(staged) + 1 :].rpartition("/") for path in store.files(spark, staged, ".parquet")]
    days = sorted({f"{base}/{day}" for day, _, _ in found})
    for day in days:
        store.make_folder(spark, day)
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda x: store.move(spark, f"{staged}/{x[0]}/{x[2]}", f"{base}/{x[0]}/{_of_run(run)}{x[2]}"), found))
    store.remove(spark, staged)
    return days


def files_of_others(spark: SparkSession, days: list[str], run: str) -> list[str]:
    """Parquet files in day folders that the run did not write."""
    return [f for day in days for f in store.files(spark, day, ".parquet") if not f.rpartition("/")[2].startswith(_of_run(run))]


def drop_run(spark: SparkSession, base: str, run: str) -> None:
    """Removes all that a run has written under ``base``."""
    store.remove(spark, f"{base}/_{_of_run(run)}staged")
    for path in store.files(spark, base, ".parquet"):
        if path.rpartition("/")[2].startswith(_of_run(run)):
            store.remove(spark, path)


def write_catalog(catalog: DataFrame, base: str) -> str:
    """By as many tasks as the catalog has partitions."""
    path = f"{base}/{CATALOG}"
    catalog.write.mode("overwrite").parquet(path)
    return path


def parquet_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size_mb) of every Parquet file under ``folder``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    return files.select("path", (F.col("length") / (1 << 20)).alias("size_mb"))


def audit_sizes(sizes: DataFrame, first: int = AUDITED) -> DataFrame:
    """One row: all files, and over the first ones by path their mean, least and greatest size and how many are out of range."""
    n = sizes.agg(F.count("*").alias("n")).first()["n"]
    few = sizes.orderBy("path").limit(first)
    odd = (F.col("size_mb") < SMALL_MB) | (F.col("size_mb") > LARGE_MB)
    return few.agg(F.lit(n).alias("total_files"), F.avg("size_mb").alias("avg_mb"), F.min("size_mb").alias("min_mb"), F.max("size_mb").alias("max_mb"), F.coalesce(F.sum(odd.cast("long")), F.lit(0)).alias("out_of_range"))
