"""The published files of a date range, and fetching those that are missing."""

from __future__ import annotations

import logging
import urllib.request
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.sources.positions import store_of

log = logging.getLogger(__name__)

#: Up to this day there is a file a month, from it on one a day.
DAILY_FROM = "2024-03-01"


def expected_files(spark: SparkSession, start: date, end: date) -> DataFrame:
    """(file) names for each day from ``start`` to ``end``, each once. An empty range gives none."""
    if end < start:
        return spark.range(0).select(F.lit("").alias("file"))
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    daily = F.date_format("d", "yyyy/'aisdk-'yyyy-MM-dd'.zip'")
    monthly = F.date_format("d", "yyyy/'aisdk-'yyyy-MM'.zip'")
    return days.select(F.when(F.col("d") >= F.lit(DAILY_FROM).cast("date"), daily).otherwise(monthly).alias("file")).distinct()


def pending(expected: DataFrame, done: DataFrame, first: int = 0) -> DataFrame:
    """(file) of ``expected`` that are not in ``done``, in order; at most ``first`` if that is not 0."""
    left = expected.join(done.select("file").distinct(), "file", "left_anti").orderBy("file")
    return left.limit(first) if first else left


def exists_remote(base_url: str, name: str, timeout: float = 30) -> bool:
    try:
        with urllib.request.urlopen(urllib.request.Request(base_url + name, method="HEAD"), timeout=timeout) as answer:
            return answer.status == 200
    except OSError as e:
        log.warning("%s: %s", name, e)
        return False


def download(base_url: str, name: str, folder: str, timeout: float = 300) -> bool:
    """Streams one file to ``folder``, a path or URI; it has its name only when it is whole."""
    store, root = store_of(folder)
    target = f"{root}/{name}"
    store.create_dir(target.rpartition("/")[0], recursive=True)
    try:
        with urllib.request.urlopen(base_url + name, timeout=timeout) as answer, store.open_output_stream(target + ".part", compression=None) as out:
            while block := answer.read(1 << 20):
                out.write(block)
        store.move(target + ".part", target)
        return True
    except OSError as e:
        log.error("%s: %s", name, e)
        if store.get_file_info(target + ".part").is_file:
            store.delete_file(target + ".part")
        return False


def download_range(spark: SparkSession, base_url: str, folder: str, start: date, end: date, force: bool = False) -> tuple[int, int]:
    """Fetches what is expected and not there; returns how many were fetched and how many skipped."""
    names = sorted(r["file"] for r in expected_files(spark, start, end).collect())
    store, root = store_of(str(folder))
    there = {n for n, info in zip(names, store.get_file_info([f"{root}/{n}" for n in names]), strict=True) if info.is_file}
    wanted = [n for n in names if force or n not in there]
    got = sum(exists_remote(base_url, n) and download(base_url, n, str(folder)) for n in wanted)
    return got, len(names) - len(wanted)
