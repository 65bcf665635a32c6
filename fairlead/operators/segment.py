"""Tracks: runs of positions without a long gap, numbered per vessel across files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.functions.geo import seconds_between, whole_seconds_between
from fairlead.functions.ids import track_id

GROUP = ("file_seq", "mmsi")


def segment_offsets(df: DataFrame, gap_hours: float, *, group: tuple = GROUP) -> DataFrame:
    """Adds segment_offset: how many gaps of more than ``gap_hours`` (in whole seconds) lie before the row in its group."""
    w = W.partitionBy(*group).orderBy("timestamp")
    gap = F.coalesce(whole_seconds_between(F.lag("timestamp").over(w), F.col("timestamp")) > F.lit(gap_hours * 3600), F.lit(False))
    flagged = df.withColumn("_gap", gap.cast("long"))
    return flagged.withColumn("segment_offset", F.sum("_gap").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("_gap")


def filter_short(df: DataFrame, least: int, keys: list[str]) -> DataFrame:
    """Rows of tracks with at least ``least`` rows: a windowed count in place of a join."""
    return df.withColumn("_n", F.count("*").over(W.partitionBy(*keys))).filter(F.col("_n") >= least).drop("_n")


def dt_seconds(keys: list[str]) -> Column:
    """Whole seconds since the track's row before; 0 for the first."""
    w = W.partitionBy(*keys).orderBy("timestamp")
    return F.coalesce(whole_seconds_between(F.lag("timestamp").over(w), F.col("timestamp")), F.lit(0)).cast("float")


def group_letter(df: DataFrame, group: tuple = GROUP) -> Column:
    """The cluster of the group's first row, which names all its tracks."""
    if "cluster_assignment" not in df.columns:
        return F.lit(None).cast("string")
    return F.first("cluster_assignment").over(W.partitionBy(*group).orderBy("timestamp").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))


def segment_tracks(df: DataFrame, gap_hours: float, *, start: Column | int = 0, group: tuple = GROUP) -> DataFrame:
    """Adds segment_num (from ``start``) and track_id."""
    cut = segment_offsets(df, gap_hours, group=group).withColumn("_letter", group_letter(df, group))
    number = F.col("segment_offset") + (F.lit(start) if isinstance(start, int) else start)
    return cut.withColumn("segment_num", number.cast("long")).withColumn("track_id", track_id(F.col("mmsi"), F.col("_letter"), F.col("segment_num"))).drop("_letter", "segment_offset")


def group_summary(offsets: DataFrame, least: int, group: tuple = GROUP) -> DataFrame:
    """Of rows with segment_offset, per group with a track that is long enough: first_ts before short tracks go, last_ts and last_offset after."""
    counted = offsets.withColumn("_n", F.count("*").over(W.partitionBy(*group, "segment_offset")))
    long = F.col("_n") >= least
    return (
        counted.groupBy(*group)
        .agg(F.min("timestamp").alias("first_ts"), F.max(F.when(long, F.col("timestamp"))).alias("last_ts"), F.max(F.when(long, F.col("segment_offset"))).alias("last_offset"))
        .filter(F.col("last_ts").isNotNull())
    )


def starting_segments(summary: DataFrame, gap_hours: float, state: DataFrame | None = None, *, group: tuple = GROUP) -> DataFrame:
    """Adds start to a group summary: the vessel's number in the file before, one more after a gap (fractional seconds; a file that begins earlier continues).

    Numbers are a running sum over files, not a loop: each file adds its own last offset and its carry. ``state`` (mmsi, last_timestamp, current_segment) counts as a file before all.
    """
    vessel = [g for g in group if g != "file_seq"]
    rows = summary
    if state is not None:
        past = state.select(*vessel, F.lit(-1).cast("long").alias("file_seq"), F.col("last_timestamp").alias("first_ts"), F.col("last_timestamp").alias("last_ts"), F.col("current_segment").alias("last_offset"))
        rows = summary.unionByName(past)
    w = W.partitionBy(*vessel).orderBy("file_seq")
    gap = seconds_between(F.lag("last_ts").over(w), F.col("first_ts")) > F.lit(gap_hours * 3600)
    carried = rows.withColumn("carry", F.coalesce(gap, F.lit(False)).cast("long"))
    total = F.sum(F.col("carry") + F.col("last_offset")).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    numbered = carried.withColumn("start", (total - F.col("last_offset")).cast("long"))
    return numbered.filter(F.col("file_seq") >= 0) if state is not None else numbered


def starting_segments_lexical(offsets: DataFrame, least: int, gap_hours: float, *, group: tuple = GROUP) -> DataFrame:
    """As ``starting_segments``, but a file goes on from the track whose id sorts last as text, so that 9 comes after 10 and numbers can repeat.

    That rule is no running sum: the files of a vessel are folded one after another, on one row a track, not a position.
    """
    vessel = [g for g in group if g != "file_seq"]
    tracks = offsets.groupBy(*group, "segment_offset").agg(F.count("*").alias("n"), F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tracks.select(*group).schema) + ", start long"

    def fold(pdf):
        rows, number, last = [], None, None
        for key, file in pdf.groupby(list(group), sort=True, dropna=False):
            long = file[file["n"] >= least]
            if long.empty:
                continue
            start = 0 if number is None else number + int((file["t0"].min() - last).total_seconds() > gap_hours * 3600)
            best = max(zip(long["segment_offset"] + start, long["t1"], strict=True), key=lambda x: str(x[0]))
            number, last = int(best[0]), best[1]
            rows.append((*key, start))
        return pd.DataFrame(rows, columns=[*group, "start"])

    return tracks.groupBy(*vessel).applyInPandas(fold, schema)
