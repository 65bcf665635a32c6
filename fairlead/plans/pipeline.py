"""The whole cleaning pass as one plan over all pending files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.config import Config
from fairlead.functions.ids import track_id
from fairlead.operators import catalog, collision, outliers, segment, validate
from fairlead.schema import REGISTRY, STATE


@dataclass
class Cleaned:
    """Frames of one pass, each lazy."""

    raw: DataFrame
    validated: DataFrame
    registry: DataFrame
    kept: DataFrame
    tracks: DataFrame
    summary: DataFrame

    @property
    def catalog(self) -> DataFrame:
        return catalog.track_catalog(self.tracks)

    def stats(self) -> DataFrame:
        """(metric, value) rows of the run's counters."""
        one = lambda df, **m: df.agg(*[e.cast("long").alias(k) for k, e in m.items()])
        parts = [
            one(self.raw, total_records_input=F.count("*")),
            one(self.validated, records_validated=F.count("*"), unique_mmsis=F.count_distinct("mmsi")),
            one(self.registry.filter("file_seq >= 0"), collisions_detected=F.count("*")),
            one(self.kept, records_after_outliers=F.count("*")),
            one(self.tracks, total_records_output=F.count("*"), unique_tracks=F.count_distinct("track_id")),
        ]
        long = [p.select(F.explode(F.create_map(*[x for c in p.columns for x in (F.lit(c), F.col(c))])).alias("metric", "value")) for p in parts]
        out = long[0]
        for p in long[1:]:
            out = out.unionByName(p)
        return out

    def state(self, before: DataFrame | None = None) -> DataFrame:
        """Where each vessel's next file goes on; vessels without a surviving track keep what they had."""
        last = self.tracks.select("mmsi", "file_seq", F.col("timestamp").alias("last_timestamp"), F.col("lat").alias("last_lat"), F.col("lon").alias("last_lon"), F.col("segment_num").alias("current_segment"), "cluster_assignment")
        if before is not None:
            last = last.unionByName(before.withColumn("file_seq", F.lit(-1).cast("long")), allowMissingColumns=True)
        fields = [f.name for f in STATE if f.name != "mmsi"]
        return last.groupBy("mmsi").agg(F.max_by(F.struct(*fields), F.struct("file_seq", "last_timestamp")).alias("s")).select("mmsi", "s.*")


def clean(raw: DataFrame, config: Config, *, order: list[str], state: DataFrame | None = None, registry: DataFrame | None = None, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> Cleaned:
    """``raw`` has the canonical columns and file_seq; ``order`` gives the order of ingestion within a file. ``state`` and ``registry`` come from earlier runs. ``keep`` writes steps that several others use and reads them back; without it they are lazy.

    Rows are dealt out by file and vessel and sorted once; all windows that follow use that. What crosses files (numbers, centroids) is worked out on one row per file and vessel and joined back.
    """
    keep = keep or (lambda df, _: df)
    how, hit = config.cleaning, config.collision
    validated = keep(validate.validate_positions(raw, how.bounds, order=order), "validated")
    found = collision.detect(validated, distance_km=hit.distance_threshold_km, eps_km=hit.dbscan_eps_km, min_bounces=hit.min_bounce_count, min_rows=hit.lookback_window)
    known, few = collision.kept_registry(collision.first_detections(found.select(*[f.name for f in REGISTRY]), registry))
    split = collision.assign_clusters(validated, known, few)
    group: tuple = ("file_seq", "mmsi")
    if how.split == "per_cluster":
        split = split.withColumn("_series", F.coalesce("cluster_assignment", F.lit("")))
        group = (*group, "_series")
        state = None if state is None else state.withColumn("_series", F.coalesce("cluster_assignment", F.lit("")))
    kept = keep(outliers.remove_outliers(split, how.max_velocity_knots, how.velocity_by_ship_type, group=group), "kept")
    offsets = segment.segment_offsets(kept, how.track_gap_hours, group=group)
    offsets = offsets.withColumn("_letter", segment.group_letter(offsets, group))
    if how.numbering == "lexical":
        if state is not None:
            raise ValueError("lexical numbering runs over all files at once")
        summary = segment.starting_segments_lexical(offsets, how.min_track_points, how.track_gap_hours, group=group)
    else:
        summary = segment.starting_segments(segment.group_summary(offsets, how.min_track_points, group), how.track_gap_hours, state, group=group)
    long = segment.filter_short(offsets, how.min_track_points, [*group, "segment_offset"])
    numbered = long.join(summary.select(*group, "start"), list(group)).withColumn("segment_num", F.col("segment_offset") + F.col("start"))
    tracks = numbered.withColumn("track_id", track_id(F.col("mmsi"), F.col("_letter"), F.col("segment_num"))).withColumn("dt_seconds", segment.dt_seconds([*group, "segment_offset"]))
    tracks = keep(tracks.drop("_letter", "_series", "segment_offset", "start"), "tracks")
    return Cleaned(raw, validated, known, kept.drop("_series"), tracks, summary)


def last_file_rows(df: DataFrame) -> DataFrame:
    """Rows of each day's last file."""
    w = W.partitionBy(F.to_date("timestamp"))
    return df.withColumn("_last", F.max("file_seq").over(w)).filter("file_seq = _last").drop("_last")
