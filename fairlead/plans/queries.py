"""The driver's queries over position views, one for each operator or group of them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.config import Config
from fairlead.functions import geo, ids
from fairlead.operators import catalog, collision, outliers, segment, validate
from fairlead.plans.pipeline import Cleaned, clean
from fairlead.plans.runs import Manifest, load_state, process, save_state
from fairlead.plans.views import DAY_FILES, HALF_MONTHS, ONE_FILE, positions
from fairlead.sources import downloads, sinks, store
from fairlead.sources import positions as sources
from fairlead.sources.scratch import scratch

BOX = Config().cleaning.bounds
NARROW = {"lat_min": 54.5, "lat_max": 58.0, "lon_min": 8.0, "lon_max": 15.0}
TYPES = {"click": 25.0, "view": 20.0, "purchase": 35.0, "signup": 15.0}
GROUP = ["file_seq", "mmsi"]


def rounded(c: str) -> Column:
    return F.round(c, 6).alias(c)


def centred(c: str) -> Column:
    """A mean of values with few decimals often lies halfway between two roundings; the shift decides it alike in both engines."""
    return F.round(F.col(c) + 1e-9, 6).alias(c)


def valid(spark: SparkSession, sf_dir: str, file: str = ONE_FILE, bounds: dict | None = BOX) -> DataFrame:
    return validate.validate_positions(positions(spark, sf_dir, file=file), bounds, order=["event_id"])


def bouncing(spark: SparkSession, sf_dir: str, file: str = ONE_FILE) -> DataFrame:
    """No speed filter here: all events count."""
    return positions(spark, sf_dir, file=file, bounce=True).drop("sog")


def whole(spark: SparkSession, sf_dir: str) -> Cleaned:
    raw = bouncing(spark, sf_dir, HALF_MONTHS)
    return clean(raw, Config.cleaner(velocity_by_ship_type={}), order=["event_id"])


def validate_positions(spark, sf_dir):
    return valid(spark, sf_dir, bounds=NARROW).select("event_id", "mmsi", "timestamp", rounded("lat"), rounded("lon"), "sog")


def validate_dedup_first(spark, sf_dir):
    df = positions(spark, sf_dir, hourly=True)
    return validate.validate_positions(df, BOX, order=["event_id"]).select("event_id", "mmsi", "timestamp")


def validation_stats(spark, sf_dir):
    df = positions(spark, sf_dir, hourly=True)
    return validate.validation_stats(df, validate.validate_positions(df, BOX, order=["event_id"])).select("original_count", "validated_count", "removed_count", rounded("removal_percentage"))


def _steps(df: DataFrame) -> list[Column]:
    w = W.partitionBy(*GROUP).orderBy("timestamp")
    return [F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")]


def haversine_km(spark, sf_dir):
    df = valid(spark, sf_dir)
    return df.select("event_id", F.round(geo.haversine_km(*_steps(df)), 6).alias("km"))


def haversine_nm(spark, sf_dir):
    df = valid(spark, sf_dir)
    return df.select("event_id", F.round(geo.haversine_nm(*_steps(df)), 6).alias("nm"))


def velocity_consecutive(spark, sf_dir):
    return outliers.consecutive_velocity(valid(spark, sf_dir)).select("event_id", rounded("velocity_knots"))


def outliers_single(spark, sf_dir):
    return outliers.remove_outliers(valid(spark, sf_dir), 50.0).select("event_id", "mmsi", "timestamp")


def outliers_by_ship_type(spark, sf_dir):
    return outliers.remove_outliers(valid(spark, sf_dir), 50.0, TYPES).select("event_id", "mmsi", "timestamp")


def outliers_iterative(spark, sf_dir):
    return outliers.remove_outliers_iterative(valid(spark, sf_dir), 40.0).select("event_id", "mmsi", "timestamp")


def segment_tracks(spark, sf_dir):
    return segment.segment_tracks(valid(spark, sf_dir), 12.0).select("event_id", "mmsi", "segment_num", "track_id")


def _short(spark, sf_dir, least: int = 2) -> DataFrame:
    return segment.filter_short(segment.segment_tracks(valid(spark, sf_dir, DAY_FILES), 4.0), least, ["file_seq", "track_id"])


def filter_short_tracks(spark, sf_dir):
    return _short(spark, sf_dir, 3).select("event_id", "file_seq", "track_id")


def dt_seconds(spark, sf_dir):
    return _short(spark, sf_dir).withColumn("dt_seconds", segment.dt_seconds(["file_seq", "track_id"])).select("event_id", "file_seq", "track_id", "dt_seconds")


def final_segment(spark, sf_dir):
    last = _short(spark, sf_dir).groupBy("file_seq", "mmsi").agg(F.max_by("track_id", "timestamp").alias("track_id"))
    return last.select("file_seq", "mmsi", ids.segment_of(F.col("track_id")).alias("final_segment"))


def track_catalog(spark, sf_dir):
    return catalog.track_catalog(_short(spark, sf_dir)).withColumn("duration_hours", F.round("duration_hours", 6))


def catalog_stats(spark, sf_dir):
    stats = catalog.catalog_stats(catalog.track_catalog(_short(spark, sf_dir)))
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_positions_per_track", "avg_duration_hours")})


def _days(spark, sf_dir, gap: float = 12.0) -> Cleaned:
    raw = positions(spark, sf_dir, file=DAY_FILES)
    return clean(raw, Config.cleaner(track_gap_hours=gap, velocity_by_ship_type={}), order=["event_id"])


def continuity_tracks(spark, sf_dir):
    return _days(spark, sf_dir).tracks.select("event_id", "track_id", "dt_seconds")


def starting_segments(spark, sf_dir):
    return _days(spark, sf_dir).summary.select("file_seq", "mmsi", "first_ts", "last_ts", "last_offset", "carry", "start")


def mmsi_state(spark, sf_dir):
    return _days(spark, sf_dir).state().select("mmsi", rounded("last_lat"), rounded("last_lon"), "last_timestamp", "current_segment")


def collision_candidates(spark, sf_dir):
    return collision.candidates(bouncing(spark, sf_dir)).select("mmsi", "n_rows", "n_jumps")


def _labels(spark, sf_dir) -> DataFrame:
    return collision.label_groups(collision.candidate_rows(bouncing(spark, sf_dir)))


def collision_labels(spark, sf_dir):
    return _labels(spark, sf_dir).select("mmsi", "timestamp", "label")


def collision_bounce(spark, sf_dir):
    return collision.bounce_patterns(_labels(spark, sf_dir)).select("mmsi", "n_points", "n_clusters", "bounces", "is_bounce")


def collision_centroids(spark, sf_dir):
    return collision.centroids(_labels(spark, sf_dir)).select("mmsi", "label", centred("lat"), centred("lon"))


def collision_registry(spark, sf_dir):
    found = collision.first_detections(collision.detect(bouncing(spark, sf_dir, HALF_MONTHS)))
    return found.select("mmsi", "file_seq", centred("a_lat"), centred("a_lon"), centred("b_lat"), centred("b_lon"), "bounces", "detected_at")


def collision_split(spark, sf_dir):
    df = bouncing(spark, sf_dir, HALF_MONTHS)
    return collision.assign_clusters(df, *collision.kept_registry(collision.first_detections(collision.detect(df)))).select("event_id", "mmsi", "cluster_assignment")


def pipeline_tracks(spark, sf_dir):
    return whole(spark, sf_dir).tracks.select("event_id", "file_seq", "mmsi", "timestamp", "cluster_assignment", "track_id", "dt_seconds")


def pipeline_stats(spark, sf_dir):
    return whole(spark, sf_dir).stats()


def ship_type_limits(spark, sf_dir):
    df = valid(spark, sf_dir)
    limits = outliers.speed_limit(df, 50.0, TYPES, tuple(GROUP))
    return df.select("mmsi", limits.alias("limit_knots")).distinct()


def distinct_tracks(spark, sf_dir):
    return _short(spark, sf_dir).select("track_id").distinct()


def parse_timestamps(spark, sf_dir):
    """Members by user, in one of the four formats each; every seventh row in another, which only a whole member's format drops."""
    shown = F.expr("CASE WHEN (user_id + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) % 4 = 0 THEN date_format(ts, 'dd/MM/yyyy HH:mm:ss') WHEN (user_id + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) % 4 = 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN (user_id + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) % 4 = 2 THEN date_format(ts, 'dd-MM-yyyy HH:mm:ss') ELSE date_format(ts, 'yyyy/MM/dd HH:mm:ss') END")
    text = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("user_id").alias("member"), shown.alias("timestamp"))
    return sources.parse_timestamps(text, ["member"]).select("event_id", "member", "timestamp")


def partition_keys(spark, sf_dir):
    return positions(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in ids.day_parts(F.col("timestamp")).items()])


def _day_names(spark, sf_dir) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(F.date_format("ts", "yyyy/'aisdk-'yyyy-MM-dd'.zip'").alias("file"), "user_id").distinct()


def pending_files(spark, sf_dir):
    days = _day_names(spark, sf_dir)
    return downloads.pending(days.select("file").distinct(), days.filter("user_id = 3").select("file"), 5)


def union_by_name(spark, sf_dir):
    df = positions(spark, sf_dir)
    some = df.filter("event_id % 2 = 0").select("event_id", "mmsi", "sog")
    return sources.union_positions([some, df.filter("event_id % 2 = 1").select("ship_type", "mmsi", "event_id")]).select("event_id", "mmsi", "sog", "ship_type")


def expected_files(spark, sf_dir):
    return downloads.expected_files(spark, date(2023, 11, 15), date(2024, 3, 20))


def _zipped(spark, sf_dir, df: DataFrame) -> str:
    """Positions as the published files look: a zip a day, times to the second."""
    folder = scratch(spark, "zips")
    named = df.select(
        F.date_format("timestamp", "'aisdk-'yyyy-MM-dd'.zip'").alias("file"),
        "event_id",
        F.date_format("timestamp", "dd/MM/yyyy HH:mm:ss").alias("# Timestamp"),
        F.col("mmsi").alias("MMSI"),
        F.col("lat").alias("Latitude"),
        F.col("lon").alias("Longitude"),
        *[F.col(a).alias(b) for a, b in (("sog", "SOG"), ("ship_type", "Ship type")) if a in df.columns],
    )
    sources.write_zips(named, folder, "file", "event_id")
    return folder


def zip_roundtrip(spark, sf_dir):
    """All events written to zipped CSV, a file a day, in a shared folder and read back by the data source."""
    read = sources.read_zips(spark, sources.list_raw_files(_zipped(spark, sf_dir, positions(spark, sf_dir))))
    return read.select("file_seq", "line", "mmsi", "timestamp", rounded("lat"), rounded("lon"), "sog", "ship_type")


def run_tracks(spark, sf_dir):
    """Zips cleaned by two runs, the second of which goes on from the state, registry and manifest of the first."""
    folder, base = _zipped(spark, sf_dir, bouncing(spark, sf_dir)), scratch(spark, "run")
    config = Config({"cleaning": {"velocity_by_ship_type": {}}, "storage": {"raw_dir": folder, "clean_dir": f"{base}/clean", "state_dir": f"{base}/state"}})
    process(spark, config, max_files=14)
    process(spark, config, resume=True)
    tracks = spark.read.option("recursiveFileLookup", True).parquet(*store_days(spark, f"{base}/clean"))
    return tracks.select("mmsi", "timestamp", "cluster_assignment", "track_id", "dt_seconds")


def store_days(spark, base: str) -> list[str]:
    """The folders of the days under ``base``."""
    return sorted({f.rpartition("/")[0] for f in store.files(spark, base, ".parquet") if "/day=" in f})


def state_roundtrip(spark, sf_dir):
    """The two halves of a month cleaned one after the other, state and registry saved and loaded in between."""
    raw, folder = bouncing(spark, sf_dir, HALF_MONTHS), scratch(spark, "state")
    config = Config.cleaner(velocity_by_ship_type={})
    first = clean(raw.filter("file_seq = 0"), config, order=["event_id"])
    save_state(first.state(), first.registry, folder, "1")
    state, registry = load_state(spark, folder, "1")
    second = clean(raw.filter("file_seq = 1"), config, order=["event_id"], state=state, registry=registry)
    both = first.tracks.unionByName(second.tracks)
    return both.select("event_id", "file_seq", "mmsi", "timestamp", "cluster_assignment", "track_id", "dt_seconds")


def assignment_state(spark, sf_dir):
    """Where each vessel goes on, with the cluster of its last position."""
    return whole(spark, sf_dir).state().select("mmsi", "last_timestamp", "current_segment", "cluster_assignment")


def manifest_roundtrip(spark, sf_dir):
    """What is pending by a manifest that was saved and loaded."""
    days, folder = _day_names(spark, sf_dir), scratch(spark, "manifest")
    done = sorted(r["file"] for r in days.filter("user_id = 3").select("file").distinct().collect())
    Manifest(processed=done, version="1", last_file=done[-1] if done else "").save(spark, folder)
    files = sorted(r["file"] for r in days.select("file").distinct().collect())
    return spark.createDataFrame([(f,) for f in Manifest.load(spark, folder).pending(files)], "file string")


def catalog_roundtrip(spark, sf_dir):
    return spark.read.parquet(sinks.write_catalog(track_catalog(spark, sf_dir), scratch(spark, "catalog")))


def sorted_files(spark, sf_dir):
    """Rows of a written file, each with whether it comes after the row before it."""
    folder = scratch(spark, "sorted")
    sinks.write_parquet(_short(spark, sf_dir).select("event_id", "track_id", "timestamp").repartition(4), folder)
    rows = spark.read.parquet(folder).select("*", "_metadata.file_path", "_metadata.row_index")
    here = F.struct("track_id", "timestamp")
    before = F.lag(here).over(W.partitionBy("file_path").orderBy("row_index"))
    return rows.select("event_id", "track_id", F.coalesce(before <= here, F.lit(True)).alias("in_order"))


def file_listing(spark, sf_dir):
    """The days found by listing what the partitioned sink wrote."""
    folder = scratch(spark, "listing")
    sinks.write_tracks(_short(spark, sf_dir).select("event_id", "file_seq", "mmsi", "timestamp", "track_id"), folder)
    part = lambda c, n: F.regexp_extract("path", f"{c}=([0-9]{{{n}}})", 1).alias(c)
    return sinks.parquet_sizes(spark, folder).filter("size_mb > 0").select(part("year", 4), part("month", 2), part("day", 2)).distinct()


def size_audit(spark, sf_dir):
    """The audit of a listing in which an event's value stands for a file's size."""
    sizes = positions(spark, sf_dir).select(F.lpad(F.col("event_id").cast("string"), 12, "0").alias("path"), F.col("sog").alias("size_mb"))
    return sinks.audit_sizes(sizes).select(F.col("total_files").cast("long").alias("total_files"), rounded("avg_mb"), "min_mb", "max_mb", "out_of_range")


def parquet_roundtrip(spark, sf_dir):
    folder = scratch(spark, "tracks")
    tracks = _short(spark, sf_dir).select("event_id", "file_seq", "mmsi", "timestamp", "track_id")
    sinks.write_tracks(tracks, folder)
    return spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(folder).select("event_id", "mmsi", "timestamp", "track_id")


NAMES = """validate_positions validate_dedup_first validation_stats haversine_km haversine_nm velocity_consecutive
outliers_single outliers_by_ship_type outliers_iterative ship_type_limits segment_tracks filter_short_tracks dt_seconds final_segment
track_catalog catalog_stats distinct_tracks continuity_tracks starting_segments mmsi_state collision_candidates collision_labels
collision_bounce collision_centroids collision_registry collision_split pipeline_tracks pipeline_stats parse_timestamps
partition_keys pending_files union_by_name expected_files zip_roundtrip parquet_roundtrip run_tracks state_roundtrip
assignment_state manifest_roundtrip catalog_roundtrip sorted_files file_listing size_audit""".split()

QUERIES = {n: globals()[n] for n in NAMES}
