"""DuckDB SQL for the queries over position views."""

from __future__ import annotations

from fairlead.plans.queries import BOX, NARROW, TYPES
from fairlead.plans.views import BOUNCE_LAT, BOUNCE_LON, HALF_MONTHS, LAT, LON, ONE_FILE

DAY = "CAST(strftime(ts, '%Y%m%d') AS BIGINT)"


def pos(file: str = ONE_FILE, bounce: bool = False, hourly: bool = False) -> str:
    ts = "CAST(date_trunc('hour', ts) AS TIMESTAMP)" if hourly else "ts"
    lat, lon = (BOUNCE_LAT, BOUNCE_LON) if bounce else (LAT, LON)
    return f"SELECT event_id, {file} AS file_seq, user_id AS mmsi, {ts} AS timestamp, {lat} AS lat, {lon} AS lon, value AS sog, event_type AS ship_type FROM events"


def valid(source: str, box: dict = BOX, sog: bool = True) -> str:
    speed = " AND (sog IS NULL OR sog BETWEEN 0 AND 102.3e0)" if sog else ""
    return (
        f"SELECT * FROM ({source}) WHERE lat BETWEEN {box['lat_min']}e0 AND {box['lat_max']}e0 AND lon BETWEEN {box['lon_min']}e0 AND {box['lon_max']}e0{speed} "
        "QUALIFY row_number() OVER (PARTITION BY file_seq, mmsi, timestamp ORDER BY event_id) = 1"
    )


def km(a: str, b: str) -> str:
    """Between rows' columns with prefixes ``a`` and ``b``."""
    half = lambda c: f"((radians({b}{c}) - radians({a}{c})) / 2)"
    h = f"sin({half('lat')}) * sin({half('lat')}) + cos(radians({a}lat)) * cos(radians({b}lat)) * sin({half('lon')}) * sin({half('lon')})"
    return f"(12742e0 * asin(sqrt(least(1e0, {h}))))"


def hours(a: str, b: str) -> str:
    return f"((epoch_us({b}timestamp) - epoch_us({a}timestamp)) / 1e6 / 3600)"


def knots(a: str, b: str) -> str:
    return f"(CASE WHEN {a}timestamp IS NULL OR {b}timestamp IS NULL THEN NULL WHEN {hours(a, b)} <= 0 THEN CAST('inf' AS DOUBLE) ELSE {km(a, b)} / 1.852e0 / {hours(a, b)} END)"


def near(source: str) -> str:
    """With the columns of the rows before (p_) and after (n_)."""
    cols = ", ".join(f"lag({c}) OVER w AS p_{c}, lead({c}) OVER w AS n_{c}" for c in ("lat", "lon", "timestamp"))
    return f"SELECT *, {cols} FROM ({source}) WINDOW w AS (PARTITION BY file_seq, mmsi ORDER BY timestamp)"


def limit_of(types: dict | None, limit: float) -> str:
    if not types:
        return f"{limit}e0"
    cases = " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in types.items())
    return f"(CASE first(ship_type) OVER (PARTITION BY file_seq, mmsi ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) {cases} ELSE {limit}e0 END)"


def no_outliers(source: str, limit: float, types: dict | None = None, keep: str = "event_id, file_seq, mmsi, timestamp, lat, lon, sog, ship_type") -> str:
    rows = f"SELECT *, {limit_of(types, limit)} AS top FROM ({near(source)})"
    glitch = f"p_timestamp IS NOT NULL AND n_timestamp IS NOT NULL AND {knots('p_', '')} > top AND {knots('', 'n_')} > top AND {knots('p_', 'n_')} <= top"
    return f"SELECT {keep} FROM ({rows}) WHERE NOT coalesce({glitch}, FALSE)"


def offsets(source: str, gap: float) -> str:
    flag = f"coalesce(date_sub('second', lag(timestamp) OVER w, timestamp) > {gap * 3600}e0, FALSE)"
    return f"SELECT *, CAST(sum(CAST(g AS BIGINT)) OVER (PARTITION BY file_seq, mmsi ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS off FROM (SELECT *, {flag} AS g FROM ({source}) WINDOW w AS (PARTITION BY file_seq, mmsi ORDER BY timestamp))"


def named(source: str) -> str:
    return f"SELECT *, CAST(mmsi AS VARCHAR) || '_' || CAST(off AS VARCHAR) AS track_id FROM ({source})"


def longer(source: str, least: int) -> str:
    return f"SELECT * FROM ({source}) QUALIFY count(*) OVER (PARTITION BY file_seq, mmsi, off) >= {least}"


def dt(keys: str) -> str:
    return f"CAST(coalesce(date_sub('second', lag(timestamp) OVER (PARTITION BY {keys} ORDER BY timestamp), timestamp), 0) AS FLOAT)"


def summary(offs: str, least: int, gap: float) -> str:
    """Starting numbers of each file and vessel, by running sums."""
    groups = f"SELECT file_seq, mmsi, min(timestamp) AS first_ts, max(timestamp) FILTER (WHERE n >= {least}) AS last_ts, max(off) FILTER (WHERE n >= {least}) AS last_offset FROM (SELECT *, count(*) OVER (PARTITION BY file_seq, mmsi, off) AS n FROM ({offs})) GROUP BY file_seq, mmsi HAVING max(timestamp) FILTER (WHERE n >= {least}) IS NOT NULL"
    carried = f"SELECT *, CAST(coalesce((epoch_us(first_ts) - epoch_us(lag(last_ts) OVER (PARTITION BY mmsi ORDER BY file_seq))) / 1e6 > {gap * 3600}e0, FALSE) AS BIGINT) AS carry FROM ({groups})"
    return f"SELECT *, CAST(sum(carry + last_offset) OVER (PARTITION BY mmsi ORDER BY file_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - last_offset AS BIGINT) AS start FROM ({carried})"


SHORT = longer(named(offsets(valid(pos(DAY)), 4)), 2)
CATALOG = f"SELECT file_seq, track_id, min(mmsi) AS mmsi, min(timestamp) AS start_time, max(timestamp) AS end_time, count(*) AS num_positions, date_sub('second', min(timestamp), max(timestamp)) / 3600e0 AS duration_hours FROM ({SHORT}) GROUP BY file_seq, track_id"
ONE_BOUNCE = pos(bounce=True)
HALF_BOUNCE = pos(HALF_MONTHS, bounce=True)


def jumps(source: str) -> str:
    jump = f"coalesce({km('p_', '')} > 50 AND {hours('p_', '')} > 0 AND {hours('p_', '')} < 0.5e0 * {km('p_', '')} / (50e0 * 1.852e0), FALSE)"
    return f"SELECT file_seq, mmsi, count(*) AS n_rows, CAST(sum(CAST({jump} AS BIGINT)) AS BIGINT) AS n_jumps FROM ({near(source)}) GROUP BY file_seq, mmsi HAVING n_rows >= 10 AND n_jumps >= 2"


def labelled(source: str) -> str:
    """Components over the pairs within 5 km, by recursion; the CTEs end in ``labels``."""
    return f"""RECURSIVE cand AS MATERIALIZED ({jumps(source)}),
p AS MATERIALIZED (SELECT s.file_seq, s.mmsi, s.timestamp, s.lat, s.lon, row_number() OVER (PARTITION BY s.file_seq, s.mmsi ORDER BY s.timestamp) AS i FROM ({source}) s JOIN cand USING (file_seq, mmsi)),
e AS MATERIALIZED (SELECT a.file_seq, a.mmsi, a.i AS x, b.i AS y FROM p a JOIN p b ON a.file_seq = b.file_seq AND a.mmsi = b.mmsi AND a.i <> b.i AND {km('a.', 'b.')} <= 5),
reach AS (SELECT file_seq, mmsi, x, x AS y FROM e UNION SELECT r.file_seq, r.mmsi, r.x, e.y FROM reach r JOIN e ON r.file_seq = e.file_seq AND r.mmsi = e.mmsi AND r.y = e.x),
comp AS (SELECT file_seq, mmsi, x AS i, min(y) AS c FROM reach GROUP BY file_seq, mmsi, x),
num AS (SELECT *, dense_rank() OVER (PARTITION BY file_seq, mmsi ORDER BY c) - 1 AS label FROM comp),
labels AS (SELECT p.*, coalesce(num.label, -1) AS label FROM p LEFT JOIN num USING (file_seq, mmsi, i)),
bounce AS (SELECT file_seq, mmsi, count(*) AS n_points, count(DISTINCT label) AS n_clusters, CAST(sum(CAST(turn AS BIGINT)) AS BIGINT) AS bounces,
  count(*) >= 6 AND count(DISTINCT label) = 2 AND sum(CAST(turn AS BIGINT)) >= 3 AS is_bounce
  FROM (SELECT *, coalesce(label <> lag(label) OVER (PARTITION BY file_seq, mmsi ORDER BY timestamp), FALSE) AS turn FROM labels WHERE label >= 0) GROUP BY file_seq, mmsi)"""


def registry(source: str) -> str:
    """All of ``labelled``, then detections and the first of each identifier as ``reg``."""
    mean = lambda c, k: f"avg({c}) FILTER (WHERE label = {k})"
    return f"""{labelled(source)},
det AS (SELECT l.file_seq, l.mmsi, {mean('lat', 0)} AS a_lat, {mean('lon', 0)} AS a_lon, {mean('lat', 1)} AS b_lat, {mean('lon', 1)} AS b_lon, min(l.timestamp) AS detected_at, any_value(b.bounces) AS bounces
  FROM labels l JOIN bounce b ON l.file_seq = b.file_seq AND l.mmsi = b.mmsi WHERE b.is_bounce GROUP BY l.file_seq, l.mmsi),
reg AS (SELECT * FROM det QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY file_seq) = 1)"""


def split(source: str) -> str:
    to_a, to_b = km("s.", "r.a_"), km("s.", "r.b_")
    return f"SELECT s.*, CASE WHEN r.mmsi IS NULL THEN NULL WHEN {to_b} < {to_a} THEN 'B' ELSE 'A' END AS cluster_assignment FROM ({source}) s LEFT JOIN reg r ON s.mmsi = r.mmsi AND s.file_seq >= r.file_seq"


VALID_BOUNCE = valid(HALF_BOUNCE, sog=False)
_KEEP = "event_id, file_seq, mmsi, timestamp, lat, lon, cluster_assignment"


def cleaned(source: str, gap: float) -> str:
    """The whole pass over valid positions; the CTEs end in ``starts`` and ``tracks``."""
    return f"""{registry(source)},
kept AS MATERIALIZED ({no_outliers(split(source), 50.0, keep=_KEEP)}),
offs AS MATERIALIZED (SELECT *, first(cluster_assignment) OVER (PARTITION BY file_seq, mmsi ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS letter FROM ({offsets('SELECT * FROM kept', gap)})),
starts AS ({summary('SELECT * FROM offs', 2, gap)}),
tracks AS (SELECT o.event_id, o.file_seq, o.mmsi, o.timestamp, o.lat, o.lon, o.cluster_assignment, off + start AS num, concat_ws('_', CAST(o.mmsi AS VARCHAR), letter, CAST(off + start AS VARCHAR)) AS track_id, {dt('o.file_seq, o.mmsi, off')} AS dt_seconds FROM ({longer('SELECT * FROM offs', 2)}) o JOIN starts s USING (file_seq, mmsi))"""


PIPELINE = cleaned(VALID_BOUNCE, 4)
TRACK_ROWS = "event_id, file_seq, mmsi, timestamp, cluster_assignment, track_id, dt_seconds"
DAYS = cleaned(valid(pos(DAY)), 12)
_STATE = "max(timestamp) AS last_timestamp, arg_max(num, (file_seq, timestamp)) AS current_segment"
# Zips hold times to the second; rows of one second stand in the order of their events.
ZIPPED = cleaned(valid(f"SELECT * REPLACE (CAST(date_trunc('second', timestamp) AS TIMESTAMP) AS timestamp) FROM ({pos(DAY, bounce=True)})", sog=False), 4)

_SHOWN = "(user_id + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) % 4"
_FORMATS = ["%d/%m/%Y %H:%M:%S", "%Y-%m-%d %H:%M:%S", "%d-%m-%Y %H:%M:%S", "%Y/%m/%d %H:%M:%S"]
_TEXT = f"SELECT event_id, user_id AS member, CASE {_SHOWN} " + " ".join(f"WHEN {i} THEN strftime(ts, '{f}')" for i, f in enumerate(_FORMATS)) + " END AS t FROM events"
_TRIED = "SELECT *, " + ", ".join(f"try_strptime(t, '{f}') AS t{i}" for i, f in enumerate(_FORMATS)) + f" FROM ({_TEXT})"
_FIRST = "CASE " + " ".join(f"WHEN count(t{i}) OVER (PARTITION BY member) > 0 THEN t{i}" for i in range(4)) + " END"
_CLOCK = "strftime(ts, '%Y') || '/aisdk-' || strftime(ts, '%Y-%m-%d') || '.zip'"

ORACLE = {
    "validate_positions": f"SELECT event_id, mmsi, timestamp, round(lat, 6) AS lat, round(lon, 6) AS lon, sog FROM ({valid(pos(), NARROW)})",
    "validate_dedup_first": f"SELECT event_id, mmsi, timestamp FROM ({valid(pos(hourly=True))})",
    "validation_stats": f"SELECT o AS original_count, v AS validated_count, o - v AS removed_count, round((o - v) * 100e0 / o, 6) AS removal_percentage FROM (SELECT (SELECT count(*) FROM events) AS o, (SELECT count(*) FROM ({valid(pos(hourly=True))})) AS v)",
    "haversine_km": f"SELECT event_id, round({km('p_', '')}, 6) AS km FROM ({near(valid(pos()))})",
    "haversine_nm": f"SELECT event_id, round({km('p_', '')} / 1.852e0, 6) AS nm FROM ({near(valid(pos()))})",
    "velocity_consecutive": f"SELECT event_id, round(coalesce({knots('p_', '')}, 0), 6) AS velocity_knots FROM ({near(valid(pos()))})",
    "outliers_single": f"SELECT event_id, mmsi, timestamp FROM ({no_outliers(valid(pos()), 50.0)})",
    "outliers_by_ship_type": f"SELECT event_id, mmsi, timestamp FROM ({no_outliers(valid(pos()), 50.0, TYPES)})",
    "outliers_iterative": f"SELECT event_id, mmsi, timestamp FROM ({no_outliers(no_outliers(no_outliers(valid(pos()), 40.0), 40.0), 40.0)})",
    "ship_type_limits": f"SELECT DISTINCT mmsi, {limit_of(TYPES, 50.0)} AS limit_knots FROM ({valid(pos())})",
    "segment_tracks": f"SELECT event_id, mmsi, off AS segment_num, track_id FROM ({named(offsets(valid(pos()), 12))})",
    "filter_short_tracks": f"SELECT event_id, file_seq, track_id FROM ({longer(named(offsets(valid(pos(DAY)), 4)), 3)})",
    "dt_seconds": f"SELECT event_id, file_seq, track_id, {dt('file_seq, track_id')} AS dt_seconds FROM ({SHORT})",
    "final_segment": f"SELECT file_seq, mmsi, arg_max(off, timestamp) AS final_segment FROM ({SHORT}) GROUP BY file_seq, mmsi",
    "track_catalog": f"SELECT * REPLACE (round(duration_hours, 6) AS duration_hours) FROM ({CATALOG})",
    "catalog_stats": f"SELECT count(*) AS total_tracks, count(DISTINCT mmsi) AS unique_mmsis, round(avg(num_positions), 6) AS avg_positions_per_track, round(avg(duration_hours), 6) AS avg_duration_hours, min(num_positions) AS min_positions, max(num_positions) AS max_positions FROM ({CATALOG})",
    "distinct_tracks": f"SELECT DISTINCT track_id FROM ({SHORT})",
    "continuity_tracks": f"WITH {DAYS} SELECT event_id, track_id, dt_seconds FROM tracks",
    "starting_segments": f"WITH {DAYS} SELECT file_seq, mmsi, first_ts, last_ts, last_offset, carry, start FROM starts",
    "mmsi_state": f"WITH {DAYS} SELECT mmsi, round(arg_max(lat, timestamp), 6) AS last_lat, round(arg_max(lon, timestamp), 6) AS last_lon, {_STATE} FROM tracks GROUP BY mmsi",
    "assignment_state": f"WITH {PIPELINE} SELECT mmsi, {_STATE}, arg_max(struct_pack(c := cluster_assignment), (file_seq, timestamp)).c AS cluster_assignment FROM tracks GROUP BY mmsi",
    "collision_candidates": f"SELECT mmsi, n_rows, n_jumps FROM ({jumps(ONE_BOUNCE)})",
    "collision_labels": f"WITH {labelled(ONE_BOUNCE)} SELECT mmsi, timestamp, label FROM labels",
    "collision_bounce": f"WITH {labelled(ONE_BOUNCE)} SELECT mmsi, n_points, n_clusters, bounces, is_bounce FROM bounce",
    "collision_centroids": f"WITH {labelled(ONE_BOUNCE)} SELECT mmsi, label, round(avg(lat) + 1e-9, 6) AS lat, round(avg(lon) + 1e-9, 6) AS lon FROM labels WHERE label >= 0 GROUP BY file_seq, mmsi, label",
    "collision_registry": f"WITH {registry(HALF_BOUNCE)} SELECT mmsi, file_seq, round(a_lat + 1e-9, 6) AS a_lat, round(a_lon + 1e-9, 6) AS a_lon, round(b_lat + 1e-9, 6) AS b_lat, round(b_lon + 1e-9, 6) AS b_lon, bounces, detected_at FROM reg",
    "collision_split": f"WITH {registry(HALF_BOUNCE)} SELECT event_id, mmsi, cluster_assignment FROM ({split(HALF_BOUNCE)})",
    "pipeline_tracks": f"WITH {PIPELINE} SELECT {TRACK_ROWS} FROM tracks",
    "state_roundtrip": f"WITH {PIPELINE} SELECT {TRACK_ROWS} FROM tracks",
    "run_tracks": f"WITH {ZIPPED} SELECT mmsi, timestamp, cluster_assignment, track_id, dt_seconds FROM tracks",
    "pipeline_stats": f"""WITH {PIPELINE} SELECT 'total_records_input' AS metric, count(*) AS value FROM events
UNION ALL SELECT 'records_validated', count(*) FROM ({VALID_BOUNCE}) UNION ALL SELECT 'unique_mmsis', count(DISTINCT mmsi) FROM ({VALID_BOUNCE})
UNION ALL SELECT 'collisions_detected', count(*) FROM reg UNION ALL SELECT 'records_after_outliers', count(*) FROM kept
UNION ALL SELECT 'total_records_output', count(*) FROM tracks UNION ALL SELECT 'unique_tracks', count(DISTINCT track_id) FROM tracks""",
    "parse_timestamps": f"SELECT event_id, member, timestamp FROM (SELECT event_id, member, {_FIRST} AS timestamp FROM ({_TRIED})) WHERE timestamp IS NOT NULL",
    "partition_keys": "SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events",
    "pending_files": f"SELECT DISTINCT {_CLOCK} AS file FROM events WHERE {_CLOCK} NOT IN (SELECT {_CLOCK} FROM events WHERE user_id = 3) ORDER BY 1 LIMIT 5",
    "union_by_name": "SELECT event_id, user_id AS mmsi, CASE WHEN event_id % 2 = 0 THEN value END AS sog, CASE WHEN event_id % 2 = 1 THEN event_type END AS ship_type FROM events",
    "expected_files": "SELECT DISTINCT CASE WHEN d >= DATE '2024-03-01' THEN strftime(d, '%Y') || '/aisdk-' || strftime(d, '%Y-%m-%d') || '.zip' ELSE strftime(d, '%Y') || '/aisdk-' || strftime(d, '%Y-%m') || '.zip' END AS file FROM (SELECT unnest(generate_series(DATE '2023-11-15', DATE '2024-03-20', INTERVAL 1 DAY)) AS d)",
    "zip_roundtrip": f"SELECT dense_rank() OVER (ORDER BY CAST(timestamp AS DATE)) - 1 AS file_seq, row_number() OVER (PARTITION BY CAST(timestamp AS DATE) ORDER BY event_id) - 1 AS line, mmsi, date_trunc('second', timestamp) AS timestamp, round(lat, 6) AS lat, round(lon, 6) AS lon, sog, ship_type FROM ({pos()})",
    "parquet_roundtrip": f"SELECT event_id, mmsi, timestamp, track_id FROM ({SHORT})",
    "manifest_roundtrip": f"SELECT DISTINCT {_CLOCK} AS file FROM events WHERE {_CLOCK} NOT IN (SELECT {_CLOCK} FROM events WHERE user_id = 3)",
    "catalog_roundtrip": f"SELECT * REPLACE (round(duration_hours, 6) AS duration_hours) FROM ({CATALOG})",
    "sorted_files": f"SELECT event_id, track_id, TRUE AS in_order FROM ({SHORT})",
    "file_listing": f"SELECT DISTINCT strftime(timestamp, '%Y') AS year, strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day FROM ({SHORT})",
    "size_audit": "SELECT (SELECT count(*) FROM events) AS total_files, round(avg(value), 6) AS avg_mb, min(value) AS min_mb, max(value) AS max_mb, count(*) FILTER (WHERE value < 10 OR value > 1000) AS out_of_range FROM (SELECT value FROM events ORDER BY lpad(CAST(event_id AS VARCHAR), 12, '0') LIMIT 10)",
}
