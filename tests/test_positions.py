"""Boundary cases of the vessel operators, each in a small hand-made table."""

import zipfile
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairlead.config import Config
from fairlead.functions import geo, ids
from fairlead.operators import catalog, collision, outliers, segment, validate
from fairlead.plans.pipeline import clean, last_file_rows
from fairlead.sources import downloads, positions, sinks

T0 = datetime(2024, 1, 1)
SCHEMA = "file_seq long, ord long, mmsi long, timestamp timestamp_ntz, lat double, lon double, sog double, ship_type string"


def table(spark, rows, file=0):
    """rows: (mmsi, seconds, lat, lon[, sog[, ship_type[, file]]])"""
    full = [(r[6] if len(r) > 6 else file, i, r[0], T0 + timedelta(seconds=r[1]) if r[1] is not None else None, r[2], r[3], r[4] if len(r) > 4 else 1.0, r[5] if len(r) > 5 else None) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def test_validation_bounds(spark):
    sogs = [None, 0.0, 102.3, 102.4, float("nan")]
    rows = [(1, i, 55.0, 10.0, s) for i, s in enumerate(sogs)] + [(2, 0, 54.0, 7.0), (2, 1, 58.5, 16.0), (2, 2, 53.99, 7.0), (2, 3, None, 7.0), (None, 4, 55.0, 10.0), (3, 0, 55.0, 10.0), (3, 0, 56.0, 11.0)]
    got = validate.validate_positions(table(spark, rows), Config().cleaning.bounds, order=["ord"])
    assert sorted(r["ord"] for r in got.collect()) == [0, 1, 2, 5, 6, 10]
    assert validate.validation_stats(table(spark, rows), got).first()[2] == 6
    free = validate.validate_positions(table(spark, [(1, 0, 90.0, 180.0), (1, 1, 90.1, 0.0)]).drop("sog"), None, order=["ord"])
    assert free.count() == 1
    empty = table(spark, [(1, 0, 55.0, 10.0)]).filter("false")
    assert validate.validation_stats(empty, empty).first()[3] == 0.0


def test_outliers(spark):
    track = [(1, 0, 55.0, 10.0), (1, 60, 57.0, 12.0), (1, 120, 55.001, 10.0)]
    keep = lambda rows, **k: sorted(r["ord"] for r in outliers.remove_outliers(table(spark, rows), 50.0, **k).collect())
    assert keep(track) == [0, 2]
    assert keep(track[:2]) == [0, 1]
    assert keep([(1, 0, 57.0, 12.0), (1, 60, 55.0, 10.0), (1, 120, 55.001, 10.0)]) == [0, 1, 2]
    assert keep([*track, (1, 180, 57.0, 12.0), (1, 240, 57.0, 12.0)]) == [0, 3, 4]  # both neighbours of an alternation are judged on the rows as given
    slow = [(1, 0, 55.0, 10.0, 1.0, "cargo"), (1, 3600, 55.5, 10.0, 1.0, "cargo"), (1, 7200, 55.0, 10.0, 1.0, "cargo")]
    assert keep(slow, by_type={"cargo": 25.0}) == [0, 2]
    assert keep(slow, by_type={"Cargo": 25.0}) == [0, 1, 2]
    assert keep(slow, by_type={"Cargo": 25.0}, casefold=True) == [0, 2]


def test_speed_of_nothing(spark):
    df = table(spark, [(1, 0, 55.0, 10.0), (1, 0, 55.0, 10.0), (1, 5, None, 10.0)])
    got = [r["velocity_knots"] for r in outliers.consecutive_velocity(df).orderBy("ord").collect()]
    assert got[1:] == [float("inf")] * 2 and got[0] == 0.0


def test_gaps(spark):
    hours = 4 * 3600
    numbers = lambda secs: [r["segment_num"] for r in segment.segment_tracks(table(spark, [(1, s, 55.0, 10.0) for s in secs]), 4.0).orderBy("timestamp").collect()]
    assert numbers([0, hours]) == [0, 0]
    assert numbers([0, hours + 0.5]) == [0, 0]
    assert numbers([0, hours + 1]) == [0, 1]


def run(spark, rows, **k):
    return clean(table(spark, rows), Config.cleaner(**({"bounds": None, "min_track_points": 1} | k)), order=["ord"])


def test_numbers_go_on_across_files(spark):
    hours = 4 * 3600
    ids_of = lambda rows, **k: [r["track_id"] for r in run(spark, rows, **k).tracks.orderBy("file_seq", "timestamp").collect()]
    p = (55.0, 10.0, 1.0, None)
    assert ids_of([(1, 0, *p, 0), (1, hours + 0.5, *p, 1)]) == ["1_0", "1_1"]
    assert ids_of([(1, 100, *p, 0), (1, 50, *p, 1)]) == ["1_0", "1_0"]
    assert ids_of([(1, i * 5 * 3600, *p, i // 11) for i in range(13)]) == [f"1_{i}" for i in range(13)]
    assert ids_of([(1, 0, *p, 0), (1, 60, *p, 0), (1, 90000, *p, 1), (1, 200000, *p, 2), (1, 200060, *p, 2)], min_track_points=2) == ["1_0", "1_0", "1_1", "1_1"]


def test_lexical_numbers(spark):
    five = 5 * 3600
    rows = [(1, i * five, 55.0, 10.0, 1.0, None, 0 if i < 11 else 1) for i in range(13)]
    got = [r["track_id"] for r in run(spark, rows, numbering="lexical").tracks.orderBy("timestamp").collect()]
    assert got == [f"1_{i}" for i in range(11)] + ["1_10", "1_11"]
    few = [r for r in rows if r[6] == 0][:5] + [(1, i * five, 55.0, 10.0, 1.0, None, 1) for i in range(5, 7)]
    both = [sorted(r["track_id"] for r in run(spark, few, numbering=n).tracks.collect()) for n in ("numeric", "lexical")]
    assert both[0] == both[1]


def test_two_runs_are_one(spark):
    rng = np.random.default_rng(5)
    rows = [(int(m), int(t), 55.0 + float(rng.random()) / 100, 10.0, 1.0, None, int(t) // 86400) for m in range(1, 6) for t in np.sort(rng.integers(0, 6 * 86400, 40))]
    whole = run(spark, rows, min_track_points=2)
    first = run(spark, [r for r in rows if r[6] < 3], min_track_points=2)
    second = clean(table(spark, [r for r in rows if r[6] >= 3]), Config.cleaner(bounds=None), order=["ord"], state=first.state(), registry=first.registry)
    key = lambda c: sorted((r["mmsi"], r["timestamp"], r["track_id"], r["dt_seconds"]) for r in c.tracks.collect())
    assert key(whole) == sorted(key(first) + key(second))
    state = lambda df: sorted(tuple(r) for r in df.select("mmsi", "last_timestamp", "current_segment").collect())
    assert state(whole.state()) == state(second.state(first.state()))


def brute_labels(lat, lon, eps):
    n = len(lat)
    label, out = list(range(n)), [-1] * n

    def km(i, j):
        p, q = np.radians(lat[i]), np.radians(lat[j])
        a = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(lon[j] - lon[i]) / 2) ** 2
        return 2 * 6371 * np.arcsin(np.sqrt(min(1.0, a)))

    for i in range(n):
        for j in range(i):
            if km(i, j) <= eps:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    seen = {}
    for i in range(n):
        if label.count(label[i]) > 1:
            out[i] = seen.setdefault(label[i], len(seen))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(54, 54.4), st.floats(10, 10.6)), max_size=25), st.sampled_from([2.0, 5.0, 9.0]))
def test_clusters(points, eps):
    lat, lon = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    assert collision.cluster_labels(lat, lon, eps).tolist() == brute_labels(lat, lon, eps)


def test_clusters_across_the_date_line_and_nulls():
    lat, lon = np.array([0.0, 0.0, np.nan, 50.0]), np.array([179.99, -179.99, 0.0, 0.0])
    assert collision.cluster_labels(lat, lon, 5.0).tolist() == [0, 0, -1, -1]


def bounce(n, places=2, mmsi=9, file=0, t=0):
    return [(mmsi, t + i * 600, 55.0 + 2.0 * (i % places), 10.0 + 2 * (i % places), 1.0, None, file) for i in range(n)]


def test_collisions(spark):
    found = lambda rows: collision.detect(table(spark, rows)).count()
    assert found(bounce(10)) == 1
    assert found(bounce(9)) == 0
    assert found(bounce(12, places=3)) == 0
    later = bounce(12) + [(9, 86400 + i * 600, 57.0, 12.0, 1.0, None, 1) for i in range(4)]
    done = run(spark, later, min_track_points=1)
    assert {r["file_seq"]: r["c"] for r in done.tracks.groupBy("file_seq").agg(F.max("cluster_assignment").alias("c")).collect()}[1] == "B"
    assert all(r["track_id"].startswith("9_B_") for r in done.tracks.filter("file_seq = 1").collect())
    each = run(spark, later, min_track_points=1, split="per_cluster")
    assert each.tracks.count() == len(later)
    assert {r["track_id"][:4] for r in each.tracks.collect()} == {"9_A_", "9_B_"}
    assert {r["metric"]: r["value"] for r in done.stats().collect()}["collisions_detected"] == 1


def test_nearest_cluster(spark):
    c = lambda *x: [F.lit(v).cast("double") for v in x]
    near = lambda lat, lon: geo.nearest_cluster(*c(lat, lon, 0.0, 0.0, 0.0, 2.0))
    assert list(spark.range(1).select(near(0.0, 1.0), near(None, 1.0), near(0.0, 1.5)).first()) == ["A", "A", "B"]


def test_segment_number(spark):
    df = spark.createDataFrame([("1_A_10",), ("x",), ("1_2",)], "t string")
    assert [r[0] for r in df.select(ids.segment_of(F.col("t"))).collect()] == [10, 0, 2]


def test_catalog(spark):
    tracks = run(spark, [(1, 0, 55.0, 10.0), (1, 5400, 55.0, 10.0)], min_track_points=2).tracks
    row = catalog.track_catalog(tracks, merged=True).first()
    assert (row["num_positions"], row["duration_hours"]) == (2, 1.5)
    assert catalog.catalog_stats(catalog.track_catalog(tracks)).first()["total_tracks"] == 1


def write_zip(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("_", "."), text)


def test_zip_source(spark, tmp_path):
    write_zip(tmp_path / "aisdk-2.zip", a_csv="# Timestamp,MMSI,Latitude,Longitude,SOG,extra\n01/02/2024 03:04:05,7,55.5,10.5,x,1\n2024-02-01 00:00:00,8,55,10,1,1\nbad\n", b_CSV="mmsi,timestamp,lat,lon,Ship type\n9,2024-02-01 00:00:00,56,11,Cargo,more,cells\n", c_txt="no")
    write_zip(tmp_path / "aisdk-1.zip", a_csv="nothing,here\n1,2\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "aisdk-3.zip").write_bytes(b"broken")
    (tmp_path / "other.zip").write_bytes(b"")
    paths = positions.list_raw_files(str(tmp_path))
    assert [p.rpartition("/")[2] for p in paths] == ["aisdk-1.zip", "aisdk-2.zip", "aisdk-3.zip"]
    assert positions.list_raw_files(str(tmp_path / "none")) == []
    rows = sorted((r["mmsi"], r["timestamp"], r["sog"], r["ship_type"], r["file_seq"]) for r in positions.read_zips(spark, paths).collect())
    assert rows == [(7, datetime(2024, 2, 1, 3, 4, 5), None, None, 1), (9, datetime(2024, 2, 1), None, "Cargo", 1)]


def test_headers():
    assert positions.map_columns(["# Timestamp", "MMSI", "lat", "Latitude", "Ship type", "x"]) == {"timestamp": "# Timestamp", "mmsi": "MMSI", "lat": "lat", "ship_type": "Ship type"}


def test_csv_source(spark, tmp_path):
    """Every file of a folder by its own header; what is read can be cleaned."""
    (tmp_path / "p.csv").write_text("Timestamp,MMSI,Latitude,Longitude\n2024-02-01 00:00:00,9,56,11\n")
    assert positions.read_csv(spark, str(tmp_path / "p.csv")).first()["lat"] == 56.0
    (tmp_path / "q.csv").write_text("lon,lat,SOG,mmsi,# Timestamp\n12,57,3.5,8,01/02/2024 00:00:05\n12,57,3.5,8,01/02/2024 00:01:05\n")
    rows = positions.read_csv(spark, str(tmp_path))
    assert sorted((r["file_seq"], r["mmsi"], r["lat"], r["lon"], r["sog"]) for r in rows.collect()) == [(0, 9, 56.0, 11.0, None), (1, 8, 57.0, 12.0, 3.5), (1, 8, 57.0, 12.0, 3.5)]
    assert clean(rows, Config(), order=["member", "line"]).tracks.count() == 2


def test_damaged_members(spark, tmp_path):
    """A flipped byte in one member: it gives no rows and is named; the other member and file are whole."""
    text = "timestamp,mmsi,lat,lon\n" + "\n".join(f"2024-01-01 00:00:{i % 60:02d},{i},55.{i},10" for i in range(4000))
    with zipfile.ZipFile(tmp_path / "aisdk-1.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("good.csv", text)
        z.writestr("bad.csv", text)
    write_zip(tmp_path / "aisdk-2.zip", a_csv=text)
    with zipfile.ZipFile(tmp_path / "aisdk-1.zip") as z:
        at = z.getinfo("bad.csv").header_offset
    data = bytearray((tmp_path / "aisdk-1.zip").read_bytes())
    data[at + 2000] ^= 0x55
    (tmp_path / "aisdk-1.zip").write_bytes(data)
    read = positions.read_text(spark, positions.list_raw_files(str(tmp_path)))
    assert [(r["file"][-11:], r["member"]) for r in positions.damaged(read).collect()] == [("aisdk-1.zip", 1)]
    assert {(r[0], r[1]): r[2] for r in positions.typed(read).groupBy("file_seq", "member").count().collect()} == {(0, 0): 4000, (1, 0): 4000}


def plain_rows(data, wanted):
    """Rows by the standard reader over the whole text."""
    import csv
    import io

    csv.field_size_limit(2**31 - 1)
    rows = [r for r in csv.reader(io.StringIO(data.decode("utf-8", "ignore").lstrip("\ufeff"), newline="")) if r]
    place = {n: rows[0].index(s) for n, s in positions.map_columns(rows[0]).items()} if rows else {}
    return [{n: (r[i] or None) if i < len(r) else None for n, i in place.items()} for r in rows[1:]] if place else []


@settings(max_examples=120, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from(["", "1", "x y", '"q"', '"a,b"', '"l\nm"', '5" pipe', "é", " "]), min_size=0, max_size=5).map(",".join), max_size=25),
    st.sampled_from(["\n", "\r\n"]),
    st.integers(1, 40),
    st.sampled_from(["mmsi,lat,other,lon", "x,y", "lat", '"mmsi","lat",z', "\ufeffmmsi,lat,lon"]),
)
def test_rows_of_any_csv(lines, end, step, header):
    """In blocks of any size, with ragged lines, quotes, empty lines and bytes that are no text: what the standard reader gives."""
    data = end.join([header, *lines]).encode().replace(b"x y", b"x\xff y")
    parts = [data[i : i + step] for i in range(0, len(data), step)]
    got = [dict(zip(b, r, strict=True)) for b in positions.parse_rows(parts) for r in zip(*(c.to_pylist() for c in b.values()), strict=True)]
    assert got == plain_rows(data, header)


def test_a_huge_field():
    data = b"mmsi,name,lat\n1," + b"n" * 300_000 + b",5\n2,b,6\n"
    got = [r for b in positions.parse_rows([data]) for r in zip(b["mmsi"].to_pylist(), b["lat"].to_pylist(), strict=True)]
    assert got == [("1", "5"), ("2", "6")]


def test_formats_of_many_members(spark, monkeypatch):
    """Beyond FEW members formats meet their rows by broadcast for large ones, by a shuffle for the rest."""
    rows = [(m, f"2024-01-{1 + i % 28:02d} 00:00:00" if m % 2 else f"{1 + i % 28:02d}/01/2024 00:00:00") for m in range(30) for i in range(60 if m == 3 else 2)] + [(5, "05/01/2024 00:00:00"), (31, "none"), (32, None)]
    df = spark.createDataFrame(rows, "member int, timestamp string")
    want = sorted(map(str, positions.parse_timestamps(df, ["member"]).collect()))
    monkeypatch.setattr(positions, "FEW", 4)
    assert sorted(map(str, positions.parse_timestamps(df, ["member"]).collect())) == want and len(want) == 60 + 28 * 2 + 1


def test_runs(spark, tmp_path):
    from fairlead.plans.runs import Manifest, process

    raw = tmp_path / "raw"
    raw.mkdir()
    for d in (1, 2, 3):
        lines = [f"2024-01-0{d} {h:02d}:00:00,{m},55.0,10.0,5" for h in range(24) for m in (1, 2)]
        write_zip(raw / f"aisdk-2024-01-0{d}.zip", a_csv="timestamp,mmsi,lat,lon,sog\n" + "\n".join(lines))
    (raw / "aisdk-2024-01-04.zip").write_bytes(b"broken")
    config = lambda name: Config({"storage": {"raw_dir": str(raw), "clean_dir": str(tmp_path / name), "state_dir": str(tmp_path / f"{name}-state")}})
    once = process(spark, config("once"))
    assert (once["files_processed"], once["total_records_output"], once["unique_tracks"]) == (3, 144, 2)
    process(spark, config("twice"), max_files=2)
    process(spark, config("twice"), resume=True)
    read = lambda name: sorted((r["mmsi"], r["timestamp"], r["track_id"]) for r in spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "run-*").parquet(*[str(p) for p in (tmp_path / name).glob("year=*")]).collect())
    assert read("once") == read("twice") and len(read("once")) == 144
    assert Manifest.load(spark, str(tmp_path / "once-state")).failed == [str(raw / "aisdk-2024-01-04.zip")]
    assert (tmp_path / "once" / "year=2024" / "month=01" / "day=02").exists()
    assert sinks.audit_sizes(sinks.parquet_sizes(spark, str(tmp_path / "once"))).first()["out_of_range"] > 0
    assert process(spark, Config({"storage": {"raw_dir": str(tmp_path / "none")}}))["error"]


def day_rows(spark, folder):
    return sorted((r["mmsi"], r["timestamp"], r["track_id"]) for r in spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "run-*").parquet(*[str(p) for p in folder.glob("year=*")]).collect())


@pytest.mark.parametrize(("dies", "resume"), [("write_catalog", True), ("save_state", True), ("files_of_others", False), ("tidy", False)])
def test_a_run_that_dies(spark, tmp_path, monkeypatch, dies, resume):
    """Whenever a run ends after its tracks are written, the next one leaves each row once."""
    from fairlead.plans import runs

    raw = tmp_path / "raw"
    raw.mkdir()
    for d in (1, 2):
        write_zip(raw / f"aisdk-2024-01-0{d}.zip", a_csv="timestamp,mmsi,lat,lon,sog\n" + "\n".join(f"2024-01-0{d} {h:02d}:00:00,{m},55.0,10.0,5" for h in range(24) for m in (1, 2)))
    config = Config({"storage": {"raw_dir": str(raw), "clean_dir": str(tmp_path / "clean"), "state_dir": str(tmp_path / "state")}})
    runs.process(spark, config, max_files=None if not resume else 1)

    def fail(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if dies == "tidy":
            calls, tidy = [], runs.Manifest.tidy
            m.setattr(runs.Manifest, "tidy", lambda *a: fail() if calls else (calls.append(1), tidy(*a)))
        else:
            m.setattr(*{"write_catalog": (sinks, "write_catalog"), "save_state": (runs, "save_state"), "files_of_others": (sinks, "files_of_others")}[dies], fail)
        with pytest.raises(KeyboardInterrupt):
            runs.process(spark, config, resume=resume)
    runs.process(spark, config, resume=resume)
    got = day_rows(spark, tmp_path / "clean")
    assert len(got) == len(set(got)) == 96
    assert not list((tmp_path / "clean").glob("_run*")) and not list((tmp_path / "state").glob("work-*"))
    left = runs.Manifest.load(spark, str(tmp_path / "state"))
    assert (left.started, left.replaced, len(left.processed)) == ("", [], 2)


def test_command_line(spark, tmp_path, capsys):
    from fairlead import cli

    settings_file = tmp_path / "c.yaml"
    settings_file.write_text(f"storage:\n  raw_dir: {tmp_path}/raw\n  clean_dir: {tmp_path}/clean\n  state_dir: {tmp_path}/state\n")
    assert cli.main(["stats", "-c", str(settings_file)]) == 1
    assert cli.main(["validate", "-c", str(settings_file)]) == 1
    (tmp_path / "raw").mkdir()
    write_zip(tmp_path / "raw" / "aisdk-1.zip", a_csv="timestamp,mmsi,lat,lon\n" + "\n".join(f"2024-01-01 0{h}:00:00,1,55,10" for h in range(5)))
    assert cli.main(["process", "-c", str(settings_file), "-o", str(tmp_path / "s.json")]) == 0
    assert cli.main(["stats", "-c", str(settings_file)]) == 0
    assert cli.main(["process", "-c", str(settings_file), "-r", "-n", "1"]) == 0
    assert cli.main(["validate", "-c", str(settings_file), "-r", str(tmp_path / "v.json")]) == 0
    import json

    report = json.loads((tmp_path / "v.json").read_text())
    assert report["total_files"] >= len(report["file_sizes_mb"]) > 0
    assert "total_tracks: 1" in capsys.readouterr().out and (tmp_path / "s.json").exists()


def test_settings(tmp_path, monkeypatch):
    assert Config.load(str(tmp_path / "none.yaml")).cleaning.track_gap_hours == 4.0
    (tmp_path / "c.yaml").write_text("cleaning:\n  track_gap_hours: 2\n  unknown: 1\n  collision: {dbscan_eps_km: 1.5}\nother: 3\nstorage: {raw_dir: s3://bucket/raw, clean_dir: ~/c, state_dir: $AIS_STATE/x}\n")
    made = Config.load(str(tmp_path / "c.yaml"))
    assert (made.cleaning.track_gap_hours, made.collision.dbscan_eps_km, made.collision.lookback_window) == (2, 1.5, 10)
    monkeypatch.setenv("AIS_STATE", "hdfs://host/state")
    monkeypatch.setenv("HOME", "/home/x")
    assert [made.path(n) for n in ("raw_dir", "clean_dir", "state_dir")] == ["s3://bucket/raw", "/home/x/c", "hdfs://host/state/x"]
    with pytest.raises(TypeError):
        Config.cleaner(gap=1)
    assert Config().cleaning.bounds is not Config().cleaning.bounds


def test_stream_of_files(spark, tmp_path):
    import os

    from fairlead.streaming.tracks import stream_tracks

    source, rows = tmp_path / "in", []
    for d in range(3):
        part = [(1, d * 86400 + h * 3600, 55.0, 10.0) for h in range(0, 24, 2)]
        rows += [(*r, 1.0, None, d) for r in part]
        table(spark, part).coalesce(1).drop("file_seq").write.mode("append").parquet(str(source))
        for p in source.glob("part-*.parquet"):
            if not (tmp_path / p.name).exists():
                (tmp_path / p.name).touch()
                os.utime(p, (1_700_000_000 + d * 100,) * 2)
    schema = table(spark, rows).drop("file_seq").schema
    stream_tracks(spark, str(source), schema, str(tmp_path / "out"), str(tmp_path / "state"), Config.cleaner(bounds=None), order=["ord"], checkpoint=str(tmp_path / "cp")).awaitTermination()
    got = sorted((r["timestamp"], r["track_id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted((r["timestamp"], r["track_id"]) for r in run(spark, rows, min_track_points=2).tracks.collect())


def test_a_batch_without_its_state(spark, tmp_path):
    from fairlead.streaming.tracks import BatchCleaner

    with pytest.raises(RuntimeError):
        BatchCleaner(str(tmp_path / "out"), str(tmp_path / "state"), Config(), ["ord"])(table(spark, [(1, 0, 55.0, 10.0)]), 3)


def test_store(spark, tmp_path):
    from fairlead.sources import store

    store.write_json(spark, {"a": "é"}, f"{tmp_path}/x/y.json")
    store.write_json(spark, {"a": [2]}, f"{tmp_path}/x/y.json")
    assert store.read_json(spark, f"file:{tmp_path}/x/y.json") == {"a": [2]} and store.read_json(spark, f"{tmp_path}/none.json") is None
    assert store.files(spark, f"{tmp_path}/x", ".json") == [f"{tmp_path}/x/y.json"] and store.files(spark, f"{tmp_path}/none") == []


def test_scratch_on_a_cluster():
    from types import SimpleNamespace

    from fairlead.sources.scratch import scratch

    with pytest.raises(RuntimeError):
        scratch(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn")), "x")


def test_labels_of_batches():
    """Groups within, across and larger than batches: each as on its own."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    sizes = [1, 2, 300, 5, 40, 1, 700, 3]
    rows = [(0, g, i, *((np.nan, 10.0) if rng.random() < 0.05 else (55 + rng.random() / 3, 10 + rng.random() / 2))) for g, n in enumerate(sizes) for i in range(n)]
    names = ["file_seq", "mmsi", "timestamp", "lat", "lon"]
    whole = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=names)
    want = [x for g in range(len(sizes)) for x in collision.cluster_labels(*(np.array([r[k] for r in rows if r[1] == g], dtype=float) for k in (3, 4)), 2.0).tolist()]
    for step in (1, 7, 250, 5000):
        got = [x for b in collision.label_batches((whole.slice(i, step) for i in range(0, len(rows), step)), 2.0) for x in b.column(5).to_pylist()]
        assert got == want


def test_expected_files(spark):
    names = lambda a, b: sorted(r["file"] for r in downloads.expected_files(spark, a, b).collect())
    assert names(date(2024, 2, 10), date(2024, 3, 2)) == ["2024/aisdk-2024-02.zip", "2024/aisdk-2024-03-01.zip", "2024/aisdk-2024-03-02.zip"]
    assert names(date(2024, 3, 2), date(2024, 3, 1)) == []


def test_downloads(spark, tmp_path):
    import threading
    from functools import partial
    from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

    (tmp_path / "srv" / "2024").mkdir(parents=True)
    (tmp_path / "srv" / "2024" / "aisdk-2024-03-01.zip").write_bytes(b"x" * 10)
    server = ThreadingHTTPServer(("127.0.0.1", 0), partial(SimpleHTTPRequestHandler, directory=str(tmp_path / "srv")))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/"
    span = (date(2024, 3, 1), date(2024, 3, 2))
    assert downloads.download_range(spark, url, tmp_path / "got", *span) == (1, 0)
    assert downloads.download_range(spark, url, tmp_path / "got", *span) == (0, 1)
    from fairlead import cli

    (tmp_path / "c.yaml").write_text(f"storage: {{raw_dir: {tmp_path}/cli}}\n")
    assert cli.main(["download", "-c", str(tmp_path / "c.yaml"), "--base-url", url, "--start", "2024-03-01", "--end", "2024-03-01"]) == 0
    assert (tmp_path / "cli" / "2024" / "aisdk-2024-03-01.zip").exists()
    server.shutdown()


def test_last_file_of_a_day(spark, tmp_path):
    df = run(spark, [(1, 0, 55.0, 10.0, 1.0, None, 0), (1, 60, 55.0, 10.0, 1.0, None, 1)]).tracks
    sinks.write_tracks(df, str(tmp_path / "t"), same_day="last_file")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1 == last_file_rows(df).count()


@pytest.mark.parametrize("mode", ["overwrite"])
def test_sorted_sink(spark, tmp_path, mode):
    df = run(spark, [(1, 60 - i, 55.0, 10.0) for i in range(5)]).tracks.coalesce(1)
    sinks.write_parquet(df, str(tmp_path / "p"), mode=mode)
    got = [r["timestamp"] for r in spark.read.parquet(str(tmp_path / "p")).collect()]
    assert got == sorted(got)
