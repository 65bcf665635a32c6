"""Identifiers that two vessels share: detection, clusters, bounce pattern, centroids, split, registry."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.functions.geo import EARTH_KM, KM_PER_NM, haversine_km, nearest_cluster, seconds_between
from fairlead.sources.scratch import keep

GROUP = ("file_seq", "mmsi")
LEAST_ROWS = 4
#: Identifiers in a registry that is broadcast (about 60 bytes each).
FEW = 100_000


def _jumps(df: DataFrame, distance_km: float, max_speed: float) -> DataFrame:
    """Adds _jump: the step to the row is longer than ``distance_km`` and at least twice too fast."""
    w = W.partitionBy(*GROUP).orderBy("timestamp")
    km = haversine_km(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))
    hours = seconds_between(F.lag("timestamp").over(w), F.col("timestamp")) / 3600
    steps = df.withColumns({"_km": km, "_hours": hours})
    jump = (F.col("_km") > distance_km) & (F.col("_hours") > 0) & (F.col("_hours") < 0.5 * F.col("_km") / (max_speed * KM_PER_NM))
    return steps.withColumn("_jump", F.coalesce(jump, F.lit(False)).cast("long")).drop("_km", "_hours")


def candidates(df: DataFrame, *, distance_km: float = 50.0, max_speed: float = 50.0, min_rows: int = 10) -> DataFrame:
    """(file_seq, mmsi, n_rows, n_jumps) of groups that are large enough and have two jumps or more."""
    found = _jumps(df, distance_km, max_speed).groupBy(*GROUP).agg(F.count("*").alias("n_rows"), F.sum("_jump").alias("n_jumps"))
    return found.filter((F.col("n_rows") >= max(LEAST_ROWS, min_rows)) & (F.col("n_jumps") >= 2))


def candidate_rows(df: DataFrame, *, distance_km: float = 50.0, max_speed: float = 50.0, min_rows: int = 10) -> DataFrame:
    """The rows of those groups, by windows in place of a join with them."""
    whole = W.partitionBy(*GROUP)
    counted = _jumps(df, distance_km, max_speed).withColumns({"_rows": F.count("*").over(whole), "_jumps": F.sum("_jump").over(whole)})
    return counted.filter((F.col("_rows") >= max(LEAST_ROWS, min_rows)) & (F.col("_jumps") >= 2)).drop("_jump", "_rows", "_jumps")


def cluster_labels(lat: np.ndarray, lon: np.ndarray, eps_km: float) -> np.ndarray:
    """Labels of the components of the graph that joins positions within ``eps_km``; -1 for positions alone or null. Numbered by first row.

    Positions are points on a sphere in space, put into cubes so small that all in one are within reach; only cubes near each other are compared, in blocks, and not if they are already joined.
    """
    labels = np.full(len(lat), -1, dtype=np.int64)
    ok = np.flatnonzero(~(np.isnan(lat) | np.isnan(lon)))
    if len(ok) < 2:
        return labels
    p, q = np.radians(lat[ok]), np.radians(lon[ok])
    xyz = EARTH_KM * np.stack([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)], axis=1)
    reach = 2 * EARTH_KM * np.sin(min(eps_km / (2 * EARTH_KM), np.pi / 2))
    if reach <= 0:
        cubes, cube = np.unique(xyz, axis=0, return_inverse=True)
        near = []
    else:
        cubes, cube = np.unique(np.floor(xyz / (reach / np.sqrt(3) * 0.999999)).astype(np.int64), axis=0, return_inverse=True)
        at = {tuple(c): i for i, c in enumerate(cubes.tolist())}
        half = [(a, b, c) for a in range(-2, 3) for b in range(-2, 3) for c in range(-2, 3) if (a, b, c) > (0, 0, 0)]
        near = ((i, at[n]) for i, (x, y, z) in enumerate(cubes.tolist()) for a, b, c in half if (n := (x + a, y + b, z + c)) in at)
    order = np.argsort(cube, kind="stable")
    ends = np.searchsorted(cube[order], np.arange(len(cubes) + 1))
    parent = list(range(len(cubes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in near:
        if (a := find(i)) == (b := find(j)):
            continue
        mine, theirs = xyz[order[ends[i] : ends[i + 1]]], xyz[order[ends[j] : ends[j + 1]]]
        for k in range(0, len(mine), 512):
            if any((((mine[k : k + 512, None] - theirs[None, m : m + 512]) ** 2).sum(axis=2) <= reach * reach).any() for m in range(0, len(theirs), 512)):
                parent[max(a, b)] = min(a, b)
                break
    root = np.array([find(i) for i in range(len(cubes))])[cube]
    size = np.bincount(root, minlength=len(cubes))
    number: dict[int, int] = {}
    for i, r in zip(ok.tolist(), root.tolist(), strict=True):
        if size[r] >= 2:
            labels[i] = number.setdefault(r, len(number))
    return labels


def small_labels(lat: np.ndarray, lon: np.ndarray, starts: np.ndarray, eps_km: float) -> np.ndarray:
    """As ``cluster_labels``, for many small groups at once, which begin at ``starts``: all pairs within groups are compared by whole arrays."""
    n = len(lat)
    size = np.diff(np.append(starts, n))
    first = np.repeat(starts, size)
    # Row i meets the rows before it in its group.
    before = np.arange(n) - first
    a = np.repeat(np.arange(n), before)
    b = np.arange(len(a)) - np.repeat(np.cumsum(before) - before, before) + first[a]
    p, q = np.radians(lat), np.radians(lon)
    xyz = EARTH_KM * np.stack([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)], axis=1)
    reach = 2 * EARTH_KM * np.sin(min(eps_km / (2 * EARTH_KM), np.pi / 2))
    near = ((xyz[a] - xyz[b]) ** 2).sum(axis=1) <= max(reach, 0.0) ** 2
    a, b = a[near], b[near]
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(jumped := root[root], root):
            root = jumped
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    joined = np.bincount(root, minlength=n) >= 2
    number = np.cumsum(joined & (root == np.arange(n)))
    earlier = np.concatenate([[0], number])[first]
    return np.where(joined[root], number[root] - 1 - earlier, -1)


#: Rows of a group that is compared pair by pair with others in one call, and pairs of such a call.
_SMALL, _PAIRS = 256, 1 << 21


def label_batches(batches: Iterator[pa.RecordBatch], eps_km: float) -> Iterator[pa.RecordBatch]:
    """Adds ``label`` to batches of (file_seq, mmsi, timestamp, lat, lon), sorted so that a group's rows are together."""

    def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [rows.column(c).to_numpy() for c in GROUP]
        starts = np.flatnonzero(np.concatenate([[True], (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])]))
        ends = np.append(starts[1:], rows.num_rows)
        lat, lon = (rows.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("lat", "lon"))
        labels = np.full(rows.num_rows, -1, dtype=np.int64)
        at = 0
        while at < len(starts):
            to, pairs = at, 0
            while to < len(starts) and ends[to] - starts[to] <= _SMALL and pairs <= _PAIRS:
                pairs += int(ends[to] - starts[to]) ** 2 // 2
                to += 1
            if to == at:
                labels[starts[at] : ends[at]] = cluster_labels(lat[starts[at] : ends[at]], lon[starts[at] : ends[at]], eps_km)
                to = at + 1
            else:
                s, e = starts[at], ends[to - 1]
                labels[s:e] = small_labels(lat[s:e], lon[s:e], starts[at:to] - s, eps_km)
            at = to
        yield from rows.append_column("label", pa.array(labels)).to_batches(10_000)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # The last group of a batch may go on in the next one.
        keys = [batch.column(i).to_numpy() for i in range(2)]
        other = np.flatnonzero((keys[0] != keys[0][-1]) | (keys[1] != keys[1][-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        goes_on = held and held[-1].column(0)[-1] == batch.column(0)[0] and held[-1].column(1)[-1] == batch.column(1)[0]
        if cut or not goes_on:
            whole = [*held, batch.slice(0, cut)]
            if sum(x.num_rows for x in whole):
                yield from flush(pa.Table.from_batches(whole).combine_chunks())
            held = []
        held.append(batch.slice(cut))
    if held:
        yield from flush(pa.Table.from_batches(held).combine_chunks())


def label_groups(rows: DataFrame, *, eps_km: float = 5.0) -> DataFrame:
    """(file_seq, mmsi, timestamp, lat, lon, label) of ``candidate_rows``: only groups that jump come here. The window keeps groups together where they already are, so candidates are neither dealt nor sorted anew; Python gets many groups a call."""
    whole = W.partitionBy(*GROUP)
    ordered = rows.select(*GROUP, "timestamp", "lat", "lon").withColumn("_n", F.count("*").over(whole)).filter("_n > 0").sortWithinPartitions(*GROUP, "timestamp").drop("_n")
    schema = "file_seq long, mmsi long, timestamp timestamp_ntz, lat double, lon double, label long"
    return ordered.mapInArrow(lambda batches: label_batches(batches, eps_km), schema)


def bounce_patterns(labels: DataFrame, *, min_bounces: int = 3) -> DataFrame:
    """Over labelled rows that are in a cluster: file_seq, mmsi, n_points, n_clusters, bounces, is_bounce; the means of the first two clusters (A is the one seen first) and the group's first time."""
    w = W.partitionBy(*GROUP).orderBy("timestamp")
    timed = labels.withColumn("_first", F.min("timestamp").over(W.partitionBy(*GROUP)))
    clustered = timed.filter(F.col("label") >= 0).withColumn("_turn", F.coalesce(F.col("label") != F.lag("label").over(w), F.lit(False)).cast("long"))
    mean = lambda c, k: F.avg(F.when(F.col("label") == k, F.col(c)))
    found = clustered.groupBy(*GROUP).agg(
        F.count("*").alias("n_points"),
        F.count_distinct("label").alias("n_clusters"),
        F.sum("_turn").alias("bounces"),
        *[mean(c, k).alias(f"{p}_{c}") for p, k in (("a", 0), ("b", 1)) for c in ("lat", "lon")],
        F.min("_first").alias("detected_at"),
    )
    return found.withColumn("is_bounce", (F.col("n_points") >= 2 * min_bounces) & (F.col("n_clusters") == 2) & (F.col("bounces") >= min_bounces))


def centroids(labels: DataFrame) -> DataFrame:
    """(file_seq, mmsi, label, lat, lon): arithmetic means of each cluster."""
    return labels.filter(F.col("label") >= 0).groupBy(*GROUP, "label").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def detect(df: DataFrame, *, distance_km: float = 50.0, eps_km: float = 5.0, min_bounces: int = 3, min_rows: int = 10, max_speed: float = 50.0) -> DataFrame:
    """A row per file and identifier that bounces between exactly two clusters: centroids (A is the cluster seen first), bounces and the group's first time."""
    rows = candidate_rows(df, distance_km=distance_km, max_speed=max_speed, min_rows=min_rows)
    found = bounce_patterns(label_groups(rows, eps_km=eps_km), min_bounces=min_bounces)
    return found.filter("is_bounce").select(*GROUP, "bounces", "a_lat", "a_lon", "b_lat", "b_lon", "detected_at")


def first_detections(detections: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The registry: for each identifier its first detection in file order; earlier ``known`` ones stand."""
    rows = detections if known is None else detections.unionByName(known.select(*detections.columns).withColumn("file_seq", F.lit(-1).cast("long")))
    return rows.groupBy("mmsi").agg(F.min_by(F.struct(*[c for c in detections.columns if c != "mmsi"]), "file_seq").alias("d")).select("mmsi", "d.*")


def kept_registry(registry: DataFrame) -> tuple[DataFrame, bool]:
    """The registry, written once so that detection runs once, and whether it is small enough to be broadcast."""
    places = keep(registry, "registry")
    return places, places.count() <= FEW


def assign_clusters(df: DataFrame, registry: DataFrame, few: bool = False) -> DataFrame:
    """Adds cluster_assignment: A or B in the file of the first detection and after it, null for others.

    A registry of up to ``FEW`` identifiers (``few``, as ``kept_registry`` says) is broadcast, so rows are not dealt out anew; a larger one joins by a shuffle.
    """
    places = registry.select("mmsi", F.col("file_seq").alias("_from"), "a_lat", "a_lon", "b_lat", "b_lon")
    near = nearest_cluster(F.col("lat"), F.col("lon"), *[F.col(c) for c in ("a_lat", "a_lon", "b_lat", "b_lon")])
    known = F.coalesce(F.col("file_seq") >= F.col("_from"), F.lit(False))
    joined = df.join(F.broadcast(places) if few else places, "mmsi", "left")
    return joined.withColumn("cluster_assignment", F.when(known, near)).drop("_from", "a_lat", "a_lon", "b_lat", "b_lon")
