"""Connected components of a link table by alternating large-star and small-star steps, all in DataFrames; a few links are solved in one task, with the same result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_labels, materialize, shared_path, skew_join, temporary

#: Links that one task solves: some megabytes, and far less time than the jobs of a round take.
FEW_LINKS = 15_000


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links, kind = [], None
    for b in batches:
        kind = b.column(0).type
        links += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
    if not links:
        return
    nodes = sorted({x for link in links for x in link})
    place = {x: i for i, x in enumerate(nodes)}
    ends = np.array([(place[u], place[v]) for u, v in links])
    labels = join_labels(np.arange(len(nodes)), ends[:, 0], ends[:, 1])
    moved = np.flatnonzero(labels != np.arange(len(nodes))).tolist()
    yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in moved], kind), pa.array([nodes[labels[i]] for i in moved], kind)], names=["node", "root"])


def components(links: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """From links (u, v): (node, root) for every linked node that is not itself the smallest of its component.

    Each round points every node at smaller ones of its neighbourhood until all point at the root, in a number of rounds that grows with the logarithm of a component's width. Rounds are written to shared storage, and their steps go when they are. Nodes with many neighbours are joined by broadcast.
    """
    edges = materialize(links.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    if edges.count() <= FEW_LINKS:
        kind = edges.schema["u"].dataType.simpleString()
        return materialize(edges.coalesce(1).mapInArrow(_solve, f"node {kind}, root {kind}"), "roots")
    before = None
    for _ in range(most_rounds):
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == before:
            break
        before = tuple(mark)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        path = shared_path(links.sparkSession, "small")
        with temporary(links.sparkSession):
            least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("_w")), "least")
            large = materialize(skew_join(both.filter(F.col("v") > F.col("u")), least, "u", "_w", "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
            least = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_w")), "least")
            moved = skew_join(large, least, "u", "_w", "inner").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            edges = materialize(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small", path)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
