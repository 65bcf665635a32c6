"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target size; each of its documents the same expected number of copies, target / size of the source. The whole part of that is taken; the fractional parts are rounded dependently: two documents at a time transfer mass (probability times size) at random, up or down so that expectations stay, until one's probability is 0 or 1. The source's expected total therefore never moves; when one document is left with a fraction it is drawn alone, so a source ends within one document of its target, and every document's expected copies are exactly target / size, whatever its length. There is one set of draws, never a choice among several.

The work forms a tree: leaves are groups of about ``LEAF`` documents of a source, rounded each in one task until one document is left in each; the left ones meet in pairs, in groups of ``FAN``, at the next level, and so on to the root. In a leaf all have the same fraction, and the largest document is paired with the rest of them as one, which gives or takes the mass evenly; when it is settled the next largest is, against what then is left. So a long document can be settled at all, the rest making up for it, and the one left over in the end is one of the smallest. No group grows with the input, however large a source or however often a row is repeated: equal rows are counted first and dealt out ``CHUNK`` at a time. Groups depend on ids and hashes of texts alone and draws on a hash, so reruns agree whatever the partitioning.

Defined results: null and empty texts have size 0, no copies and nothing taken. A null source is a source, last in order. Repeated rows are rounded one by one. Extra columns are kept by ``mix`` and ignored by ``mix_counts``. An empty table gives an empty result. Copies never exceed ``max_repeats``. Any number of sources: targets of up to ``FEW_SOURCES`` are worked out on the driver and broadcast, those of more in a table, with the same result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, free_name, materialize, skew_join

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3.0
#: Documents rounded in one leaf, and leaves' residuals that meet in one group.
LEAF, FAN = 500, 64
#: Equal rows that go to a leaf together.
CHUNK = 64
#: Sources whose targets are worked out on the driver and broadcast.
FEW_SOURCES = 10_000


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], max_repeats: float = MAX_REPEATS) -> list[float]:
    """Shares of the total by weight, each at most ``max_repeats`` times its source's size; what is above goes to the others by weight."""
    got = [0.0] * len(sizes)
    left, active = float(sum(sizes)), list(range(len(sizes)))
    while active and left > 0:
        per = left / sum(weights[i] for i in active)
        over = [i for i in active if weights[i] * per > max_repeats * sizes[i]]
        if not over:
            for i in active:
                got[i] = weights[i] * per
            break
        for i in over:
            got[i] = max_repeats * sizes[i]
            left -= got[i]
        active = [i for i in active if i not in set(over)]
    return got


def duel(p: np.ndarray, w: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds ``p`` in order: the document left with a fraction meets the next. Mass p * w moves from one to the other and stays in sum. Returns the probabilities, all 0 or 1 but at most one, and that one's index or -1."""
    p = p.tolist()
    w = w.tolist()
    carry = -1
    for j, x in enumerate(p):
        if not 0.0 < x < 1.0:
            continue
        if carry < 0:
            carry = j
            continue
        i = carry
        a, b, wi, wj = p[i], x, w[i], w[j]
        up = min((1.0 - a) * wi, b * wj)
        down = min(a * wi, (1.0 - b) * wj)
        if u[j] * (up + down) < down:  # up with chance down / (up + down), so that the expected move is 0
            whole = (1.0 - a) * wi <= b * wj
            p[i], p[j] = (1.0 if whole else a + up / wi), (b - up / wj if whole else 0.0)
        else:
            whole = a * wi <= (1.0 - b) * wj
            p[i], p[j] = (0.0 if whole else a - down / wi), (b + down / wj if whole else 1.0)
        for k in (i, j):
            if p[k] < 1e-12:
                p[k] = 0.0
            elif p[k] > 1 - 1e-12:
                p[k] = 1.0
        carry = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return np.array(p, dtype=float), carry


def settle(p: float, w: np.ndarray, u: np.ndarray, last: bool) -> tuple[np.ndarray, int]:
    """Rounds documents that all have probability ``p``, largest first: each meets the rest as one, and mass moves between them, evenly over the rest, until the document or the whole rest is at 0 or 1. Returns what ``duel`` does.

    A rest that is too small to make up for a document is at 0 or 1 before the document is. Where others follow (not ``last``) the document is then left with a fraction. At the root it is drawn, and the rest makes up for as much as it can with all expectations kept: no more than the mass of that document can then be missing.
    """
    out, n = np.zeros(len(w)), len(w)
    rest = np.append(np.cumsum(w[::-1])[::-1], 0.0).tolist()
    w, u = w.tolist(), u.tolist()
    for i in range(n):
        if p < 1e-12 or p > 1 - 1e-12:
            out[i:] = round(p)
            return out, -1
        s = rest[i + 1]
        if last and s > 0.0:
            out[i] = float(u[i] < p)
            share = min(w[i] / s, p / (1.0 - p), (1.0 - p) / p)
            p = min(1.0, max(0.0, p + share * (p - out[i])))
            continue
        up, down = min((1.0 - p) * w[i], p * s), min(p * w[i], (1.0 - p) * s)
        if s <= 0.0:
            out[i] = p
            return out, i
        more = u[i] * (up + down) < down
        move = up if more else -down
        if whole := ((1.0 - p) * w[i] <= p * s if more else p * w[i] <= (1.0 - p) * s):
            out[i], p = float(more), min(1.0, max(0.0, p - move / s))
        if not whole:
            out[i], out[i + 1 :] = p + move / w[i], 0.0 if more else 1.0
            return out, i if 1e-12 < out[i] < 1 - 1e-12 else -1
    return out, -1


_STATE = "doc_id {id}, source string, size long, source_size long, target double, copies long, p double, tie long, rank long, n long, leaf long, mark long"


def _uniform(ids: np.ndarray, level: int, seed: int) -> np.ndarray:
    """A draw from [0, 1) for each hash, by splitmix64."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1) + seed * 0xD1342543DE82EF95) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(float) / 2.0**53


def round_rows(size: np.ndarray, p: np.ndarray, names: np.ndarray, level: int, seed: int, last: bool) -> np.ndarray:
    """``p`` of one group, largest first, rounded until one fraction is left; at the root (``last``) that one is drawn alone. ``names`` tell the rows' draws apart."""
    draws = _uniform(names, level, seed)
    some = np.flatnonzero((p > 0.0) & (p < 1.0))
    if level == 0 and len(some):
        p = p.copy()
        p[some], left = settle(float(p[some[0]]), size[some], draws[some], last)
        left = int(some[left]) if left >= 0 else -1
    else:
        p, left = duel(p, size, draws)
    if last and left >= 0:
        p[left] = float(_uniform(names[left : left + 1], level + 1000, seed)[0] < p[left])
    return p


def _round_group(level: int, seed: int, last: bool):
    """Rows of a source's leaf (level 0) or of the ones left over by several groups."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        times = pdf["n"].to_numpy()
        pdf = pdf.iloc[np.repeat(np.arange(len(pdf)), times)]
        pdf = pdf.assign(rank=pdf["rank"].to_numpy() + np.arange(len(pdf)) - np.repeat(np.cumsum(times) - times, times), n=1)
        pdf = pdf.sort_values(["size", "tie", "rank"], ascending=[False, True, True], kind="stable", ignore_index=True)
        with np.errstate(over="ignore"):
            names = pdf["tie"].to_numpy().view(np.uint64) + pdf["rank"].to_numpy().astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        p = round_rows(pdf["size"].to_numpy(dtype=float), pdf["p"].to_numpy(dtype=float), names, level, seed, last)
        pdf["copies"] = pdf["copies"] + (p == 1.0).astype(np.int64)
        pdf["p"] = np.where((p > 0.0) & (p < 1.0), p, 0.0)
        return pdf

    return run


def source_targets(counts: DataFrame, weights: Sequence[float], max_repeats: float) -> list[tuple]:
    """(source, size, documents, target) from (source, s, n) of each source, by code point, null last. ``weights`` repeat over that order."""
    rows = counts.collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["s"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], max_repeats)
    return [(r["source"], r["s"], r["n"], t) for r, t in zip(rows, goal, strict=True)]


def table_targets(counts: DataFrame, weights: Sequence[float], max_repeats: float) -> DataFrame:
    """As ``source_targets``, as a table (source, s, n, target): places in order are counts within ranges and of the ranges before; the share of a unit of weight rises, one aggregate a step, until no source is above its limit."""
    order = [F.col("source").isNull(), F.col("source")]
    ranged = materialize(counts.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranged")
    before = ranged.groupBy("_p").agg(F.count("*").alias("_k")).withColumn("_before", F.sum("_k").over(W.orderBy("_p")) - F.col("_k"))
    place = F.row_number().over(W.partitionBy("_p").orderBy(*order)) - 1 + F.col("_before")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    known = materialize(ranged.join(F.broadcast(before.drop("_k")), "_p").select("source", "s", "n", weight.alias("_w")), "weighted")
    total = float(known.agg(F.sum("s")).first()[0] or 0)
    limit = float(max_repeats) * F.col("s")
    per = 0.0
    while True:
        over = F.col("_w") * F.lit(per) > limit
        got = known.agg(F.sum(F.when(over, limit).otherwise(0.0)).alias("taken"), F.sum(F.when(over, 0.0).otherwise(F.col("_w"))).alias("w")).first()
        now = (total - got["taken"]) / got["w"] if got["w"] else per
        if now <= per:
            break
        per = now
    return known.select("source", "s", "n", F.least(F.col("_w") * F.lit(per), limit).alias("target"))


def _with_targets(rows: DataFrame, weights: Sequence[float], max_repeats: float, leaf: int) -> tuple[DataFrame, int]:
    """``rows`` (source, size, n and more) with source_size, target and _leaves of their source, and the most leaves that a source has."""
    counts = materialize(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s"), F.sum("n").alias("n")), "sources")
    keyed = rows.withColumns({"_null": F.col("source").isNull(), "_source": F.coalesce("source", F.lit(""))})
    leaves = F.greatest(F.lit(1), F.ceil(F.col("n") / leaf)).cast("long")
    if counts.count() <= FEW_SOURCES:
        found = source_targets(counts, weights, max_repeats)
        spec = rows.sparkSession.createDataFrame(found, "source string, s long, n long, target double")
    else:
        spec = materialize(table_targets(counts, weights, max_repeats), "targets")
    spec = spec.select(F.col("source").isNull().alias("_null"), F.coalesce("source", F.lit("")).alias("_source"), F.col("s").alias("source_size"), "target", leaves.alias("_leaves"), F.col("n").alias("_w"))
    most = counts.agg(F.max("n")).first()[0] or 0
    joined = keyed.join(F.broadcast(spec.drop("_w")), ["_null", "_source"]) if counts.count() <= FEW_SOURCES else skew_join(keyed, spec, ["_null", "_source"], "_w", "inner")
    return joined, max(1, math.ceil(most / leaf))


def mix_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS, seed: int = 42, leaf: int = LEAF, fan: int = FAN, marks: bool = False) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (of its source), copies and taken (copies * size). With ``marks`` also mark, a hash of the text."""
    sizes = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("mark")), "sizes")
    rows = materialize(sizes.groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("n")), "rows")
    keyed, most = _with_targets(rows, weights, max_repeats, leaf)
    many = CHUNK * 4096
    keyed = keyed.withColumn("_far", F.explode(F.expr(f"sequence(0L, (n - 1) div {many}L)")))
    keyed = keyed.withColumn("_near", F.explode(F.expr(f"sequence(0L, (least({many}L, n - _far * {many}L) - 1) div {CHUNK}L)")))
    first = F.col("_far") * many + F.col("_near") * CHUNK
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rate = F.least(rate, F.lit(float(max_repeats)))
    near = F.when(F.abs(rate - F.round(rate)) < 1e-12, F.round(rate)).otherwise(rate)
    state = keyed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.floor(near)).otherwise(0).cast("long").alias("copies"),
        F.when(F.col("size") > 0, near - F.floor(near)).otherwise(0.0).alias("p"),
        F.xxhash64("doc_id", "size", "mark").alias("tie"),
        first.alias("rank"),
        F.least(F.lit(CHUNK), F.col("n") - first).cast("long").alias("n"),
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "mark", first), F.col("_leaves")).alias("leaf"),
        "mark",
    )
    schema = _STATE.format(id=sizes.schema["doc_id"].dataType.simpleString())
    levels = 0
    while most > 1:
        levels, most = levels + 1, math.ceil(most / fan)
    done = None
    for level in range(levels + 1):
        state = materialize(state.groupBy("source", "leaf").applyInPandas(_round_group(level, seed, level == levels), schema), "rounded")
        settled = state.filter(F.col("p") == 0.0)
        done = settled if done is None else done.unionByName(settled)
        state = state.filter(F.col("p") > 0.0).withColumn("leaf", F.floor(F.col("leaf") / fan))
    return done.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["mark"] if marks else []))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", copies_as: str = "copies", **options) -> DataFrame:
    """The mixture: each document that is taken, with its columns and its number of copies. Rows with the same id, source and text share out their copies by rank, so repeated rows keep their own."""
    counts = mix_counts(docs, id_col=id_col, text_col=text_col, source_col=source_col, marks=True, **options)
    keys = ["_id", "_s", "_m"]
    taken = materialize(counts.groupBy(*[F.col(c).alias(k) for c, k in zip(("doc_id", "source", "mark"), keys, strict=True)]).agg(F.sum("copies").alias("_c"), F.count("*").alias("_rows")).filter("_c > 0"), "taken")
    name = free_name(docs.columns, copies_as)
    names = [free_name(keys, f"_c{i}") for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    at = {c: own[names[docs.columns.index(c)]] for c in (id_col, text_col, source_col)}
    joined = own.join(taken, at[id_col].eqNullSafe(taken["_id"]) & at[source_col].cast("string").eqNullSafe(taken["_s"]) & (F.xxhash64(at[text_col]) == taken["_m"]))
    # A source's draws are a number or one more, so the sum over repeated rows says how many of them have one more.
    copies, more = F.expr("_c div _rows"), F.col("_c") % F.col("_rows")
    if taken.filter(more > 0).isEmpty():
        return joined.select(*names, copies).toDF(*docs.columns, name)
    joined = materialize(joined.withColumn("_p", F.spark_partition_id()), "joined")
    # Ranks count on from one partition to the next, so that a row repeated often is not one task.
    parts = joined.filter(more > 0).groupBy(*keys, "_p").agg(F.count("*").alias("_k"))
    before = F.sum("_k").over(W.partitionBy(*keys).orderBy("_p")) - F.col("_k")
    parts = parts.select(*[F.col(k).alias(f"b{k}") for k in [*keys, "_p"]], before.alias("_before"))
    same = [joined[k].eqNullSafe(parts[f"b{k}"]) for k in [*keys, "_p"]]
    ranked = joined.filter(more > 0).join(parts, same).withColumn("_rank", F.row_number().over(W.partitionBy(*keys, "_p").orderBy("_p")) + F.col("_before"))
    ranked = ranked.select(*names, (copies + (F.col("_rank") <= more).cast("long")).alias("_c"))
    whole = joined.filter(more == 0).select(*names, copies.alias("_c"))
    return whole.unionByName(ranked).filter("_c > 0").toDF(*docs.columns, name)
