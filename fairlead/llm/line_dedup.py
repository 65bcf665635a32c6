"""Line dedup by overlapping three-line windows.

Of each text's lines those with a word are numbered; every ``WINDOW`` consecutive ones form a window, known by two 64-bit hashes (together 128 bits, so that chance matches are out of the question at any size). Windows are counted over all documents. The first occurrence, by document id and place, stays; all later ones mark their lines, marked ranges that touch or overlap are merged, and marked lines go. Every removed line has an equal one earlier that stays.

Windows are counted with partial sums and joined back with hot windows by broadcast, so a window found in a third of all documents meets in no task.

Defined results: null and empty texts, and texts with fewer than ``WINDOW`` lines with words, have no window and stay as they are. Lines without a word are never removed. Rows with the same id and text are one document: they don't count against each other and are cut alike. Of different texts with one id the one that is first by a hash of the text counts as earlier, an order that is arbitrary but the same in every run. A null id sorts first. Extra columns are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, free_name, map_rows, materialize, skew_join

WINDOW = 3

FIELDS = [T.StructField("_new", T.StringType()), T.StructField("_n_lines", T.LongType()), T.StructField("_n_removed", T.LongType())]


def _worded(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))


def windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, th, at, a, b) of each window of docs (id, text): hash of the text, number of the first line, the window's hashes."""
    lines = docs.select("id", F.xxhash64("text").alias("th"), _worded(F.col("text")).alias("lines")).filter(F.size("lines") >= window)
    parts = lambda i: [F.col("lines")[i + k] for k in range(window)]
    each = F.transform(F.sequence(F.lit(0), F.size("lines") - window), lambda i: F.struct(i.alias("at"), F.xxhash64(*parts(i)).alias("a"), F.xxhash64(F.lit("b"), *parts(i)).alias("b")))
    return lines.select("id", "th", F.inline(each))


def repeats(found: DataFrame) -> DataFrame:
    """Of materialised windows those that are later occurrences: id, th and their places as an array for each document."""
    place = F.struct("id", "th", "at")
    known = materialize(found.groupBy("a", "b").agg(F.count("*").alias("_w"), F.min(place).alias("first")).filter("_w > 1"), "repeated")
    later = skew_join(found, known, ["a", "b"], "_w", "inner").filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "th").agg(F.collect_set("at").alias("at"))


def cut_lines(text: str | None, at: list | None, window: int = WINDOW) -> tuple[str | None, int, int]:
    """The text without the lines of windows ``at``, its lines, and how many of them went."""
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    if not at:
        return text, len(lines), 0
    worded = [i for i, x in enumerate(lines) if x.strip(" \t\n\r\x0b\x0c")]
    edge = np.zeros(len(worded) + 1, dtype=np.int64)
    first = np.array(at)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + window, -1)
    gone = {worded[i] for i in np.flatnonzero(np.cumsum(edge)[:-1]).tolist()}
    return "\n".join([x for i, x in enumerate(lines) if i not in gone]), len(lines), len(gone)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the texts cut. ``counts`` names two more columns: lines, and removed lines."""
    found = materialize(windows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), window), "windows")
    marks = repeats(found)
    names = [free_name(docs.columns, f"_c{i}") for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    a, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    joined = own.join(marks, own[a].eqNullSafe(marks["id"]) & (F.xxhash64(own[text]) == marks["th"]), "left")
    packed = joined.select(*[c for c in names if c != text], F.struct(F.col(text).alias("t"), F.col("at")).alias("_in"))

    def make():
        def many(rows: list) -> dict:
            got = [cut_lines(r["t"], r["at"], window) for r in rows]
            return {f.name: [g[i] for g in got] for i, f in enumerate(FIELDS)}

        return many

    out = map_rows(packed, "_in", FIELDS, make)
    more = [] if counts is None else [F.col("_n_lines").alias(counts[0]), F.col("_n_removed").alias(counts[1])]
    return out.select(*[F.col("_new" if n == text else n).alias(c) for n, c in zip(names, docs.columns, strict=True)], *more)
