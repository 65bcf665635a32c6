"""Quality rules on documents and, from their failures, on hosts.

Base rules look at one text: too few words, or too many words in repeated five-word windows. Their failures are counted by host (any column that names a document's origin); a beta prior fitted by moments over all hosts shrinks each host's failure rate; documents of hosts whose shrunk rate is above ``max_host_rate`` go too.

That threshold is 0.8 because a rejected host takes its passing documents with it: above a rate of r it gives up at most (1 - r) / r passing documents for each failing one, at 0.8 one for four; at a mere majority it would be as many good ones as bad. The rate is shrunk, so a host of few documents needs more than that to fall.

Defined results: a null or empty text has no words and fails. A null host is a host of its own and can fall like any other. Repeated rows are judged and counted one by one. Columns of the input with the name of an output are replaced. An empty table gives an empty result. Texts of any length are judged whole; per word a few integers are held.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HOT_KEYS, map_rows, materialize, skew_join

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.8
SALTS = 64

STATS = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]

_SPACE = " \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"


def _ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs, different for different ones."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in windows of so many words that occur twice or more, the first occurrence included. Windows are compared exactly: pairs of ranks are ranked again until they span the window."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    single = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    if len(ids) == len(words):
        return 0
    rank, span = single, 1
    while span < window:
        step = min(span, window - span)
        more = rank[span:] if step == span else single[span:]
        if step < span:
            step = 1
        size = min(len(rank), len(more))
        rank, span = _ranks(rank[:size], more[:size]), span + step
    twice = np.bincount(rank)[rank] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in _SPACE),
        len(data) - len(data.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def document_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the five counts of STATS."""

    def make():
        names = [f.name for f in STATS]
        return lambda texts: dict(zip(names, zip(*map(text_stats, texts), strict=True) if texts else [[]] * len(names), strict=True))

    return map_rows(docs, text_col, STATS, make)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_verdicts(counts: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """From (host, n, failed): host, n, rate (shrunk) and rejected.

    The prior Beta(a, b) has the mean of all documents and the strength that the spread of the hosts' rates implies (moments, weighted by n).
    """
    t = counts.agg(F.sum("n").alias("n"), F.sum("failed").alias("f"), F.count("*").alias("k"), F.sum(F.col("n").cast("double") * F.col("n")).alias("n2")).first()
    if not t["n"]:
        return counts.select("host", "n", F.lit(0.0).alias("rate"), F.lit(False).alias("rejected"))
    mean = t["f"] / t["n"]
    dev = counts.agg(F.sum(F.col("n") * F.pow(F.col("failed") / F.col("n") - F.lit(mean), 2)).alias("d")).first()["d"]
    spread, room = mean * (1 - mean), t["n"] - t["n2"] / t["n"] - (t["k"] - 1)
    rho = min(0.999, max(0.001, (dev / spread - (t["k"] - 1)) / room)) if spread > 0 and room > 0 else 0.001
    strength = 1 / rho - 1
    rate = (F.lit(strength * mean) + F.col("failed")) / (F.lit(strength) + F.col("n"))
    return counts.select("host", "n", rate.alias("rate"), (rate > max_rate).alias("rejected"))


def judge_quality(docs: DataFrame, *, text_col: str = "text", host_col: str = "source", max_host_rate: float = MAX_HOST_RATE, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of each document (all by default), the counts of STATS, ``base_failed`` and ``kept``.

    Texts are read once: the counts, with the kept columns, are written to shared storage; hosts are counted from there.
    """
    keep = docs.columns if keep is None else keep
    columns = [F.col(text_col).alias("_text"), F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")).alias("host"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]]
    stats = document_stats(docs.select(*columns), "_text").drop("_text")
    stats = materialize(stats.withColumn("base_failed", base_failed()), "quality")
    counts = materialize(stats.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts")
    verdicts = materialize(host_verdicts(counts, max_host_rate).select("host", F.col("n").alias("_w"), "rejected"), "verdicts")
    judged = skew_join(stats, verdicts, "host", "_w")
    drop = {f.name for f in STATS} | {"base_failed", "kept"}
    return judged.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep) if c not in drop], *[f.name for f in STATS], "base_failed", (~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame, *, text_col: str = "text", host_col: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that the rules and their host's rate leave, with their own columns.

    Texts are judged once and written to shared storage, those that fail without any text; hosts are counted from there, and rows of rejected hosts dropped by a broadcast if these are few, else by a salted join.
    """
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit(""))
    columns = [F.col(text_col).alias("_text"), host.alias("host"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(docs.columns)]]
    judged = document_stats(docs.select(*[c for c, n in zip(columns, ["", "", *docs.columns], strict=True) if n != text_col]), "_text")
    names = [f"_k{i}" for i, c in enumerate(docs.columns) if c != text_col]
    slim = judged.select("host", base_failed().alias("base_failed"), F.when(~base_failed(), F.col("_text")).alias("_text"), *[F.when(~base_failed(), F.col(n)).alias(n) for n in names])
    slim = materialize(slim, "quality")
    counts = materialize(slim.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts")
    rejected = materialize(host_verdicts(counts, max_host_rate).filter("rejected").select("host"), "rejected")
    good = slim.filter(~F.col("base_failed"))
    if rejected.count() <= HOT_KEYS:
        good = good.join(F.broadcast(rejected), "host", "left_anti")
    else:
        salted = rejected.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        good = good.withColumn("_salt", F.pmod(F.xxhash64("_text"), F.lit(SALTS)).cast("int")).join(salted, ["host", "_salt"], "left_anti")
    return good.select(*[F.col("_text" if c == text_col else f"_k{i}").alias(c) for i, c in enumerate(docs.columns)])
