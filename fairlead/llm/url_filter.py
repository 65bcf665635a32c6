"""URL filters: rules by host and path, then the reputation of hosts shrunk by empirical Bayes.

Labelled pages are counted by host, registered domain and public suffix. A bad share at each level is a beta-binomial posterior whose prior has the parent's posterior mean and a strength fitted by moments, so a host with few labels takes after its domain, a domain after its suffix, a suffix after all pages. A page is blocked if the lower bound of its host's bad share, a quantile of the beta posterior, is above ``max_bad``.

Reputation goes by the host's name: without user and port. Its registered domain is one label more than its public suffix, which is the longest that the table of suffixes has (``*.x``: any label before x; ``!y.x``: not y), else the last label. ``SUFFIXES`` has the most common suffixes of two labels; a full public list goes in by parameter. Numeric addresses are domains of their own and share a suffix.

Defined results: a null url, or one without ``://``, has empty host and path and the reputation of the empty host. Null labels and labels of unknown pages count nowhere; a page with repeated labels counts once and is bad if any label says so. Repeated rows give repeated rows and count each. Of equally long rules that fit, the one greatest as text wins. Any number of rules: ``RULES_AT_ONCE`` are looked up in a pass. Extra columns are ignored; of ``pages`` only the id and url are read. Empty tables give empty results; without labels nothing is blocked by reputation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, skew_join

#: Rules travel in the plan as literals, so many in a pass.
RULES_AT_ONCE = 10_000

#: Public suffixes of two labels, the most common ones. Fixed values.
SUFFIXES = """
co.uk org.uk ac.uk gov.uk me.uk net.uk ltd.uk plc.uk sch.uk com.au net.au org.au edu.au gov.au co.nz net.nz org.nz
co.jp ne.jp or.jp ac.jp go.jp com.br net.br org.br gov.br com.cn net.cn org.cn gov.cn edu.cn co.in net.in org.in
co.kr or.kr com.mx org.mx com.tr com.tw com.hk com.sg com.ar co.za co.il com.ua com.pl co.id
github.io gitlab.io blogspot.com wordpress.com netlify.app vercel.app herokuapp.com
""".split()
#: The suffix that all numeric addresses share.
ADDRESS = "#address"
_ADDRESS = r"^(\d{1,3}(\.\d{1,3}){3}|\[.*)$"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def name_of(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")


def domain_and_suffix(name: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host's name."""
    labels = F.split(name, r"\.", -1)
    n = F.size(labels)
    plain = F.array(*[F.lit(x) for x in sorted({x for x in suffixes if x[0] not in "*!"})] or [F.lit("")])
    wild = F.array(*[F.lit(x[2:]) for x in sorted(set(suffixes)) if x.startswith("*.")] or [F.lit("")])
    spared = F.array(*[F.lit(x[1:]) for x in sorted(set(suffixes)) if x.startswith("!")] or [F.lit("")])
    end = lambda k: F.array_join(F.slice(labels, n - k + 1, k), ".")

    def is_suffix(k: Column) -> Column:
        known = F.array_contains(plain, end(k)) | (F.array_contains(wild, F.when(k > 1, end(k - 1)).otherwise("")) & (k > 1))
        return known & ~F.array_contains(spared, end(k))

    lengths = F.filter(F.sequence(F.lit(1), n), is_suffix)
    length = F.greatest(F.lit(1), F.coalesce(F.array_max(lengths), F.lit(1)))
    address = F.rlike(name, F.lit(_ADDRESS))
    domain = F.when(address, name).otherwise(end(F.least(n, length + 1)))
    return domain, F.when(address, ADDRESS).otherwise(end(length))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule (host and path together; of equals the greatest text) that fits, as struct<n, text, action>, or null.

    Each of the host's suffixes is looked up in a literal map, so the work per row does not grow with the number of rules.
    """
    by_host: dict[str, list[Rule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    if not by_host:
        return F.lit(None).cast("struct<n:int,text:string,action:string,path:string>")
    entry = lambda r: F.struct(F.lit(len(r.text)).alias("n"), F.lit(r.text).alias("text"), F.lit(r.action).alias("action"), F.lit(r.path).alias("path"))
    table = F.create_map(*[x for h, rs in by_host.items() for x in (F.lit(h), F.array(*[entry(r) for r in rs]))])
    labels = F.split(host, r"\.", -1)
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = F.flatten(F.filter(F.transform(ends, lambda e: F.try_element_at(table, e)), lambda x: x.isNotNull()))
    return F.array_max(F.filter(known, lambda r: F.startswith(path, r["path"])))


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y) for x, y in zip(a.tolist(), b.tolist(), strict=True)])


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The continued fraction of the incomplete beta function, for x below (a + 1) / (a + b + 2), where it settles in about sqrt(max(a, b)) steps."""
    tiny = 1e-300
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    c, out = np.ones_like(d), d.copy()
    for m in range(1, 1_000_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            out = out * d * c
        if (np.abs(d * c - 1) < 1e-14).all():
            break
    return out


def beta_below(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The chance that a Beta(a, b) value is at most x."""
    a, b, x = (np.atleast_1d(np.asarray(v, dtype=float)) for v in np.broadcast_arrays(a, b, x))
    if not a.size:
        return x.copy()
    flip = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    inner = np.clip(y, 1e-300, 1 - 1e-16)
    got = np.exp(p * np.log(inner) + q * np.log1p(-inner) - _log_beta(p, q)) * _beta_fraction(p, q, inner) / p
    got = np.where(flip, 1 - got, got)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, np.clip(got, 0.0, 1.0)))


def beta_quantile(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """The value that a Beta(a, b) variable stays below with chance ``p``, by bisection."""
    low, high = np.zeros(len(a)), np.ones(len(a))
    for _ in range(40):
        mid = (low + high) / 2
        under = beta_below(a, b, mid) < p
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return (low + high) / 2


def _up(level: DataFrame, *keys: str) -> DataFrame:
    """Sums over the members of each parent, those that a level's strength is fitted from, and how many members there are."""
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    sums = {"_n": F.col("n"), "_bad": F.col("bad"), "_sq": n * n, "_hit": F.when(n > 0, bad * bad / n), "_some": F.when(n > 0, 1)}
    return level.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in sums.items()], F.count("*").alias("_members"))


def _strength(up: DataFrame) -> float:
    """Fitted prior strength of a level: the moment estimate of the intra-class correlation of ``bad`` out of ``n`` around the shares of the parents. All of it comes from sums by parent."""
    s = (
        up.filter(F.col("_n") > 0)
        .agg(
            F.sum(F.col("_hit") - F.col("_bad").cast("double") * F.col("_bad") / F.col("_n")).alias("dev"),
            F.sum("_bad").alias("bad"),
            F.sum("_n").alias("n"),
            F.sum("_some").alias("k"),
            F.count("*").alias("parents"),
            F.sum(F.col("_sq") / F.col("_n")).alias("c"),
        )
        .first()
    )
    if not s["n"]:
        return 1e3
    mean, free = s["bad"] / s["n"], s["k"] - s["parents"]
    spread, room = mean * (1 - mean), s["n"] - s["c"] - free
    if spread <= 0 or room <= 0:
        return 1e3
    rho = min(0.999, max(0.001, (s["dev"] / spread - free) / room))
    return 1 / rho - 1


def host_reputation(labelled: DataFrame, *, confidence: float = 0.95, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """From (name, n, bad) of all hosts, n labelled pages each or none: name, domain, suffix, n, bad, the posterior means of suffix, domain and host, and bad_lower, which the host's bad share is above with chance ``confidence``.

    A row per host. Levels are summed with partial sums; a domain or suffix with very many hosts joins by broadcast. The strengths are three numbers fetched by the driver.
    """
    domain, suffix = domain_and_suffix(F.col("name"), suffixes)
    hosts = materialize(labelled.select("name", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    by_domain = materialize(_up(hosts, "domain", "suffix"), "domains")
    domains = by_domain.select("domain", "suffix", F.col("_n").alias("n"), F.col("_bad").alias("bad"), "_members")
    by_suffix = materialize(_up(domains.drop("_members"), "suffix"), "suffixes")
    whole = _up(by_suffix.select(F.col("_n").alias("n"), F.col("_bad").alias("bad")))
    total = whole.first()
    base = (total["_bad"] + 1) / (total["_n"] + 2)
    ks, kd, kh = _strength(whole), _strength(by_suffix), _strength(by_domain)
    mean = lambda k, prior, n="n", bad="bad": (F.lit(k) * prior + F.col(bad)) / (F.lit(k) + F.col(n))
    sm = materialize(by_suffix.select("suffix", mean(ks, F.lit(base), "_n", "_bad").alias("suffix_mean"), F.col("_members").alias("_w")), "means")
    dm = skew_join(domains, sm, "suffix", "_w", "inner").select("domain", "suffix_mean", mean(kd, F.col("suffix_mean")).alias("domain_mean"), F.col("_members").alias("_w"))
    known = skew_join(hosts, materialize(dm, "means"), "domain", "_w", "inner")
    a = F.lit(kh) * F.col("domain_mean") + F.col("bad")
    rows = known.select("name", "domain", "suffix", "n", "bad", "suffix_mean", "domain_mean", (a / (F.lit(kh) + F.col("n"))).alias("host_mean"), a.alias("_a"), (F.lit(kh) + F.col("n") - a).alias("_b"))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = beta_quantile(batch.column(8).to_numpy(), batch.column(9).to_numpy(), 1 - confidence) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:8], pa.array(low, pa.float64())], names=[*batch.schema.names[:8], "bad_lower"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:8])
    return rows.mapInArrow(bounds, f"{kinds}, bad_lower double")


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url", max_bad: float = 0.5, confidence: float = 0.95, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict.

    ``outcomes`` has (page_id, bad boolean). Only hosts whose bound exceeds ``max_bad`` are joined back to pages.
    """
    host = host_of(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path_of(F.col(url_col)).alias("path"), name_of(host).alias("name"))
    marks = outcomes.filter(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    # Repeated pages are counted before they meet their labels; pages without an id never travel.
    some = urls.filter(F.col("page_id").isNotNull()).groupBy("page_id", "name").agg(F.count("*").alias("c")).join(marks, "page_id")
    counted = urls.groupBy("name").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"), F.count("*").alias("pages"))
    counted = counted.unionByName(some.select("name", F.col("c").alias("n"), (F.col("c") * F.col("bad")).alias("bad"), F.lit(0).cast("long").alias("pages")))
    hosts = materialize(counted.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("n", "bad", "pages")]), "counted")
    bad = host_reputation(hosts, confidence=confidence, suffixes=suffixes).filter(F.col("bad_lower") > max_bad)
    blocked = materialize(bad.select("name", F.lit(True).alias("_bad")).join(hosts.select("name", F.col("pages").alias("_w")), "name"), "blocked")
    judged = skew_join(urls, blocked, "name", "_w")
    first, *more = [rules[i : i + RULES_AT_ONCE] for i in range(0, len(rules), RULES_AT_ONCE)] or [[]]
    judged = judged.withColumn("_r", matching_rule(F.col("host"), F.col("path"), first))
    for block in more:
        judged = materialize(judged, "ruled").withColumn("_r", F.greatest("_r", matching_rule(F.col("host"), F.col("path"), block)))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("_r.text").alias("rule"),
        F.when(F.col("_r").isNotNull(), F.col("_r.action")).when(F.coalesce("_bad", F.lit(False)), "block").otherwise("allow").alias("verdict"),
    )
