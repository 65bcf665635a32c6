"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, scanned against every training token window.

Words are runs of digits, letters a-z (A-Z lower-cased) and any character beyond ASCII. A benchmark item gives its windows of ``n`` consecutive words, or, if it has fewer, its whole sequence as one. Documents are scanned as byte arrays: word hashes from prefix sums of a polynomial, window hashes from word hashes, a bitmap to pass over almost all windows, then the word-for-word comparison with the benchmark's window. No document is shuffled.

The broadcast has a checked size: a benchmark beyond ``BLOCK_BYTES`` of text is split into blocks (equal items once, long items in pieces that overlap by ``n`` - 1 words), each scanned in a pass of its own. A pass writes nothing but what it hit, by a hash of the text; the last one gets what was hit before joined to its rows, by broadcast if that is little. Texts are never written.

Defined results: null or empty texts have no words and no hits; benchmark items without words, with a null text, have no windows; windows of items with a null id count as hits but name no item. Repeated rows give repeated rows, repeated items count once by id. An empty benchmark hits nothing. Extra columns are kept (by ``find_contamination``, unless named like an output). A text of any length is hashed in pieces; held per word are a hash and two offsets. A word has one hash wherever it stands, so words of any length are found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, free_name, map_rows, materialize, skew_join

N = 10
#: Bytes of benchmark text whose windows go into one broadcast, about 20 bytes a byte of text.
BLOCK_BYTES = 8 << 20

#: Texts hit in earlier blocks, and spans of these together, that are broadcast to the last one's rows.
FEW_HITS, FEW_SPANS = 100_000, 1_000_000

_PIECE = 1 << 18
#: Words of more bytes are hashed by digest, all others by whole arrays.
_LONG = 1 << 12
_MASK = np.uint64(2**64 - 1)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BITS = 20


def _is_word() -> np.ndarray:
    table = np.zeros(256, dtype=np.int8)
    for a, b in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
        table[a:b] = 1
    return table


class WordHasher:
    """Splits lower-cased bytes into words and hashes each, by whole arrays. A word's hash depends on its bytes alone."""

    def __init__(self) -> None:
        self.table = _is_word()
        size = _PIECE + _LONG + 1
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE, dtype=np.uint64)]), dtype=np.uint64)
        inverse = pow(_BASE, -1, 2**64)
        self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse, dtype=np.uint64)]), dtype=np.uint64)

    def _piece(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Only the last word of a piece can reach beyond ``_PIECE``, so any other that does not go by digest lies within the powers."""
        a = np.frombuffer(data, dtype=np.uint8)
        edge = np.diff(self.table[a], prepend=np.int8(0), append=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        near = a[: len(self.power) - 1]
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((near.astype(np.uint64) + np.uint64(1)) * self.power[: len(near)], dtype=np.uint64)])
        h = (total[np.minimum(end, len(near))] - total[np.minimum(start, len(near))]) * self.inverse[np.minimum(start, len(near))]
        h ^= h >> np.uint64(29)
        for i in np.flatnonzero(end - start > _LONG).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
        return h, start, end

    def _word_end(self, data: bytes, at: int) -> int:
        """The first place from ``at`` on that is in no word."""
        while at < len(data):
            gap = np.flatnonzero(self.table[np.frombuffer(data, dtype=np.uint8, count=min(_PIECE, len(data) - at), offset=at)] == 0)
            if len(gap):
                return at + int(gap[0])
            at += _PIECE
        return len(data)

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, starts and ends of the words of ``data``. Pieces end between words."""
        if len(data) <= _PIECE:
            return self._piece(data)
        out, at = [], 0
        while at < len(data):
            end = self._word_end(data, min(len(data), at + _PIECE))
            h, s, e = self._piece(data[at:end])
            out.append((h, s + at, e + at))
            at = end
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Of every ``n`` consecutive word hashes one."""
    if len(h) < n:
        return h[:0]
    w = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for k in range(n):
        w = w * _STEP + h[k : k + len(w)]
    return w ^ (w >> np.uint64(32))


@dataclass
class NgramSet:
    """Windows of benchmark items by length: a bitmap of hashes, and from each hash the windows with their items."""

    n: int
    bitmap: dict[int, np.ndarray] = field(default_factory=dict)
    items: dict[int, dict[int, list[tuple[bytes, list]]]] = field(default_factory=dict)

    @classmethod
    def build(cls, rows: list[tuple], n: int) -> NgramSet:
        self, hasher = cls(n), WordHasher()
        seen: dict[bytes, list] = {}
        for item, text in rows:
            data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
            h, start, end = hasher.words(data)
            if not len(h):
                continue
            k = min(n, len(h))
            w = window_hashes(h, k)
            by_hash = self.items.setdefault(k, {})
            for i, x in enumerate(w.tolist()):
                key = b" ".join(data[start[j] : end[j]] for j in range(i, i + k))
                if key not in seen:
                    seen[key] = []
                    by_hash.setdefault(x, []).append((key, seen[key]))
                if item is not None and item not in seen[key]:
                    seen[key].append(item)
        for k, by_hash in self.items.items():
            self.bitmap[k] = np.zeros(1 << _BITS, dtype=bool)
            self.bitmap[k][np.fromiter(by_hash, dtype=np.uint64, count=len(by_hash)) >> np.uint64(64 - _BITS)] = True
        return self

    def scan(self, data: bytes, h: np.ndarray, start: np.ndarray, end: np.ndarray, first: int, last: int, windows: dict[int, np.ndarray]) -> list[tuple[int, int, list]]:
        """(first word, length, items) of each verified window among words ``first`` to ``last``."""
        found = []
        for k, by_hash in self.items.items():
            w = windows[k][first : max(first, last - k + 1)]
            for i in (np.flatnonzero(self.bitmap[k][w >> np.uint64(64 - _BITS)]) + first).tolist():
                for key, items in by_hash.get(int(windows[k][i]), ()):
                    if key == b" ".join(data[start[j] : end[j]] for j in range(i, i + k)):
                        found.append((i, k, items))
        return found


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
]


#: The text without its hit spans.
CUT = T.StructField("cut_text", T.StringType())


def _merge(spans: list) -> list[list[int]]:
    """Spans in order, those that touch or overlap joined."""
    out: list[list[int]] = []
    for s, e in sorted(map(tuple, spans)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _scanner(shared: Broadcast, cut: bool, before: bool):
    """Makes the function from texts to word counts, hits, items and the byte spans of hit words, merged; with ``cut`` also the text without them. With ``before`` rows are (t, spans, items): texts and what earlier blocks hit in them."""

    def make():
        grams = NgramSet(*shared.value)
        hasher = WordHasher()

        def many(rows: list) -> dict:
            texts = [r["t"] for r in rows] if before else rows
            out: dict[str, list] = {f.name: [] for f in [*FIELDS, *([CUT] if cut else [])]}
            datas = [(t or "").encode("utf-8", "surrogatepass").translate(LOWER) for t in texts]
            at = 0
            while at < len(datas):
                to, size = at, 0
                while to < len(datas) and (to == at or size + len(datas[to]) < _PIECE):
                    size += len(datas[to]) + 1
                    to += 1
                data = b"\n".join(datas[at:to])
                h, start, end = hasher.words(data)
                windows = {k: window_hashes(h, k) for k in grams.items}
                stops = np.cumsum([len(x) + 1 for x in datas[at:to]])
                cuts = [0, *np.searchsorted(start, stops).tolist()]
                offset = 0
                for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False), at):
                    found = grams.scan(data, h, start, end, a, b, windows) if b > a else []
                    hit = np.zeros(b - a + 1, dtype=np.int64)
                    items = set()
                    for w, k, names in found:
                        hit[w - a] += 1
                        hit[w - a + k] -= 1
                        items.update(names)
                    if before and rows[i]["spans"]:
                        items.update(rows[i]["items"])
                        old = np.array(_merge(rows[i]["spans"])) + offset
                        np.add.at(hit, np.searchsorted(start[a:b], old[:, 0]), 1)
                        np.add.at(hit, np.searchsorted(start[a:b], old[:, 1]), -1)
                    spans = []
                    n_hit = 0
                    if hit.any():
                        covered = np.concatenate([[0], (np.cumsum(hit)[:-1] > 0).astype(np.int8), [0]])
                        n_hit = int(covered.sum())
                        d = np.diff(covered)
                        spans = [[int(start[a + s]) - offset, int(end[a + e - 1]) - offset] for s, e in zip(np.flatnonzero(d == 1), np.flatnonzero(d == -1), strict=True)]
                    out["n_words"].append(b - a)
                    out["n_hit"].append(n_hit)
                    out["hit_items"].append(sorted(map(str, items)))
                    out["hit_spans"].append(spans)
                    if cut:
                        out[CUT.name].append(cut_spans(texts[i], spans) if spans else texts[i])
                    offset += len(datas[i]) + 1
                at = to
            return out

        return many

    return make


def _in_pieces(items: DataFrame, n: int, most: int) -> DataFrame:
    """(item_id, text) with texts of more than ``most`` bytes in pieces of about as many, which overlap by ``n`` - 1 words and so have the same windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
                if len(data) <= most:
                    parts = [text]
                else:
                    _, start, end = hasher.words(data)
                    parts, at = [], 0
                    while at < len(start):
                        to = min(len(start), max(at + n, int(np.searchsorted(end, start[at] + most))))
                        to = len(start) if len(start) - to < n else to
                        parts.append(data[start[at] : end[to - 1]].decode("utf-8", "surrogatepass"))
                        at = len(start) if to == len(start) else to - n + 1
                for i in range(0, len(parts), 64):
                    some = parts[i : i + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(some), pa.string()), pa.array(some, pa.string())], names=["item_id", "text"])

    return items.mapInArrow(run, "item_id string, text string")


def _blocks(benchmark: DataFrame, n: int, block_bytes: int) -> Iterator[list[tuple]]:
    """Different items in parts of bounded size: at most about ``block_bytes`` each, in pieces of at most a 64th of that or ``n`` words."""
    items = benchmark.distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= block_bytes:
        yield [tuple(r) for r in items.collect()]
        return
    pieces = materialize(_in_pieces(items, n, max(1, block_bytes // 64)), "items")
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0]
    parts = -(-total // block_bytes) + 1
    for i in range(parts):
        yield [tuple(r) for r in pieces.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = N, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, cut: bool = False) -> DataFrame:
    """``docs`` with n_words, n_hit (words within any occurring window), hit_items (ids as strings, sorted as strings) and hit_spans (merged [start, end) byte offsets in UTF-8); with ``cut`` also cut_text."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text"))
    spark = docs.sparkSession
    fields = [*FIELDS, *([CUT] if cut else [])]

    def share(block: list[tuple]) -> Broadcast:
        grams = NgramSet.build(block, n)
        return spark.sparkContext.broadcast((grams.n, grams.bitmap, grams.items))  # plain values: a broadcast carries no classes

    hits, last = None, None
    for block in _blocks(items, n, block_bytes):
        if last is not None:
            found = map_rows(docs.select(F.col(text_col).alias("t")), "t", FIELDS, _scanner(last, False, False)).filter("n_hit > 0")
            some = materialize(found.groupBy(F.md5("t").alias("th")).agg(F.first("hit_spans").alias("spans"), F.first("hit_items").alias("items"), F.count("*").alias("_w")), "hits")
            hits = some if hits is None else hits.unionByName(some)
        last = share(block)
    if hits is None:
        return map_rows(docs, text_col, fields, _scanner(last, cut, False))
    # At most one row a text and block meets here.
    met = materialize(hits.groupBy("th").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"), F.max("_w").alias("_w")), "met")
    names = [free_name(["th", "spans", "items"], f"_c{i}") for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    own = docs.toDF(*names).withColumn("th", F.coalesce(F.md5(names[at]), F.lit("")))
    size = met.agg(F.count("*"), F.coalesce(F.sum(F.size("spans") + F.size("items")), F.lit(0))).first()
    joined = own.join(F.broadcast(met.drop("_w")), "th", "left") if size[0] <= FEW_HITS and size[1] <= FEW_SPANS else skew_join(own, met, "th", "_w")
    packed = joined.select(*names, F.struct(F.col(names[at]).alias("t"), "spans", "items").alias("_in"))
    out = map_rows(packed, "_in", fields, _scanner(last, cut, True)).drop("_in")
    replaced = {f.name.lower() for f in fields}
    return out.select(*[F.col(a).alias(b) for a, b in zip(names, docs.columns, strict=True) if b.lower() not in replaced], *[f.name for f in fields])


def cut_spans(text: str, spans: list) -> str:
    """The text without the byte spans, a space where one was inside."""
    data, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    for s, e in spans:
        out.append(data[at:s])
        at = e
    out.append(data[at:])
    return b" ".join(x.strip() for x in out if x.strip()).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, mode: str = "document", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without hit documents (mode ``document``), or with the hit spans cut out of their texts (``span``). Columns stay as they are."""
    if mode not in ("document", "span"):
        raise ValueError(f"mode {mode!r}: document or span")
    names = [free_name(docs.columns, f"_c{i}") for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    found = find_contamination(docs.toDF(*names), benchmark, text_col=text, cut=mode == "span", **options)
    if mode == "document":
        found = found.filter(F.col("n_hit") == 0)
    return found.select(*[F.col(CUT.name if a == text and mode == "span" else a).alias(b) for a, b in zip(names, docs.columns, strict=True)])
